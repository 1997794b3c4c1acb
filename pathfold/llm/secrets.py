"""Secret scans weighed by ownership across the corpus.  DataFrame functions only.

Spans come from splitting a text by a pattern: the lengths of the parts and of
the matches, summed up in order, are the matches' places.  Every candidate
value is hashed, and the hashes are counted over the whole corpus by distinct
repositories and owners: a value that several owners have is a widely copied
example, one that few have and that looks random is likely live.

Scale: texts are read once and not shuffled; what is shuffled is one row per
document and one per match.  Counts go by (value, owner, repository) first, so
that a value found everywhere is spread before it is summed up.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

#: kind, pattern, group of the value, least characters of the value; the first three are the base
KINDS = [
    ("assign", r"""(?:(?i)(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 28),
    ("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 0, 27),
]
BASE = [k for k, *_ in KINDS[:3]]
PLACEHOLDER = r"(?i)example|changeme|change_me|placeholder|your_|dummy|sample|xxxx|0000|1234"


def _matches(text: Column, kind: int) -> Column:
    """Array of (kind, i, gap before, length, value) of all matches of a kind."""
    _, pattern, group, _ = KINDS[kind]
    parts, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.length(p))
    rows = F.transform(F.arrays_zip(gaps.alias("g"), whole.alias("m"), values.alias("v")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), x["g"].alias("gap"), F.length(x["m"]).alias("n"), x["v"].alias("value")))
    return F.when(text.rlike(pattern), rows)


def spans(docs: DataFrame, repository: str, owner: str) -> DataFrame:
    """One row per match that is long enough, with its place, and one with null
    kind for every document: row (any number, one per document), doc_id, kind
    (number in KINDS), start, end (code points, end exclusive), value,
    repository, owner."""
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"),
                       F.col(repository).cast("string").alias("repository"), F.col(owner).cast("string").alias("owner"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = F.concat(*[F.coalesce(_matches(F.col("text"), k), F.expr(
        "cast(array() as array<struct<kind:int,i:int,gap:int,n:int,value:string>>)")) for k in range(len(KINDS))])
    nothing = F.expr("cast(null as struct<kind:int,i:int,gap:int,n:int,value:string>)")
    rows = read.select("row", "doc_id", "repository", "owner", F.explode(F.concat(F.array(nothing), found)).alias("m"))
    order = Window.partitionBy("row", "m.kind").orderBy("m.i")
    end = F.sum(F.col("m.gap") + F.col("m.n")).over(order)
    least = F.get(F.array(*[F.lit(n) for *_, n in KINDS]), F.col("m.kind"))
    return (rows.select("row", "doc_id", "repository", "owner", "m.kind", (end - F.col("m.n")).alias("start"),
                        end.alias("end"), "m.value", (F.length("m.value") >= least).alias("_long"))
            .where(F.col("kind").isNull() | F.col("_long")).drop("_long"))


def ownership(found: DataFrame) -> DataFrame:
    """digest, n_repositories, n_owners of every candidate value."""
    own = found.where("kind is not null").select(F.md5("value").alias("digest"), "owner", "repository")
    return (own.groupBy("digest", "owner", "repository").agg(F.lit(1).alias("_"))
            .groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("digest").agg(F.sum("n").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners")))


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source", least_owners: int = 3) -> DataFrame:
    """One row per span (and per document without one, with null kind), with
    n_repositories, n_owners, copied (``least_owners`` or more have the value)
    and live (not copied, no placeholder, at least 8 different characters).

    Null and empty texts have no span; repeated rows are documents of their
    own; a null repository or owner counts as one; other columns are not read.
    """
    found = staged(spans(docs, repository, owner).withColumn("digest", F.md5("value")), "secret-spans")
    known = ownership(found)
    copied = F.col("n_owners") >= least_owners
    different = F.size(F.array_distinct(F.split("value", ""))) >= 8
    judged = found.where("kind is not null").join(known, "digest")
    # documents without a span have no part in the join
    none = found.where("kind is null").withColumns({c: F.lit(None).cast("long") for c in ("n_repositories", "n_owners")})
    return (judged.unionByName(none).select(
        "row", "doc_id", F.when(F.col("kind").isNotNull(), F.get(F.array(*[F.lit(k) for k, *_ in KINDS]), F.col("kind"))).alias("kind"),
        F.col("kind").alias("kind_no"), "start", "end", "digest", "n_repositories", "n_owners", copied.alias("copied"),
        (~copied & ~F.col("value").rlike(PLACEHOLDER) & different).alias("live")))


def per_document(scanned: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, span lists, and how many spans are copied or live."""
    told = F.when(F.col("kind").isNotNull(), F.struct(
        F.col("start"), F.col("kind_no"), F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("s")))
    count = lambda c: F.count(F.when(c, 1))
    all_ = F.array_sort(F.collect_list(told))
    text = lambda keep: F.array_join(F.transform(keep, lambda x: x["s"]), ",")
    return (scanned.groupBy("row", "doc_id").agg(
        *[count(F.col("kind") == k).alias(f"n_{k}") for k in BASE], all_.alias("all"),
        count(F.col("copied")).alias("n_copied"), count(F.col("live")).alias("n_live"))
        .select("doc_id", *[f"n_{k}" for k in BASE],
                F.sha2(text(F.filter("all", lambda x: x["kind_no"] < len(BASE))), 256).alias("base_sha256"),
                text(F.col("all")).alias("spans"), "n_copied", "n_live"))
