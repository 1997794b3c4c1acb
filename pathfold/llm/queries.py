"""One registered query per operator, over whole tables, and their SQL."""
from __future__ import annotations

from pyspark.sql import functions as F

from . import ann, chat, decontam, hard_negatives, licenses, linedup, lm_score, neardup, packing, periodic, secrets, toxicity, va_file
from .common import staged, table

CAPACITY = 2048


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark, sf_dir):
    pieces = staged(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path(), CAPACITY, memory_mb=250), "op1-pieces")
    return packing.pack_pieces(pieces, CAPACITY)


def op2_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.score(docs.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 5 == 1))


def op3_preference_formatting(spark, sf_dir):
    """Conversations 2i and 2i + 1 as the chosen and the rejected one of pair i."""
    turns = table(spark, sf_dir, "conversations")
    return chat.preference_turns(turns.select(
        F.expr("conv_id div 2").alias("pair_id"), F.when(F.col("conv_id") % 2 == 0, "chosen").otherwise("rejected").alias("side"),
        "turn", "role", "text"))


#: the label table's columns in the order of the chain
CATEGORIES = ["quality", "toxic"]


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), CATEGORIES))


def op5_decontamination(spark, sf_dir):
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def op6_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("key")


def op7_line_dedup(spark, sf_dir):
    return linedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *[F.col(f"_dedup.{c}").cast("long").alias(c) for c in ("n_lines", "n_removed", "n_removed_lines")],
        "text")


def op8_secret_scan(spark, sf_dir):
    return secrets.per_document(secrets.scan(table(spark, sf_dir, "documents")))


def op9_license_scan(spark, sf_dir):
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = lambda c: F.transform(c, lambda x: x["label"])
    text = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    words = F.transform("places", lambda x: x["word"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"), text(names(F.col("places"))).alias("base_labels"),
        text(F.concat(names(F.col("places")), names(F.col("detections")))).alias("labels"), "score")


def op10_collision_counting_ann(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op11_hard_negatives(spark, sf_dir):
    own = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(own.select("vec_id", "embedding", moved.alias("label")), F.col("id") % 50 == 0)


def with_repeats(docs):
    """``docs`` (doc_id, text), where every tenth document (by the hash h of its
    id) repeats, from some word on, the words that begin there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    own = docs.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), F.when(h % 10 == 0, words).alias("w")).withColumn("n", F.size("w"))
    at = own.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int")).withColumn(
        "p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    rest = F.flatten(F.array_repeat(F.expr("slice(w, a + 1, p)"), F.expr("cast((n - a) div p + 1 as int)")))
    repeated = F.array_join(F.slice(F.concat(F.expr("slice(w, 1, a)"), rest), F.lit(1), F.col("n")), " ")
    return at.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    found = periodic.find_runs(with_repeats(table(spark, sf_dir, "documents")))
    told = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    best = found.withColumn("best", F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period")))))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", (-F.col("best.less")).alias("length"), "best.period",
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"), F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_va_file_topk(spark, sf_dir):
    return va_file.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_preference_formatting": op3_preference_formatting,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_license_scan": op9_license_scan,
    "op10_collision_counting_ann": op10_collision_counting_ann,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_va_file_topk": op13_va_file_topk,
}


# --- SQL, where it can express an operator ----------------------------------------------------------------------------

_SQL3 = """WITH own AS (
  SELECT conv_id // 2 AS pair_id, CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side, turn, role, text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
by_turn AS (
  SELECT pair_id, turn,
    list_sort(list({'role': role, 'text': text}) FILTER (side = 'chosen')) AS c,
    list_sort(list({'role': role, 'text': text}) FILTER (side = 'rejected')) AS r
  FROM own GROUP BY ALL),
pairs AS (
  SELECT pair_id, min(turn) FILTER (c IS DISTINCT FROM r) AS first_diff
  FROM by_turn GROUP BY pair_id HAVING count(c) > 0 AND count(r) > 0),
parts AS (
  SELECT o.pair_id, o.turn, o.role, o.text, o.side,
    CASE WHEN p.first_diff IS NULL OR o.turn < p.first_diff THEN 'prompt' ELSE o.side END AS part
  FROM own o JOIN pairs p USING (pair_id))
SELECT pair_id, part, turn, role, text,
  '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS rendered,
  part <> 'prompt' AND role IS NOT DISTINCT FROM 'assistant' AS trained
FROM parts WHERE part <> 'prompt' OR side = 'chosen'"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SQL5 = f"""WITH items AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + least(len(w), 10) - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
places AS (
  SELECT r, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM places JOIN windows USING (win)),
marked AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN marked USING (r) LEFT JOIN found USING (r)"""

_SQL6 = f"""WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, hash(list_slice(w, i, i + 4)) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.c < l.b)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""

_SQL7 = r"""WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
marked AS (SELECT *, list_transform(lines, lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT)) AS h FROM docs),
cut AS (
  SELECT *, list_filter(range(1, len(lines) + 1), lambda i: i = 1
    OR (CASE WHEN i > 2 THEN h[i - 2] ELSE 0 END * 31 + h[i - 1]) % 16 <> 0) AS starts FROM marked),
ends AS (
  SELECT *, CASE WHEN after - s >= 2 THEN after ELSE coalesce(starts[k + 2], len(lines) + 1) END AS e
  FROM (SELECT *, starts[k] AS s, coalesce(starts[k + 1], len(lines) + 1) AS after
        FROM (SELECT *, unnest(range(1, len(starts) + 1)) AS k FROM cut))),
able AS (
  SELECT * FROM (SELECT r, doc_id, text, s, e - s AS n, array_to_string(list_slice(lines, s, e - 1), chr(10)) AS chunk FROM ends)
  WHERE n > 1 AND length(chunk) >= 80
  UNION ALL
  SELECT r, doc_id, text, s, 1 AS n, lines[s] AS chunk FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS s FROM docs)
  WHERE len(regexp_extract_all(lines[s], '[^ \x09-\x0D]+')) >= 50),
known AS (SELECT chunk, min({'d': doc_id, 't': text, 's': s}) AS first FROM able GROUP BY chunk HAVING count(*) > 1),
gone AS (SELECT r, s, n FROM able JOIN known USING (chunk) WHERE {'d': doc_id, 't': text, 's': s} IS DISTINCT FROM first),
lost AS (SELECT DISTINCT r, unnest(range(s, s + n)) AS i FROM gone),
counts AS (SELECT r, count(*) AS n_removed FROM gone GROUP BY r),
kept AS (
  SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (lost.i IS NULL) AS left_, count(lost.i) AS n_lost
  FROM (SELECT r, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM docs JOIN counts USING (r)) l
  LEFT JOIN lost ON lost.r = l.r AND lost.i = l.i GROUP BY l.r)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_lost, 0) AS n_removed_lines,
  CASE WHEN n_removed IS NULL THEN text ELSE coalesce(left_, '') END AS text
FROM docs LEFT JOIN counts USING (r) LEFT JOIN kept USING (r)"""


def _sql8() -> str:
    """Places of matches from the parts between them, as the operator has them."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    kinds = []
    for no, (kind, pattern, group, least) in enumerate(secrets.KINDS):
        p = quoted(pattern)
        kinds.append(f"""SELECT r, doc_id, source, {no} AS no, '{kind}' AS kind, g, m, val FROM (
  SELECT r, doc_id, source, list_slice(string_split_regex(t, {p}), 1, len(regexp_extract_all(t, {p}))) AS g,
    regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {group}) AS val FROM docs) WHERE len(m) > 0""")
    base = ", ".join(quoted(k) for k in secrets.BASE)
    return f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
matched AS ({' UNION ALL '.join(kinds)}),
each AS (
  SELECT r, doc_id, source, no, kind, val[i] AS val, length(m[i]) AS n,
    CAST(sum(length(g[i]) + length(m[i])) OVER (PARTITION BY r, no ORDER BY i) AS BIGINT) AS e
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM matched)),
spans AS (
  SELECT *, e - n AS s, kind || ':' || CAST(e - n AS VARCHAR) || ':' || CAST(e AS VARCHAR) AS told FROM each
  WHERE length(val) >= [{', '.join(str(n) for *_, n in secrets.KINDS)}][no + 1]),
owned AS (SELECT val, count(DISTINCT coalesce(source, '')) AS owners FROM spans GROUP BY val),
judged AS (
  SELECT *, owners >= 3 AS copied, owners < 3 AND NOT regexp_matches(val, {quoted(secrets.PLACEHOLDER)})
    AND len(list_distinct(string_split(val, ''))) >= 8 AS live FROM spans JOIN owned USING (val)),
told AS (
  SELECT r, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.BASE)},
    string_agg(told, ',' ORDER BY s, no) FILTER (kind IN ({base})) AS base, string_agg(told, ',' ORDER BY s, no) AS spans,
    count(*) FILTER (copied) AS n_copied, count(*) FILTER (live) AS n_live FROM judged GROUP BY r)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_copied, 0) AS n_copied, coalesce(n_live, 0) AS n_live
FROM docs LEFT JOIN told USING (r)"""


def _whole_sql(scale: int, more: str = "") -> str:
    """The embeddings that take part, in whole numbers."""
    return f"""v AS (
  SELECT vec_id, {more}list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


_SQL11 = f"""WITH {_whole_sql(256, "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, ")},
a AS (SELECT * FROM v WHERE vec_id % 50 = 0 AND label IS NOT NULL),
scores AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS alike, CAST(list_dot_product(a.x, v.x) AS BIGINT) AS score
  FROM a, v WHERE a.vec_id <> v.vec_id AND v.label IS NOT NULL),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 3"""

_SQL13 = f"""WITH {_whole_sql(64)}
SELECT q.vec_id AS query_id, CAST(row_number() OVER w AS INTEGER) AS rank, v.vec_id, CAST(list_dot_product(q.x, v.x) AS BIGINT) AS score
FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.x) = len(v.x) WHERE q.vec_id % 20 = 0
WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_dot_product(q.x, v.x) DESC, v.vec_id) QUALIFY row_number() OVER w <= 20"""


ORACLE: dict[str, str] = {
    "op3_preference_formatting": _SQL3,
    "op5_decontamination": _SQL5,
    "op6_minhash_near_dedup": _SQL6,
    "op7_line_dedup": _SQL7,
    "op8_secret_scan": _sql8(),
    "op11_hard_negatives": _SQL11,
    "op13_va_file_topk": _SQL13,
}
