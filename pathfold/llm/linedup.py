"""Line dedup by content-defined chunks of lines.  DataFrame functions only.

A rolling hash over the hashes of the last two lines decides after which lines a
chunk may begin and end: after most of them, so that a short passage has
boundaries of its own in whatever context, and an insertion moves none but those
next to it.  A chunk goes from a boundary over at least two lines to the next
one, so chunks overlap; a line of ``long_words`` words or more (a passage) is a
chunk by itself, too.  Of a chunk that occurs more than once in the corpus the
occurrence with the smallest (doc_id, row key, line) stays, and the lines of the
others go.

First the chunks are counted by a 64-bit digest.  Only chunks whose digest occurs
again (and few others, see ``_again``) are looked at as text: they are grouped by
their text, that is, compared byte for byte.

Scale: the digests are shuffled (combined map-side), then the texts of the chunks
that occur again, written once, and the documents to take their lines out.  A text
that a third of all chunks share is combined map-side, and its occurrences are
joined by adaptive execution's split of skewed partitions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathfold.operators.client_filter import bits_of, word_of

from .common import free_name, row_key, staged

_WORDS = r"[^\x20\x09-\x0D]+"


def _as_row(df: DataFrame, *keep: str, **made: Column) -> DataFrame:
    """Compute ``made`` once per row: a generator in between keeps the optimizer
    from copying the expressions into the lambdas that read them."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def with_chunks(docs: DataFrame, *keep: str, divisor: int = 16, long_words: int = 50, least_chars: int = 80) -> DataFrame:
    """``keep`` and ``chunks``: array of (at, n_lines, digest, text), at counted from
    0.  Single lines are there if they are long enough for ``long_words`` words,
    whatever words they have."""
    lines = _as_row(docs, *keep, lines=_lines(F.col("text")))
    marked = _as_row(lines, *keep, "lines", marks=F.transform("lines", lambda x: F.struct(
        F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long").alias("h"), F.xxhash64(x).alias("x"), F.length(x).alias("n"))))

    def begins(i: Column) -> Column:
        last, before = (F.get("marks", j) for j in (i - 1, i - 2))
        return (i == 0) | (F.pmod(F.coalesce(before["h"], F.lit(0)) * 31 + last["h"], F.lit(divisor)) != 0)

    cut = _as_row(marked, *keep, "lines", "marks", starts=F.filter(F.sequence(F.lit(0), F.size("lines") - 1), begins))

    def length(s: Column, k: Column) -> Column:
        after = F.coalesce(F.get("starts", k + 1), F.size("lines"))
        end = F.when(after - s >= 2, after).otherwise(F.coalesce(F.get("starts", k + 2), F.size("lines")))
        return F.struct(s.alias("at"), (end - s).alias("n"))

    sized = _as_row(cut, *keep, "lines", "marks", spans=F.concat(
        F.filter(F.transform("starts", length), lambda c: c["n"] > 1),
        # fewer characters can't hold so many words
        F.filter(F.transform("marks", lambda m, i: F.struct(i.alias("at"), F.when(m["n"] >= 2 * long_words - 1, 1).alias("n"))),
                 lambda c: c["n"].isNotNull())))

    def chunk(c: Column) -> Column:
        return F.struct(c["at"].alias("at"), c["n"].alias("n_lines"), F.xxhash64(F.slice("marks", c["at"] + 1, c["n"])["x"]).alias("digest"),
                        F.array_join(F.slice("lines", c["at"] + 1, c["n"]), "\n").alias("text"))

    return _as_row(sized, *keep, chunks=F.filter(
        F.transform("spans", chunk), lambda c: (c["n_lines"] == 1) | (F.length(c["text"]) >= least_chars)))


def _again(chunks: DataFrame) -> DataFrame:
    """``chunks`` whose digest occurs more than once, and few others: by a Bloom
    filter of at most ``client_filter.WORDS`` (2^18) rows, which bounds its
    broadcast.  With more than some million such digests it lets more and more
    pass; what passes is compared as text in any case."""
    digest = F.col("digest")
    words = (chunks.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .groupBy(word_of(digest).alias("word")).agg(F.bit_or(bits_of(digest)).alias("bits")))
    probe = chunks.withColumns({"_word": word_of(digest), "_bits": bits_of(digest)})
    match = (probe["_word"] == words["word"]) & (words["bits"].bitwiseAND(probe["_bits"]) == probe["_bits"])
    return probe.join(F.broadcast(words), match, "left_semi").drop("_word", "_bits")


def repeated(docs: DataFrame, long_words: int = 50, **options) -> DataFrame:
    """What to remove: doc_id, key (the row's), gone (array of at, n_lines: first line and number of lines)."""
    own = docs.select("doc_id", "text", row_key("doc_id", "text").alias("key"))
    chunks = with_chunks(own, "doc_id", "key", long_words=long_words, **options).select("doc_id", "key", F.inline("chunks"))
    able = (F.col("n_lines") > 1) | (F.regexp_count("text", F.lit(_WORDS)) >= long_words)
    some = staged(_again(chunks).where(able).select("doc_id", "key", "at", "n_lines", F.md5("text").alias("digest"), "text"), "line-chunks")
    place = F.struct("doc_id", "key", "at")
    # grouped by the bytes themselves; a digest (and a number of lines) stands for one text from here on
    known = (some.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("kept"))
             .where("n > 1").select("digest", "kept"))
    return (some.drop("text").join(known, "digest").where(~place.eqNullSafe(F.col("kept")))
            .groupBy("doc_id", "key").agg(F.collect_set(F.struct("at", "n_lines")).alias("gone")))


def dedup(docs: DataFrame, told: str = "_dedup", **options) -> DataFrame:
    """``docs`` with its columns, ``text`` without the lines of repeated chunks, and
    a struct ``told`` of n_lines, n_removed (repeated chunks) and n_removed_lines.

    A null or empty text has one empty line and stays as it is; rows alike in
    doc_id and text count as one document and stay alike; other columns are
    carried along, whatever their names; one named as ``told`` is refused.  An empty
    table stays empty.  A very long text is one task's work, in proportion to its
    lines.
    """
    if free_name(docs.columns, told) != told:
        raise ValueError(f"the documents have a column {told}; give another name")
    # the whole row in one column, so that none of its names meets one used here
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text",
                      row_key("doc_id", "text").alias("key"))
    gone = repeated(docs, **options).select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key"), "gone")
    joined = own.join(gone, own["doc_id"].eqNullSafe(gone["gone_id"]) & (own["key"] == gone["gone_key"]), "left")
    parts = _as_row(joined, "row", "gone", lines=_lines(F.col("text")))
    lost = F.flatten(F.transform("gone", lambda g: F.sequence(g["at"], g["at"] + g["n_lines"] - 1)))
    left = _as_row(parts, "row", "gone", "lines", left=F.when(
        F.col("gone").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), lost)))
    text = F.when(F.col("left").isNull(), F.col("row")["text"]).otherwise(
        F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n"))
    counts = F.struct(F.size("lines").alias("n_lines"),
                      F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_removed"),
                      F.when(F.col("left").isNull(), 0).otherwise(F.size("lines") - F.size("left")).alias("n_removed_lines"))
    return left.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns],
                       counts.alias(told))
