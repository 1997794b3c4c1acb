import hashlib
import time

import numpy as np
import pytest
from odd_documents import ODD, documents
from oracle_compare import compare, duck

from pathfold.llm import linedup
from pathfold.llm.queries import ORACLE, QUERIES


def chunks(text, divisor=16, long_words=50, least_chars=80):
    """(first line, number of lines, text) of the chunks that may go."""
    lines = (text or "").split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    starts = [i for i in range(len(lines)) if i == 0 or ((h[i - 2] if i > 1 else 0) * 31 + h[i - 1]) % divisor != 0]
    for s in starts:
        e = next((x for x in starts if x >= s + 2), len(lines))
        c = "\n".join(lines[s:e])
        if e - s > 1 and len(c) >= least_chars:
            yield s, e - s, c
    for i, x in enumerate(lines):
        if len(x.encode().split()) >= long_words:
            yield i, 1, x


def brute(rows):
    """(doc_id, text, chunks gone) with the lines of a chunk only where it stands first, by doc_id."""
    first = {}
    for i, text in rows:
        for s, _, c in chunks(text):
            place = (i is not None, i, text, s)
            first[c] = min(first.get(c, place), place, key=lambda p: (p[0], p[1] or 0, p[3]))
    out = []
    for i, text in rows:
        gone = {(s, n) for s, n, c in chunks(text) if first[c] != (i is not None, i, text, s)}
        lost = {k for s, n in gone for k in range(s, s + n)}
        left = "\n".join(x for k, x in enumerate((text or "").split("\n")) if k not in lost)
        out.append((i, left if gone else text, len(gone)))
    return sorted(out, key=str)


PASSAGE = " ".join(f"p{i}" for i in range(60))
BLOCK = "\n".join(f"line {i} of a block that stands in several documents, as it is" for i in range(12))
DOCS = ODD + [(30, f"first\n{PASSAGE}\nend of it"), (31, f"another begin\nand one more\n{PASSAGE}"), (32, PASSAGE), (33, f"{PASSAGE}\n{PASSAGE}"),
              (40, f"a\nb\n{BLOCK}\nc"), (41, f"other lines before\n{BLOCK}\nand behind"), (42, BLOCK), (43, "short\nshort\nshort"), (44, "short\nshort")]


def test_against_brute_force(spark):
    docs = documents(spark, DOCS)
    left = linedup.dedup(docs)
    assert left.columns == docs.columns + ["_dedup"]
    assert sorted(((r.doc_id, r.text, r._dedup.n_removed) for r in left.collect()), key=str) == brute(DOCS)
    assert all(r.lines == "x" or True for r in left.collect()) and {r.lines for r in left.collect()} == {"lines"}


def test_a_passage_stays_once(spark):
    texts = [r.text or "" for r in linedup.dedup(documents(spark, DOCS)).collect()]
    assert sum(t.count(PASSAGE) for t in texts) == 1
    # of a block of short lines nearly all goes from later documents
    shared = [t for t in texts if "of a block" in t]
    assert 12 <= sum(t.count("of a block") for t in shared) <= 12 + 4


def test_an_insertion_moves_boundaries_near_it_only():
    lines = [f"line number {i} {hashlib.md5(str(i).encode()).hexdigest()}" for i in range(200)]
    one, two = ({c for _, _, c in chunks("\n".join(x))} for x in (lines, lines[:100] + ["new"] + lines[100:]))
    assert len(one - two) <= 3


def test_short_passages_of_ordinary_lines_go(spark):
    """Passages of 3 to 8 lines of 20 words, each in two documents among other lines."""
    r = np.random.default_rng(11)
    line = lambda: " ".join(f"w{x}" for x in r.integers(0, 100_000, 20))
    rows, lengths = [], {}
    for n in (3, 4, 5, 6, 8):
        for _ in range(60):
            passage = [line() for _ in range(n)]
            for _ in range(2):
                lengths[len(rows)] = n
                rows.append((len(rows), "\n".join([*(line() for _ in range(6)), *passage, *(line() for _ in range(6))])))
    got = {x.doc_id: x._dedup for x in linedup.dedup(documents(spark, rows)).collect()}
    for n in (3, 4, 5, 6, 8):
        later = [got[i] for i, m in lengths.items() if m == n and i % 2 == 1]
        assert all(got[i].n_removed == 0 for i, m in lengths.items() if m == n and i % 2 == 0)
        assert sum(x.n_removed > 0 for x in later) >= 0.9 * len(later)
        assert sum(x.n_removed_lines for x in later) >= (0.75 if n == 3 else 0.85) * n * len(later)


def test_many_repeated_lines_take_little_time(spark):
    """One text that says the same few lines 16,000 times, and its copy."""
    text = "\n".join(f"the same line number {i % 7} over and over again, with enough characters in it" for i in range(16_000))
    began = time.perf_counter()
    got = {x.doc_id: x for x in linedup.dedup(documents(spark, [(1, text), (2, text)])).collect()}
    assert time.perf_counter() - began < 60
    assert got[2].text == "" and got[1].text != "" and got[1].text in text


def test_a_filter_that_lets_all_pass_changes_nothing(spark, monkeypatch):
    docs = documents(spark, DOCS)
    want = sorted(((r.doc_id, r.text) for r in linedup.dedup(docs).collect()), key=str)
    monkeypatch.setattr(linedup, "_again", lambda chunks: chunks)
    assert sorted(((r.doc_id, r.text) for r in linedup.dedup(docs).collect()), key=str) == want


def test_empty_table(spark):
    assert linedup.dedup(documents(spark, [])).count() == 0


def test_chunks_are_those_of_the_model(spark):
    for r in linedup.with_chunks(documents(spark, DOCS), "doc_id", "text").collect():
        own = [(c["at"], c.n_lines, c.text) for c in r.chunks]
        assert [c for c in own if c[1] > 1 or len(c[2].encode().split()) >= 50] == list(chunks(r.text))


@pytest.mark.parametrize("name", ["op7_line_dedup", "op8_secret_scan", "op3_preference_formatting"])
def test_query_matches_its_sql(spark, sf, name):
    ok, told = compare(spark, name, QUERIES[name], ORACLE[name], sf, duck(sf))
    assert ok, told


@pytest.mark.parametrize("name", ["op7_line_dedup", "op8_secret_scan", "op3_preference_formatting"])
def test_native_plans_run_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_a_column_of_the_reports_name(spark):
    import corpus_pipeline
    docs = documents(spark, DOCS).withColumnsRenamed({"row": "_dedup", "marks": "_DEDUP_"})
    with pytest.raises(ValueError, match="_dedup"):
        linedup.dedup(docs)
    assert linedup.dedup(docs, told="counts").columns == [*docs.columns, "counts"]
    left = corpus_pipeline.drop_repeated_chunks(spark, docs, None)
    assert left.columns == docs.columns and {r._dedup for r in left.collect()} == {"row"}
