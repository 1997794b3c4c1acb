import hashlib
import re

import pytest
from odd_documents import ODD, documents
from oracle_compare import compare, duck

from pathfold.llm import decontam
from pathfold.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, n=10):
    out = []
    for i, text in rows:
        own, hit, ids = words(text), set(), set()
        for item, t in items:
            w = words(t)
            size = min(n, len(w))
            for win in {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if size else ():
                for k in range(len(own) - size + 1):
                    if tuple(own[k:k + size]) == win:
                        hit.update(range(k, k + size))
                        if item is not None:
                            ids.add(item)
        out.append((i, len(own), sorted(hit), sorted(ids)))
    return sorted(out, key=str)


def flat(rows):
    return sorted(((r.doc_id, r.n_words, sorted({k for s in r.spans for k in range(s.first, s.end)}), r["items"]) for r in rows), key=str)


LONG = "one two three four five six seven eight nine ten eleven twelve"
ITEMS = [(1, LONG), (2, "Short, item"), (3, None), (4, ""), (5, "!!"), (6, LONG), (None, "no id here"), (1, "ünï wörds"), (7, "here")]
DOCS = ODD + [(20, f"zero {LONG} thirteen. {LONG.upper()}!"), (21, "a short item, short item here"), (22, "no-id HERE"),
              (23, "two three four five six seven eight nine ten eleven"), (24, "ÜNÏ wörds ünï wörds")]


@pytest.mark.parametrize("block_chars", [1 << 20, 40])
def test_against_brute_force(spark, block_chars):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.contamination(documents(spark, DOCS), bench, 10, block_chars).collect()
    assert flat(got) == brute(DOCS, ITEMS)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(documents(spark, []), none).count() == 0
    assert flat(decontam.contamination(documents(spark, DOCS), none).collect()) == brute(DOCS, [])
    assert decontam.decontaminate(documents(spark, DOCS), none).count() == len(DOCS)


@pytest.mark.parametrize("block_chars", [1 << 20, 40])
def test_documents_or_spans_go(spark, block_chars):
    docs, bench = documents(spark, DOCS), spark.createDataFrame(ITEMS, "item_id long, text string")
    dirty = {i for i, _, hit, _ in brute(DOCS, ITEMS) if hit}
    left = decontam.decontaminate(docs, bench, block_chars=block_chars)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in DOCS if i not in dirty)
    cut = {r.doc_id: r.text for r in decontam.decontaminate(docs, bench, remove="span", block_chars=block_chars).collect()}
    assert cut[20] == "zero  thirteen. !" and cut[23] == "" and cut[9] == "one" and cut[1] is None
    with pytest.raises(ValueError):
        decontam.decontaminate(docs, bench, remove="all")


def test_query_matches_its_sql(spark, sf):
    name = "op5_decontamination"
    ok, told = compare(spark, name, QUERIES[name], ORACLE[name], sf, duck(sf))
    assert ok, told
    r = QUERIES[name](spark, sf).where("not contaminated").first()
    assert r.items_sha256 == hashlib.sha256(b"").hexdigest()


def test_long_and_repeated_items_keep_blocks_small(spark):
    """One item far over the bound, and one row that is there 3000 times: no block is larger than the bound."""
    long_ = " ".join(f"x{i % 1000}" for i in range(6000))
    rows = [(1, long_), (2, "a a a a a a a a a a a a a a a a a a a a a")] + [(3, LONG)] * 3000
    bench = spark.createDataFrame(rows, "item_id long, text string")
    blocks = list(decontam._blocks(bench, 10, 4000))
    assert len(blocks) >= 7 and max(len(b.words) for b in blocks) <= 2000
    windows = {tuple(list(b.vocabulary)[w - 1] for w in b.words[s:s + size])
               for b in blocks for size, (_, starts, *_) in b.by_size.items() for s in starts}
    own = [w.encode() for w in long_.split()]
    assert windows == {tuple(own[i:i + 10]) for i in range(5991)} | {(b"a",) * 10} | {tuple(LONG.encode().split()[i:i + 10]) for i in range(3)}
    docs = [(5, f"begin {long_[500:900]} end"), (6, LONG), (7, "nothing of it")]
    got = decontam.contamination(documents(spark, docs), bench, 10, 4000).collect()
    assert flat(got) == brute(docs, list(dict.fromkeys(rows)))


def test_a_full_block_is_built_in_little_time():
    """A quarter of a full block: growth is close to linear, so a full one takes seconds."""
    import random
    import time
    r = random.Random(1)
    words = [f"w{i}" for i in range(20_000)]
    items = [(i, " ".join(r.choices(words, k=200))) for i in range(3000)]
    began = time.process_time()
    found = decontam.WindowSet(items, 10)
    assert time.process_time() - began < 20 and len(found.by_size[10][0]) > 500_000
    assert found.scan([items[7][1].encode()])[1] == {0: ([(0, 200)], {7})}
