"""Every stage of the pipeline against brute force on what the stage before it kept."""
import contextlib
import io

import pytest
from odd_documents import ODD, documents
from test_decontam import brute as contaminated
from test_linedup import brute as without_repeats
from test_neardup import brute as components
from test_packing import check, pieces_of

import corpus_pipeline as P
from pathfold.llm import common, decontam, neardup, packing, toxicity
from pathfold.llm.common import staged, table
from pathfold.llm.queries import CAPACITY, CATEGORIES, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def one_of_each(rows):
    kept = {(i, t) for i, t in rows}
    comp = {}
    for i, _, c in components(sorted(kept, key=str)):
        comp.setdefault(i, set()).add(c)
    return sorted(((i, t) for i, t in kept if i in comp[i]), key=str)


@pytest.mark.parametrize("odd", [False, True])
def test_stages_against_brute_force(spark, sf, tokenizer, odd):
    docs = documents(spark, ODD + [(2000, "an idiot, a moron and worthless scum")]) if odd else table(spark, sf, "documents")
    names = docs.columns
    stages = dict(P.STAGES)
    clean = staged(stages["toxicity"](spark, docs, sf), "t")
    chain = toxicity.fit(docs, table(spark, sf, "labels"), CATEGORIES)
    toxic = {(r.doc_id, r.toxic) for r in toxicity.scores(docs, chain).collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, t in toxic if not t}

    cut = staged(stages["line_dedup"](spark, clean, sf), "t")
    assert pairs(cut) == sorted(((i, t) for i, t, n in without_repeats(pairs(clean)) if not n or t.strip(" ")), key=str)
    assert all(r.n_chars == len(r.text) for r in cut.where("text is not null").collect())

    single = staged(stages["minhash_near_dedup"](spark, cut, sf), "t")
    assert pairs(single) == one_of_each(pairs(cut))

    left = staged(stages["benchmark_decontamination"](spark, single, sf), "t")
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    dirty = {(i, k) for k, (i, t) in enumerate(pairs(single)) if contaminated([(i, t)], items)[0][2]}
    assert pairs(left) == [p for k, p in enumerate(pairs(single)) if (p[0], k) not in dirty]
    for df in (clean, cut, single, left):
        assert df.columns == names

    packed = stages["best_fit_packing"](spark, left, sf).collect()
    check(packed, [(i, pieces_of(tokenizer, t, CAPACITY)) for i, t in pairs(left)], CAPACITY)


def test_run_is_its_stages(spark, sf):
    got = P.run(spark, sf)
    docs = table(spark, sf, "documents")
    for _, stage in P.STAGES:
        docs = staged(stage(spark, docs, sf), "t")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    a, b = got.select(columns), docs.select(columns)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_empty_documents(spark, sf):
    docs = documents(spark, [])
    for _, stage in P.STAGES:
        docs = staged(stage(spark, docs, sf), "t")
    assert docs.count() == 0


def python_steps_at_once(df):
    """Most steps in Python of the frame's plan without an exchange between them, which a task has open together."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    most, above = 0, []  # (place in the line, steps since the exchange above)
    for line in out.getvalue().splitlines():
        at = len(line) - len(line.lstrip(" :+-*"))
        name = line[at:].split(") ", 1)[-1] if line[at:].startswith("(") else line[at:]
        while above and above[-1][0] >= at:
            above.pop()
        n = above[-1][1] if above else 0
        n = 0 if "Exchange" in name.split(" ")[0] else n + name.startswith(("MapInArrow", "FlatMapGroups", "MapInPandas"))
        above.append((at, n))
        most = max(most, n)
    return most


def test_a_task_has_one_python_worker(spark, sf, monkeypatch):
    """Steps in Python right on one another take two workers a core, all of which stay (the pipeline was stopped at 3010 MB)."""
    steps, map_arrow = [], common.map_arrow

    def seen(df, run, schema, **more):
        out = map_arrow(df, run, schema, **more)
        steps.append(python_steps_at_once(out))
        return out

    for module in (decontam, neardup, packing, toxicity):
        monkeypatch.setattr(module, "map_arrow", seen)
    docs = table(spark, sf, "documents")
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf)
        steps.append(python_steps_at_once(out))
        docs = staged(out, "t")
    crowded = documents(spark, [(i, f"{' '.join(f'w{k}' for k in range(40))} x{i}") for i in range(30)])
    links = neardup.near_duplicates(crowded, crowd=3, group_rows=4)
    assert {(r.component_id, r.kept) for r in links.collect()} == {(0, True), (0, False)}
    assert max(steps) == 1 and len(steps) > 15
