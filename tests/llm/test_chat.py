from pathfold.llm import chat

DDL = "pair_id long, side string, turn int, role string, text string, part string, rendered string"


def turns(spark, *rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)


def conversation(pair, side, *texts):
    return [(pair, side, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]


def told(df):
    return sorted((r.pair_id, r.part, r.turn, r.text or "", r.trained) for r in df.collect())


def test_prefix_is_rendered_once(spark):
    rows = conversation(1, "chosen", "hi", "hello", "why?", "because", "ok", "bye") + conversation(1, "rejected", "hi", "hello", "why?", "no idea")
    got = chat.preference_turns(turns(spark, *rows))
    assert told(got) == sorted(
        [(1, "prompt", 0, "hi", False), (1, "prompt", 1, "hello", False), (1, "prompt", 2, "why?", False),
         (1, "chosen", 3, "because", True), (1, "chosen", 4, "ok", False), (1, "chosen", 5, "bye", True), (1, "rejected", 3, "no idea", True)])
    r = chat.preference_texts(got).first()
    assert r.prompt == "<|user|>\nhi\n<|assistant|>\nhello\n<|user|>\nwhy?\n"
    assert r.chosen == "<|assistant|>\nbecause\n<|user|>\nok\n<|assistant|>\nbye\n" and r.rejected == "<|assistant|>\nno idea\n"
    assert [(m.length, m.trained) for m in r.chosen_mask] == [(22, True), (12, False), (18, True)]


def test_a_later_turn_alike_is_no_prefix(spark):
    rows = conversation(1, "chosen", "a", "b", "same") + conversation(1, "rejected", "a", "c", "same")
    assert [x[1] for x in told(chat.preference_turns(turns(spark, *rows)))] == ["chosen", "chosen", "prompt", "rejected", "rejected"]


def test_odd_rows(spark):
    rows = (conversation(1, "chosen", "a", None) + conversation(1, "rejected", "a", None)          # equal: all prompt
            + conversation(2, "chosen", "alone")                                                  # no pair
            + conversation(3, "chosen", "x", "y") + conversation(3, "chosen", "x", "y") + conversation(3, "rejected", "x", "y")
            + [(None, "chosen", 0, "user", "t"), (4, "other", 0, "user", "t"), (5, "chosen", None, "user", "t"), (5, "rejected", 0, "user", "t"),
               (6, "chosen", 0, None, None), (6, "rejected", 0, None, ""), (7, "chosen", 1, "user", "b"), (7, "rejected", 0, "user", "b")])
    got = told(chat.preference_turns(turns(spark, *rows)))
    assert [x for x in got if x[0] == 1] == [(1, "prompt", 0, "a", False), (1, "prompt", 1, "", False)]
    # a turn given twice on one side differs from the turn given once
    assert [x[1] for x in got if x[0] == 3] == ["chosen"] * 4 + ["rejected"] * 2
    assert [x for x in got if x[0] == 6] == [(6, "chosen", 0, "", False), (6, "rejected", 0, "", False)]
    assert [x for x in got if x[0] == 7] == [(7, "chosen", 1, "b", False), (7, "rejected", 0, "b", False)]
    assert not [x for x in got if x[0] in (2, 4, 5)]


def test_empty_table(spark):
    assert chat.preference_turns(turns(spark)).count() == 0


def test_a_long_conversation(spark):
    rows = conversation(1, "chosen", *map(str, range(3000))) + conversation(1, "rejected", *map(str, range(2999)), "else")
    got = chat.preference_turns(turns(spark, *rows)).groupBy("part").count().collect()
    assert {r.part: r["count"] for r in got} == {"prompt": 2999, "chosen": 1, "rejected": 1}
