"""White-box: histories are cut into slots, and the numbers stay the same."""
import pytest
from pyspark.sql import functions as F

from pathfold.operators import history, numbered, sequence
from pathfold.operators.sequence import ranged, slot_carry

DDL = "ClientID string, HitTimeStamp bigint, channel string, conv boolean, qual boolean, pre boolean"
# one client, cut into [1 2c 5 | 12 15c | 31c 33] below, start = 12
ROWS = [("a", 1, "A", False, False, False), ("a", 2, "B", True, False, True), ("a", 5, "C", False, False, False),
        ("a", 12, "D", False, False, False), ("a", 15, "E", True, True, False),
        ("a", 31, "F", True, True, False), ("a", 33, "G", False, False, False)]
OTHERS = [(c, t, "X", t % 2 == 0, t % 2 == 0, False) for c in ("A", "b", "c", None) for t in (3, 4, 32)]


def test_slot_carries(spark):
    rows = ROWS + [("b", 40, "X", True, True, False), (None, 1, "X", True, False, False)]
    slots = spark.createDataFrame(rows, DDL).withColumn("slot", F.expr("cast(if(ClientID = 'b', 3, HitTimeStamp div 10) as int)"))
    slots = slots.withColumn("slot", F.coalesce("slot", F.lit(0)))
    got = {r.own_slot: (r.first, r.last) for r in slot_carry(slots).collect()}
    assert set(got) == {0, 1, 3}
    a = lambda s: (s.client, s.hits_before, s.conv_before, s.all_conv, s.all_pre, s.all_qual)
    assert a(got[0][0]) == (None, 0, 0, 1, 0, 0) and a(got[0][1]) == ("a", 0, 0, 3, 1, 2)
    assert a(got[1][0]) == a(got[1][1]) == ("a", 3, 1, 3, 1, 2)
    assert a(got[3][0]) == ("a", 5, 2, 3, 1, 2) and a(got[3][1]) == ("b", 0, 0, 1, 0, 1)


@pytest.mark.parametrize("share", [None, 2, 3, 7, 1000])
def test_global_rank_and_segment(spark, share):
    seq = sequence(spark.createDataFrame(ROWS, DDL), share, 1 if share else 50_000).orderBy("HitTimeStamp").collect()
    assert [(r.rn, r.seg) for r in seq] == [(1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (6, 2), (7, 3)]
    assert {(r.client_conv, r.client_pre, r.client_qual) for r in seq} == {(3, 1, 2)}


@pytest.mark.parametrize("clients", ["all", "converters", "nonconverters"])
def test_slots_and_whole_histories_give_the_same_rows(spark, clients):
    hits = spark.createDataFrame(ROWS + OTHERS + OTHERS, DDL)
    wanted = {"all": "true", "converters": "client_qual > 0", "nonconverters": "client_qual = 0"}[clients]
    cut, whole = (sequence(hits, *how, clients).where(wanted) for how in ((1000, 1), (None, 50_000)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(key, cut.collect())) == sorted(map(key, whole.collect()))
    assert cut.columns == whole.columns


def test_ordinary_clients_need_no_slots(spark):
    found = history(spark.createDataFrame(ROWS, DDL))
    assert found.carry is None and found.keys == ("ClientID",) and (found.n_conv, found.n_pre) == (3, 1)


def _bursts(spark):
    """100,000 hits of one client within ten milliseconds, 50,000 hits of the null
    client that are alike in everything, among 2,000 ordinary clients."""
    client = F.when(F.col("id") < 100_000, "bot").when(F.col("id") < 150_000, None).otherwise((F.col("id") % 2000).cast("string"))
    null = (F.col("id") >= 100_000) & (F.col("id") < 150_000)
    return spark.range(0, 200_000).select(
        client.alias("ClientID"), F.when(null, 5).otherwise(F.col("id") * 7919 % 10).alias("HitTimeStamp"), F.lit("x").alias("channel"),
        (~null & (F.col("id") % 10 == 0)).alias("conv"), F.lit(False).alias("qual"), F.lit(False).alias("pre"))


def test_a_burst_is_split_anywhere(spark):
    hits = _bursts(spark)
    slots = ranged(hits, 8)
    sizes = {(r.slot, r.ClientID): r["count"] for r in slots.groupBy("slot", "ClientID").count().collect()}
    per_slot = {}
    for (slot, _), n in sizes.items():
        per_slot[slot] = per_slot.get(slot, 0) + n
    assert sum(sizes.values()) == 200_000 and len(per_slot) >= 24
    assert max(per_slot.values()) <= 2.5 * 200_000 / 32
    assert slot_carry(slots).count() == len(per_slot)
    cut = sequence(hits, 50, 1000).groupBy("ClientID").agg(F.max("rn"), F.count_distinct("rn"), F.max("seg"), F.sum("seg"))
    whole = sequence(hits).groupBy("ClientID").agg(F.max("rn"), F.count_distinct("rn"), F.max("seg"), F.sum("seg"))
    assert cut.exceptAll(whole).count() == 0 and whole.exceptAll(cut).count() == 0
    assert cut.where("ClientID = 'bot'").first()[1:3] == (100_000, 100_000)


def test_windows_within_slots_need_no_shuffle(spark):
    """No exchange of hits after they are written; joins are left to Spark's sizes."""
    seq = numbered(history(_bursts(spark), 50, 1000))
    assert "ResolvedHint" not in seq._jdf.queryExecution().analyzed().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = seq.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    hits_side = plan[plan.index("SortMergeJoin"):plan.index("FileScan")]
    assert "row_number" in hits_side and "Exchange" not in hits_side, plan
    assert plan.count("Exchange hashpartitioning") == 2 and "Broadcast" not in plan, plan  # the carries: by client, by slot
