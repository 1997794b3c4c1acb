"""Hand-made hit logs for tests."""
from __future__ import annotations

from pathfold.constants import HIT_COLUMNS

HIT_DDL = ", ".join(f"{n} {t}" for n, t in HIT_COLUMNS)


def hit(client, letter, ts, goal=None, project=1, src="ga", **kw):
    """A ga hit whose channel is '<letter> / x'."""
    row = {n: None for n, _ in HIT_COLUMNS}
    row.update(ProjectID=project, ClientID=client, HitTimeStamp=ts, ga_sourcemedium=letter,
               utm_source="s", utm_medium="m", utm_campaign="x", goal=goal, src=src,
               ga_location="p1")
    row.update(kw)
    return tuple(row[n] for n, _ in HIT_COLUMNS)


def hits_df(spark, rows, partitions=None):
    df = spark.createDataFrame(rows, HIT_DDL)
    return df.repartition(partitions) if partitions else df


def letters(path: str | None) -> str | None:
    return None if path is None else path.replace(" / x", "")


# FIXTURES.md section 2: (client, channel, ts, goal)
MICRO = [
    ("c1", "A", 10, 3), ("c1", "B", 50, None), ("c1", "C", 110, None), ("c1", "D", 120, 3),
    ("c1", "E", 130, None), ("c1", "F", 140, 5), ("c1", "G", 150, None),
    ("c2", "A", 20, None), ("c2", "B", 90, 3),
    ("c3", "A", 60, None), ("c3", "B", 70, 3), ("c3", "C", 80, None), ("c3", "D", 110, None),
    ("c3", "E", 115, 7),
    ("c4", "A", 110, 3), ("c4", "A", 111, 3),
    ("c5", "A", 150, None), ("c5", "B", 160, -1),
    ("c6", "C", 199, 3), ("c6", "D", 200, 3),
    (None, "A", 110, 3),
    ("c8", "A", 105, -1), ("c8", "B", 106, 3),
]


def micro_rows():
    return [hit(c, ch, ts, g) for c, ch, ts, g in MICRO]
