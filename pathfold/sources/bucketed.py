"""A hit log kept by client: a Parquet table bucketed by ``ClientID`` and sorted in it.

Windows, aggregates and semi-joins by client over it need no shuffle of hits, so
a log that many reports read pays for its shuffle once, when it is written.  All
hits of a client are in one bucket, and a bucket is one task's; so a log in which
one bucket has many times its share (a bot, a default id) is read like any
other Parquet log, which splits its files, and the reports shuffle as usual.
"""
from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import HIT_COLUMNS
from ..session import file_sizes
from .hits import to_hit_schema

_BUCKET = re.compile(r"_(\d{5,})(?:\.[^/]*)?$")  # of a file name that Spark gives


def write_bucketed_hits(hits: DataFrame, table: str, path: str, buckets: int, mode: str = "errorifexists") -> None:
    """Write ``hits`` as the table ``table``, its files under ``path`` (where all
    executors reach it), in ``buckets`` buckets by client, sorted by client and time.

    The hits are dealt by the same hash as the buckets, so a bucket is one file;
    one that is far larger than the others is split among several writers (and is
    several files) by adaptive execution, so a hot client does not keep one task
    busy.  Columns other than the hit schema's are not kept.  Null clients are one
    bucket's.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    dealt = to_hit_schema(hits).hint("rebalance", buckets, F.col("ClientID"))
    (dealt.write.format("parquet").mode(mode).bucketBy(buckets, "ClientID").sortBy("ClientID", "HitTimeStamp")
     .option("path", path).saveAsTable(table))


def bucket_sizes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes per bucket that has files."""
    sizes: dict[int, int] = {}
    for name, size in file_sizes(spark, path):
        found = _BUCKET.search(name)
        if found and not name.startswith(("_", ".")):
            sizes[int(found[1])] = sizes.get(int(found[1]), 0) + size
    return sizes


def read_bucketed_hits(spark: SparkSession, table: str, needed: Iterable[str] = (), uneven: float = 4.0,
                       least_bytes: int = 1 << 30) -> DataFrame:
    """The table's hits, by bucket.  If its largest bucket has more than ``uneven``
    times the average and more than ``least_bytes``, its files are read without
    their buckets: the same rows, split as any Parquet log is.
    """
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in details or "ClientID" not in details.get("Bucket Columns", ""):
        raise ValueError(f"{table} is not bucketed by ClientID")
    sizes = bucket_sizes(spark, details["Location"])
    largest, average = max(sizes.values(), default=0), sum(sizes.values()) / int(details["Num Buckets"])
    hot = largest > least_bytes and largest > uneven * average
    own = spark.read.schema(", ".join(f"{n} {t}" for n, t in HIT_COLUMNS)).parquet(details["Location"]) if hot else spark.table(table)
    return to_hit_schema(own, needed)
