"""CSV-era hit log: header line, ';' separated, every field a string."""
from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .hits import to_hit_schema


def read_csv_hits(spark: SparkSession, paths: str | Sequence[str], sep: str = ";",
                  needed: Iterable[str] = ()) -> DataFrame:
    """Read the CSV hit log and cast it to the hit schema.

    Columns are taken by their header names, in any order, as strings (no
    inference pass over the data).  Every path is read by its own header;
    within a path (a folder, a pattern) a file with another header than the
    first one's fails the job.  A log without a key column is refused, other
    columns it lacks become null, and so do bad numbers.
    """
    if isinstance(paths, str):
        paths = [paths]
    reader = (spark.read.option("header", "true").option("sep", sep).option("inferSchema", "false")
              .option("enforceSchema", "false"))
    return reduce(DataFrame.unionByName, [to_hit_schema(reader.csv(p), needed) for p in paths])
