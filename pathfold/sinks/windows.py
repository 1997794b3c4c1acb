"""Reports kept side by side, one partition per report window."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = "report_window"


def write_window(df: DataFrame, path: str, window: str, file_format: str = "csv", most_rows: int = 1_000_000,
                 keep_order: bool = False) -> None:
    """``df`` as the partition ``report_window=<window>`` of the report at ``path``.

    Only that partition is replaced (dynamic partition overwrite), and only when all
    its new files are there; other windows' files stay as they are, byte by byte.
    An empty ``df`` replaces nothing: Spark cannot tell its partition.  Files have
    at most ``most_rows`` rows.  Adaptive execution makes them of like size, unless
    ``keep_order`` asks to keep a sorted report's order across its files.
    """
    if not window or "/" in window:
        raise ValueError(f"{window!r} is no name for a report window")
    if WINDOW in df.columns:
        raise ValueError(f"the report has a column {WINDOW} already")
    out = (df if keep_order else df.hint("rebalance")).withColumn(WINDOW, F.lit(window))
    writer = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", most_rows)
              .partitionBy(WINDOW))
    if file_format == "csv":  # blanks around a value are part of it
        writer = writer.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    writer.format(file_format).save(path)
