"""CSV report writers."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single_file: bool = False,
              sort_by: Sequence | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` as CSV with a header line.

    ``single_file`` funnels only the final rows into one writer task: the
    plan above it (aggregations, their shuffles) stays parallel because the
    single partition is made by a shuffle, not by ``coalesce`` reaching up
    into the plan.  ``sort_by`` orders rows inside the file(s).
    """
    out = df.repartition(1) if single_file else df
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    # blanks around a value are part of it
    (out.write.mode(mode).option("header", "true").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
