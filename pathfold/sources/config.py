"""One-record JSON job configuration."""
from __future__ import annotations

from pyspark.sql import SparkSession

from ..params import JobParams

#: fields of the record
CONFIG_SCHEMA = ("projectID bigint, date_start string, date_finish string, target_numbers array<bigint>, source_platform array<string>, "
                 "product_name string, flat_path string, output_path string")
REQUIRED = ("projectID", "date_start", "date_finish", "target_numbers", "source_platform")
_BAD = "_corrupt_record"


def read_config(spark: SparkSession, path: str, **overrides) -> JobParams:
    """Read the JSON config (one record) into ``JobParams``.

    Read through Spark so that the config may live on any file system the cluster
    reads, by a fixed schema: nothing is inferred.  A text that is no JSON, a field
    of another type, a missing or null required field (a null inside a list, too),
    no record or more than one are refused; other fields than the known ones are
    not looked at.
    """
    rows = (spark.read.schema(f"{CONFIG_SCHEMA}, {_BAD} string").option("multiLine", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _BAD).json(path).head(2))
    if len(rows) != 1:
        raise ValueError(f"{path} has {'more than one' if rows else 'no'} record")
    record = rows[0].asDict(recursive=True)
    bad = record.pop(_BAD)
    if bad is not None:
        raise ValueError(f"{path} is no JSON record, or a field has another type than in ({CONFIG_SCHEMA}): {bad.strip()[:200]}")
    lacking = [c for c in REQUIRED if record[c] is None or (isinstance(record[c], list) and None in record[c])]
    if lacking:
        raise ValueError(f"{path} has no {', '.join(lacking)}")
    return JobParams.from_config_record(record, **overrides)
