"""Hit-log readers (parquet, many paths) and the cast to the hit schema."""
from __future__ import annotations

import datetime
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import HIT_COLUMNS, KEY_COLUMNS, LEGACY_COLUMN_NAMES
from ..session import expanded


def _fields(df: DataFrame) -> dict[str, T.StructField]:
    """Fields by name as Spark resolves names: whatever the case, unless
    ``spark.sql.caseSensitive`` is set."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    wanted = {n if exact else n.lower(): n for n in (*(n for n, _ in HIT_COLUMNS), *LEGACY_COLUMN_NAMES)}
    found: dict[str, T.StructField] = {}
    for f in df.schema.fields:
        name = wanted.get(f.name if exact else f.name.lower())
        if name in found:
            raise ValueError(f"the hit log has {name} twice: {found[name].name}, {f.name}")
        if name is not None:
            found[name] = f
    return found


def _typed(fields: dict[str, T.StructField], name: str, sql_type: str) -> Column:
    """``name`` in ``sql_type``: native columns pass as they are (so filters
    on them reach the parquet reader), others are ``try_cast`` so a bad
    value becomes null instead of failing the job.  Where a log has a column
    under both its names (merged files of different age), either may hold the value."""
    names = [name, *(old for old, new in LEGACY_COLUMN_NAMES.items() if new == name)]
    there = [(F.col(f"`{fields[n].name}`"), fields[n].dataType.simpleString()) for n in names if n in fields]
    found = [c if kind == sql_type else c.try_cast(sql_type) for c, kind in there]
    if not found:
        return F.lit(None).cast(sql_type).alias(name)
    return (found[0] if len(found) == 1 else F.coalesce(*found)).alias(name)


def _check(logs: Sequence[DataFrame], needed: Iterable[str]) -> None:
    """Key columns and ``needed`` ones must be in one of ``logs`` (the groups of a log)."""
    there = {LEGACY_COLUMN_NAMES.get(n, n) for df in logs for n in _fields(df)}
    lacking = [c for c in dict.fromkeys((*KEY_COLUMNS, *needed)) if c not in there]
    if lacking:
        raise ValueError(f"the hit log has no column {', '.join(lacking)}; it has {', '.join(dict.fromkeys(c for df in logs for c in df.columns))}")


def to_hit_schema(df: DataFrame, needed: Iterable[str] = ()) -> DataFrame:
    """Project any hit log onto the 13-column hit schema.

    Older logs call ``interaction_type``/``profile`` ``adr_typenum``/
    ``adr_profile``.  Names are told apart by case only if the session does so.
    A log without a key column, or without one of ``needed``, is refused, and one
    with two columns of one name; other columns it lacks are null.
    """
    _check([df], needed)
    fields = _fields(df)
    return df.select(*[_typed(fields, name, t) for name, t in HIT_COLUMNS])


def _do_not_merge(e: Exception) -> bool:
    return bool(re.search("CANNOT_MERGE|merge (incompatible|schema)|[Ff]ailed (to merge|merging)", str(e)))


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """The Parquet files of ``paths`` as few DataFrames, each of files whose
    schemas merge; partition columns stay.

    Where all merge (Spark reads all footers to know), that is one.  Otherwise, path
    by path, folders are grouped by the schema of one of their files, and a group
    that doesn't merge after all is halved until its parts do.
    """
    def read(files: Sequence[str], root: str | None = None) -> list[DataFrame]:
        reader = spark.read.option("mergeSchema", "true")
        try:
            return [(reader.option("basePath", root) if root else reader).parquet(*files)]
        except Exception as e:  # noqa: BLE001  the classes differ by how Spark is reached
            if not _do_not_merge(e):
                raise
            return []

    def halved(files: Sequence[str], root: str) -> list[DataFrame]:
        half = len(files) // 2
        return read(files, root) or [df for part in (files[:half], files[half:]) for df in halved(part, root)]

    if whole := read(paths):
        return whole
    out = []
    for root in (r for p in paths for r in expanded(spark, p)):
        if whole := read([root]):
            out += whole
            continue
        folders: dict[str, list[str]] = {}
        for f in sorted(spark.read.option("mergeSchema", "false").parquet(root).inputFiles()):
            folders.setdefault(f.rsplit("/", 1)[0], []).append(f)
        alike: dict[str, list[str]] = {}
        for files in folders.values():
            kinds = spark.read.parquet(files[0]).schema  # one footer
            alike.setdefault(str(sorted((f.name.lower(), f.dataType.simpleString()) for f in kinds)), []).extend(files)
        out += [df for files in alike.values() for df in halved(files, root)]
    return out


def read_hits(spark: SparkSession, paths: str | Sequence[str], merge_schema: bool = True,
              day_column: str | None = None,
              days: tuple[datetime.date, datetime.date] | None = None, day_format: str | None = None,
              schema: str | T.StructType | None = None, needed: Iterable[str] = ()) -> DataFrame:
    """Parquet hit log from one or more paths (comma list allowed).

    A log partitioned by day (``.../dt=2024-01-10/...``, or another
    ``day_format`` such as ``yyyyMMdd``) is read only for the partitions with
    ``day_column`` in ``days`` (inclusive) and for the partition without a day:
    a filter on the partition column, so Spark opens only those directories.
    With ``merge_schema`` Spark reads the footers of all files first; files whose
    schemas do not merge (a goal that is an int here and a long or a text there)
    are read in groups (see ``schema_groups``), each cast by itself.  Give the
    log's ``schema`` to read no footer.
    """
    if isinstance(paths, str):
        paths = [p.strip() for p in paths.split(",") if p.strip()]
    if schema is not None:
        logs = [spark.read.schema(schema).parquet(*paths)]
    elif merge_schema:
        logs = schema_groups(spark, paths)
    else:
        logs = [spark.read.option("mergeSchema", "false").parquet(*paths)]
    if day_column is not None and days is not None:
        first, last = days
        day = F.to_date(F.col(day_column).cast("string"), day_format) if day_format else F.col(day_column).cast("date")
        logs = [raw.filter(F.col(day_column).isNull() | ((day >= F.lit(first)) & (day <= F.lit(last)))) for raw in logs]
    _check(logs, needed)
    parts = [raw.select(*[_typed(fields, name, t) for name, t in HIT_COLUMNS]) for raw in logs for fields in [_fields(raw)]]
    return reduce(DataFrame.unionAll, parts)
