"""Session helpers: a local session for tests and benches, and the shared
folder jobs write intermediate tables to."""
from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pathfold",
                  extra: dict | None = None) -> SparkSession:
    """A local session: UI off, adaptive execution on, UTC session zone."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # small local inputs: let AQE keep one partition per core instead of
         # merging every shuffle into a single 1 MB task
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("PATHFOLD_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor reaches, ``spark.checkpoint.dir`` (or the
    context's checkpoint folder).

    Where neither is set, a local master gets a temporary folder of its own;
    any other master raises, since each executor would write to its own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        sc = spark.sparkContext
        d = sc.getCheckpointDir()
        if not d:
            if not re.match(r"local(\[|$)", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="pathfold-ckpt-")
            sc.setCheckpointDir(d)
    return d


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of ``path``, on whatever file system it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a staged table."""
    fs, hadoop = _hadoop(spark, path)
    fs.delete(hadoop, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _hadoop(spark, path)
    return fs.exists(hadoop)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, hadoop = _hadoop(spark, path)
    fs.create(hadoop, True).close()


def expanded(spark: SparkSession, path: str) -> list[str]:
    """The paths that a pattern stands for; one that is no pattern is itself."""
    if not re.search(r"[*?\[{]", path):
        return [path]
    fs, hadoop = _hadoop(spark, path)
    return [f.getPath().toString() for f in fs.globStatus(hadoop) or ()]


def file_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the files right in ``path``."""
    fs, hadoop = _hadoop(spark, path)
    return [(f.getPath().getName(), f.getLen()) for f in fs.listStatus(hadoop) if f.isFile()]


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a path job over ``input_bytes`` of hit log on a cluster.

    The hit shuffle carries a handful of the log's columns, so it is about
    the size of the compressed input; one shuffle partition per
    ``partition_bytes`` of input keeps each sort / window task well inside an
    executor's memory (it spills, but should not need to), and adaptive
    execution merges the small partitions of the later, smaller shuffles
    (carries, pieces, path counts).  Skewed join partitions (a hot client in
    a client-set semi / anti join) are split by AQE.
    """
    if input_bytes < 0 or partition_bytes <= 0:
        raise ValueError("sizes must be positive")
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }
