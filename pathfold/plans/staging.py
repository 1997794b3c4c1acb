"""Stages of a job that a rerun takes up: tables and actions with commit markers.

A job's stages live in one folder of the shared checkpoint folder, named by what the
job is (its parameters and input files).  A stage counts as finished once its
marker is there, which is written after everything else of it; a rerun of the
same job reads finished tables and skips finished actions, and does over whatever
has no marker.  The folder goes when the job is done.  Two runs of one job at the
same time are not provided for.
"""
from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_folder, path_exists, shared_dir, touch


def job_key(hits: DataFrame, *what) -> str:
    """A name for the job that reads ``hits`` under parameters ``what``: the same
    for the same input files and parameters; of its own kind where the hits come
    from no files."""
    files = sorted(hits.inputFiles())
    if not files:
        return uuid.uuid4().hex
    return hashlib.sha256("\n".join([*map(repr, what), *files]).encode()).hexdigest()[:32]


class Stages:
    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.folder = spark, os.path.join(shared_dir(spark), f"job-{job}")

    def _marker(self, name: str) -> str:
        return os.path.join(self.folder, "_finished", name)

    def finished(self, name: str) -> bool:
        return path_exists(self.spark, self._marker(name))

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """``make()`` as a Parquet table: written now, unless an earlier run has finished it."""
        path = os.path.join(self.folder, name)
        if not self.finished(name):
            make().write.mode("overwrite").parquet(path)  # over what an earlier run left unfinished
            touch(self.spark, self._marker(name))
        return self.spark.read.parquet(path)

    def once(self, name: str, act: Callable[[], None]) -> None:
        """``act()``, unless an earlier run has finished it."""
        if not self.finished(name):
            act()
            touch(self.spark, self._marker(name))

    def done(self) -> None:
        delete_folder(self.spark, self.folder)
