"""Where multi-step jobs keep their intermediate tables.

A loop that only grows its plan re-reads everything in every step. ``settle`` cuts the plan by
writing a table to the shared folder that ``spark.checkpoint.dir`` names and reading it back, so the
next step starts from a file scan with known size, and a lost executor costs no recomputation of
earlier steps.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

SMALL_INPUT = 256 << 20


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables; only a local session may fall back to its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="minekit-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the stored table."""
    return stored(df, label).table


@dataclass(frozen=True)
class Stored:
    """A written table and the folder it lies in."""

    table: DataFrame
    path: str

    def discard(self) -> None:
        """Remove the folder; for states of a loop that a later state has replaced."""
        spark = self.table.sparkSession
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str) -> Stored:
    """Write ``df`` once; the result knows its folder, so it can be discarded when it is replaced."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return Stored(df.sparkSession.read.schema(df.schema).parquet(path), path)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df``; for scans the size of the files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def partitions_for(df: DataFrame, bytes_each: int, factor: float = 1.0) -> int:
    """How many partitions of about ``bytes_each`` the rows of ``df`` fill, at least one per core."""
    wanted = math.ceil(estimated_bytes(df) * factor / bytes_each)
    return max(df.sparkSession.sparkContext.defaultParallelism, min(wanted, 1 << 20))


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a small input over all cores.

    For work that is heavy per row (tokenising, measuring): a small input may sit in a single row
    group, and so in a single task. By the size test the shuffle is cheap; anything larger passes
    through untouched.
    """
    size = estimated_bytes(df)
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < SMALL_INPUT else df
