"""Where intermediate results that must outlive an executor are kept."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names, or a temporary one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    known = getattr(spark, "_tickstone_scratch", None)
    if known is None:
        known = spark._tickstone_scratch = tempfile.mkdtemp(prefix="tickstone-")
    return known


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the copy.

    Several branches of a plan then see the same rows even where the plan that
    made them is not repeatable, a lost executor costs a re-read and not a
    recomputation, and each branch reads only the columns it uses.
    """
    path = scratch_path(df.sparkSession, "part")
    df.write.option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Workspace:
    """Copies that only one piece of work needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.used = spark, path, False

    def store(self, df: DataFrame) -> tuple[DataFrame, int]:
        """``df`` written once and read back, and its row count."""
        path, written = f"{self.path}/{uuid.uuid4().hex}", Observation()
        self.used = True
        counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.option("compression", "snappy").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), written.get["rows"]


@contextmanager
def workspace(spark: SparkSession) -> Iterator[Workspace]:
    """A workspace, emptied when the work is done and left for replay when it fails."""
    work = Workspace(spark, scratch_path(spark, "work"))
    yield work
    if work.used:
        remove(spark, work.path)
