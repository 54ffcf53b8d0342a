"""Cutting lineage with tables written to the shared folder the cluster names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"

# Tables cut so far, by the run that owns them; the last run is the one that is open.
_runs: list[list[str]] = [[]]


# The run of the stage that next_stage has opened.
_stage: list[str] | None = None


def new_path(spark: SparkSession, label: str = "cut", outlive: bool = False) -> str:
    """A fresh path in the shared folder, owned by the run that is open.

    With ``outlive`` the run around an open stage owns it, so that it stays for the next stage.

    Only a local-mode session may go without the setting; it then gets a temporary
    folder, which goes when the process ends.
    """
    base = spark.conf.get(SHARED_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SHARED_DIR} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="cellarium-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set(SHARED_DIR, base)
    path = f"{base}/cellarium-{label}-{uuid.uuid4().hex}"
    owner = _runs[-1]
    if outlive and owner is _stage:
        owner = _runs[-2]
    owner.append(path)
    return path


def next_stage(spark: SparkSession) -> None:
    """Opens a stage of a chain of jobs, and deletes what the stage before it has cut.

    A stage's result is stored before the next one starts, so nothing reads its tables any more.
    """
    global _stage
    end_stage(spark)
    _stage = []
    _runs.append(_stage)


def end_stage(spark: SparkSession) -> None:
    global _stage
    if _stage is not None and _runs[-1] is _stage:
        release(spark)
        _runs.pop()
    _stage = None


@contextmanager
def run(spark: SparkSession) -> Iterator[None]:
    """Tables cut inside belong to this run alone and go at its end.

    What is computed from them has to be stored, or read, before.  Runs may be nested.
    """
    _runs.append([])
    try:
        yield
    finally:
        release(spark)
        _runs.pop()


def release(spark: SparkSession) -> int:
    """Deletes the tables of the run that is open; call it once results are kept."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _runs[-1]:
        path = jvm.org.apache.hadoop.fs.Path(_runs[-1].pop())
        gone += path.getFileSystem(conf).delete(path, True)
    return gone


def settle(
    df: DataFrame, label: str = "cut", by: str | None = None, outlive: bool = False
) -> DataFrame:
    """Write ``df`` once and read it back, with a folder per value of ``by`` if given.

    A later loss of an executor then re-reads the same rows, in the same files,
    rather than running a shuffle again that may place rows differently.
    """
    spark = df.sparkSession
    path = new_path(spark, label, outlive)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
