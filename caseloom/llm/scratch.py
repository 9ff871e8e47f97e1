"""Shared scratch space: where intermediate tables live between jobs.

Everything goes below the folder that the cluster names in
``spark.checkpoint.dir`` (visible to the driver and every executor), so a lost
executor never loses an intermediate result.  Only where the setting is absent
and the master is local, as in unit tests, a temporary folder is made and set;
on a cluster that is an error.

Tables that a lazy result still reads cannot be deleted by the operator that
made it.  A run that writes its results itself collects the tables made meanwhile
(``collecting``) and deletes those, and only those, when it no longer reads them.
"""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_MADE: contextvars.ContextVar[set[str] | None] = contextvars.ContextVar("tables made in this run", default=None)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def root(spark: SparkSession) -> str:
    """The shared folder of this session."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="caseloom-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{root(spark).rstrip('/')}/caseloom/{name}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.add(path)
    return path


@contextmanager
def collecting() -> Iterator[set[str]]:
    """The paths of the tables that are made inside, and not dropped again."""
    before = _MADE.set(set())
    try:
        yield _MADE.get()
    finally:
        _MADE.reset(before)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")  # the written table replaces the shuffle files
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that no later plan reads."""
    jvm = spark.sparkContext._jvm
    made = _MADE.get()
    for path in paths:
        if made is not None:
            made.discard(path)
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, which else holds 10,000 texts of any length."""
    try:
        now = int(spark.conf.get(BATCH))
    except ValueError:
        now = 1 << 62
    if now > BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))
