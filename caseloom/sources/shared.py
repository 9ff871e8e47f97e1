"""Where written intermediate tables live: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one is made only where the master is local and none is set."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="caseloom-")
    spark.sparkContext.setCheckpointDir(base)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: what it holds is settled."""
    path = f"{folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
