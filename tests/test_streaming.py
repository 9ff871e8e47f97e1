"""Numbers of a stream over restarts and batches that are run again."""

from __future__ import annotations

from caseloom import streaming


def run(spark, tmp_path):
    stream = spark.readStream.schema("v long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = streaming.numbered_sink(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    q.processAllAvailable()
    q.stop()
    return sorted(int(r.ID.removeprefix("CASE")) for r in spark.read.parquet(str(tmp_path / "out")).collect())


def test_numbers_run_on_over_a_restart(spark, tmp_path):
    for k, n in enumerate((5, 3)):
        spark.range(n).withColumnRenamed("id", "v").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run(spark, tmp_path) == list(range(1, 9))
    assert run(spark, tmp_path) == list(range(1, 9))  # nothing new
    spark.range(4).withColumnRenamed("id", "v").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run(spark, tmp_path) == list(range(1, 13))


def test_a_batch_that_is_run_again_keeps_its_numbers(spark, tmp_path):
    path = str(tmp_path / "again")
    ids = lambda: sorted(r.ID for r in spark.read.parquet(path).collect())
    streaming.write_numbered(spark.range(3), 0, path)
    streaming.write_numbered(spark.range(2), 1, path)
    first = ids()
    streaming.write_numbered(spark.range(2), 1, path)
    assert ids() == first == [f"CASE{i}" for i in range(1, 6)]
    streaming.write_numbered(spark.range(0), 2, path)
    streaming.write_numbered(spark.range(1), 3, path)
    assert ids() == [f"CASE{i}" for i in range(1, 7)]
