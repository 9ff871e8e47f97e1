"""Writers of tables and documents."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.sources.tables import numbered


def write_delimited(df: DataFrame, path: str, separator: str = "\t", single: bool = False) -> None:
    """A table with a header; ``single`` gives one file, by one task."""
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, sep=separator, header=True, quote='"', escape='"', emptyValue="")


def write_json_lines(packets: DataFrame, path: str) -> None:
    packets.write.mode("overwrite").json(path)


def _enclosed(rows: DataFrame, order: str, opening: str, closing: str, path: str) -> None:
    """Lines ``j`` in order between two brackets, a comma after each but the last, as part files in order.

    Rows are sorted by range and numbered over all parts, so each knows whether it is
    the first or the last one of all; every task writes its own part.
    """
    placed = numbered(rows, [order], "_n")
    n = placed.count()
    if not n:
        placed.sparkSession.createDataFrame([(opening + closing,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    first = F.when(F.col("_n") == 1, F.lit(opening + "\n")).otherwise("")
    last = F.when(F.col("_n") == n, F.lit("\n" + closing)).otherwise(",")
    lines = placed.select("_n", F.concat(first, "j", last).alias("value"))
    lines.repartitionByRange("_n").sortWithinPartitions("_n").select("value").write.mode("overwrite").text(path)


def write_json_array(packets: DataFrame, path: str, indent: int = 2, key: str = "id") -> None:
    """One indented JSON array, in order of the key, as a folder of parts; ``single_file`` makes one file of them."""
    rows = packets.select(key, _indented(F.to_json(F.struct(*packets.columns), {"pretty": "true"}), indent).alias("j"))
    _enclosed(rows, key, "[", "]", path)


def _indented(text: Column, indent: int) -> Column:
    """Pretty JSON one level deeper, with ``indent`` spaces a level in place of two."""
    named = lambda x: F.regexp_replace(F.ltrim(x), r'^("(?:[^"\\]|\\.)*") : ', "$1: ")
    lines = F.transform(F.split(text, "\n"), lambda x: F.concat(F.repeat(F.lit(" "), (F.char_length(F.regexp_extract(x, "^ *", 0)) / 2).cast("int") * indent + indent), named(x)))
    return F.array_join(lines, "\n")


def write_annotations(annotated: DataFrame, path: str) -> None:
    """A JSON map of sorted term lists, one entry a line, as a folder of parts."""
    entry = annotated.select("id", F.concat(F.expr("substring(to_json(array(id)), 2, length(to_json(array(id))) - 2)"), F.lit(": "), F.to_json("terms")).alias("j"))
    _enclosed(entry, "id", "{", "}", path)


def single_file(spark: SparkSession, folder: str, path: str) -> None:
    """The parts of a folder, in order of their names, as one file: bytes are passed on, nothing is held."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    source, target = Path(folder), Path(path)
    store = source.getFileSystem(conf)
    parts = sorted(str(x.getPath()) for x in store.listStatus(source) if x.getPath().getName().startswith("part-"))
    making = Path(f"{path}.making")
    out = target.getFileSystem(conf).create(making, True)
    for part in parts:
        into = store.open(Path(part))
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(into, out, 1 << 20, False)
        into.close()
    out.close()
    target.getFileSystem(conf).delete(target, False)
    target.getFileSystem(conf).rename(making, target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, by the path's own file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def file_names(ids: Column) -> Column:
    """A file name for each id, never the same for two and never a hidden one: ids that need cleaning get a hash of what they were."""
    clean = F.regexp_replace(ids, r"[^\p{L}\p{N}._-]", "_")
    safe = ids.isNotNull() & (clean == ids) & (F.octet_length(ids) <= 200) & ids.rlike(r"^[^._]") & ~F.lower(ids).rlike("-[0-9a-f]{16}$")
    lead = F.substring(F.regexp_replace(F.coalesce(clean, F.lit("null")), "^[._]+", ""), 1, 60)
    return F.when(safe, ids).otherwise(F.concat(lead, F.lit("-"), F.substring(F.sha2(F.coalesce(ids, F.lit("null")).cast("binary"), 256), 1, 16)))


def write_each(packets: DataFrame, folder: str) -> int:
    """One JSON file for each document, named by its id; gives their number.

    Files are written under a name of the attempt and then renamed, so a task that
    is run again leaves the same files and no part of one.  Documents that share an
    id are numbered in order of their text.
    """
    docs = packets.select(F.col("id").cast("string").alias("id"), F.to_json(F.struct(*packets.columns), {"pretty": "true"}).alias("j")).withColumn("name", file_names(F.col("id")))
    again = docs.groupBy("name").count().where("count > 1").select("name", F.lit(True).alias("again"))
    docs = docs.join(again, "name", "left")
    place = F.row_number().over(Window.partitionBy("name").orderBy("j"))
    docs = docs.where("again IS NULL").select("name", "j").unionByName(docs.where("again").select("name", "j").withColumn("k", place).select(F.concat("name", F.lit("."), "k").alias("name"), "j"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(base, recursive=True)
        attempt = f"{base}/_attempt-{uuid.uuid4().hex}"
        n = 0
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("j").to_pylist()):
                with store.open_output_stream(attempt) as out:
                    out.write(text.encode())
                store.move(attempt, f"{base}/{name}.json")
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    return docs.mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def metrics_json(metrics: DataFrame) -> str:
    return metrics.select(F.to_json(F.struct(*metrics.columns), {"pretty": "true"})).first()[0]
