"""Delimited tables of cases, as strings, with missing values as nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.functions.missing import without_na
from caseloom.sources.shared import written
from caseloom.sources.sheets import read_workbook


def read_delimited(spark: SparkSession, path: str, separator: str = "\t", encoding: str = "UTF-8", strip_header: bool = False, na: bool = True) -> DataFrame:
    """A table with a header, all columns strings; quoted fields may hold separators and line ends."""
    df = spark.read.csv(path, sep=separator, header=True, encoding=encoding, multiLine=True, quote='"', escape='"', inferSchema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if strip_header:
        df = df.toDF(*[c.strip() for c in df.columns])
    return without_na(df) if na else df


def read_latin1(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, encoding="ISO-8859-1")


def read_sheet(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A sheet of an Excel workbook (``sheets``), or its export as a tab-separated table."""
    if not path.endswith((".xlsx", ".xlsm")):
        return read_delimited(spark, path)
    return without_na(read_workbook(spark, path, sheet))


def read_positional(spark: SparkSession, path: str) -> DataFrame:
    """id and text, by position; headers and short rows go, of rows with one id the last stays."""
    df = spark.read.csv(path, sep="\t", header=True, enforceSchema=True, multiLine=True, quote='"', escape='"', schema="id string, text string", mode="PERMISSIVE")
    df = df.withColumn("ord", F.monotonically_increasing_id()).where(F.col("text").isNotNull())
    last = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("ord")))
    return df.withColumn("r", last).where("r = 1").drop("r")


def read_associations(spark: SparkSession, path: str) -> DataFrame:
    """gene and term of a tab-separated association table; genes without terms go."""
    df = read_delimited(spark, path)
    gene, term = df.columns[:2]
    return df.select(F.col(gene).alias("gene"), F.col(term).alias("term")).dropna().distinct()


def read_transcripts(spark: SparkSession, path: str | None) -> DataFrame:
    """accession and gene; an empty table where no lookup is given."""
    if path is None:
        return spark.createDataFrame([], "accession string, gene string")
    return spark.read.parquet(path).select("accession", "gene")


def numbered(df: DataFrame, order: list, name: str = "ID") -> DataFrame:
    """A number from 1 on in the order given, without a single-task window over all rows.

    Rows are sorted by range and written once to the shared folder, with their
    partition and place in it; numbers are made from that table only, so both the
    sizes of the partitions and the rows come from one and the same dealing,
    whatever adaptive execution does.  Rows that are equal in ``order`` go by a hash
    of all their columns; equal rows are alike, so their order shows nowhere.
    """
    columns = [f"`{c}`" for c in df.columns]
    keyed = df.withColumn("_h", F.xxhash64(*columns))
    placed = keyed.orderBy(*order, "_h").withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()).drop("_h")
    held = written(placed, "numbered")
    sizes = held.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_m").alias("_low"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sizes.select("_p", before.alias("_base"), "_low")  # a row for each partition
    out = held.join(F.broadcast(base), "_p")
    return out.withColumn(name, (F.col("_base") + F.col("_m") - F.col("_low") + 1).cast("long")).drop("_p", "_m", "_base", "_low")
