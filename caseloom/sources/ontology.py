"""Ontologies in OBO text, one row for each stanza."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.functions.missing import strip


def stanzas(spark: SparkSession, path: str) -> DataFrame:
    """ord, kind (Term, Typedef, ...) and body of each stanza."""
    raw = spark.read.option("lineSep", "\n[").text(path).withColumn("ord", F.monotonically_increasing_id())
    kind = F.regexp_extract("value", r"^\[?(\w+)\]", 1)
    return raw.select("ord", kind.alias("kind"), F.col("value").alias("body")).where("kind <> ''")


def _field(name: str):
    return F.regexp_extract("body", rf"(?m)^{name}: (.*)$", 1)


def terms(spark: SparkSession, path: str, prefix: str = "HP:") -> DataFrame:
    """ord, id, label, synonyms and parents of the terms with this id prefix."""
    t = stanzas(spark, path).where("kind = 'Term'")
    return t.select(
        "ord", strip(_field("id")).alias("id"), strip(_field("name")).alias("label"),
        F.regexp_extract_all("body", F.lit(r'(?m)^synonym: "([^"]+)"'), F.lit(1)).alias("synonyms"),
        F.regexp_extract_all("body", F.lit(r"(?m)^is_a: (\S+)"), F.lit(1)).alias("parents"),
    ).where(F.col("id").startswith(prefix))


def labels_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """id and label; an empty table if the file cannot be read."""
    try:
        found = terms(spark, path).select("id", "label")
        found.isEmpty()
        return found
    except Exception:  # noqa: BLE001  any reader failure leaves cases without labels
        return spark.createDataFrame([], "id string, label string")


def names(terms_: DataFrame, normal=F.lower, synonyms: bool = True) -> DataFrame:
    """name, id, label and ord of each name; of equal names the last one counts."""
    every = F.concat(F.array("label"), F.col("synonyms")) if synonyms else F.array("label")
    each = terms_.select("ord", "id", "label", F.posexplode(every).alias("k", "name")).select("ord", "k", "id", "label", normal("name").alias("name"))
    last = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("ord"), F.desc("k")))
    first = F.struct("ord", "k")
    place = F.min(first).over(Window.partitionBy("name"))
    return each.withColumn("r", last).withColumn("place", place).where("r = 1").select("name", "id", "label", F.struct(F.col("place.ord"), F.col("place.k")).alias("ord"))


def loose_names(spark: SparkSession, path: str) -> DataFrame:
    """name -> id by lines: any id prefix; an id of a later stanza kind replaces the current one.

    A missing file is an error here.
    """
    t = stanzas(spark, path).select("ord", strip(_field("id")).alias("id"), "kind", _field("name").alias("label"), F.regexp_extract_all("body", F.lit(r'(?m)^synonym: "([^"]+)"'), F.lit(1)).alias("synonyms"))
    return names(t.where("id <> ''").withColumn("label", strip("label"))).select("name", "id")


def edges(terms_: DataFrame) -> DataFrame:
    """child and parent."""
    return terms_.select(F.col("id").alias("child"), F.explode("parents").alias("parent"))
