"""Nested JSON documents and annotation maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.packets import PACKET
from caseloom.sources.elements import read_elements


def read_annotations(spark: SparkSession, path: str, joined: bool = False) -> DataFrame:
    """id and terms of a JSON map of term lists; a malformed file gives none."""
    entries = read_elements(spark, path, "{", joined).where("text IS NOT NULL")
    return entries.select(F.explode(F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), "map<string,array<string>>")).alias("id", "terms"))


def read_raw_documents(spark: SparkSession, path: str, joined: bool = False) -> DataFrame:
    """doc (raw JSON text) and i of a JSON array or a single object; a malformed file gives one doc that is null."""
    return read_elements(spark, path, "[", joined).select("i", F.col("text").alias("doc"))


def read_packets(spark: SparkSession, folder: str) -> DataFrame:
    """All ``*.json`` documents of a folder, one for each file."""
    return spark.read.schema(PACKET).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
