"""Phrases to dictionary names: exact, then fuzzy for the rest."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from caseloom.functions.clinical import is_finding
from caseloom.operators import isolate, mentions, subsequence
from caseloom.sources.shared import written

THRESHOLD = 60.0
#: Names that a task holds at once for fuzzy matching: some 10 KB each with 64 letters.
NAMES = 50_000
#: Tasks for each core in fuzzy matching.
TASKS = 4


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).lower().strip())


def normalise(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the NFKC, lower-case, stripped form; Python sees distinct non-ASCII texts only."""
    ascii_ = F.col(column).rlike(r"^[\x00-\x7F]*$")
    wide = df.select(column).where(~ascii_).distinct().withColumn("_n", _nfkc(F.col(column))).withColumnRenamed(column, "_raw")
    done = df.join(wide, F.col(column) == F.col("_raw"), "left").drop("_raw")
    plain = F.regexp_replace(F.lower(column), r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return done.withColumn(out, F.when(ascii_, plain).otherwise(F.col("_n"))).drop("_n")


def token_sort(c: Column) -> Column:
    """Words in sorted order, one space between them."""
    return F.array_join(F.array_sort(F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")), " ")


def exact(phrases: DataFrame, names: DataFrame, phrase: str = "phrase") -> DataFrame:
    """Adds the id of the name that equals the phrase, or null."""
    return phrases.join(names.select(F.col("name").alias(phrase), "id"), phrase, "left")


def fuzzy(phrases: DataFrame, names: DataFrame, threshold: float = THRESHOLD, most: int = NAMES) -> DataFrame:
    """phrase, best name, id and score of phrases with a name at or over the threshold.

    The score is 200 L / (l1 + l2) on sorted words, L the longest common
    subsequence.  Each task holds the names as matrices and gives one row for a
    phrase at most (``subsequence``), so pairs are never rows.  Dictionaries of over
    ``most`` names are cut; each part is one pass over the phrases, and the best of
    all passes stays.  Ties go to the name that is first in the dictionary.
    """
    each = phrases.select("phrase").where("phrase is not null").distinct()
    d = names.select("name", "id", "ord").where("name is not null")
    parts = max(1, -(-d.count() // most))
    kinds = {c: d.schema[c].dataType for c in ("id", "ord")}
    schema = T.StructType([T.StructField("phrase", T.StringType()), T.StructField("name", T.StringType()), T.StructField("id", kinds["id"]), T.StructField("ord", kinds["ord"]), T.StructField("score", T.DoubleType())])
    # dealt evenly: a short phrase stands for long work, which sizes in bytes do not tell
    dealt = each.repartition(TASKS * d.sparkSession.sparkContext.defaultParallelism, "phrase")
    spread = dealt.withColumn("_s", token_sort(F.col("phrase")))
    found = None
    for k in range(parts):
        mine = d if parts == 1 else d.where(F.pmod(F.xxhash64("name"), F.lit(parts)) == k)
        rows = mine.withColumn("_s", token_sort(F.col("name"))).collect()  # about ``most`` names
        held = d.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            rows = held.value
            table = subsequence.Names([r["_s"] for r in rows], [r["ord"] for r in rows])
            fields = to_arrow_schema(schema)
            for batch in batches:
                out = []
                for phrase, hit in zip(batch.column(0).to_pylist(), table.bests(batch.column(1).to_pylist(), threshold)):
                    if hit:
                        r = rows[hit[0]]
                        out.append({"phrase": phrase, "name": r["name"], "id": r["id"], "ord": r["ord"], "score": hit[1]})
                yield pa.RecordBatch.from_pylist([{**x, "ord": x["ord"].asDict() if hasattr(x["ord"], "asDict") else x["ord"]} for x in out], schema=fields)

        part = spread.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if parts > 1:
        first = F.row_number().over(Window.partitionBy("phrase").orderBy(F.desc("score"), "ord"))  # one row for each part
        found = found.withColumn("_r", first).where("_r = 1")
    return found.select("phrase", "name", "id", "score")


def match(phrases: DataFrame, names: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """phrase and id of distinct phrases: exact matches, then fuzzy ones for those left."""
    each = phrases.select("phrase").distinct()
    found = each.join(names.select(F.col("name").alias("phrase"), "id"), "phrase")
    rest = each.join(names.select(F.col("name").alias("phrase")), "phrase", "left_anti")
    return found.unionByName(fuzzy(rest, names, threshold).select("phrase", "id"))


def map_text(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """Lower-cased free text (``text``) to ids; without a match ``id`` is null."""
    return texts.join(terms.select(F.col("name").alias("_n"), "id"), F.lower("text") == F.col("_n"), "left").drop("_n")


def annotate(texts: DataFrame, names: DataFrame, key: str = "id", text: str = "text", threshold: float = THRESHOLD, extract=None) -> DataFrame:
    """key and terms (sorted ids, maybe none) of every text.

    Names that stand in the text, wherever and of whatever length, give their ids
    unless they are negated; what stands between them is matched to its best name
    where that reaches the threshold.  In place of both, ``extract`` may be any
    annotator that gives key and phrase (a language model, say); ``annotate_or_skip``
    takes one that may fail.
    """
    if extract is not None:
        said = extract(texts, key, text)
        matched = said.join(match(said, names, threshold).withColumnRenamed("id", "_term"), "phrase")
    else:
        direct = mentions.find(texts, names, key, text).where("NOT negated").select(key, "name").distinct()
        direct = direct.join(names.select("name", F.col("id").alias("_term")), "name").select(key, "_term")
        rest = mentions.pieces(texts, names, key, text).withColumnRenamed("piece", "phrase").where(is_finding(F.col("phrase"))).distinct()
        rest = written(rest, "pieces")  # read three times below, and made once
        near = rest.join(match(rest, names, threshold).withColumnRenamed("id", "_term"), "phrase").select(key, "_term")
        matched = direct.unionByName(near)
    ids = matched.groupBy(key).agg(F.array_sort(F.collect_set("_term")).alias("terms"))
    return texts.select(key).distinct().join(ids, key, "left").select(key, F.coalesce("terms", F.array().cast("array<string>")).alias("terms"))


def annotate_or_skip(texts: DataFrame, names: DataFrame, find, key: str = "id", text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``annotate`` with phrases by ``find`` (a function of one text), and the texts that it fails on (key, text, error).

    Those have no terms of their own here, so what patterns find in them still counts
    where both are merged.
    """
    said, failed = isolate.phrases_by(find)(texts, key, text)
    return annotate(texts, names, key, text, threshold, extract=lambda *_: said), failed
