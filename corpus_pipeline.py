"""The corpus pipeline: language, toxicity, near duplicates, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; ``run`` writes it
as Parquet below the shared checkpoint folder and reads it back as the next
stage's documents.  All stages but the last give the columns of ``documents``.

A language stage learns from the labelled rows of its own input, the toxicity
stage from ``labels`` of its own input; texts without any letter go in the first
stage.  Cases (nulls, empty or repeated texts, empty tables) are those of the
operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import bpe, decontaminate, jaccard, langid, scratch, toxicity

def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of the learned ones."""
    scratch.small_batches(spark)
    model = langid.fit(docs)
    return langid.identify(docs, model).where("accepted").select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic."""
    chain = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, chain).where("NOT toxic").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of linked documents."""
    return jaccard.keep_one(docs).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and whether decoding gives the text back."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = bpe.encode(docs.select("doc_id", "text"), path, pattern, decoded="decoded")
    return both.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("round_trip"),
    )


STAGES = [
    ("language ID", language),
    ("toxicity", toxic),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("byte-level BPE", token_ids),
]

#: Trained models and exact merges are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with scratch.collecting() as made:
            docs, path = scratch.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.drop(spark, *last, *(made - {path}))  # the stage before, and what this one has written on its way
        last = [path]
    return docs
