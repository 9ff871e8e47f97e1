"""The registered queries: thin uses of the operators on the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import attention, bpe, conversations, decontaminate, flac, jaccard, langid, licenses, merkle, planes, sampling, scratch, toxicity, urls

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    scratch.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = F.octet_length("text").cast("long")
    units = F.greatest(F.lit(1), F.ceil(n / 192)).cast("long")
    padded = docs.select(
        "doc_id", n.alias("n_bytes"),
        F.encode(F.concat("text", F.repeat(F.lit(" "), (units * 192 - n).cast("int"))), "utf-8").alias("payload"),
    )
    stored = flac.encode(padded).drop("payload")
    back = flac.decode(stored)
    size = F.length("pcm")
    return back.select(
        "doc_id", "n_bytes", size.cast("long").alias("payload_bytes"), F.sha2("pcm", 256).alias("payload_sha256"),
        F.crc32(F.substring("pcm", -16, 16)).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), "feature", F.size("blocks").cast("long").alias("n_blocks"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "contaminated", "n_items", "items", "coverage")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(F.col("doc_id"), 5, 0)
    model = langid.fit(docs.where(~held))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "accepted")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = langid.held_out(F.col("doc_id"), 7, 2)
    # 50,256 ranks, and the free id after them ends a text
    scored = attention.score(docs, ~held, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, 50_257)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = planes.write(docs, public_tokenizers.path(TOKENIZER))
    return planes.read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).drop("text")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def bpe_digests(docs: DataFrame) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return bpe.encode(docs, path, pattern, decoded="decoded").drop("text").select(
        "*", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damaged(table(spark, sf_dir, "conversations"))
    pieces = conversations.repair(damaged, conv="conv", present=F.col("present"))
    return conversations.summaries(pieces).withColumnRenamed("conv", "conv_id")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents_manifest(table(spark, sf_dir, "documents"))


def op13_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sampling.edit_report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def queries() -> dict:
    return {f.__name__: f for f in (op1_flac, op2_decontaminate, op3_language_id, op4_license_scan, op5_attention_lm, op6_bit_planes, op7_jaccard_join, op8_toxicity, op9_byte_bpe, op10_url_filter, op11_conversation_repair, op12_merkle_manifest, op13_weighted_sampling)}


def oracle_sql() -> dict[str, str]:
    return {"op4_license_scan": licenses.oracle(), "op7_jaccard_join": jaccard.oracle(), "op10_url_filter": urls.oracle(), "op11_conversation_repair": conversations.oracle(), "op12_merkle_manifest": merkle.oracle()}
