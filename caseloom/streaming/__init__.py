"""The row rules on streams, which keep no state, and numbers that run on over all batches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from caseloom.functions import clinical as C
from caseloom.operators import validate as V
from caseloom.sources.tables import numbered


def derived_cases(stream: DataFrame) -> DataFrame:
    """Adds age, sex, disease, class, terms and genes to a stream (or table) of canonical cases."""
    return stream.withColumns(
        {
            "age_iso": C.age_iso(F.col("age")), "sex_enum": C.sex_enum(F.col("sex")), "omim": C.omim_id(F.col("diagnosticComment")),
            "acmg": C.acmg_class(F.col("variantInterpretation")), "terms": C.listed_terms(F.col("phenotypicFeatureIds")),
            "genes": F.transform(C.variant_list(F.col("genomicVariants")), C.gene_symbol),
        }
    )


def validated(stream: DataFrame, doc: str = "doc") -> DataFrame:
    return V.validate(stream, doc)


def numbered_sink(stream: DataFrame, path: str, checkpoint: str, prefix: str = "CASE") -> StreamingQuery:
    """Writes micro-batches with ids ``prefix`` and a number that runs on over all batches, without gaps.

    Each batch is numbered densely in the order that it is read (``tables.numbered``)
    and starts where the one before has ended.  That total is kept below ``path`` with
    the batch's id, so a batch that is run again, or a query that is started again from
    its checkpoint, gives the same numbers.
    """
    return stream.writeStream.foreachBatch(lambda batch, k: write_numbered(batch, k, path, prefix)).option("checkpointLocation", checkpoint).start()


def numbers_before(spark: SparkSession, path: str, batch: int) -> int:
    """How many rows all batches before this one had."""
    try:
        totals = spark.read.schema("total long, batch long").parquet(f"{path}/_numbers").where(F.col("batch") < batch)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
    last = totals.agg(F.max_by("total", "batch")).first()[0]
    return last or 0


def write_numbered(batch: DataFrame, k: int, path: str, prefix: str = "CASE") -> None:
    """One batch of ``numbered_sink``: its rows first, then its total; both replace what an earlier try has left."""
    spark = batch.sparkSession
    before = numbers_before(spark, path, k)
    out = numbered(batch, [F.monotonically_increasing_id()], "_n")
    n = out.count()
    out.withColumn("ID", F.concat(F.lit(prefix), F.col("_n") + before)).drop("_n").write.mode("overwrite").parquet(f"{path}/batch={k}")
    spark.range(1).select(F.lit(before + n).cast("long").alias("total")).write.mode("overwrite").parquet(f"{path}/_numbers/batch={k}")
