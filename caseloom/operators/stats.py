"""Coverage and frequency statistics, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import clinical as C
from caseloom.functions.missing import is_missing


def share(part: Column, whole: Column) -> Column:
    """Percentage with one decimal; null without anything to divide by."""
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 1)


def case_coverage(cases: DataFrame, by: str | None = "dataSourceType") -> DataFrame:
    """Counts of cases with terms, variants, a diagnosis, an age and a known sex."""
    col, n = F.col, F.count("*")
    has = {
        "phenotypes": F.size(C.listed_terms(col("phenotypicFeatureIds"))) > 0, "variants": F.size(C.variant_list(col("genomicVariants"))) > 0,
        "diagnosis": ~is_missing(col("diagnosticComment"), blank=False), "age": C.age_iso(col("age")).isNotNull(), "sex": C.sex_enum(col("sex")) != "UNKNOWN_SEX",
    }
    sums = [F.count_if(v).alias(f"with_{k}") for k, v in has.items()]
    more = [F.sum(F.size(C.listed_terms(col("phenotypicFeatureIds")))).cast("long").alias("total_terms"), F.sum(F.size(C.variant_list(col("genomicVariants")))).cast("long").alias("total_variants")]
    grouped = cases.groupBy(by) if by else cases.groupBy()
    out = grouped.agg(n.alias("cases"), *sums, *more)
    return out.withColumns({f"{k}_pct": share(col(f"with_{k}"), col("cases")) for k in has})


def packet_summary(packets: DataFrame) -> DataFrame:
    """All counters of the built documents."""
    variants = F.flatten(F.transform(F.coalesce("interpretations", F.array().cast(packets.schema["interpretations"].dataType)), lambda i: i["diagnosis"]["genomicInterpretations"]))
    p = packets.select("subject", "phenotypicFeatures", "diseases", variants.alias("v"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return p.agg(
        F.count("*").alias("packets"), F.count_if(F.size("phenotypicFeatures") > 0).alias("with_features"), F.count_if(F.size("v") > 0).alias("with_variants"),
        F.count_if(F.col("diseases").isNotNull()).alias("with_diseases"), F.count_if(F.col("subject.timeAtLastEncounter").isNotNull()).alias("with_age"),
        F.count_if(F.col("subject.sex").isNotNull()).alias("with_sex"), count(F.size("phenotypicFeatures")).alias("features"),
        count(F.size(F.filter("phenotypicFeatures", lambda f: ~f["type"]["label"].startswith("Unknown term")))).alias("labelled_features"),
        count(F.size("v")).alias("variants"),
        count(F.size(F.filter("v", lambda g: g["variantInterpretation"]["variationDescriptor"]["geneContext"].isNotNull()))).alias("variants_with_gene"),
        count(F.coalesce(F.size(F.filter("diseases", lambda d: d["term"]["id"].startswith("OMIM:"))), F.lit(0))).alias("omim_diseases"),
    )


def top_terms(rows: DataFrame, term: str, place: str, k: int = 10) -> DataFrame:
    """The k most frequent terms; equal counts in order of first mention."""
    return rows.groupBy(F.col(term).alias("term")).agg(F.count("*").alias("n"), F.min(place).alias("first")).orderBy(F.desc("n"), "first").limit(k).select("term", "n")


def mean_per_group(sizes: Column) -> Column:
    """Mean size among groups that have any."""
    return F.sum(sizes) / F.nullif(F.count_if(sizes > 0), F.lit(0))


def first_sample(df: DataFrame, column: str) -> DataFrame:
    return df.where(~is_missing(F.col(column))).limit(1).select(column)


def annotation_gaps(annotated: DataFrame, key: str = "id", terms: str = "terms") -> DataFrame:
    """Ids without any term."""
    return annotated.where(F.size(terms) == 0).select(key)
