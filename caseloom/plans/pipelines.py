"""Sources to cases, cases to documents, parsed cases to documents, documents to ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import clinical as C
from caseloom.operators import harmonize as H
from caseloom.operators import match as M
from caseloom.operators import packets as P
from caseloom.operators import similarity as S
from caseloom.operators import stats
from caseloom.operators import validate as V
from caseloom.sources import tables
from caseloom.sources.shared import written


def canonical_cases(literature: DataFrame, clinical: DataFrame, hospital: DataFrame, names: DataFrame | None = None, prefix: str = "CASE", find=None) -> DataFrame:
    """Three raw sources to one case table; with ``names`` free text of the first two is annotated as well.

    ``find`` (a function of one text that gives phrases) may take the place of the
    dictionary; texts that it fails on keep the ids that patterns find.
    """
    lit, clin, hosp = H.standardise(literature, H.literature()), H.standardise(clinical, H.clinical_literature()), H.standardise(hospital, H.hospital())
    if names is not None:
        texts = H.keyed_phenotypes(lit, clin).select(F.col("ID").alias("id"), F.col("phenotypes").alias("text")).where("text is not null")
        found = M.annotate(texts, names) if find is None else M.annotate_or_skip(texts, names, find)[0]
        lit, clin = H.merge_annotations(lit, found, "LIT_"), H.merge_annotations(clin, found, "CLIT_")
    return H.union_sources(lit, clin, hosp, prefix=prefix)


def parse_cases(cases: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Adds four ``;``-joined columns: parsed_hpo_ids, parsed_omim_ids, parsed_pheno_text, parsed_variants.

    ``terms`` (name, id) maps free text by a join.
    """
    # the pieces stand in a projection of their own, so that a text is taken apart once
    pieces = cases.withColumn("_pieces", C.phenotype_pieces(F.col("phenotypes")))
    both = pieces.withColumns({"_p": C.phenotype_sets(F.col("_pieces")), "_row": F.monotonically_increasing_id()}).drop("_pieces")
    hpo, free = F.col("_p.hpo"), F.col("_p.text")
    if terms is not None:
        each = both.select("_row", F.explode("_p.text").alias("text"))
        m = M.map_text(each, terms).groupBy("_row").agg(F.collect_set("id").alias("_ids"), F.collect_set(F.when(F.col("id").isNull(), F.col("text"))).alias("_left"))
        both = both.join(m, "_row", "left")
        none = F.array().cast("array<string>")
        hpo, free = F.array_sort(F.array_union(hpo, F.coalesce("_ids", none))), F.array_sort(F.coalesce("_left", none))
    out = both.withColumns(
        {
            "parsed_hpo_ids": F.array_join(hpo, ";"), "parsed_omim_ids": F.array_join("_p.omim", ";"), "parsed_pheno_text": F.array_join(free, ";"),
            "parsed_variants": F.array_join(C.parsed_variants(F.col("variants")), ";"),
        }
    )
    return out.select(*cases.columns, "parsed_hpo_ids", "parsed_omim_ids", "parsed_pheno_text", "parsed_variants")


def rank_genes(packets: DataFrame, profiles: DataFrame, edges: DataFrame, transcripts: DataFrame, method: str = "resnik") -> tuple[DataFrame, DataFrame]:
    """Results for each evaluated document, and why others were skipped."""
    truth = S.skip_reason(S.truth_of(packets, transcripts), profiles)
    good = truth.where("skip_reason is null")
    terms = packets.select("id", F.explode("phenotypicFeatures.type.id").alias("term")).join(good.select("id"), "id", "left_semi")
    results = S.evaluated(terms, good, profiles, S.closure(edges), method).join(good.select("id", F.col("n_terms").alias("num_hpo_terms")), "id")
    return results.select(F.col("id").alias("packet_id"), "ground_truth_gene", "rank", "score", "num_hpo_terms", "roc_auc"), truth.where("skip_reason is not null")


def generate(parsed: DataFrame, created: str, prefix: str = "CASE_") -> tuple[DataFrame, DataFrame]:
    """Documents of parsed cases that validate, and those that do not (id, messages).

    A finding that asks for a disease does not count where the case has none.
    Documents and findings are written to the shared folder once: a filter on
    findings would else be pushed below all rules, each time with all it is made of.
    """
    own = parsed if "reference" in parsed.columns else parsed.withColumn("reference", F.lit(None).cast("string"))
    made = P.parsed_packets(own, created, prefix)
    held = written(made.select("*", F.to_json(F.struct(*made.columns)).alias("_text")), "packets")
    judged = written(V.validate(held, "_text").drop("_text", "name", "findings", "warnings"), "judged")
    good = V.accepted(judged, F.col("diseases").isNotNull()).select(*made.columns)
    left = V.accepted(judged, F.col("diseases").isNotNull(), False)
    return good, left.select("id", F.array_join(F.transform("errors", lambda e: e["message"]), "; ").alias("messages"))


def generation_summary(parsed: DataFrame, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """One row of counts over parsed cases, and the k most frequent terms (equal counts by first mention)."""
    split = lambda c: F.coalesce(F.filter(F.split(c, ";"), lambda x: F.trim(x) != ""), F.array().cast("array<string>"))
    own = parsed.select(split("parsed_hpo_ids").alias("h"), split("parsed_variants").alias("v"), F.monotonically_increasing_id().alias("place"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    summary = own.agg(F.count("*").alias("cases"), F.count_if(F.size("h") > 0).alias("with_features"), F.count_if(F.size("v") > 0).alias("with_variants"), count(F.size("h")).alias("features"))
    each = own.select(F.posexplode("h").alias("i", "term"), F.col("place")).withColumn("at", F.struct("place", "i"))
    return summary, stats.top_terms(each, "term", "at", k)


def convert(spark: SparkSession, cases_path: str, terms: DataFrame, created: str) -> DataFrame:
    return P.build(tables.read_delimited(spark, cases_path), terms, created)


def check(spark: SparkSession, path: str) -> DataFrame:
    from caseloom.sources.documents import read_raw_documents

    return V.validate(read_raw_documents(spark, path), number="i")
