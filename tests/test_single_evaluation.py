"""Readers that name a value several times find it once; odd texts give what they gave."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions import clinical as C
from caseloom.operators import packets as P


def plan(df) -> str:
    return df._jdf.queryExecution().analyzed().toString()


def test_components_and_genes_are_found_once(spark):
    parsed = spark.createDataFrame([("1", None, "", "", "", "")], "ID string, reference string, parsed_hpo_ids string, parsed_pheno_text string, parsed_omim_ids string, parsed_variants string")
    assert plan(P.parsed_packets(parsed, "t")).count("aggregate(") == 1
    one = spark.createDataFrame([("TTN:c.1A>G",)], "v string")
    assert plan(one.select(C.gene_symbol(F.col("v")).alias("x"))).count("regexp_extract(") == 3
    assert plan(one.select(C.age_iso(F.col("v")).alias("x"))).count("regexp_extract(") == 4


def test_odd_parts_and_ages(spark):
    texts = spark.createDataFrame([(0, "x (HP:0000001)|(HP:0000002) (OMIM:123456)| (HP:1)|free (note)|a (OMIM:654321),(),\u2003"), (1, None), (2, "")], "k int, t string")
    pieces = {r["k"]: [(p["hpo"], p["omim"], p["text"]) for p in r["p"]] for r in texts.select("k", C.phenotype_pieces(F.col("t")).alias("p")).collect()}
    want = [(["HP:0000001"], [], []), ([], ["OMIM:123456"], []), ([], [], []), ([], [], ["free"]), ([], ["OMIM:654321"], []), ([], [], [])]
    assert pieces == {0: want, 1: [], 2: []}
    mapped = F.create_map(F.lit("free"), F.lit("HP:0000009"))
    found = texts.where("k = 0").select(F.filter(C.phenotype_pieces(F.col("t"), mapped), lambda x: F.array_contains(x["hpo"], "HP:0000009")).alias("p")).first()["p"]
    assert len(found) == 1 and found[0]["text"] == []
    ages = spark.createDataFrame([("2 weeks 1 day",), ("",), (None,), (" infant ",), ("p3y",), ("none",), ("5Y 3 months",)], "a string").select(C.age_iso(F.col("a")))
    assert [r[0] for r in ages.collect()] == ["P1D14D", None, None, "P6M", "P3Y", None, "P5Y3M"]
