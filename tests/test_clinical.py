"""Golden values of the column builders."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caseloom.functions import clinical as C
from caseloom.functions import hgvs as H


def one(spark, builder, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", builder(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_age(spark):
    want = {
        "22Y": "P22Y", "6 months": "P6M", "3 years 6 months": "P3Y6M", "infant": "P6M", "newborn": "P0D", "p3y": "P3Y", "22": None, "Not reported": None, "": None, None: None,
        "1 week 3 days": "P3D7D", "2 weeks": "P14D", "1.5 years": "P5Y", "2-3 years": "P3Y", "5 min": "P5M", "Prenatal": "PRENATAL", "6MY": None, "2010-05-01": None, "unknown": None,
        " \t22 y\n": "P22Y",
    }
    assert one(spark, C.age_iso, list(want)) == list(want.values())


def test_sex(spark):
    want = {" M ": "MALE", "Girl": "FEMALE", "intersex": "OTHER_SEX", "n/a": "UNKNOWN_SEX", None: "UNKNOWN_SEX", "Not reported": "UNKNOWN_SEX", "": "UNKNOWN_SEX"}
    assert one(spark, C.sex_enum, list(want)) == list(want.values())


def test_terms(spark):
    assert one(spark, C.term_ids, ["a HP:2, HP:10 HP:2", "none", None]) == ["HP:2,HP:10", "", ""]
    assert one(spark, C.listed_terms, ["HP:1, X:2,HP:1", None, "Not reported", ""]) == [["HP:1", "HP:1"], [], [], []]


def test_gene(spark):
    want = {
        "SCN1A:c.2398G>A": "SCN1A", "BRCA1:NM_007294.3:c.1A>G": "BRCA1", "TP53 (c.1A>G)": "TP53", "TTN [x]": "TTN", "TP53 p.Arg1Ter": "TP53", "CHR1:123": None,
        "NM_001:c.1A>G": None, "C9orf72:c.1A>G": None, "HLA-A:c.1A>G": None, "T:c.1A>G": None, "BRCA1": None, None: None, "": None,
    }
    assert one(spark, C.gene_symbol, list(want)) == list(want.values())


def test_omim(spark):
    want = {
        "X (OMIM:123456)": "OMIM:123456", "omim 654321": "OMIM:654321", "X #123456": "OMIM:123456", "OMIM:1234567": "OMIM:123456", "OMIM: 613721.0": "OMIM:613721",
        "OMIM 123456, OMIM:654321": "OMIM:654321", "MIM 123456": None, None: None, "Not reported": None,
    }
    assert one(spark, C.omim_id, list(want)) == list(want.values())


def test_acmg(spark):
    want = {
        "Pathogenic": "PATHOGENIC", "Likely pathogenic": "PATHOGENIC", "VUS": "UNCERTAIN_SIGNIFICANCE", "Likely Benign": "LIKELY_BENIGN", "benign": "BENIGN", "Pathogenic;;;": "PATHOGENIC",
        "DM": "NOT_PROVIDED", None: "NOT_PROVIDED", "non-pathogenic": "PATHOGENIC",
    }
    assert one(spark, C.acmg_class, list(want)) == list(want.values())
    assert one(spark, lambda c: C.acmg_class(c, strict=True), ["Likely pathogenic"]) == ["LIKELY_PATHOGENIC"]


def test_phenotypes(spark):
    want = {
        "Seizures (HP:0001250)|Ataxia, Retinitis pigmentosa (OMIM:204000)": (["HP:0001250"], ["OMIM:204000"], ["Ataxia"]),
        "(HP:0000001)(HP:0000002)": (["HP:0000001", "HP:0000002"], [], []), "(HP:0000001) (HP:0000002)": (["HP:0000002"], [], []),
        "Fever (HP:0001945) (OMIM:204000)": (["HP:0001945"], [], []), "Ataxia (mild)": ([], [], ["Ataxia"]), None: ([], [], []), " | ,": ([], [], []),
    }
    assert [tuple(r) for r in one(spark, C.phenotype_parts, list(want))] == list(want.values())


def test_expressions(spark):
    want = {
        "SCN1A:NM_001165963.4:c.2398G>A:p.Glu800Lys": ["NM_001165963.4:c.2398G>A", "SCN1A:p.Glu800Lys"], "SCN1A:c.2398G>A": ["c.2398G>A"], "NM_001:c.5A>G": ["NM_001:c.5A>G"],
        "c.1A>G, p.Met1?": ["c.1A>G", "p.Met1?"], "chr1:12345": ["chr1:12345"], "NP_001:p.Arg1Ter": ["NP_001:p.Arg1Ter"],
    }
    assert one(spark, C.variant_expressions, list(want)) == list(want.values())
    assert one(spark, C.parsed_variants, ["A:c.1|B:p.2; ;", None]) == [["c.1", "B:p.2"], []]


@pytest.mark.parametrize(
    ("v", "symbol", "transcript", "genomic", "protein", "cdna", "other", "chosen"),
    [
        ("NM_1:c.2A>G,SCN1A:p.Glu800Lys", "SCN1A", "NM_1", None, "p.Glu800Lys", "c.2A>G", [], "NM_1:c.2A>G"), ("chr1:123", None, None, None, None, None, [], "chr1:123"),
        ("g.5A>T", None, None, "g.5A>T", None, None, [], "g.5A>T"), ("A:NM_2:c.1:p.3", "A", "NM_2", None, None, "c.1:p.3", [], "NM_2:c.1:p.3"), ("BRCA1", None, None, None, None, None, ["BRCA1"], "BRCA1"),
    ],
)
def test_components(spark, v, symbol, transcript, genomic, protein, cdna, other, chosen):
    r = spark.createDataFrame([(v,)], "v string").withColumn("p", C.variant_components(F.col("v"))).select("p.*", C.chosen_expression(F.col("v"), F.col("p")).alias("c")).first()
    assert (r.symbol, r.transcript, r.genomic, r.protein, r.cdna, r.other, r.c) == (symbol, transcript, genomic, protein, cdna, other, chosen)


def test_pmid(spark):
    want = {"https://pubmed.ncbi.nlm.nih.gov/28600779/": "PMID:28600779", "https://doi.org/10.1186/s12920-020-00743-8": "PMID:8", "PMID:1": None, None: None}
    assert one(spark, C.pmid, list(want)) == list(want.values())


def test_labelled(spark):
    df = spark.createDataFrame([("x", None, "123456"), (None, "AR", None), (None, None, None)], "a string, b string, c string")
    got = [r[0] for r in df.select(C.labelled(Comments=F.col("a"), Inheritance=F.col("b"), OMIM=F.col("c"))).collect()]
    assert got == ["Comments: x;;OMIM: 123456", "Inheritance: AR", ""]


def test_findings_filter(spark):
    assert one(spark, C.is_finding, ["fever", "man", "abc", "the patient"]) == [True, False, False, False]


ACCEPTED = {
    "NM_007294.3:c.1A>G": ("NM_007294.3", None, "c", "1", None, "A>G"), "NM_1.2(BRCA1):c.-14+5_*20-3del": ("NM_1.2", "BRCA1", "c", "-14+5", "*20-3", "del"),
    "NC_000017.11:g.(10_20)_(30_40)delAC": ("NC_000017.11", None, "g", "(10_20)", "(30_40)", "delAC"), "NM_1:c.5_7delinsTTG": ("NM_1", None, "c", "5", "7", "delinsTTG"), "NM_1:c.5_7delACGinsT": ("NM_1", None, "c", "5", "7", "delACGinsT"),
    "NM_1:c.5dup": ("NM_1", None, "c", "5", None, "dup"), "NM_1:c.5_6insACGT": ("NM_1", None, "c", "5", "6", "insACGT"), "NM_1:c.10_20inv": ("NM_1", None, "c", "10", "20", "inv"), "NM_1:c.5=": ("NM_1", None, "c", "5", None, "="),
    "NM_1:c.123CAG[23]": ("NM_1", None, "c", "123", None, "CAG[23]"), "NR_1:n.7A>T": ("NR_1", None, "n", "7", None, "A>T"), "NM_1:r.7a>u": ("NM_1", None, "r", "7", None, "a>u"), "NC_012920.1:m.3243A>G": ("NC_012920.1", None, "m", "3243", None, "A>G"),
    "ENST00000357654.9:c.1A>G": ("ENST00000357654.9", None, "c", "1", None, "A>G"), "LRG_1t1:c.?_5del": ("LRG_1t1", None, "c", "?", "5", "del"), "NM_1:c.88+?del": ("NM_1", None, "c", "88+?", None, "del"),
    "NP_1.1:p.Arg97Ter": ("NP_1.1", None, "p", "Arg97", None, "Ter"), "NP_1.1:p.(Arg97ProfsTer23)": ("NP_1.1", None, "p", "Arg97", None, "ProfsTer23"), "NP_1.1:p.Lys23_Val25del": ("NP_1.1", None, "p", "Lys23", "Val25", "del"),
    "NP_1.1:p.Ter110GlnextTer17": ("NP_1.1", None, "p", "Ter110", None, "GlnextTer17"), "NP_1.1:p.Met1ext-5": ("NP_1.1", None, "p", "Met1", None, "ext-5"), "NP_1.1:p.Met1?": ("NP_1.1", None, "p", "Met1", None, "?"), "NP_1.1:p.?": ("NP_1.1", None, "p", None, None, "?"),
}
REJECTED = ["c.1A>G", "NM_1", "NM_1:c.", "NM_1:c.A>G", "NM_1:c.1A>", "NM_1:x.1A>G", "BRCA1:c.1A>G", "NM_1:c.1_2_3del", "NP_1:p.Foo5Bar", "NP_1:p.Arg5", "NM_1:c.1A>G;", " NM_1:c.1A>G", "NM_1 :c.1A>G", "NM_1:c.5insZ", "NP_1:p.Arg97delins", "", "chr1:123"]


def test_hgvs_grammar(spark):
    got = one(spark, H.parts, [*ACCEPTED, *REJECTED, None])
    assert [r and tuple(r) for r in got] == [*ACCEPTED.values(), *[None] * (len(REJECTED) + 1)]
    assert one(spark, H.is_expression, [*ACCEPTED, *REJECTED]) == [True] * len(ACCEPTED) + [False] * len(REJECTED)


def test_hgvs_normal(spark):
    want = {
        "NP_001.1:p.R5*": "NP_001.1:p.Arg5Ter", "NP_001.1:p.R5fs": "NP_001.1:p.Arg5fs", "NP_1:p.(R97Pfs*23)": "NP_1:p.(Arg97ProfsTer23)", "NP_1:p.R97fsX9": "NP_1:p.Arg97fsTer9", "NP_1:p.K23_V25delinsGA": "NP_1:p.Lys23_Val25delinsGlyAla",
        "NP_1:p.*110Qext*17": "NP_1:p.Ter110GlnextTer17", "NP_1:p.K2_G3insQSK": "NP_1:p.Lys2_Gly3insGlnSerLys", "NP_1:p.Arg97*": "NP_1:p.Arg97Ter", "NP_1:p.Arg97Ter": "NP_1:p.Arg97Ter", "NP_1:p.R5": "NP_1:p.R5", "SCN1A:p.E8K": "SCN1A:p.E8K",
        "c.1A>G": "c.1A>G", "NM_1:c.1A>G": "NM_1:c.1A>G", None: None, "": "",
    }
    assert one(spark, H.normal, list(want)) == list(want.values())
