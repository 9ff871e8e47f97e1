"""Validation, ranks, matching, sources and sinks on small inputs."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from caseloom.operators import harmonize as H
from caseloom.operators import match as M
from caseloom.operators import packets as P
from caseloom.operators import similarity as S
from caseloom.operators import sinks, stats
from caseloom.operators import validate as V
from caseloom.plans import pipelines
from caseloom.sources import documents, ontology, tables

OBO = """format-version: 1.2

[Term]
id: HP:0000001
name: All
synonym: "Everything" EXACT []

[Term]
id: HP:0000002
name: Gait ataxia
is_a: HP:0000001 ! All

[Term]
id: MP:1
name: Mouse

[Typedef]
id: part_of
name: part of
"""


def test_validation(spark):
    docs = [
        "{}", '{"id":"a","subject":{"id":"a","sex":"M"},"metaData":{"created":"t","phenopacketSchemaVersion":"2.0","resources":[]}}', '{"id":"a","subject":{"id":"a"},"metaData":{}}', '{"id":',
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    got = V.validate(df, number="i").orderBy("i").collect()
    assert [(len(r.errors), len(r.warnings)) for r in got] == [(2, 1), (1, 1), (3, 1), (1, 0)]
    assert [e.field for e in got[0].errors] == ["id", "metaData"]
    assert got[0].name == "phenopacket_1"
    t = V.totals(V.validate(df, number="i")).first()
    assert (t.total, t.valid, t.errors, t.warnings, t.file_valid) == (4, 0, 7, 3, False)


def test_numbered_is_dense_over_partitions(spark):
    df = spark.range(1000).withColumn("o", F.xxhash64("id")).repartition(7)
    got = [r.n for r in tables.numbered(df, ["o"], "n").orderBy("o").collect()]
    assert got == list(range(1, 1001))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_numbered_keeps_every_wide_row(spark, adaptive):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = spark.range(1_100_000).select((F.col("id") % 700_001).alias("o"), *[F.sha2(F.concat("id", F.lit(str(k))), 256).alias(f"c{k}") for k in range(3)])
        r = tables.numbered(df, ["o"], "n").agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n"), F.countDistinct("c0")).first()
        assert tuple(r) == (1_100_000, 1_100_000, 1, 1_100_000, 1_100_000)
        low = tables.numbered(df, ["o"], "n").where("n <= 1000").orderBy("n").select("o").collect()
        assert [x.o for x in low] == sorted(x.o for x in low)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rank_and_area(spark):
    scores = spark.createDataFrame([("p", "g1", 3.0), ("p", "g2", 3.0), ("p", "g3", 1.0), ("p", "g4", 5.0)], "id string, entity_id string, score double")
    truth = spark.createDataFrame([("p", "g1")], "id string, entity_id string")
    r = S.evaluate(scores, truth).first()
    assert (r["rank"], r.roc_auc) == (2, 0.5)
    assert [x["rank"] for x in S.ranked(scores).orderBy("entity_id").collect()] == [2, 3, 4, 1]
    only = S.evaluate(scores.where("entity_id = 'g1'"), truth).first()
    assert only.roc_auc is None


def test_similarity_against_plain_python(spark):
    edges = {"b": ["a"], "c": ["a"], "d": ["b"], "e": ["b", "c"], "f": ["c"]}
    profiles = {"g1": ["d", "f"], "g2": ["e"], "g3": ["f"]}
    patients = {"p": ["d", "e"], "q": ["f"]}

    def up(t):
        return {t}.union(*[up(x) for x in edges.get(t, [])])

    have = {t: sum(any(t in up(x) for x in v) for v in profiles.values()) for t in "abcdef"}
    ic = {t: -math.log(n / 3) for t, n in have.items() if n}

    def sim(a, b, m):
        best = max([ic[t] for t in up(a) & up(b) if t in ic], default=0)
        total = ic.get(a, 0) + ic.get(b, 0)
        lin = 2 * best / total if total and best else 0
        return {"resnik": best, "lin": lin, "jc": 1 / (1 + total - 2 * best) if best else 0, "rel": lin * (1 - math.exp(-best))}[m]

    e = spark.createDataFrame([(c, p) for c, ps in edges.items() for p in ps], "child string, parent string")
    pr = spark.createDataFrame([(g, t) for g, ts in profiles.items() for t in ts], "entity_id string, term string")
    pt = spark.createDataFrame([(g, t) for g, ts in patients.items() for t in ts], "id string, term string")
    closed = S.closure(e)
    assert {(r.term, r.ancestor) for r in closed.collect()} == {(t, a) for t in "abcdef" for a in up(t)}
    found_ic = S.information_content(closed, pr.withColumnRenamed("entity_id", "item"))
    for m in S.METHODS:
        got = {(r.id, r.entity_id): r.score for r in S.set_similarity(pt, pr, S.pair_similarity(pt, pr, closed, found_ic, m)).collect()}
        for p, a in patients.items():
            for g, b in profiles.items():
                rows = sum(max(sim(x, y, m) for y in b) for x in a) / len(a)
                cols = sum(max(sim(x, y, m) for x in a) for y in b) / len(b)
                assert abs(got[p, g] - (rows + cols) / 2) < 1e-9, (m, p, g)


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], max(row[j + 1], row[j], last + 1) if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_fuzzy_equals_brute_force(spark):
    names = ["seizure", "gait ataxia", "ataxia", "short stature", "tall", "blue sclera", "a", "fever of unknown origin"]
    phrases = ["seizures", "ataxia gait", "shrt statur", "sclerae blue", "zzzzzz", "fever", "b", "unknown fever origin", "tall"]
    d = spark.createDataFrame([(n, f"HP:{i}", i) for i, n in enumerate(names)], "name string, id string, ord int")
    got = {r.phrase: (r.name, round(r.score, 4)) for r in M.fuzzy(spark.createDataFrame([(p,) for p in phrases], "phrase string"), d).collect()}
    sort = lambda s: " ".join(sorted(s.split()))
    want = {}
    for p in phrases:
        scored = [(200 * _lcs(sort(p), sort(n)) / (len(sort(p)) + len(sort(n))), -i, n) for i, n in enumerate(names)]
        s, _, n = max(scored)
        if s >= 60:
            want[p] = (n, round(s, 4))
    assert got == want
    assert got["seizures"] == ("seizure", 93.3333) and got["ataxia gait"] == ("gait ataxia", 100.0)


def test_ontology_and_annotation(spark, tmp_path):
    (tmp_path / "hp.obo").write_text(OBO)
    path = str(tmp_path / "hp.obo")
    terms = ontology.terms(spark, path)
    assert sorted((r.id, r.label, r.synonyms, r.parents) for r in terms.collect()) == [("HP:0000001", "All", ["Everything"], []), ("HP:0000002", "Gait ataxia", [], ["HP:0000001"])]
    assert {(r.name, r.id) for r in ontology.loose_names(spark, path).collect()} == {("all", "HP:0000001"), ("everything", "HP:0000001"), ("gait ataxia", "HP:0000002"), ("mouse", "MP:1"), ("part of", "part_of")}
    assert ontology.labels_or_empty(spark, str(tmp_path / "none.obo")).count() == 0
    texts = spark.createDataFrame([("1", "Ataxia gait. No everything."), ("2", "qqqq zzzz")], "id string, text string")
    found = {r.id: r.terms for r in M.annotate(texts, ontology.names(terms)).collect()}
    assert found["1"] == ["HP:0000002"] and found["2"] == []
    wide = spark.createDataFrame([("ＨＰ Ａtaxia ",), ("Plain ",)], "t string")
    assert {r.n for r in M.normalise(wide, "t", "n").collect()} == {"hp ataxia", "plain"}


def test_sources_to_documents_and_back(spark, tmp_path):
    head = "id\tpatient_gender\tpatient_age\ttest\ttest_strategy\tconsanguinity\tfamily_id\tnumber_of_family_members\tcohort_size\tphenotypes\tresult\tresult_comment\tvariants\tzygosity\tpathogenicity\treference\n"
    (tmp_path / "lit.tsv").write_bytes((head + "9\tM\t3Y\tWES\t\t\tF1\t1\tNA\tataxia HP:2 HP:2\tpos\tX (OMIM:123456)\tA1:c.1;B2:c.2\thet\tVUS\tPMID:1\n" + "8\tF\t\tWES\t\t\tF2\t\t\tcaf\xe9 HP:3\tneg\t\t\t\t\t" + H.LITERATURE_LINK + "\n").encode("latin-1"))
    raw = tables.read_latin1(spark, str(tmp_path / "lit.tsv"))
    lit = H.standardise(raw, H.literature())
    cases = H.union_sources(lit)
    row = cases.first()
    assert (row.ID, row.sex, row.phenotypicFeatureIds, row.totalCohortMembers, row.dataSourceType) == ("CASE1", "M", "HP:2", "Not reported", "literature")
    assert cases.count() == 1
    terms = spark.createDataFrame([("HP:2", "Ataxia")], "id string, label string")
    made = P.build(cases, terms, "2024-01-01T00:00:00Z")
    doc = json.loads(P.as_json(made).first().doc)
    assert list(doc) == ["id", "subject", "phenotypicFeatures", "metaData", "interpretations", "diseases"]
    assert doc["phenotypicFeatures"] == [{"type": {"id": "HP:2", "label": "Ataxia"}}]
    assert [g["variantInterpretation"]["variationDescriptor"]["geneContext"]["symbol"] for g in doc["interpretations"][0]["diagnosis"]["genomicInterpretations"]] == ["A1", "B2"]
    assert doc["diseases"][0]["term"] == {"id": "OMIM:123456", "label": "X (OMIM:123456)"} and doc["subject"]["timeAtLastEncounter"]["age"]["iso8601duration"] == "P3Y"
    sinks.write_json_array(made, str(tmp_path / "array"))
    text = next((tmp_path / "array").glob("part-*")).read_text()
    assert json.loads(text) == [doc]
    again = documents.read_raw_documents(spark, str(tmp_path / "array"))
    assert V.totals(V.validate(again, number="i")).first().file_valid
    assert sinks.write_each(made, str(tmp_path / "each")) == 1
    assert documents.read_packets(spark, str(tmp_path / "each")).first().id == "CASE1"
    sinks.write_delimited(cases, str(tmp_path / "out"), single=True)
    assert tables.read_delimited(spark, str(tmp_path / "out")).first().ID == "CASE1"
    s = stats.packet_summary(made).first()
    assert (s.packets, s.variants, s.variants_with_gene, s.omim_diseases, s.labelled_features) == (1, 2, 2, 1, 1)


def test_annotation_map_round_trip(spark, tmp_path):
    a = spark.createDataFrame([("LIT_1", ["HP:1"]), ("CLIT_1", [])], "id string, terms array<string>")
    sinks.write_annotations(a, str(tmp_path / "a"))
    text = next((tmp_path / "a").glob("part-*")).read_text()
    assert json.loads(text) == {"LIT_1": ["HP:1"], "CLIT_1": []}
    assert documents.read_annotations(spark, str(tmp_path / "a")).count() == 2
    assert [r.id for r in stats.annotation_gaps(a).collect()] == ["CLIT_1"]


def test_ranking_pipeline(spark):
    edges = spark.createDataFrame([("HP:2", "HP:1"), ("HP:3", "HP:1")], "child string, parent string")
    profiles = spark.createDataFrame([("A1", "HP:2"), ("B2", "HP:3")], "entity_id string, term string")
    cases = spark.createDataFrame([("1", "HP:2", "A1:c.1"), ("2", "HP:3", "NM_5:c.2"), ("3", "", "A1:c.1"), ("4", "HP:2", "ZZ:c.1")], "ID string, phenotypicFeatureIds string, genomicVariants string")
    for c in ("sex", "age", "diagnosticComment", "variantInterpretation", "externalReference", *P.EXTRA):
        if c not in cases.columns:
            cases = cases.withColumn(c, F.lit(None).cast("string"))
    made = P.build(cases, spark.createDataFrame([], "id string, label string"), "t")
    packets = spark.createDataFrame([json.loads(r.doc) for r in P.as_json(made).collect()], P.PACKET)
    results, skipped = pipelines.rank_genes(packets, profiles, edges, tables.read_transcripts(spark, None))
    assert [(r.packet_id, r["rank"], r.roc_auc) for r in results.collect()] == [("1", 1, 1.0)]
    assert {(r.id, r.skip_reason) for r in skipped.collect()} == {("2", "no gene"), ("3", "no features"), ("4", "gene not in profiles")}
    m = S.metrics(results).first()
    assert (m.total_cases_evaluated, m.hits_at_1, m.median_rank) == (1, 1.0, 1.0)


def test_stream_takes_the_same_rules(spark, tmp_path):
    from caseloom import streaming

    src = spark.createDataFrame([("1", "3Y", "M", "OMIM:123456", "VUS", "HP:1", "A1:c.1")], "ID string, age string, sex string, diagnosticComment string, variantInterpretation string, phenotypicFeatureIds string, genomicVariants string")
    src.write.parquet(str(tmp_path / "in"))
    stream = streaming.derived_cases(spark.readStream.schema(src.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("derived").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    r = spark.table("derived").first()
    assert (r.age_iso, r.sex_enum, r.omim, r.acmg, r.terms, r.genes) == ("P3Y", "MALE", "OMIM:123456", "UNCERTAIN_SIGNIFICANCE", ["HP:1"], ["A1"])
    q = streaming.numbered_sink(spark.readStream.schema(src.schema).parquet(str(tmp_path / "in")).drop("ID"), str(tmp_path / "out"), str(tmp_path / "c2"))
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "out")).first().ID == "CASE1"
