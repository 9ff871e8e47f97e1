"""The stages, one after the other, against what each must keep."""

from __future__ import annotations

import random

import corpus_pipeline
from caseloom.llm import queries


def test_stages(spark, tmp_path):
    r = random.Random(3)
    en, fr = "the of and with house river water people thing other".split(), "le la les avec maison rivière eau gens chose autre".split()
    rows = [(i, " ".join(r.choice(en if i % 2 else fr) + str(r.randint(0, 99)) for _ in range(40)), "en" if i % 2 else "fr", "s", 1) for i in range(300)]
    bad = {}
    rows[10] = (10, None, "en", "s", 0)
    rows[11] = (11, "12 34 !!", "en", "s", 0)
    for i in range(20, 80):
        rows[i] = (i, rows[i][1] + " idiot moron scum", rows[i][2], "s", 1)
        bad[i] = 1
    rows[101] = (101, rows[100][1], "fr", "s", 1)
    rows[102] = (102, rows[100][1] + " fin", "fr", "s", 1)
    item = "this passage of the benchmark stands in one of the documents as it is"
    rows[120] = (120, rows[120][1] + ". " + item, "fr", "s", 1)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, bad.get(i, 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    gone = [{10, 11}, set(bad), {101, 102}, {120}]
    have = set(range(300))
    for (name, stage), out in zip(corpus_pipeline.STAGES, gone):
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        have -= out
        assert {x.doc_id for x in docs.select("doc_id").collect()} == have, name
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in last} == have and all(x.round_trip for x in last)


def test_every_operator_has_its_query():
    names = queries.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert set(queries.oracle_sql()) <= set(names)
