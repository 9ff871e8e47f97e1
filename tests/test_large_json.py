"""Arrays and maps read in many small blocks, and written by many tasks."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from caseloom.operators import sinks
from caseloom.sources import documents, elements


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def value(r, deep=0):
    k = r.random()
    if deep > 3 or k < 0.4:
        return r.choice([1, 2.5, None, True, "plain", 'quo"te, [not] {open}', "back\\slash\\", "\\\\,", "é,中", "", "x" * 700, "line\nend,"])
    if k < 0.7:
        return [value(r, deep + 1) for _ in range(r.randint(0, 4))]
    return {f"k{i},\"]": value(r, deep + 1) for i in range(r.randint(0, 4))}


def test_array_in_many_blocks(spark, tmp_path, small_blocks):
    r = random.Random(1)
    files = {f"f{k}.json": [value(r) for _ in range(r.choice([0, 1, 2, 30]))] for k in range(8)}
    for k, (name, v) in enumerate(files.items()):
        (tmp_path / name).write_text(" \n" + json.dumps(v, indent=[None, 2][k % 2], ensure_ascii=k % 3 > 0) + "\n", encoding="utf-8")
    got: dict = {}
    for x in elements.read_elements(spark, str(tmp_path)).collect():
        got.setdefault(x.file.rsplit("/", 1)[1], {})[x.i] = json.loads(x.text)
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == {k: v for k, v in files.items() if v}
    assert elements._blocks(spark, str(tmp_path), False).select("file", "start").distinct().count() > 12


@pytest.mark.parametrize(
    "text,docs",
    [
        ('[{"id":1},{"id":2}]', ['{"id":1}', '{"id":2}']), ('{"id":1, "x":[1,2]}', ['{"id":1, "x":[1,2]}']), ("[]", []), (" [ \n ] ", []), ('["a,b"]', ['"a,b"']),
        ("[1,2", [None]), ("[1,,2]", [None]), ("[1,2],", [None]), ("[1,2]]", [None]), ("[1] [2]", [None]), ('["a]', [None]), ("{", [None]), ("[1,2}", [None]), ("[1,nope]", [None]), ("7", ["7"]), ("[,]", [None]), ("", []),
    ],
)
def test_small_and_malformed(spark, tmp_path, text, docs):
    (tmp_path / "a.json").write_text(text)
    got = documents.read_raw_documents(spark, str(tmp_path / "a.json")).orderBy("i").collect()
    assert [x.doc for x in got] == docs and [x.i for x in got] == list(range(len(docs)))


def test_map_in_many_blocks(spark, tmp_path, small_blocks):
    r = random.Random(2)
    want = {f'P{i},"\\{i}': [f"HP:{r.randint(0, 99)}" for _ in range(r.randint(0, 30))] for i in range(60)}
    (tmp_path / "m.json").write_text(json.dumps(want))
    assert {x.id: x.terms for x in documents.read_annotations(spark, str(tmp_path / "m.json")).collect()} == want
    (tmp_path / "bad.json").write_text(json.dumps(want) + "}")
    assert documents.read_annotations(spark, str(tmp_path / "bad.json")).count() == 0


def test_sinks_in_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts stay apart
    df = spark.range(500).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("id"), F.struct(F.lit("é,\"x").alias("a"), (F.col("id") % 7).alias("n")).alias("s")).repartition(9)
    sinks.write_json_array(df, str(tmp_path / "array"))
    parts = sorted(p for p in (tmp_path / "array").iterdir() if p.name.startswith("part-"))
    text = "".join(p.read_text(encoding="utf-8") for p in parts)
    want = [{"id": f"{i:04}", "s": {"a": 'é,"x', "n": i % 7}} for i in range(500)]
    assert len(parts) > 1 and json.loads(text) == want and text.strip() == json.dumps(want, indent=2, ensure_ascii=False)
    sinks.single_file(spark, str(tmp_path / "array"), str(tmp_path / "one.json"))
    assert (tmp_path / "one.json").read_text(encoding="utf-8") == text
    back = documents.read_raw_documents(spark, str(tmp_path / "array"), joined=True).orderBy("i").collect()
    assert [json.loads(x.doc) for x in back] == want
    sinks.write_json_array(df.limit(0), str(tmp_path / "none"))
    assert documents.read_raw_documents(spark, str(tmp_path / "none"), joined=True).count() == 0
    maps = df.select("id", F.array(F.lit("HP:2"), F.lit("HP:1")).alias("terms"))
    sinks.write_annotations(maps, str(tmp_path / "map"))
    assert documents.read_annotations(spark, str(tmp_path / "map"), joined=True).count() == 500
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_file_for_each_record(spark, tmp_path):
    ids = ["a/b", "a_b", "a:b", "x", "x", "..", "", None, "é", "Z" * 300, "plain-0123456789abcdef"]
    df = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "id string, n int").repartition(4)
    for _ in range(2):  # run twice: the same files
        assert sinks.write_each(df, str(tmp_path / "each")) == len(ids)
        found = [p for p in (tmp_path / "each").iterdir() if not p.name.startswith(".")]
        assert len(found) == len(ids) and sorted(json.loads(p.read_text())["n"] for p in found) == list(range(len(ids)))
    assert {"a_b.json", "é.json"} <= {p.name for p in found}
