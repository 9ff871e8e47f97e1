"""Rows that make Python work fail stand alone in the end."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from caseloom.operators import isolate
from caseloom.operators import match as M
from caseloom.operators import similarity as S


@pytest.mark.parametrize("bad", [set(), {0}, {7, 8}, {0, 31, 63}, set(range(64))])
def test_halves(bad):
    calls = []

    def work(batch):
        calls.append(batch.num_rows)
        if bad & set(batch.column(0).to_pylist()):
            raise ValueError("no")
        return batch

    batch = pa.RecordBatch.from_pydict({"i": list(range(64))})
    parts = list(isolate.attempts(batch, work))
    assert [i for rows, _, _ in parts for i in rows.column(0).to_pylist()] == list(range(64))
    assert {rows.column(0)[0].as_py() for rows, made, _ in parts if made is None} == bad
    assert len(calls) <= 1 + 2 * len(bad) * 6


def test_a_failing_annotator_loses_no_row(spark):
    def find(text):
        if "boom" in text:
            raise RuntimeError(f"cannot read {text}")
        return text.split(", ")

    names = spark.createDataFrame([("ataxia", "HP:1", 0), ("fever", "HP:2", 1)], "name string, id string, ord int")
    rows = [(i, "boom" if i % 7 == 0 else "ataxia, fever" if i % 2 else "fever") for i in range(100)] + [(None, None)]
    texts = spark.createDataFrame(rows, "id long, text string").coalesce(2)
    found, failed = M.annotate_or_skip(texts, names, find)
    got = {r.id: r.terms for r in found.collect()}
    assert len(got) == 101 and got[7] == [] and got[1] == ["HP:1", "HP:2"] and got[2] == ["HP:2"]
    assert sorted(r.id for r in failed.collect()) == list(range(0, 100, 7)) and failed.first().error == "RuntimeError: cannot read boom"


def test_any_columns_and_no_rows(spark):
    def double(batch):
        i = batch.column(0).to_pylist()
        if None in i:
            raise TypeError("null")
        return pa.RecordBatch.from_pydict({"j": [2 * x for x in i for _ in range(x)]})

    schema = T.StructType([T.StructField("j", T.LongType())])
    good, bad = isolate.isolated(spark.createDataFrame([(1, "a", [1]), (None, "b", []), (3, "c", None)], "i long, made string, error array<int>").coalesce(1), double, schema)
    assert sorted(r.j for r in good.collect()) == [2, 6, 6, 6] and [r.made for r in bad.collect()] == ["b"]
    good, bad = isolate.isolated(spark.createDataFrame([], "i long"), double, schema)
    assert good.count() == bad.count() == 0


def test_unknown_terms_are_listed(spark):
    closed = spark.createDataFrame([("HP:1", "HP:1")], "term string, ancestor string")
    patients = spark.createDataFrame([("p", "HP:1"), ("p", "HP:9"), ("p", "HP:9"), ("q", None)], "id string, term string")
    assert [tuple(r) for r in S.unknown_terms(patients, closed).collect()] == [("p", "HP:9")]
