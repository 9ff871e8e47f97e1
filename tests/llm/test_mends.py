"""Cases that users met: clashing names, wide ids, many languages, slots that stand for too many values, tables of other runs."""

from __future__ import annotations

import numpy as np
import pytest

from caseloom.llm import decontaminate, langid, licenses, planes, scratch


def test_license_scan_keeps_columns_named_like_its_own(spark):
    names = ["label", "rank", "size", "i", "least", "ranks"]
    df = spark.createDataFrame([(1, "released under the apache license version", *"abcdef"), (2, None, *"ghijkl")], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [got[1][n] for n in names] == list("abcdef") and got[1].base_labels == "apache" and [got[2][n] for n in names] == list("ghijkl")


def test_ids_that_do_not_fit_are_an_error():
    block = np.array([1, 70_000], dtype="<u4")
    with pytest.raises(ValueError):
        planes.to_planes(block, 2, False)
    assert (planes.from_planes(planes.to_planes(block, 3, True), 2, 3, True) == block).all()


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(0x4E00 + i % 90) * 3} words of {i % 90} {chr(0x4E00 + i % 90) * 9}", f"l{i % 90:02}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.sample(df, "doc_id", "text", "lang").select("lang").distinct().count() == 90
    assert langid.sample(df, "doc_id", "text", "lang", most=90 * 90).groupBy("lang").count().agg({"count": "max"}).first()[0] == 1
    model = langid.fit(df)
    got = langid.identify(df.limit(200), model).where("lang_pred = lang").count()
    assert got == 200


def test_one_value_in_all_slots_is_not_a_new_question(spark):
    item = "Tom has 5 red apples in the big box and Ann has 7 green apples in the small box by the door"
    docs = [
        (1, "Bob has 6 red apples in the big box and Eve has 9 green apples in the small box by the door"),
        (2, "Bob has 6 red apples in the big box and Bob has 6 green apples in the small box by the door"),
        (3, item),
    ]
    found = decontaminate.mark(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r.doc_id: r.contaminated for r in found.collect()} == {1: True, 2: False, 3: True}


def test_a_run_deletes_its_own_tables_only(spark):
    kept, _ = scratch.stored(spark.range(5), "kept")
    with scratch.collecting() as made:
        _, path = scratch.stored(spark.range(3), "own")
        _, gone = scratch.stored(spark.range(3), "dropped")
        scratch.drop(spark, gone)
    assert made == {path}
    scratch.drop(spark, *made)
    assert kept.count() == 5
