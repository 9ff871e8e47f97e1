"""Closure and information content: no key gathers all terms, and both equal plain Python."""

from __future__ import annotations

import math

from caseloom.operators import similarity as S


def plain(edges):
    up = {t: {t} for e in edges for t in e}
    while any(not up[p] <= up[c] for c, p in edges):
        for c, p in edges:
            up[c] |= up[p]
    return up


def test_rounds_join_at_one_distance(spark, monkeypatch):
    edges = [(f"T{k}", f"T{k // 3}") for k in range(1, 200)] + [(f"T{k}", f"T{k // 4}") for k in range(7, 200, 7)]
    made, written = [], S.written
    monkeypatch.setattr(S, "written", lambda df, name: made.append((name, written(df, name))) or made[-1][1])
    closed = S.closure(spark.createDataFrame(edges, "child string, parent string"))
    assert sorted(map(tuple, closed.collect())) == sorted((t, a) for t, v in plain(edges).items() for a in v)
    far = [df for name, df in made if name == "far"]
    assert far and all(df.where("ancestor = 'T0'").count() < 150 for df in far)  # all 200 terms have the root above them


def test_cycles_end(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("y", "x"), ("z", "z")]
    closed = S.closure(spark.createDataFrame(edges, "child string, parent string"))
    assert sorted(map(tuple, closed.collect())) == sorted((t, a) for t, v in plain(edges).items() for a in v)


def test_information_goes_by_numbers(spark, monkeypatch):
    edges = [(f"T{k}", f"T{k // 3}") for k in range(1, 40)]
    rows = [(f"i{k % 7}", f"T{k}") for k in range(3, 39)] + [("i9", "no such term"), ("i9", None), (None, "T3"), ("i1", "T8"), ("i1", "T8")]
    asked = []
    numbers = S.ranking.numbers_of
    monkeypatch.setattr(S.ranking, "numbers_of", lambda *a: asked.append(1) or numbers(*a))
    up, items = plain(edges), {}
    for i, t in rows:
        if i and t:
            items.setdefault(i, set()).update(up.get(t, set()))
    found = S.information_content(S.closure(spark.createDataFrame(edges, "child string, parent string")), spark.createDataFrame(rows, "item string, term string"))
    want = {t: -math.log(n / len(items)) for t in up if (n := sum(t in v for v in items.values()))}
    got = {r.term: r.ic for r in found.collect()}
    assert asked and got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-12 for t in want)
