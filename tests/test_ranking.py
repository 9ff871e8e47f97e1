"""Ranks without pairs against all pairs by plain Python."""

from __future__ import annotations

import math
import random
import tracemalloc

import numpy as np
import pytest

from caseloom.operators import ranking as R
from caseloom.operators import similarity as S


def world(seed, terms=60, entities=25, patients=12):
    r = random.Random(seed)
    parents = {t: sorted({r.randrange(t) // r.choice([1, 2]) for _ in range(r.choice([1, 1, 1, 2]))}) for t in range(1, terms)}
    name = lambda t: f"T{t:03d}"

    def up(t):
        out = {t}
        for p in parents.get(t, []):
            out |= up(p)
        return out

    profiles = {f"g{k}": {r.randrange(terms) for _ in range(r.randint(1, 12))} for k in range(entities)}
    sets = {f"p{k}": {r.randrange(terms) for _ in range(r.randint(1, 6))} for k in range(patients)}
    have = {t: sum(any(t in up(x) for x in v) for v in profiles.values()) for t in range(terms)}
    ic = {t: -math.log(n / entities) for t, n in have.items() if n}
    closed = [(name(t), name(a)) for t in range(terms) for a in up(t)]
    return name, up, profiles, sets, ic, closed


def plain(up, ic, method, x, y):
    def sim(a, b):
        m = max([ic[t] for t in up(a) & up(b) if t in ic], default=0)
        ia, ib = ic.get(a, 0), ic.get(b, 0)
        lin = 2 * m / (ia + ib) if m and ia + ib else 0
        return {"resnik": m, "lin": lin, "jc": 1 / (1 + max(ia + ib - 2 * m, 0)) if m else 0, "rel": lin * (1 - math.exp(-m))}[method]

    rows = sum(max(sim(a, b) for b in y) for a in x) / len(x)
    return (rows + sum(max(sim(a, b) for a in x) for b in y) / len(y)) / 2


def standing(scores, truth):
    s = scores[truth]
    rest = {g: v for g, v in scores.items() if g != truth}
    above, same = sum(v > s for v in rest.values()), [g for g, v in rest.items() if v == s]
    return above, len(same), sum(g < truth for g in same), len(rest) - above - len(same)


@pytest.mark.parametrize("method", S.METHODS)
def test_standing_equals_all_pairs(method):
    for seed in range(8):
        name, up, profiles, sets, ic, closed = world(seed)
        rows = [(g, name(t)) for g, v in profiles.items() for t in v]
        table = R.Profiles(tuple(zip(*closed)), ([name(t) for t in ic], list(ic.values())), tuple(zip(*rows)), method)
        for p, x in sets.items():
            terms = [name(t) for t in x]
            want = {g: round(plain(up, ic, method, x, y), 9) for g, y in profiles.items()}
            got = dict(zip(table.entities, table.scores(terms, np.arange(len(profiles))).tolist()))
            assert all(abs(got[g] - want[g]) < 2e-9 for g in want)
            for truth in profiles:
                low, high = table._bounds(terms, got[truth])
                assert (low <= np.array([got[g] for g in table.entities]) + 1e-8).all()
                assert table.standing(terms, truth, got[truth]) == standing(got, truth)
                # an upper bound may be loose only where the truth's score is out of reach
                assert all(h + 1e-8 >= got[g] or h < got[truth] and got[g] < got[truth] for g, h in zip(table.entities, high))


@pytest.mark.parametrize("rows", [R.ROWS, 40])
def test_standings_and_totals_in_shards(spark, rows):
    name, up, profiles, sets, ic, closed = world(99)
    truth = {p: random.Random(p).choice(sorted(profiles)) for p in sets}
    truth["p0"] = "not there"
    pr = spark.createDataFrame([(g, name(t)) for g, v in profiles.items() for t in v] + [("g1", None), (None, "T001")], "entity_id string, term string")
    pt = spark.createDataFrame([(p, name(t), 1) for p, v in sets.items() for t in v] + [("p1", name(min(sets["p1"])), 2), ("none", None, 1)], "id string, term string, s int")
    tr = spark.createDataFrame(list(truth.items()) + [("none", "g1")], "id string, entity_id string")
    up_rows, ics = spark.createDataFrame(closed, "term string, ancestor string"), spark.createDataFrame([(name(t), v) for t, v in ic.items()], "term string, ic double")
    got = {r.id: (r.ground_truth_gene, r["rank"], round(r.roc_auc, 9)) for r in R.standings(pt, tr, pr, up_rows, ics, rows=rows).collect()}
    scores = {p: {g: round(plain(up, ic, "resnik", x, y), 9) for g, y in profiles.items()} for p, x in sets.items()}
    want = {}
    for p, g in truth.items():
        if g in profiles:
            above, same, first, below = standing(scores[p], g)
            want[p] = (g, 1 + above + first, round((below + 0.5 * same) / (above + same + below), 9))
    assert got == want
    sums = {r.entity_id: (round(r.total, 6), round(r.best, 6)) for r in R.totals(pt, pr, up_rows, ics, rows=rows).collect()}
    assert sums == {g: (round(sum(s[g] for s in scores.values()), 6), round(max(s[g] for s in scores.values()), 6)) for g in profiles}


def test_a_large_ontology_goes_through_joins(spark, monkeypatch):
    name, _, profiles, sets, _, closed = world(5, entities=6, patients=4)
    pr = spark.createDataFrame([(g, name(t)) for g, v in profiles.items() for t in v], "entity_id string, term string")
    pt = spark.createDataFrame([(p, name(t)) for p, v in sets.items() for t in v], "id string, term string")
    tr = spark.createDataFrame([(p, f"g{k}") for k, p in enumerate(sets)], "id string, entity_id string")
    up = spark.createDataFrame(closed, "term string, ancestor string")
    found = lambda: sorted((r.id, r["rank"], round(r.score, 8), round(r.roc_auc, 8)) for r in S.evaluated(pt, tr, pr, up).collect())
    small = found()
    monkeypatch.setattr(R, "fits", lambda closed: False)
    assert found() == small and len(small) == 4


def test_patients_are_dealt_over_all_cores(spark):
    patients = spark.createDataFrame([(f"p{k}", "T001") for k in range(300)], "id string, term string")
    numbers = spark.createDataFrame([("T001", 0)], "term string, number int")
    dealt = R._dealt(R._sets(patients, numbers)).mapInArrow(lambda batches: batches, "id string, terms array<int>")
    sizes = dealt.rdd.glom().map(len).collect()
    assert sum(sizes) == 300 and sum(n > 0 for n in sizes) >= spark.sparkContext.defaultParallelism


def test_a_closure_of_over_two_million_rows_makes_no_pairs(spark):
    assert R.fits(spark.range(2_500_000).selectExpr("id AS term", "id AS ancestor"))


def test_each_shard_is_passed_once_for_truths_and_once_for_counts(spark):
    name, _, profiles, sets, ic, closed = world(3)
    pr = spark.createDataFrame([(g, name(t)) for g, v in profiles.items() for t in v], "entity_id string, term string")
    pt = spark.createDataFrame([(p, name(t)) for p, v in sets.items() for t in v], "id string, term string")
    tr = spark.createDataFrame([(p, f"g{k}") for k, p in enumerate(sets)], "id string, entity_id string")
    up, ics = spark.createDataFrame(closed, "term string, ancestor string"), spark.createDataFrame([(name(t), v) for t, v in ic.items()], "term string, ic double")
    rows = 40
    shards = -(-pr.distinct().count() // rows)
    out = R.standings(pt, tr, pr, up, ics, rows=rows)
    assert shards > 2 and out.count() == len(sets)
    # each pass used to hold those of all shards before it
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == shards


def test_scores_of_patients_side_by_side(monkeypatch):
    monkeypatch.setattr(R, "SIDE", 3)
    for method in ("resnik", "lin", "jc", "rel"):
        name, up, profiles, sets, ic, closed = world(7)
        rows = [(g, name(t)) for g, v in profiles.items() for t in v]
        table = R.Profiles(tuple(zip(*closed)), ([name(t) for t in ic], list(ic.values())), tuple(zip(*rows)), method)
        patients = [[name(t) for t in x] for x in sets.values()] + [[]]
        found = list(table.blocks(patients))
        assert len(found) == len(patients) > R.SIDE
        for terms, got in zip(patients, found):
            assert got.tolist() == table.scores(terms, np.arange(len(profiles))).tolist()


def tree(terms, entities, each):
    """A closure by numbers (children of k are 3k to 3k + 2), information, and profiles."""
    r = np.random.default_rng(5)
    up = [np.zeros(0, dtype=np.int32)]
    for k in range(1, terms):
        up.append(np.append(up[k // 3], np.int32(k)))
    start = np.append(0, np.cumsum([len(x) for x in up]))
    entity, term = np.repeat(np.arange(entities), each), r.integers(0, terms, entities * each)
    return start, np.concatenate(up), 1 + r.permutation(terms) / terms + np.log1p(np.arange(terms)), [f"g{k:05d}" for k in range(entities)], entity, term


def test_arrays_of_a_shard_are_small():
    world = tree(20_000, 400, 500)
    for method in ("resnik", "lin"):
        tracemalloc.start()
        table = R.Profiles.of_numbers(*world, method)
        held, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        pairs = int(np.diff(table.below_start).sum())
        assert pairs > 600_000 and held < 12 * pairs and peak < 80 * pairs  # 25 and 105 bytes a pair before


@pytest.mark.parametrize("method", S.METHODS)
def test_scores_of_a_few_entities_take_no_pass_over_all_terms(method, monkeypatch):
    table = R.Profiles.of_numbers(*tree(3000, 40, 30), method)
    r = np.random.default_rng(6)
    sets = [sorted(r.choice(3000, 4, replace=False).tolist()) for _ in range(20)]
    every = [table.scores(x, np.arange(40)) for x in sets]
    passes = []
    monkeypatch.setattr(table, "_row", lambda known: passes.append(1))
    monkeypatch.setattr(table, "_column", lambda known: passes.append(1))
    assert all(table.scores(x, np.array([k])).tolist() == [s[k]] for x, s in zip(sets, every) for k in (0, 7, 39)) and not passes


@pytest.mark.parametrize("method", S.METHODS)
def test_profiles_are_summed_as_kinds_of_terms(method):
    # two parents for some terms, so that narrow ancestors of one branch meet wide ones of another
    r = np.random.default_rng(8)
    up = [np.zeros(0, dtype=np.int32)]
    for k in range(1, 6000):
        up.append(np.append(np.union1d(up[k // 3], up[k // 4] if k % 5 == 0 else up[0]), k).astype(np.int32))
    entity, term = np.repeat(np.arange(60), 300), r.integers(0, 6000, 60 * 300)
    ic = np.append(0, r.permutation(np.log1p(np.arange(1, 6000)) + 0.1 * r.integers(0, 9, 5999)))  # no order along the branches
    table = R.Profiles.of_numbers(np.append(0, np.cumsum([len(x) for x in up])), np.concatenate(up), ic, [f"g{k:02d}" for k in range(60)], entity, term, method)
    sets = [sorted(r.choice(6000, r.integers(1, 6), replace=False).tolist()) for _ in range(70)] + [[], [-1]]
    for x, got in zip(sets, table.blocks(sets)):
        assert np.abs(got - table.scores(x, np.arange(60))).max() < 2e-9
    assert 0 < table.wide.sum() < 1500 and (method != "resnik" or table.row_kind.size < table.back.size)
