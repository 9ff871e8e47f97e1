"""Names in texts, negation and fuzzy top-1 against plain re-statements."""

from __future__ import annotations

import random

import numpy as np
import pytest

from caseloom.operators import match as M
from caseloom.operators import mentions as N
from caseloom.operators import subsequence

NAMES = ["fever", "high fever", "short stature", "ataxia", "severe intellectual disability of early childhood onset type two", "hand", "hand foot", "foot hand foot", "1.5 mm gap", "no taste"]


def plain_find(text, names):
    """Longest name at every place, without those inside another one; by comparing slices."""
    tokens = N.tokens_of(text)
    split = {n: N.tokens_of(n) for n in names}
    hits = []
    for i in range(len(tokens)):
        fits = [(len(t), n) for n, t in split.items() if t and tokens[i : i + len(t)] == t]
        if fits:
            size, name = max(fits)
            hits.append((i, i + size, name))
    return [(a, b, n) for a, b, n in hits if not any((c, d) != (a, b) and c <= a and b <= d for c, d, _ in hits)]


def test_every_place_and_length():
    r = random.Random(1)
    words = "fever high short stature ataxia severe intellectual disability of early childhood onset type two hand foot 1.5 mm gap . , no".split()
    trie = N.Trie([N.tokens_of(n) for n in NAMES])
    for _ in range(300):
        texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 40))) for _ in range(3)] + [None, ""]
        got = {i: [(a, b, NAMES[w]) for a, b, w in zip(begin.tolist(), end.tolist(), which.tolist())] for i, _, _, begin, end, which, _, _ in N._walked(texts, trie)}
        assert [got.get(i, []) for i in range(5)] == [plain_find(t, NAMES) for t in texts]


@pytest.mark.parametrize(
    "text,negated",
    [
        ("no fever", True), ("fever", False), ("Patient denies high fever.", True), ("no cough. fever", False), ("no cough, fever", True), ("no cough but fever", False), ("fever was ruled out", True),
        ("fever. was ruled out", False), ("no increase of fever", False), ("ataxia, although no fever", True), ("negative for\nfever", False), ("fever however not present", False), ("without fever or ataxia", True),
        ("short stature; fever is absent", True), ("fever is absent; short", True), ("not only fever", False),
    ],
)
def test_scoped_negation(text, negated):
    (row,) = [x for x in N._walked([text], N.Trie([["fever"], ["high", "fever"]]))]
    assert row[6].tolist() == [negated]


def test_a_cue_inside_a_name_and_texts_side_by_side():
    trie = N.Trie([N.tokens_of(n) for n in NAMES])
    rows = list(N._walked(["no", "fever", "no taste", "ataxia not seen"], trie))
    assert [r[6].tolist() for r in rows] == [[], [False], [False], [True]]


def test_find_and_pieces(spark):
    names = spark.createDataFrame([(n,) for n in NAMES] + [(None,), ("...",)], "name string")
    texts = spark.createDataFrame([(1, "He has short stature and no ataxia. Large tongue seen with hand foot hand", "x"), (2, None, "y"), (3, "", "z"), (1, "FEVER", "w")], "id long, text string, name string")
    got = sorted(tuple(r) for r in N.find(texts, names).collect())
    assert got == [(1, 0, 1, "fever", False), (1, 2, 4, "short stature", False), (1, 6, 7, "ataxia", True), (1, 12, 14, "hand foot", False), (1, 14, 15, "hand", False)]
    assert sorted(tuple(r) for r in N.find(texts, names, most=2).collect()) == got  # several passes
    assert {r.piece for r in N.pieces(texts, names).collect()} == {"he", "large tongue seen"}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b):
            old, row[j + 1] = row[j + 1], old + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_subsequences_over_many_words():
    r = random.Random(3)
    texts = ["".join(r.choice("abcdé 𝄞") for _ in range(n)) for n in (0, 1, 5, 63, 64, 65, 127, 128, 129, 200, 300)]
    table = subsequence.Names(texts, list(range(len(texts))))
    for phrase in ["", "a", "zz", *("".join(r.choice("abcdé 𝄞z") for _ in range(n)) for n in (3, 64, 65, 130, 400))]:
        got = table.common(phrase, np.arange(len(texts))) if phrase else np.zeros(len(texts))
        assert got.tolist() == [lcs(phrase, t) for t in texts]


def test_fuzzy_equals_brute_force(spark, monkeypatch):
    r = random.Random(7)
    words = "small large red blue ring bolt widget economy standard plated tin nickel".split()
    names = [(" ".join(r.choice(words) for _ in range(r.randint(1, 5))), f"T{i}", 1000 - i) for i in range(600)]
    phrases = ["".join(c for c in n if r.random() > 0.2) + r.choice(["", "s", " x"]) for n, _, _ in names[:150]] + ["", "qqqq", "ring red", "Ring", None]
    sort = lambda t: " ".join(sorted(t.split()))
    want = {}
    for p in {p for p in phrases if p is not None}:
        score, order, name, i = max((200.0 * lcs(sort(p), sort(n)) / (len(sort(p)) + len(sort(n))), -o, n, i) for n, i, o in names)
        if score >= 60:
            want[p] = (name, i, round(score, 9))
    df = spark.createDataFrame(names, "name string, id string, ord int")
    asked = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    for most in (50_000, 200):
        got = {x.phrase: (x.name, x.id, round(x.score, 9)) for x in M.fuzzy(asked, df, most=most).collect()}
        assert got == want


def test_annotate(spark):
    names = spark.createDataFrame([("ataxia", "HP:1", 0), ("short stature", "HP:2", 1), ("abnormality of the immune system", "HP:3", 2)], "name string, id string, ord int")
    texts = spark.createDataFrame([("a", "No ataxia. Shot statures were seen"), ("b", "Severe ataxia and abnormality of the immune system"), ("c", None), ("d", "nothing like them at all")], "id string, text string")
    assert {r.id: r.terms for r in M.annotate(texts, names).collect()} == {"a": ["HP:2"], "b": ["HP:1", "HP:3"], "c": [], "d": []}
    own = M.annotate(texts, names, extract=lambda t, k, x: t.select(k, t[x].alias("phrase")).where("text like 'No%'"))
    assert {r.id: r.terms for r in own.collect()}["b"] == []


def test_names_of_other_lengths_are_left_aside():
    names = subsequence.Names(["abcd", "ab", "abcdefgh", "xbcd"], [3, 2, 1, 0])
    assert names.reach(4, 60.0) == (0, 4) and names.reach(40, 60.0) == (4, 4) and names.reach(1, 60.0) == (0, 1)
    assert names.best("bcd", 60.0) == (3, 200 * 3 / 7)  # equal scores: the first in order


def test_pieces_are_made_once_and_phrases_dealt_over_all_cores(spark):
    names = spark.createDataFrame([("short stature", "HP:1", 1), ("seizures", "HP:2", 2)], "name string, id string, ord int")
    texts = spark.createDataFrame([(f"t{k}", f"seizure number {k}. short statures") for k in range(300)], "id string, text string")
    out = M.annotate(texts, names)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2  # mentions and fuzzy; pieces were made anew for each use
    phrases = M.fuzzy(texts.select(texts.text.alias("phrase")), names, 1.0)
    tasks = phrases.rdd.glom().map(len).collect()
    assert sum(n > 0 for n in tasks) >= spark.sparkContext.defaultParallelism


def test_the_number_of_passes_changes_neither_mentions_nor_pieces(spark):
    names = spark.createDataFrame([(n,) for n in [*NAMES, "FEVER", "Fever ", "hand  foot"]], "name string")
    r = random.Random(5)
    words = "fever high short stature ataxia severe intellectual disability of early childhood onset type two hand foot 1.5 mm gap . , no tongue".split()
    # one key may stand for several texts
    texts = spark.createDataFrame([(k % 7, " ".join(r.choice(words) for _ in range(r.randint(0, 30)))) for k in range(40)] + [(1, None)], "id long, text string")
    for f in (N.find, N.pieces):
        one = sorted(tuple(x) for x in f(texts, names).collect())
        assert one and all(sorted(tuple(x) for x in f(texts, names, most=most).collect()) == one for most in (1, 4))


def test_many_phrases_at_once_equal_one_at_a_time(monkeypatch):
    r = random.Random(11)
    monkeypatch.setattr(subsequence, "PAIRS", 300)
    monkeypatch.setattr(subsequence, "MANY", 60)
    for letters, lengths in (("abcdefgh", (0, 1, 4, 9, 12)), ("abcdé 𝄞", (0, 5, 31, 33, 64)), ("abcd ", (3, 64, 65, 140))):
        texts = ["".join(r.choice(letters) for _ in range(r.choice(lengths))) for _ in range(200)]
        names = subsequence.Names(texts, [r.randrange(20) * 1000 + k for k in range(200)])
        phrases = ["".join(c for c in r.choice(texts) if r.random() > 0.2) + r.choice(["", "zz", "a"]) for _ in range(150)] + ["", "zzzz", "é" * 300]
        for threshold in (0.0, 30.0, 60.0, 95.0, 100.0, 250.0):
            found = names.bests(phrases, threshold)
            assert found == [names.best(p, threshold) for p in phrases]
            for p, hit in zip(phrases, found):
                scores = [200.0 * lcs(p, t) / max(1, len(p) + len(t)) if p or t else 100.0 for t in texts] if threshold == 60.0 else []
                assert not scores or (hit[1] == max(scores) if hit else max(scores) < 60.0)


def test_most_phrases_end_at_groups_of_names(monkeypatch):
    r = random.Random(12)
    words = "small large red blue ring bolt widget economy standard plated tin nickel".split()
    names = subsequence.Names([" ".join(sorted(r.choices(words, k=3))) for _ in range(2000)], list(range(2000)))
    alone = []
    best = subsequence.Names.best
    monkeypatch.setattr(subsequence.Names, "best", lambda self, p, t: alone.append(p) or best(self, p, t))
    phrases = ["".join(r.choice("uvwxyzkqj") for _ in range(r.randint(8, 30))) for _ in range(500)]
    assert names.bests(phrases, 60.0) == [None] * 500 and not alone
