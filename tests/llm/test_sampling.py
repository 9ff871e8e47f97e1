"""Consistent weighted sampling: exact draws by plain Python, collision rates, neighbours in order of doc_id."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from caseloom.llm import sampling as S


def log_a(key):
    return (key & ~np.uint64(0xFFFF)).view(np.float64) - S._OFFSET


def test_draws_equal_the_published_scheme():
    """t, and ln a, by the formulas over c, r and b; with weight 1 the short way gives the same."""
    rng = np.random.default_rng(1)
    terms = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    weights = rng.choice([1, 2, 3, 17, 1000], 400)
    for k in (0, 5, 127):
        d = S.Draws(terms, weights)
        got = log_a(d.all(k)).tolist()
        h = d.hashes(k, np.empty(400, dtype=np.uint64))
        short = np.log(S._exponential(d.ones(k, np.empty(400, dtype=np.uint64)) >> np.uint64(16), 48)).tolist()
        for w, c, r, b, x, one in zip(weights.tolist(), *(v.tolist() for v in S.scheme(h)), got, short):
            t = math.floor(math.log(w) / r + b)
            y = math.exp(r * (t - b))
            assert abs(x - math.log(c / (y * math.exp(r)))) < 1e-6
            assert w > 1 or abs(x - one) < 1e-6 and t == 0


def test_draws_have_their_distributions():
    h = np.random.default_rng(2).integers(0, 1 << 63, 1 << 17).astype(np.uint64) << np.uint64(1)
    c, r, b = S.scheme(h)
    for x in (c, r):
        p = np.sort(1 - np.exp(-x) * (1 + x))
        assert np.abs(p - np.arange(p.size) / p.size).max() < 0.006
    assert np.abs(np.sort(b) - np.arange(b.size) / b.size).max() < 0.006
    assert np.abs(np.corrcoef([c, r, b]) - np.eye(3)).max() < 0.015


@pytest.mark.parametrize("seed", range(3))
def test_collisions_estimate_the_generalised_jaccard_similarity(seed):
    r = random.Random(seed)
    errors = []
    for _ in range(60):
        lines = [" ".join(f"w{r.randint(0, 10**6)}" for _ in range(5)) for _ in range(12)]
        a = " \n".join(x for x in lines for _ in range(r.choice([0, 1, 1, 2, 9])))
        b = " \n".join(x for x in lines for _ in range(r.choice([0, 1, 1, 2, 9])))
        fa, fb = (S.text_of(x, bool(s.strip())) for x, s in zip(S.fingerprints([a.encode(), b.encode()]), (a, b)))
        errors.append(S.likeness(fa, fb) - S.generalised_jaccard(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.06


def test_fingerprints_do_not_depend_on_the_batch():
    texts = [b"a b c d e f g", b"a b c", b"", None, b"A B C d e f g", b"x " * 5000, b"\xc3\xa9 \xe4\xb8\xad q r s t u v", b" \n"]
    whole = S.fingerprints(texts)
    for i, t in enumerate(texts):
        assert (S.fingerprints([t])[0] == whole[i]).all()
    assert (whole[0] == whole[4]).all() and S.likeness(S.text_of(whole[2], False), S.text_of(whole[3], False)) == 1.0
    assert S.likeness(S.text_of(whole[0], True), "") == 0.0


def plain(rows):
    """Each row with its next one in order of id (nulls first); ids of these rows have one text each."""
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))
    out = []
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        prints = [S.text_of(x, bool(t.strip(" \t\n\x0b\x0c\r"))) for x, t in zip(S.fingerprints([t.encode() for t in (text, changed, following)]), (text, changed, following))]
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1], S.likeness(prints[0], prints[1]), S.likeness(prints[0], prints[2])))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, part string, id int").repartition(5)
    found = S.edit_report(df).collect()
    return sorted(((r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest(), r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in found), key=repr)


def test_report_equals_plain_neighbours(spark):
    r = random.Random(4)
    words = ["alpha", "beta", "é", "中文", "𝄞", "gamma", "x", "delta"]
    rows = [(i * 3 - 40, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 4, 5, 30, 200])))) for i in range(120)]
    rows += [(None, "null id comes first"), (10_000, None), (10_001, "z " * 50_000), (10_002, rows[5][1]), (-(1 << 62), "")]
    r.shuffle(rows)
    assert got(spark, rows) == plain(rows)


def test_ties_repeated_rows_single_and_empty(spark):
    assert got(spark, [(1, "just one row of a few words")]) == plain([(1, "just one row of a few words")])
    assert got(spark, []) == []
    tied = [(1, "same text here is it"), (1, "same text here is it"), (1, "other text of that id"), (2, "b c"), (2, "b c")]
    found = got(spark, tied)
    assert len(found) == 5 and len({x[3] for x in found if x[0] == 2}) == 1
    many = [(7, f"t{k % 3} a b c d e f") for k in range(200)]
    assert len(got(spark, many)) == 200
