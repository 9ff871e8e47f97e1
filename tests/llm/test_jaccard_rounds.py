"""Links that only the last round of the Jaccard join can find."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from caseloom.llm import jaccard


def brute(rows):
    """Component of each doc_id by all pairs of exact sets."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    comp = {i: i for i in sets}

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            comp[y] = x
    return {i: top(i) for i in sets}


def bits_apart(a: str, b: str) -> int:
    x, y = (jaccard.signature(s)[None] for s in jaccard.shingles([a.encode(), b.encode()]))
    w = min(x.shape[1], y.shape[1])
    return int(np.bitwise_count(jaccard.folded(x, w) ^ jaccard.folded(y, w)).sum())


def misleading(name: str, first: int) -> list[tuple[int, str]]:
    """Documents whose closest pair by signature fails and was checked before, while a farther pair links.

    E and D share 31 of 41 shingles and link; H is E and one word more, and shares 31
    of 42 with D.  Words are searched until H and D seem closer (9 bits) than E and D
    (10).  Another text repeats the added shingle, so that H leads the lists of all.
    """
    for k in range(100_000):
        e = [f"{name}{i}" for i in range(40)]
        d = e[:18] + [f"{name}x{k}"] + e[19:]
        h = [*e, f"{name}y{k}"]
        texts = [" ".join(x) for x in (h, e, d)]
        if (bits_apart(texts[0], texts[2]), bits_apart(texts[1], texts[2])) == (9, 10):
            break
    often = " ".join([" ".join(h[-5:])] * 30)
    return [(first + i, t) for i, t in enumerate([*texts, often])]


def components(spark, rows):
    return {r.doc_id: r.component_id for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_a_pair_checked_before_does_not_end_the_rounds(spark):
    rows = misleading("a", 1)
    want = brute(rows)
    assert want == {1: 1, 2: 1, 3: 1, 4: 4}
    assert components(spark, rows) == want


@pytest.mark.parametrize("block", [1000, 2])
def test_many_misleading_families_and_random_ones(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = [x for k in range(6) for x in misleading(f"f{k}-", 100 * k)]
    r = random.Random(block)
    for g in range(25):
        base = [f"g{g}w{i}" for i in range(r.randint(8, 50))]
        for i in range(r.randint(2, 6)):
            w = list(base)
            for _ in range(r.randint(0, 2)):
                w[r.randrange(len(w))] = f"z{r.randint(0, 5)}"
            rows.append((10_000 + 10 * g + i, " ".join(w + [f"t{r.randint(0, 9)}"] * r.randint(0, 2))))
    assert components(spark, rows) == brute(rows)
