"""The gradient sums of op 5 are of every window of a training text, as registered."""

from __future__ import annotations

import tracemalloc

import numpy as np

from caseloom.llm import attention


def test_every_window_is_in_the_sums(spark):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 40, 1_000).astype("<u2")
    stored = spark.createDataFrame([(5 << 20, bytearray(ids.tobytes()), 0)], "h long, ids binary, part int")
    end, d = 40, attention.WIDTH
    small, of = np.arange(end + 1), np.arange(end + 1) % attention.CLASSES
    p = {k: rng.standard_normal((d, d)) * 0.3 for k in "qkvo"} | {"e": rng.standard_normal((end + 1, d)), "p": rng.standard_normal((attention.WINDOW, d)), "u": rng.standard_normal((d, attention.CLASSES)), "b": np.zeros(attention.CLASSES)}
    base = rng.standard_normal((end + 1, attention.CLASSES))
    source, target = np.append(end, ids).astype(int), np.append(ids, end).astype(int)
    place = np.arange(0, source.size, attention.WINDOW)[:, None] + np.arange(attention.WINDOW)
    used, place = place < source.size, np.minimum(place, source.size - 1)
    _, want = attention.gradients(p, source[place], of[target[place]], used, base[source[place]])
    g = attention._sums(stored, end)(0, p, small, of, base)
    assert all(np.allclose(g[k], want[k], atol=1e-4) for k in p)


def test_summed_gradients_are_the_mean_ones_times_their_number():
    r = np.random.default_rng(4)
    d, c, w, many = attention.WIDTH, attention.CLASSES, attention.WINDOW, 40
    draw = lambda *s: (r.standard_normal(s) * 0.3).astype(np.float32)
    p = {k: draw(d, d) for k in "qkvo"} | {"e": draw(many, d), "p": draw(w, d), "u": draw(d, c), "b": draw(c)}
    base, total, rest, n = draw(many, c), 0.0, 0.0, 0
    found = attention.Summed(p, base)
    for size in (7, 1, 30):
        x, y, used = r.integers(0, many, (size, w)), r.integers(0, c, (size, w)), np.arange(w) < r.integers(1, 40, (size, 1))
        found.add(x, y, used)
        _, g = attention.gradients(p, x, y, used, base[x])
        total, rest, n = total + g["e"] * used.sum(), rest + np.concatenate([g[z].reshape(-1) for z in attention._REST]) * used.sum(), n + used.sum()
    e, others, used_n = found.sums()
    assert used_n == n and np.allclose(e, total, atol=1e-3) and np.allclose(others, rest, atol=1e-3)


def test_summing_a_block_takes_no_new_memory():
    """The wide arrays of a block are those of the block before; what is new is small beside its scores."""
    r = np.random.default_rng(5)
    d, c, w, many = attention.WIDTH, attention.CLASSES, attention.WINDOW, 40
    p = {k: r.standard_normal((d, d)).astype(np.float32) for k in "qkvo"} | {"e": r.standard_normal((many, d)).astype(np.float32), "p": np.zeros((w, d), np.float32), "u": np.zeros((d, c), np.float32), "b": np.zeros(c, np.float32)}
    found = attention.Summed(p, np.zeros((many, c), np.float32))
    x, y, used = r.integers(0, many, (30, w)), r.integers(0, c, (30, w)), np.ones((30, w), bool)
    found.add(x, y, used)
    tracemalloc.start()
    found.add(x, y, used)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.size * c * 4 / 2


def test_counts_in_an_array_are_those_by_sorting(spark, monkeypatch):
    r = np.random.default_rng(6)
    texts = [r.integers(0, 40, r.integers(0, 30)) for _ in range(50)]
    stored = spark.createDataFrame([(bytearray(t.astype("<u2").tobytes()),) for t in texts], "ids binary")
    code = lambda source, target: source * 41 + target
    want = np.zeros(41 * 41)
    for t in texts:
        np.add.at(want, code(np.append(40, t), np.append(t, 40)), 1)
    for dense in (41 * 41, 0):
        monkeypatch.setattr(attention, "DENSE", dense)
        k, n = attention._counted(stored, code, 40, 41 * 41)
        assert len(set(k)) == len(k) and np.array_equal(np.bincount(k, weights=n, minlength=41 * 41), want)
