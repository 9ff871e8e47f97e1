"""Language-model scoring by a causal self-attention model on subword ids.

Model: one head of causal attention over windows of ``WINDOW`` ids, trained in
numpy with Adam.  It predicts the class of the next id (``CLASSES`` classes,
k-means over what ids come before an id); within a class ids have their smoothed
training frequency.  A class's score starts at the log of how often it follows the
id (counted over the whole corpus); embeddings and attention learn what that
leaves.  Without a layer norm all that depends on an id alone is folded into one
row of a table before scoring, so scoring is gathers and one masked attention over
batches of windows.

Windows overlap: the first of a text scores all its places, each later one its
last ``STRIDE`` places, so every id, and the end id after the text, is scored
once, with ``WINDOW - STRIDE`` ids of context at least.

Word counts: every word of every training document is counted (a shuffle whose
size follows the corpus).  The most frequent words, ``HEAD`` at most, are
broadcast (a fixed bound); other words of a text meet their counts in a join.

Every text is encoded once, its ids written, and read from there for training and
scoring.  Training covers every training document; counts of
ids and of id pairs over all of them give the classes, what follows what, the class
bias and the frequencies within a class.  ``STEPS`` steps on a bounded sample
(``DOCS`` texts) only set the parameters from which training starts; then every
training text is in the gradient sum of one of ``PARTS`` further steps, summed by
task, with all of its windows (``SPACING`` 1).

Cases: null and empty texts are the end token alone.  Without training
documents all counts are 0 and the model is uniform.  Repeated rows get equal
results.  Columns besides the key are left out.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm import arrays, scratch
from caseloom.llm.subwords import Subwords

WINDOW, STRIDE, WIDTH, CLASSES = 16, 12, 16, 128
DOCS, LONGEST, STEPS, BATCH, SCORED, SUMMED, HELD, ROWS = 800, 12_500, 150, 512, 180, 30, 1 << 15, 240
PARTS, SPACING, RATE, FIXED = 8, 1, 0.01, 1 << 20  # a spacing of 1 is every window
PRIOR = 4.0
HEAD = 1 << 17
MERGE, DENSE = 1_000_000, 1 << 21
U8 = np.uint64


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Subwords:
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Subwords(lambda text: np.array(e.encode_ordinary(text), dtype="<u4"), 600_000, 21)


# --- model ---------------------------------------------------------------------


@dataclass
class Model:
    """Tables for scoring; ``end`` is the id before and after every text."""

    end: int
    row: np.ndarray  # table row of each id; ids without any count share the last
    mixing: np.ndarray  # (rows, 3 * WIDTH + 1): query, key, value and 1 side by side
    direct: np.ndarray  # (rows, CLASSES): the id's own share of the scores
    over: np.ndarray  # (WIDTH, WIDTH): from mixed values to what a place adds to its embedding
    to: np.ndarray  # (WIDTH, CLASSES): from there to scores
    at: tuple[np.ndarray, np.ndarray]  # mixing and embedding of places
    of: np.ndarray  # class of each id
    inside: np.ndarray  # log probability of each id in its class

    def score(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log probability of each text with the end after it."""
        n = np.diff(starts) + 1
        if not n.size:
            return np.zeros(0)
        begin = starts[:-1] + np.arange(n.size)
        source, target = shifted(ids, starts, self.end)
        x, of, log_p = self.row[source], self.of[target], self.inside[target]
        many = 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))
        doc = np.repeat(np.arange(n.size), many)
        number = np.arange(doc.size) - np.repeat(np.cumsum(many) - many, many)
        first, left = begin[doc] + number * STRIDE, n[doc] - number * STRIDE
        for lead, those in ((0, number == 0), (WINDOW - STRIDE, number > 0)):
            f, m = first[those], left[those]
            for i in range(0, f.size, SCORED):  # so many windows that their scores stay in the cache
                place = np.minimum(f[i : i + SCORED, None] + np.arange(WINDOW), source.size - 1)
                own = place[:, lead:]
                mine = np.arange(lead, WINDOW) < m[i : i + SCORED, None]
                log_p[own[mine]] += self._classed(x[place], of[own], lead)[mine]
        return np.add.reduceat(log_p, begin, dtype=np.float64)

    def _classed(self, x: np.ndarray, c: np.ndarray, lead: int) -> np.ndarray:
        """Log probability of the classes c at the places from ``lead`` on of windows of table rows x."""
        (n, w), many, room = x.shape, c.size, _ROOM
        e = np.take(self.mixing, x.reshape(-1), axis=0, out=room("mixing", n * w, 3 * WIDTH + 1), mode="clip").reshape(n, w, -1)
        e += self.at[0]
        a = np.matmul(e[:, lead:, :WIDTH], e[:, :, WIDTH : 2 * WIDTH].transpose(0, 2, 1), out=room("a", n, w - lead, w))
        attend(a, _CAUSAL[lead:])
        mixed = np.matmul(a, e[:, :, 2 * WIDTH :], out=room("mixed", n, w - lead, WIDTH + 1)).reshape(many, -1)  # the last column is the sum of a
        values = np.divide(mixed[:, :WIDTH], mixed[:, WIDTH:], out=room("values", many, WIDTH))
        h = np.matmul(values, self.over, out=room("h", many, WIDTH))
        h.reshape(n, w - lead, WIDTH)[:] += self.at[1][lead:]
        s = np.matmul(h, self.to, out=room("s", many, self.to.shape[1]))
        add_rows(s, self.direct, x[:, lead:].reshape(-1), room)
        chosen = s.reshape(-1)[np.arange(0, s.size, s.shape[1]) + c.reshape(-1)]
        np.exp(s, out=s)
        return (chosen - np.log(s @ np.ones(s.shape[1], np.float32))).reshape(c.shape)

    def _window(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Log probability of y at each place of windows of ids x."""
        return self._classed(self.row[x], self.of[y], 0) + self.inside[y]


class Room(dict):
    """Float32 arrays by name, the same memory each time: new memory for each block costs more than the sums."""

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self or self[name].size < size:
            self[name] = np.empty(size, dtype=np.float32)
        return self[name][:size].reshape(shape)


_ROOM = Room()
_CAUSAL = np.tril(np.ones((WINDOW, WINDOW), dtype=np.float32))


def attend(a: np.ndarray, seen: np.ndarray) -> None:
    """Turns scores of pairs of places into weights that are not yet divided by their sums, in place."""
    np.clip(a, -30, 30, out=a)
    np.exp(a, out=a)
    a *= seen


def add_rows(s: np.ndarray, table: np.ndarray, at: np.ndarray, room: Room) -> None:
    """Adds rows of a table to those of ``s``, so many at a time that they stay in the cache."""
    for i in range(0, len(s), ROWS):
        part = s[i : i + ROWS]
        part += np.take(table, at[i : i + ROWS], axis=0, out=room("rows", *part.shape), mode="clip")


def common_column(count: np.ndarray) -> np.ndarray:
    """A column for each id: the 256 most frequent have one each, all others the last."""
    common = np.argsort(-count, kind="stable")[:256]
    column = np.full(count.size, 256, dtype=np.int64)
    column[common] = np.arange(common.size)
    return column


def classes(count: np.ndarray, ids: np.ndarray, columns: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A class for each id: k-means over the log counts ``n`` of the columns of ids before it."""
    of = np.full(count.size, CLASSES - 1, dtype=np.int64)
    known = np.flatnonzero(count > 0)
    row = np.full(count.size, -1, dtype=np.int64)
    row[known] = np.arange(known.size)
    x = np.zeros((known.size, 257), dtype=np.float32)
    np.add.at(x, (row[ids], columns), n)
    x = np.log1p(x)
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-6
    weight = np.sqrt(count[known]).astype(np.float32)
    centre = x[np.argsort(-count[known], kind="stable")[: CLASSES - 1]].copy()
    near = np.zeros(known.size, dtype=np.int64)
    for _ in range(8):
        near = np.argmax(x @ centre.T - 0.5 * (centre * centre).sum(axis=1), axis=1)
        for c in range(len(centre)):
            own = near == c
            if own.any():
                centre[c] = np.average(x[own], axis=0, weights=weight[own])
    of[known] = near
    return of


def follows(size: int, of: np.ndarray, count: np.ndarray, rows: np.ndarray, k: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log probability of each class after each of the ``rows`` ids, smoothed by the classes' own; the last row is the latter.

    ``k`` is id * CLASSES + class of the next id, ``n`` how often that occurs.
    """
    own = np.bincount(of, weights=count + 0.1, minlength=CLASSES) + 1e-6
    own /= own.sum()
    table = np.tile(own * PRIOR, (rows.size + 1, 1))
    small = np.full(size, rows.size, dtype=np.int64)
    small[rows] = np.arange(rows.size)
    np.add.at(table, (small[k // CLASSES], k % CLASSES), n)
    table[-1] = own
    return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def gradients(p: dict[str, np.ndarray], x: np.ndarray, c: np.ndarray, used: np.ndarray, base: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss in nats of the class c after each id of windows x, and its gradient; ``base`` is added to the scores."""
    e = p["e"][x] + p["p"]
    flat = lambda t: t.reshape(-1, t.shape[-1])
    times = lambda t, w: (flat(t) @ w).reshape(*t.shape[:-1], w.shape[1])
    scale = e.dtype.type(1 / np.sqrt(p["q"].shape[1]))
    q, k, v = times(e, p["q"]), times(e, p["k"]), times(e, p["v"])
    a = np.matmul(q, k.transpose(0, 2, 1))
    a *= scale
    np.exp(np.clip(a, -30, 30, out=a), out=a)
    a *= np.tril(np.ones((x.shape[1],) * 2, dtype=e.dtype))
    a /= a.sum(axis=2, keepdims=True)
    mixed = np.matmul(a, v)
    h = times(mixed, p["o"]) + e
    s = times(h, p["u"]) + p["b"]
    if base is not None:
        s += base
    s -= s.max(axis=2, keepdims=True)
    prob = np.exp(s, out=s)
    prob /= prob.sum(axis=2, keepdims=True)
    total = max(1.0, float(used.sum()))
    own = np.take_along_axis(prob, c[:, :, None], axis=2)[:, :, 0]
    loss = float(-(np.log(np.maximum(own, 1e-30)) * used).sum() / total)
    ds = prob
    np.put_along_axis(ds, c[:, :, None], own[:, :, None] - 1, axis=2)
    ds *= (used / total)[:, :, None].astype(ds.dtype)
    g = {"u": flat(h).T @ flat(ds), "b": flat(ds).sum(axis=0)}
    dh = times(ds, p["u"].T)
    g["o"] = flat(mixed).T @ flat(dh)
    dm = times(dh, p["o"].T)
    da = np.matmul(dm, v.transpose(0, 2, 1))
    dv = np.matmul(a.transpose(0, 2, 1), dm)
    da -= np.einsum("nij,nij->ni", da, a)[:, :, None]
    dz = np.multiply(da, a, out=da)
    dz *= scale
    dq, dk = np.matmul(dz, k), np.matmul(dz.transpose(0, 2, 1), q)
    de = dh + times(dq, p["q"].T) + times(dk, p["k"].T) + times(dv, p["v"].T)
    for name, d in (("q", dq), ("k", dk), ("v", dv)):
        g[name] = flat(e).T @ flat(d)
    g["p"] = de.sum(axis=0)
    g["e"] = np.zeros_like(p["e"])
    at = x.reshape(-1)
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    g["e"][at[order[first]]] = np.add.reduceat(flat(de)[order], first, axis=0)
    return loss, g


class Summed:
    """Sums over windows of the gradients that ``gradients`` gives the mean of, block after block.

    The scores of all classes are the one wide array; it is made, turned into
    exponentials and into their differences from the true class in place, and each
    product with it is one call for a whole block.  In all other arrays a row is a
    feature of every place of the block, so that plain operations run along memory.
    The rows of ones beside the values and the mixed values sum up.
    """

    def __init__(self, p: dict[str, np.ndarray], base: np.ndarray) -> None:
        d, c = p["u"].shape
        plain = lambda z: np.ascontiguousarray(z, dtype=np.float32)
        self.scale = np.float32(1 / np.sqrt(d))
        self.base, self.ids = plain(base + p["b"]), plain(p["e"])
        self.place = np.tile(plain(p["p"].T), SUMMED)
        self.into = plain(np.hstack([p["q"] * self.scale, p["k"], p["v"]]))
        self.back, self.o, self.over = plain(self.into.T), plain(p["o"]), plain(p["o"].T)
        self.u, self.to, self.ones = plain(p["u"]), plain(p["u"].T), np.ones(c, np.float32)
        self.g = {"into": np.zeros((d, 3 * d)), "o": np.zeros((d, d)), "u": np.zeros((d, c)), "b": np.zeros(c)}
        self.e, self.dplace = np.zeros(self.ids.shape[::-1]), np.zeros(self.place.shape)
        self.used, self.places = 0, 0
        self.held, self.room = (np.empty(HELD, dtype=np.int64), np.empty((d, HELD), dtype=np.float32)), Room()

    def add(self, x: np.ndarray, c: np.ndarray, used: np.ndarray) -> None:
        """At most ``SUMMED`` windows of ids x (rows of the embeddings), the classes after them, and which of these count."""
        (n, w), (d, wide), room = x.shape, self.u.shape, self.room
        many = n * w
        if self.places + many > HELD:
            self._gather()
        at = self.held[0][self.places : self.places + many]
        at[:] = x.reshape(-1)
        c, counts = c.reshape(-1), used.reshape(-1).astype(np.float32)
        windows = lambda z: z.reshape(-1, n, w).transpose(1, 0, 2)  # noqa: E731  windows, features, places
        turned = lambda z: np.add(z.transpose(0, 2, 1), 0, out=room("turned", n, w, w))  # noqa: E731  products with the array as it lies are faster
        rows = np.take(self.ids, at, axis=0, out=room("rows", many, d), mode="clip")
        e = np.add(rows.T, self.place[:, :many], out=room("e", d, many))
        qkv = room("qkv", 3 * d + 1, many)
        np.matmul(self.back, e, out=qkv[: 3 * d])
        qkv[3 * d] = 1
        q, k, v = windows(qkv[:d]), windows(qkv[d : 2 * d]), windows(qkv[2 * d :])
        a = np.matmul(q.transpose(0, 2, 1), k, out=room("a", n, w, w))
        attend(a, _CAUSAL)
        mixed = room("mixed", d + 1, many)
        np.matmul(v, turned(a), out=windows(mixed))
        over = 1 / mixed[d]
        mixed = mixed[:d]
        mixed *= over
        h = np.matmul(self.over, mixed, out=room("h", d, many))
        h += e
        s = np.matmul(h.T, self.u, out=room("s", many, wide))
        add_rows(s, self.base, at, room)
        np.exp(s, out=s)
        total = s @ self.ones
        weight = counts / total
        dh = np.multiply(np.matmul(s, self.to, out=room("rows", many, d)).T, weight, out=room("dh", d, many))
        true = np.take(self.u, c, axis=1, out=room("true", d, many), mode="clip")
        true *= counts
        dh -= true
        s.reshape(-1)[np.arange(0, s.size, wide) + c] -= total
        h *= weight
        self.g["u"] += h @ s
        self.g["b"] += weight @ s
        self.g["o"] += mixed @ dh.T
        dm = room("dm", d + 1, many)  # the last row takes off what all values have in common
        np.matmul(self.o, dh, out=dm[:d])
        np.negative(np.add.reduce(np.multiply(dm[:d], mixed, out=h), axis=0), out=dm[d])
        dm *= over
        dqkv = room("dqkv", 3 * d, many)
        np.matmul(windows(dm[:d]), a, out=windows(dqkv[2 * d :]))
        a *= np.matmul(windows(dm).transpose(0, 2, 1), v, out=room("turned", n, w, w))
        np.matmul(k, turned(a), out=windows(dqkv[:d]))
        np.matmul(q, a, out=windows(dqkv[d : 2 * d]))
        self.g["into"] += e @ dqkv.T
        dh += np.matmul(self.into, dqkv, out=h)
        self.dplace[:, :many] += dh
        self.held[1][:, self.places : self.places + many] = dh
        self.used += int(np.count_nonzero(used))
        self.places += many

    def _gather(self) -> None:
        """Adds the gradients of the places held to those of their ids."""
        at, de = self.held[0][: self.places], self.held[1][:, : self.places]
        for total, column in zip(self.e, de):
            total += np.bincount(at, weights=column, minlength=total.size)
        self.places = 0

    def sums(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Of the embeddings, of the other parameters in the order of ``_REST``, and how many places counted."""
        self._gather()
        d = len(self.u)
        own = {z: self.g["into"][:, i * d : (i + 1) * d] for i, z in enumerate("qkv")} | {z: self.g[z] for z in "oub"}
        own["p"] = self.dplace.reshape(d, -1, WINDOW).sum(axis=1).T
        own["q"] = own["q"] * self.scale
        return self.e.T, np.concatenate([own[z].reshape(-1) for z in _REST]), self.used


def shifted(ids: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The end and a text's ids, and its ids and the end, for all texts."""
    ids = ids.astype(np.int64)
    return np.insert(ids, starts[:-1], end), np.insert(ids, starts[1:], end)


def train(ids: np.ndarray, starts: np.ndarray, size: int, end: int, steps: int = STEPS, seed: int = 1, counted: tuple | None = None, sums: Callable | None = None, base: np.ndarray | None = None) -> Model:
    """Fit on the texts whose ids are given; ``size`` ids there are, ``end`` among them.

    With ``counted`` (id counts and classes of a corpus), ``base`` (``follows``) and ``sums`` (part,
    parameters, ids with an embedding and classes to the mean gradient of that part)
    the texts only set where the steps over the corpus start.
    """
    rng = np.random.default_rng(seed)
    source, target = shifted(ids, starts, end)
    if counted:
        count, of = counted
    else:
        count = np.bincount(target, minlength=size).astype(np.float64)
        of = classes(count, target, common_column(count)[source], np.ones(target.size)) if target.size else np.arange(size) % CLASSES
    inside = np.log(count + 0.1) - np.log(np.maximum(np.bincount(of, weights=count + 0.1, minlength=CLASSES), 1e-9))[of]
    n, d = np.diff(starts) + 1, WIDTH
    begin = starts[:-1] + np.arange(n.size)
    # the embeddings of ids without any count stay at zero
    seen = np.union1d(np.flatnonzero(count > 0), [end])
    small = np.zeros(size, dtype=np.int64)
    small[seen] = np.arange(seen.size)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3 / np.sqrt(shape[0] if len(shape) > 1 else 1)).astype(np.float32)
    p = {k: draw(d, d) for k in "qkvo"} | {"e": (rng.standard_normal((seen.size, d)) * 0.1).astype(np.float32), "p": np.zeros((WINDOW, d), np.float32), "u": draw(d, CLASSES) * np.float32(0.1), "b": np.zeros(CLASSES, np.float32)}
    if base is None:
        k, c = np.unique(source * CLASSES + of[target], return_counts=True)
        base = follows(size, of, count, seen, k, c)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    chance = n / n.sum() if n.size else n

    def step(g: dict[str, np.ndarray], t: int, rate: float) -> None:
        for k in p:
            m[k] += 0.1 * (g[k] - m[k])
            v2[k] += 0.01 * (g[k] * g[k] - v2[k])
            p[k] -= np.float32(rate) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v2[k] / (1 - 0.99**t)) + 1e-8)

    first = steps if target.size else 0
    for t in range(1, first + 1):
        doc = rng.choice(n.size, size=BATCH, p=chance)
        at = begin[doc] + (rng.random(BATCH) * np.maximum(1, n[doc] - WINDOW + 1)).astype(np.int64)
        place = at[:, None] + np.arange(WINDOW)
        used = place < (begin + n)[doc][:, None]
        place = np.minimum(place, source.size - 1)
        x = small[source[place]]
        _, g = gradients(p, x, of[target[place]], used, base[x])
        step(g, t, 0.02 * (1 - 0.9 * t / steps))
    for i in range(PARTS if sums else 0):
        g = sums(i, p, small, of, base)
        if g is not None:
            step(g, first + i + 1, RATE * (1 - 0.9 * i / PARTS))
    e = np.concatenate((p["e"], np.zeros((1, d), np.float32)))
    row = np.full(size, seen.size, dtype=np.int32)
    row[seen] = np.arange(seen.size)
    scale = np.float32(1 / np.sqrt(d))
    fold = lambda z, one: np.hstack([z @ p["q"] * scale, z @ p["k"], z @ p["v"], np.full((len(z), 1), one, np.float32)])
    return Model(end, row, fold(e, 1), e @ p["u"] + p["b"] + base, p["o"], p["u"], (fold(p["p"], 0), p["p"]), of, inside.astype(np.float32))


def encoded(docs: DataFrame, training: Column, path: str, pattern: str, size: int, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """key, text, h (hash of the key), ids and part (-1 where nothing is learned) of every row, written by part; and where.

    Every text is encoded here once, for training and for scoring; ids are bytes, as ``_kind`` says.
    """
    spark = docs.sparkSession
    h = F.xxhash64(F.col(key).cast("string"), F.lit("attention sample"))
    learned = F.coalesce(training, F.lit(False)) & F.col(text).isNotNull()
    part = F.when(learned, F.pmod(F.shiftright(h, 7), F.lit(PARTS))).otherwise(-1).cast("int")
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), h.alias("h"), part.alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                ids, starts = e.encode(arrays.as_bytes(batch.column("text")))
                at = (starts * _kind(size).itemsize).astype(np.int32)
                held = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(at), pa.py_buffer(ids.astype(_kind(size)))])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "text", "h")), held, batch.column("part")], names=["key", "text", "h", "ids", "part"])

    kinds = dict(own.dtypes)
    rows = own.mapInArrow(run, f"key {kinds['key']}, text {kinds['text']}, h long, ids binary, part int")
    at = scratch.new_path(spark, "ids")
    rows.write.partitionBy("part").parquet(at)  # a training step reads its own part only
    return spark.read.schema(rows.schema).parquet(at), at


def _kind(size: int) -> np.dtype:
    """How ids below ``size`` are stored."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def _texts(held: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and starts of texts from their stored bytes."""
    kind = _kind(size)
    n = np.fromiter(map(len, held), dtype=np.int64, count=len(held)) // kind.itemsize
    return np.frombuffer(b"".join(held), dtype=kind), np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(n)))


def _counted(stored: DataFrame, code: Callable[[np.ndarray, np.ndarray], np.ndarray], end: int, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each code below ``codes`` of an id and the one after it occurs; combined in tasks before the shuffle.

    Up to ``DENSE`` codes a task counts in an array, else by sorting.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if codes <= DENSE:
            n = np.zeros(codes, dtype=np.int64)
            for batch in batches:
                n += np.bincount(code(*shifted(*_texts(batch.column("ids").to_pylist(), end + 1), end)), minlength=codes)
            keys = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n[keys])], names=["k", "n"])
            return
        keys, n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            more, c = np.unique(code(*shifted(*_texts(batch.column("ids").to_pylist(), end + 1), end)), return_counts=True)
            keys, row = np.unique(np.concatenate((keys, more)), return_inverse=True)
            n = np.bincount(row, weights=np.concatenate((n, c)), minlength=keys.size).astype(np.int64)
            if keys.size > MERGE:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["k", "n"])
                keys, n = keys[:0], n[:0]
        if keys.size:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["k", "n"])

    got = stored.select("ids").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()  # at most ids x 257 rows
    return got["k"].to_numpy(dtype=np.int64), got["n"].to_numpy(dtype=np.float64)


_REST = ("q", "k", "v", "o", "p", "u", "b")


def _sums(stored: DataFrame, end: int) -> Callable:
    """The mean gradient over all windows of a part; sums are of whole numbers, so their order does not matter."""
    spark = stored.sparkSession
    names = [f"g{j}" for j in range(WIDTH)]
    schema = "row long, " + ", ".join(f"{x} long" for x in names)

    def mean(part: int, p: dict[str, np.ndarray], small: np.ndarray, of: np.ndarray, base: np.ndarray) -> dict[str, np.ndarray] | None:
        held = spark.sparkContext.broadcast((p, small, of, base))
        many = len(p["e"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p, small, of, base = held.value
            found = Summed(p, base)
            for batch in batches:
                ids, starts = _texts(batch.column("ids").to_pylist(), end + 1)
                source, target = shifted(ids, starts, end)
                n = np.diff(starts) + 1
                windows = -(-n // WINDOW)
                first = np.cumsum(windows) - windows
                place = np.arange(source.size) + np.repeat(first * WINDOW - (starts[:-1] + np.arange(n.size)), n)
                x, c, used = np.zeros((3, windows.sum() * WINDOW), dtype=np.int64)
                x[place], c[place], used[place] = small[source], of[target], 1
                x, c, used = (z.reshape(-1, WINDOW) for z in (x, c, used))
                if SPACING > 1:
                    k = np.arange(len(x)) - np.repeat(first, windows)
                    x, c, used = (z[(k + np.repeat(batch.column("h").to_numpy() >> 20, windows)) % SPACING == 0] for z in (x, c, used))
                for i in range(0, len(x), SUMMED):
                    found.add(x[i : i + SUMMED], c[i : i + SUMMED], used[i : i + SUMMED])
            total, rest, used_n = found.sums()
            if not used_n:
                return
            row = np.flatnonzero(total.any(axis=1))
            full = np.concatenate((total[row], rest.reshape(-1, WIDTH)))
            whole = np.rint(full * FIXED).astype(np.int64)
            where = np.concatenate((row, many + np.arange(len(full) - row.size), [many + 1_000_000]))
            whole = np.concatenate((whole, np.full((1, WIDTH), used_n)))
            yield pa.RecordBatch.from_arrays([pa.array(where), *(pa.array(np.ascontiguousarray(whole[:, j])) for j in range(WIDTH))], names=["row", *names])

        mine = stored.where(F.col("part") == part).select("h", "ids").mapInArrow(run, schema)
        got = mine.groupBy("row").agg(*[F.sum(x).alias(x) for x in names]).toPandas()  # a row for each id at most
        held.destroy()
        arrays.trim()
        if got.empty:
            return None
        row, value = got["row"].to_numpy(dtype=np.int64), got[names].to_numpy(dtype=np.float64)
        n = value[row == many + 1_000_000][0, 0]
        value /= FIXED * n
        e = np.zeros(p["e"].shape, np.float32)
        e[row[row < many]] = value[row < many]
        rest = np.zeros((sum(p[z].size for z in _REST) // WIDTH, WIDTH), np.float32)
        kept = (row >= many) & (row < many + 1_000_000)
        rest[row[kept] - many] = value[kept]
        cut = np.split(rest.reshape(-1), np.cumsum([p[z].size for z in _REST])[:-1])
        return {"e": e} | {z: c.reshape(p[z].shape) for z, c in zip(_REST, cut)}

    return mean


def fit(stored: DataFrame, size: int) -> Model:
    """Train on the rows of ``encoded`` that have a part; ``size - 1`` is the end id."""
    end = size - 1
    stored = stored.where(F.col("part") >= 0)
    count = np.zeros(size)
    k, n = _counted(stored, lambda source, target: target, end, size)
    count[k] = n
    of, base = np.arange(size) % CLASSES, None
    if k.size:
        column, seen = common_column(count), np.union1d(np.flatnonzero(count > 0), [end])
        row = np.zeros(size, dtype=np.int64)
        row[seen] = np.arange(seen.size)
        k, n = _counted(stored, lambda source, target: row[target] * 257 + column[source], end, seen.size * 257)
        of = classes(count, seen[k // 257], k % 257, n)
        k, n = _counted(stored, lambda source, target: row[source] * CLASSES + of[target], end, seen.size * CLASSES)
        base = follows(size, of, count, seen, seen[k // CLASSES] * CLASSES + k % CLASSES, n)
    some = stored.where(F.octet_length("ids") <= LONGEST * _kind(size).itemsize)
    share = min(1.0, (1.5 * DOCS + 50) / max(1, some.count()))
    rows = some.where((F.col("h") / 2.0**64 + 0.5) < share).orderBy("h", "ids").limit(DOCS).toPandas()["ids"].tolist()
    ids, starts = _texts(list(map(bytes, rows)), size)
    return train(ids, starts, size, end, counted=(count, of), sums=_sums(stored, end), base=base)


# --- words ---------------------------------------------------------------------


def _words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    buffer, starts = arrays.joined(texts)
    begin, length, first = arrays.words(buffer, starts)
    return arrays.hashes(buffer, begin, length), first


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """h (hash of the lower-cased word) and c of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            h, c = (np.concatenate(x) for x in zip(*parts))
            keys, row = np.unique(h, return_inverse=True)
            c = np.bincount(row, weights=c, minlength=keys.size).astype(np.int64)
            for i in range(0, keys.size, 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + (1 << 18)].view(np.int64)), pa.array(c[i : i + (1 << 18)])], names=["h", "c"])

        parts, held = [], 0
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                keys, c = np.unique(_words(arrays.as_bytes(batch.column("text")))[0], return_counts=True)
                parts.append((keys, c))
                held += keys.size
                if held > MERGE:
                    yield from out(parts)
                    parts, held = [], 0
        if parts:
            yield from out(parts)

    partial = docs.select(F.col(text).alias("text")).mapInArrow(run, "h long, c long")
    return partial.groupBy("h").agg(F.sum("c").alias("c"))


def _head(counts: DataFrame, most: int = HEAD) -> DataFrame:
    """The words over a count that at most ``most`` words reach, from a histogram in steps of an eighth of a power of two."""
    step = F.floor(F.log2("c") * 8).cast("int")
    rows = counts.groupBy(step.alias("s")).agg(F.count("*").alias("n"), F.min("c").alias("c")).orderBy(F.desc("s")).collect()  # some hundred rows
    least, total = 1 << 62, 0
    for r in rows:
        total += r["n"]
        if total > most:
            break
        least = r["c"]
    return counts.where(F.col("c") >= least)


def score(docs: DataFrame, training: Column, path: str, pattern: str, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score and score (log10) of every row.

    ``training`` says which rows to learn from.  Eager: counts and scores are
    written to the shared folder.
    """
    spark = docs.sparkSession
    learn = docs.where(training)
    texts, at = encoded(docs, training, path, pattern, size, key, text)
    model = fit(texts, size)
    counts, _ = scratch.stored(count_words(learn, text), "counts")
    ends = learn.count()
    total = counts.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    n_all, distinct = (total["n"] or 0) + ends, total["v"] + (1 if ends else 0)
    head = _head(counts).toPandas()
    order = np.argsort(head["h"].to_numpy(dtype=np.int64).view(U8))
    held = spark.sparkContext.broadcast((model, head["h"].to_numpy(dtype=np.int64).view(U8)[order], head["c"].to_numpy(dtype=np.int64)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caseloom.llm.langid import Table

        m, keys, c = held.value
        table, c = Table(keys), np.append(c, 0)
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                log_p = m.score(*_texts(batch.column("ids").to_pylist(), size)) / np.log(10)
                h, first = _words(arrays.as_bytes(batch.column("text")))
                row = table.find(h)
                here = c[row]
                up = np.concatenate((np.zeros(1), np.cumsum(np.log10(here + 1.0))))
                known = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(here > 0)))
                rare = np.flatnonzero(row < 0)
                cut = np.searchsorted(rare, first).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(np.diff(first) + 1), pa.array(np.diff(known[first])), pa.array(np.diff(up[first])), pa.array(log_p), pa.ListArray.from_arrays(pa.array(cut), pa.array(h[rare].view(np.int64)))],
                    names=["key", "n_tokens", "known", "up", "score", "rare"],
                )

    own = texts.select("key", "text", "ids")
    kind = dict(own.dtypes)["key"]
    scored = own.mapInArrow(run, f"key {kind}, n_tokens long, known long, up double, score double, rare array<long>")
    scored, _ = scratch.stored(scored, "scored")
    scratch.drop(spark, at)
    scored = scored.withColumn("row", F.monotonically_increasing_id())
    more = scored.select("row", F.explode("rare").alias("h")).join(counts, "h")
    more = more.groupBy("row").agg(F.count("*").alias("known2"), F.sum(F.log10(F.col("c") + 1)).alias("up2"))
    both = scored.drop("rare").join(more, "row", "left")
    end_known, end_up = (1, float(np.log10(ends + 1))) if ends else (0, 0.0)
    rest = float(np.log10(float(n_all) + distinct + 1))
    return both.select(
        F.col("key").alias(key), "n_tokens", (F.col("known") + F.coalesce("known2", F.lit(0)) + end_known).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), (F.col("up") + F.coalesce("up2", F.lit(0.0)) + end_up - F.col("n_tokens") * rest).alias("base_score"), "score",
    )
