"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other: ``KINDS`` kinds of toxicity, then
toxicity itself.  Each model is a logistic regression on the presence of selected
words and word beginnings, and on the log odds of the categories before it; in
training these come from out-of-fold predictions (``FOLDS`` folds, dealt by a hash
of the text, so that copies share one), so that a later model sees earlier ones as
they are on texts they have not seen.

Labels: ``toxic`` is given.  The kinds come from the labelled texts themselves: the
``MARKERS`` features that mark toxic texts best are put into ``KINDS`` clusters by
the toxic texts they stand in (k-means on directions), and a toxic text is of a
kind if it has a feature of that cluster.

Features: words are runs of ASCII letters, digits and non-ASCII bytes,
lower-cased; their first 4 to 7 bytes count as features of their own.  Kept are
the ``FEATURES`` with the highest z-score between toxic and other texts, at 4 at
least and in 3 toxic texts; each fold's models select theirs from the other folds.

Training takes a bounded sample (a documented bound): ``POSITIVE`` toxic and
``NEGATIVE`` other labelled documents by a hash of their key, whole texts of at
most ``LONGEST`` characters, and of each label at most ``BYTES`` bytes.  A key that
is repeated counts once, with its smallest text.  One task fits the chain, and only
the chain comes to the driver.  The threshold is the lowest at which the
out-of-fold predictions have a precision of ``PRECISION``.

Cases: null and empty texts have no features.  Without labels of both kinds all
probabilities are 0 and nothing is toxic.  Equal z-scores go by the feature's hash,
equal labels of a key by the larger one.  Repeated rows get equal results; columns
named like a result are replaced, all others are kept.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm import arrays
from caseloom.llm.langid import Table

KINDS = 3
CATEGORIES = (*(f"kind_{k + 1}" for k in range(KINDS)), "toxic")
POSITIVE, NEGATIVE, LONGEST, BYTES = 1200, 2400, 100_000, 24 << 20
FEATURES, MARKERS, FOLDS, PRECISION = 1024, 96, 5, 0.98
PREFIXES = (4, 5, 6, 7)
SEPARATORS = arrays.separators(bytes(b for b in range(128) if not chr(b).isalnum()))
U8 = np.uint64


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature hash of all features there are (with repeats)."""
    buffer, starts = arrays.joined(texts)
    begin, length, first = arrays.words(buffer, starts, SEPARATORS)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))
    docs, found = [doc], [arrays.hashes(buffer, begin, length)]
    for k in PREFIXES:
        long = np.flatnonzero(length > k)
        docs.append(doc[long])
        found.append(arrays.hashes(buffer, begin[long], np.full(long.size, k), seed=k))
    return np.concatenate(docs), np.concatenate(found)


@dataclass
class Chain:
    """Feature table, and for each category weights, weights of earlier log odds and bias."""

    table: Table = field(default_factory=lambda: Table(np.zeros(0, dtype=U8)))
    weights: list[np.ndarray] = field(default_factory=list)
    earlier: list[np.ndarray] = field(default_factory=list)
    bias: list[float] = field(default_factory=list)
    threshold: float = 0.5

    def predict(self, texts: list[bytes | None]) -> np.ndarray:
        """Probabilities, (texts, categories)."""
        if not self.weights:
            return np.zeros((len(texts), len(CATEGORIES)))
        doc, row = present(texts, self.table)
        odds = np.zeros((len(texts), len(CATEGORIES)))
        for j, (w, e, b) in enumerate(zip(self.weights, self.earlier, self.bias)):
            odds[:, j] = np.bincount(doc, weights=w[row], minlength=len(texts)) + np.clip(odds[:, :j], -8, 8) @ e + b
        return _sigmoid(odds)


def present(texts: list[bytes | None], table: Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, row of the table) pairs."""
    doc, h = features(texts)
    row = table.find(h)
    hit = row >= 0
    size = max(1, table.keys.size)
    pair = np.unique(doc[hit].astype(np.int64) * size + row[hit])
    return pair // size, pair % size


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(doc: np.ndarray, row: np.ndarray, size: int, dense: np.ndarray, y: np.ndarray, used: np.ndarray, ridge: float = 1e-4, steps: int = 200) -> np.ndarray:
    """Weights of ``size`` present-or-not features, of the dense columns, and the bias, by Adam.

    (doc, row) are the features that are present; ``used`` weighs the texts.
    """
    many = size + dense.shape[1] + 1
    w, m, v = np.zeros(many), np.zeros(many), np.zeros(many)
    total = max(1.0, used.sum())
    for k in range(1, steps + 1):
        z = np.bincount(doc, weights=w[row], minlength=len(y)) + dense @ w[size:-1] + w[-1]
        r = (_sigmoid(z) - y) * used / total
        g = np.concatenate((np.bincount(row, weights=r[doc], minlength=size), dense.T @ r, [r.sum()]))
        g[:-1] += ridge * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= 0.15 * (1 - 0.9 * k / steps) * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return w


def _counted(texts: list[bytes], fold: np.ndarray, table: Table) -> np.ndarray:
    """In how many texts of each fold each feature of the table stands: (features, folds)."""
    out = np.zeros((table.keys.size, FOLDS), dtype=np.int64)
    for i in range(0, len(texts), 200):
        doc, row = present(texts[i : i + 200], table)
        np.add.at(out, (row, fold[i + doc]), 1)
    return out


def _frequent(texts: list[bytes], least: int) -> np.ndarray:
    """Features that stand in at least so many of the texts; sorted."""
    keys, n = np.zeros(0, dtype=U8), np.zeros(0, dtype=np.int64)
    for i in range(0, len(texts), 200):
        doc, h = features(texts[i : i + 200])
        order = np.lexsort((doc, h))
        doc, h = doc[order], h[order]
        new = np.ones(h.size, dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        more, c = np.unique(h[new], return_counts=True)
        keys, row = np.unique(np.concatenate((keys, more)), return_inverse=True)
        n = np.bincount(row, weights=np.concatenate((n, c)), minlength=keys.size).astype(np.int64)
    return keys[n >= least]


def _selected(inside: np.ndarray, outside: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Rows of the best features by z-score, best first; equal scores by row, which is by hash."""
    if not n1 or not n0:
        return np.zeros(0, dtype=np.int64)
    mean = (inside + outside) / (n1 + n0)
    z = (inside / n1 - outside / n0) / np.sqrt(mean * (1 - mean) * (1 / n1 + 1 / n0) + 1e-12)
    best = np.argsort(-z, kind="stable")[:FEATURES]
    return best[(z[best] >= 4) & (inside[best] >= 3)]


def _kinds(doc: np.ndarray, row: np.ndarray, markers: np.ndarray, toxic: np.ndarray) -> list[np.ndarray]:
    """For each kind, which texts are of it."""
    at = np.full(int(row.max(initial=-1)) + 2, -1)
    at[markers] = np.arange(markers.size)
    hit = toxic[doc] & (at[row] >= 0)
    x = np.zeros((markers.size, toxic.size), dtype=np.float32)
    x[at[row[hit]], doc[hit]] = 1
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-6
    chosen = [0][: markers.size]
    while len(chosen) < min(KINDS, markers.size):  # the one least like those chosen
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    centre = x[chosen]
    near = np.zeros(markers.size, dtype=np.int64)
    for _ in range(10 if chosen else 0):
        near = np.argmax(x @ centre.T, axis=1)
        centre = np.stack([x[near == k].sum(axis=0) if (near == k).any() else centre[k] for k in range(len(centre))])
        centre /= np.linalg.norm(centre, axis=1, keepdims=True) + 1e-6
    out = [np.zeros(toxic.size, dtype=bool) for _ in range(KINDS)]
    for k in range(len(chosen)):
        out[k][doc[hit & (near[at[row]] == k)]] = True
    return out


def train(texts: list[str | bytes], toxic: np.ndarray) -> Chain:
    """Fit the chain on labelled texts (held in memory)."""
    toxic = np.asarray(toxic, dtype=bool)
    if not toxic.any() or toxic.all():
        return Chain()
    raw = [t.encode() if isinstance(t, str) else t for t in texts]
    fold = np.array([xxhash.xxh64_intdigest(t) % FOLDS for t in raw])
    pick = lambda mask: [t for t, m in zip(raw, mask.tolist()) if m]
    # only features of 3 toxic texts can be selected, so others are never counted
    table = Table(_frequent(pick(toxic), 3))
    inside, outside = _counted(pick(toxic), fold[toxic], table), _counted(pick(~toxic), fold[~toxic], table)
    ones, zeros = np.bincount(fold[toxic], minlength=FOLDS), np.bincount(fold[~toxic], minlength=FOLDS)
    best = _selected(inside.sum(axis=1), outside.sum(axis=1), ones.sum(), zeros.sum())
    in_fold = [_selected((inside.sum(axis=1) - inside[:, k]), (outside.sum(axis=1) - outside[:, k]), ones.sum() - ones[k], zeros.sum() - zeros[k]) for k in range(FOLDS)]
    every = np.unique(np.concatenate([best, *in_fold]))
    small = Table(table.keys[every])
    pairs = [(doc + i, row) for i in range(0, len(raw), 200) for doc, row in [present(raw[i : i + 200], small)]]
    doc, row = (np.concatenate(c) for c in zip(*pairs))
    size = every.size
    place = lambda rows: np.searchsorted(every, rows)
    of = lambda rows: np.isin(row, place(rows))
    kept = of(best)
    targets = [*_kinds(doc, row, place(best[:MARKERS]), toxic), toxic]
    chain = Chain(Table(table.keys[np.sort(best)]))
    columns = place(np.sort(best))
    odds = np.zeros((len(raw), 0))
    for y in targets:
        dense = np.clip(odds, -8, 8)
        out = np.zeros(len(raw))
        for k in range(FOLDS):
            mine = of(in_fold[k])
            w = _logistic(doc[mine], row[mine], size, dense, y, fold != k)
            z = np.bincount(doc[mine], weights=w[row[mine]], minlength=len(raw)) + dense @ w[size:-1] + w[-1]
            out[fold == k] = z[fold == k]
        w = _logistic(doc[kept], row[kept], size, dense, y, np.ones(len(raw)))
        chain.weights.append(w[:size][columns])
        chain.earlier.append(w[size:-1])
        chain.bias.append(float(w[-1]))
        odds = np.concatenate((odds, out[:, None]), axis=1)
    order = np.argsort(-odds[:, -1], kind="stable")
    precise = np.cumsum(toxic[order]) / np.arange(1, len(raw) + 1) >= PRECISION
    if precise.any():
        at = int(np.flatnonzero(precise)[-1])
        chain.threshold = float(np.clip(_sigmoid(odds[order[at], -1]), 0.2, 0.8))
    return chain


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """key, y and text of a bounded number of labelled documents, one row a key."""
    some = labels.where(F.col(toxic).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), (F.col(toxic) > 0).alias("y"))
    some = some.groupBy("key").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in some.groupBy("y").agg(F.count("*").alias("n")).collect()}
    h = F.xxhash64("key", F.lit("toxicity sample"))
    share = F.when(F.col("y"), min(1.0, (1.5 * POSITIVE + 50) / max(1, sizes.get(True, 0)))).otherwise(min(1.0, (1.5 * NEGATIVE + 50) / max(1, sizes.get(False, 0))))
    few = some.withColumn("h", h).where((F.col("h") / 2.0**64 + 0.5) < share)
    rank = F.row_number().over(Window.partitionBy("y").orderBy("h", "key"))
    ids = few.withColumn("r", rank).where(F.col("r") <= F.when(F.col("y"), POSITIVE).otherwise(NEGATIVE)).select("key", "y", "h")
    # the sample has a fixed bound, so its keys may be broadcast
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull() & (F.length("text") <= LONGEST))
    one = own.join(F.broadcast(ids), "key").groupBy("key", "y", "h").agg(F.min("text").alias("text"))
    upto = F.sum(F.octet_length("text")).over(Window.partitionBy("y").orderBy("h", "key"))
    return one.withColumn("upto", upto).where(F.col("upto") <= BYTES).select("key", "y", "h", "text")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Chain:
    """Train on a bounded sample of the labelled rows, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        y: list[bool] = []
        for batch in batches:
            texts += arrays.as_bytes(batch.column("text"))
            y += batch.column("y").to_pylist()
        yield pa.RecordBatch.from_pydict({"chain": [pickle.dumps(train(texts, np.array(y, dtype=bool)))]})
        del texts
        arrays.trim()

    rows = sample(docs, labels, key, text, toxic).repartition(1).sortWithinPartitions("h", "key")
    made = rows.select("text", "y").mapInArrow(run, "chain binary").first()  # none where no task has rows
    return pickle.loads(made[0]) if made else Chain()


def score(df: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """Adds the probabilities p_kind_1 and so on, p_toxic, and toxic."""
    own = [*(f"p_{c}" for c in CATEGORIES), "toxic"]
    kept = df.drop(*[c for c in own if c != text])
    held = df.sparkSession.sparkContext.broadcast(chain)  # FEATURES rows at most
    schema = kept.select("*", *[F.lit(0.0).alias(c) for c in own[:-1]], F.lit(True).alias("toxic")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = held.value
        for whole in batches:
            for batch in arrays.slices(whole, text):
                p = c.predict(arrays.as_bytes(batch.column(text)))
                more = [*(pa.array(p[:, k]) for k in range(len(CATEGORIES))), pa.array(p[:, -1] >= c.threshold)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *own])

    return kept.mapInArrow(run, schema)
