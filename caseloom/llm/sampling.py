"""Document fingerprints by consistent weighted sampling.

A document is a weighted set: its runs of ``SIZE`` words (with fewer words, the whole
sequence), each weighing as often as it occurs.  For each of ``SAMPLES`` samples every
term draws r and c from Gamma(2, 1) and b from [0, 1), all from a hash of the term and
the sample's number (Ioffe 2010).  With weight w it takes t = floor(ln w / r + b) and
ln a = ln c - r (t + 1 - b); the term with the least a is the sample, and (term, t) is
what the fingerprint keeps of it.  Two documents have the same sample with a
probability equal to their generalised Jaccard similarity, the sum of the least
weights over the sum of the greatest, so the share of equal samples estimates it; its
standard error is at most 0.5 / sqrt(SAMPLES).

Draws.  Gamma(2, 1) is the sum of two exponentials, and such a sum is independent of
the first one's share in it, which is uniform.  So three exponentials A, E and F of a
hash give all: c = A + E, then X = ln(c / A) is exponential and independent of c,
r = X + F and b = 1 - X / r.  With weight 1, t is 0 and a = c exp(-X) = A: most terms
need the one number A, which rises with the hash itself, so their least a is the least
hash; only terms that occur again are worked out in full.  Terms that several
documents of a batch hold with the same weight are drawn once.  16 bits of each sample
are kept, in hexadecimal; two different samples look alike once in 65,536.

The edited text of a document ends with the beginning of the next document in order
of doc_id.  ``with_next`` brings both to one task with one shuffle of the texts: a
first pass over keys and hashes alone finds where a range sort cuts them, and the
first document of each part goes to the part before it as well.

Cases: a null text is an empty one.  Texts without words have no terms and an empty
fingerprint, which is like another empty one (1) and unlike all others (0).  Equal
doc_ids go by a hash of their texts; a null doc_id comes first.  A single row is its
own next one.  An empty table gives an empty result.  Other columns are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm import arrays, jaccard

SIZE, SAMPLES = 5, 128
U8 = np.uint64
#: Terms of one pass over the samples: their draws stay in the processor's cache.
CHUNK = 1 << 13
LOWEST = np.iinfo(np.int64).min


_SEEDS = arrays.mix(np.arange(1, SAMPLES + 1, dtype=U8) * U8(0x9E3779B97F4A7C15)) | U8(1)
_KEPT = U8(0xFFFF)
_OFFSET = 128.0  # makes all ln a positive, so that they sort like their bits


def _exponential(bits: np.ndarray, n: int) -> np.ndarray:
    """Exponentials of n-bit numbers: rising, never 0."""
    return -np.log1p(-(bits.astype(np.float64) + 0.5) / 2.0**n)


def scheme(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """c, r and b of hashes of a term and a sample."""
    more = arrays.mix(h ^ U8(0xD1B54A32D192ED03))
    a = _exponential(h >> U8(16), 48)
    c = a + _exponential(more >> U8(32), 32)
    x = np.log(c / a)
    r = x + _exponential(more & U8(0xFFFFFFFF), 32)
    return c, r, 1 - x / r


def _sortable(log_a: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """ln a as bits that sort like it, the last 16 of them what is kept of the sample."""
    return (log_a + _OFFSET).view(U8) & ~_KEPT | kept


class Draws:
    """The draws of terms, one sample after the other, in arrays that are made once."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray | None = None) -> None:
        self.terms, self.weights = terms, weights
        self.kept = arrays.mix(terms + U8(1)) & _KEPT
        self.hash, self.shifted = np.empty(terms.size, dtype=U8), np.empty(terms.size, dtype=U8)

    def hashes(self, k: int, out: np.ndarray) -> np.ndarray:
        """For sample ``k`` one hash for each term."""
        np.multiply(self.terms, _SEEDS[k], out=out)  # terms are well mixed; the factors are odd
        for shift, factor in ((32, 0x94D049BB133111EB), (29, None)):
            np.right_shift(out, U8(shift), out=self.shifted)
            np.bitwise_xor(out, self.shifted, out=out)
            if factor:
                np.multiply(out, U8(factor), out=out)
        return out

    def ones(self, k: int, out: np.ndarray) -> np.ndarray:
        """Terms of weight 1: 48 bits that rise with a, then what is kept of the term."""
        self.hashes(k, out)
        np.bitwise_and(out, ~_KEPT, out=out)
        return np.bitwise_or(out, self.kept, out=out)

    def all(self, k: int) -> np.ndarray:
        """Terms with their weights: ln a, then what is kept of (term, t)."""
        c, r, b = scheme(self.hashes(k, self.hash))
        t = np.floor(np.log(self.weights) / r + b)
        kept = self.kept ^ (arrays.mix(t.astype(U8)) & _KEPT) * (t > 0)
        return _sortable(np.log(c) - r * (t + 1 - b), kept)


def _least(terms: np.ndarray, weights: np.ndarray | None, starts: np.ndarray) -> np.ndarray:
    """The least key of each run of terms for each sample (SAMPLES, runs); equal terms are drawn once."""
    # numbered as they come, so that texts read them in a row
    pair = terms if weights is None else arrays.mix(terms + weights.astype(U8) * U8(0xD6E8FEB86659FD93))
    _, one, back = np.unique(pair, return_index=True, return_inverse=True)
    order = np.argsort(one)
    number = np.empty_like(order)
    number[order] = np.arange(order.size)
    back, one = number[back], one[order]
    cuts = range(0, one.size, CHUNK)
    parts = [Draws(terms[one[a : a + CHUNK]], None if weights is None else weights[one[a : a + CHUNK]]) for a in cuts]
    best = np.empty((SAMPLES, starts.size), dtype=U8)
    key, read = np.empty(one.size, dtype=U8), np.empty(back.size, dtype=U8)
    for k in range(SAMPLES):
        for a, part in zip(cuts, parts):
            if weights is None:
                part.ones(k, key[a : a + CHUNK])
            else:
                key[a : a + CHUNK] = part.all(k)
        best[k] = np.minimum.reduceat(key.take(back, mode="wrap", out=read), starts)  # "wrap" spares a check
    return best


def weighted(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and weights of all texts, and where each text's terms start (one entry more)."""
    h, w, first = jaccard._hashes(texts, SIZE)
    doc, term = [], []
    count = np.diff(first)
    owner = np.repeat(np.arange(count.size), count)
    if w.size:
        inside = owner[: w.size] == owner[SIZE - 1 :]
        doc.append(owner[: w.size][inside])
        term.append(w[inside])
    short = np.flatnonzero((count > 0) & (count < SIZE))
    if short.size:
        doc.append(short)
        term.append(np.concatenate([jaccard._short(h[first[i] : first[i + 1]]) for i in short.tolist()]))
    doc = np.concatenate([*doc, np.zeros(0, dtype=np.int64)])
    term = np.concatenate([*term, np.zeros(0, dtype=U8)])
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    new = np.ones(doc.size, dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return term[at], np.diff(np.append(at, doc.size)), np.searchsorted(doc[at], np.arange(count.size + 1))


def fingerprints(texts: list[bytes | None]) -> np.ndarray:
    """The kept 16 bits of each sample (texts, SAMPLES); those of texts without words mean nothing."""
    term, weight, first = weighted(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    best = np.full((SAMPLES, len(texts)), np.iinfo(np.uint64).max, dtype=U8)
    for one in (True, False):
        mine = np.flatnonzero((weight == 1) == one)
        if not mine.size:
            continue
        starts = np.flatnonzero(np.diff(doc[mine], prepend=-1))
        least = _least(term[mine], None if one else weight[mine], starts)
        if one:
            least = _sortable(np.log(_exponential(least >> U8(16), 48)), least & _KEPT)
        whose = doc[mine[starts]]
        best[:, whose] = np.minimum(best[:, whose], least)
    return (best & _KEPT).astype(np.uint16).T


def text_of(row: np.ndarray, has_terms: bool) -> str:
    return row.astype(">u2").tobytes().hex() if has_terms else ""


def likeness(a: str, b: str) -> float:
    """Share of equal samples of two fingerprints."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(bytes.fromhex(f), dtype=">u2") for f in (a, b))
    return float((x == y).mean())


# --- next documents ------------------------------------------------------------------


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text, tail, in parts of a range sort; a part ends with the next part's first document (``tail``).

    The first part's first document ends the last part.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    keyed = own.withColumns({"_d": F.coalesce("id", F.lit(LOWEST)), "_h": F.xxhash64("text")})
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a stated number, as these rows are much smaller than those they stand for
    cuts = keyed.select("_d", "_h").repartitionByRange(parts, "_d", "_h").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("_d", "_h")).alias("low"))
    low = sorted((tuple(r["low"]) for r in cuts.collect()))  # one row for each partition
    if not low:
        low = [(LOWEST, LOWEST)]
    ids, hashes = (np.array(x, dtype=np.int64) for x in zip(*low))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def places(d, h):  # the parts of a document: its own, and for a part's first one the part before
        import pandas as pd

        d, h = d.to_numpy(), h.to_numpy()
        part = np.searchsorted(ids, d, side="right") - 1
        # several cuts in one id: by the hash
        same = np.searchsorted(ids, d, side="left")
        for i in np.flatnonzero((part >= 0) & (same <= part)).tolist():
            part[i] = same[i] + np.searchsorted(hashes[same[i] : part[i] + 1], h[i], side="right") - 1
        part = np.maximum(part, 0)
        first = (ids[part] == d) & (hashes[part] == h)
        return pd.Series([[p, (p - 1) % len(low)] if f else [p] for p, f in zip(part.tolist(), first.tolist())])

    placed = keyed.select("id", "text", "_d", "_h", F.posexplode(places("_d", "_h")).alias("tail", "part"))
    return placed.repartitionById(len(low), F.col("part")).sortWithinPartitions("part", "tail", "_d", "_h").select("id", "text", "part", "tail")


RESULT = "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """``text`` with its last half, rounded down, replaced by as much of the next one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare(placed: DataFrame) -> DataFrame:
    """``RESULT`` for each document of ``with_next``, against its edited text and the next document."""

    def judged(ids: list, texts: list[str], parts: list[int], tails: list[int]) -> pa.RecordBatch:
        """All but the last row, which is only the next one of the row before."""
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        both = [x.encode("utf-8", "surrogatepass") for x in texts + changed]
        prints = fingerprints(both)
        words = [bool(x.strip(b" \t\n\x0b\x0c\r")) for x in both]
        shown = [text_of(r, w) for r, w in zip(prints, words)]
        n = len(texts)
        keep = [i for i in range(n - 1) if not tails[i]]
        columns = {
            "id": pa.array([ids[i] for i in keep], pa.int64()), "n_chars": pa.array([len(texts[i]) for i in keep], pa.int64()), "edited": pa.array([changed[i] for i in keep], pa.string()),
            "fingerprint": [shown[i] for i in keep], "edited_fingerprint": [shown[n + i] for i in keep],
            "near_edited": pa.array([likeness(shown[i], shown[n + i]) for i in keep], pa.float64()), "near_next": pa.array([likeness(shown[i], shown[i + 1]) for i in keep], pa.float64()),
        }
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.string()) for x in columns.values()], names=list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row so far: its next one is still to come
        for whole in batches:
            for batch in arrays.slices(whole):
                rows = list(zip(*(batch.column(c).to_pylist() for c in ("id", "text", "part", "tail"))))
                start = 0
                for i in range(1, len(rows) + 1):  # parts never mix
                    if i == len(rows) or rows[i][2] != rows[i - 1][2]:
                        run_ = ([held] if held is not None and held[2] == rows[start][2] else []) + rows[start:i]
                        if len(run_) > 1:
                            yield judged(*map(list, zip(*run_)))
                        held, start = run_[-1], i

    return placed.mapInArrow(run, RESULT)


def fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of a text; all other columns stay."""
    kept = [c for c in docs.columns if c != name]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, text):
                found = arrays.as_bytes(batch.column(text))
                made = [text_of(r, bool(x and x.strip(b" \t\n\x0b\x0c\r"))) for r, x in zip(fingerprints(found), found)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, name])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def edit_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ``RESULT`` of every document."""
    return compare(with_next(docs, key, text)).withColumnRenamed("id", key)


def generalised_jaccard(a: str, b: str) -> float:
    """The similarity that likeness estimates, exactly; 1 for two texts without words."""
    x, y = (Counter(dict(zip(t.tolist(), w.tolist()))) for t, w, _ in (weighted([s.encode()]) for s in (a, b)))
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 1.0

