"""Language identification by interpolated Kneser-Ney character models.

Method: one model of characters per language, orders 1 to ``ORDER``, with
absolute discounts and continuation counts below the top order.  All languages
share one sorted array of n-gram hashes per order; a row of it holds each
language's discounted probability and back-off weight.  A text is scored by
every language at once, and the language with the lowest cross-entropy per
character wins.  A text is rejected if it has no letter, or if even the best
cross-entropy lies above what labelled texts of that language and about that
length have (calibration below).

Characters: simple lower case; each run of other characters than letters is one
boundary, and a boundary stands before and after the text.

Training takes a bounded sample (a documented bound): at most ``DOCS`` documents
for each language, whole texts of at most ``LONGEST`` characters, drawn by a
hash of their key, of which every fifth is kept back to calibrate.  Every language is
learned.  All samples together have ``BYTES`` bytes, in equal shares but at least one
text each; as the n-gram table has a column for each language, they have in proportion
less with more than ``COLUMNS`` languages, so that the table stays as large.

Calibration: the kept-back texts give each language a mean and a deviation of
the cross-entropy of the right model; the limit for a text of n characters is
mean + 4 deviations + ``SLACK`` + ``SHORT`` / sqrt(n) nats.  The temperature of
the confidence is the one of a fixed grid with the lowest log loss there.

Cases: null, empty and letterless texts are ``und`` with score 0, rejected.
Without any learned language every text is ``und``.  Ties go to the language
that is first by name.  Repeated rows get equal results; columns named like a
result are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm import arrays

ORDER = 5
DOCS = 400
LONGEST = 200_000
#: Bytes of all texts that are learned from, and the number of languages up to which they are.
BYTES, COLUMNS = 64 << 20, 64
#: Rows of the table of languages up to which it is broadcast; else texts would be dealt by language before they are sampled.
BROADCAST = 100_000
SLACK = 0.75
SHORT = 5.0
U8 = np.uint64


@lru_cache(maxsize=1)
def _folding() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its simple lower case, 0 if it is no letter."""
    fold = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            fold[i] = ord(low) if len(low) == 1 else i
    return fold, fold > 0


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts, where each text begins and ends, and its letters.

    0 is the boundary.  ``ORDER - 1`` of them stand before each text, so that no
    context reaches into the text before; a text ends with one of its own.
    """
    fold, _ = _folding()
    gap = ORDER - 1
    joined = ("\0" * gap).join(["", *(x or "" for x in texts), ""])
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sizes = np.fromiter((len(x) if x else 0 for x in texts), dtype=np.int64, count=len(texts))
    first = gap + np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(sizes + gap)))[: len(texts)]
    code = fold[raw]
    letter = code > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a letter
    forced = np.zeros(raw.size + 1, dtype=np.int32)
    np.add.at(forced, np.concatenate((first - gap, first[-1:] + sizes[-1:])), 1)
    np.add.at(forced, np.concatenate((first, first[-1:] + sizes[-1:] + gap)), -1)
    keep |= np.cumsum(forced[:-1]) > 0
    place = np.cumsum(keep) - keep
    many = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(letter)))
    begin, end = place[first], place[first + sizes] + 1
    return code[keep], begin, end, many[first + sizes] - many[first]


_MULT = arrays.mix(np.arange(1, 33, dtype=U8) * U8(0xA24BAED4963EE407)) | U8(1)


def grams(code: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each place from n - 1 on."""
    c = code.astype(U8) + U8(1)
    total = c[n - 1 :] * _MULT[0]
    for j in range(1, n):
        total = total + c[n - 1 - j : c.size - j] * _MULT[j]
    return arrays.mix(total + U8(n))


def _grams_at(code: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``grams`` at some places only."""
    total = np.zeros(at.size, dtype=U8)
    for j in range(n):
        total += (code[at - j].astype(U8) + U8(1)) * _MULT[j]
    return arrays.mix(total + U8(n))


class Table:
    """A sorted array of hashes with a small index on the first bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(4, min(22, int(np.ceil(np.log2(max(2, keys.size)))) + 3))
        self.first = np.searchsorted(keys, np.arange((1 << self.bits) + 1, dtype=np.uint64) << U8(64 - self.bits)).astype(np.int32)
        self.first[-1] = keys.size  # the shift wrapped around
        self.deep = int(np.diff(self.first).max()) if keys.size else 0
        self.padded = np.concatenate((keys, np.zeros(1, dtype=U8)))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, or -1."""
        at = self.first.take((h >> U8(64 - self.bits)).astype(np.int64))
        if not self.keys.size:
            return np.full(h.size, -1, dtype=np.int32)
        found = self.padded.take(at)
        row = np.where(found == h, at, np.int32(-1))
        left = np.flatnonzero(found < h)
        for _ in range(1, self.deep):
            if not left.size:
                break
            near = np.minimum(at[left] + 1, self.keys.size)
            at[left] = near
            got, want = self.padded[near], h[left]
            row[left[got == want]] = near[got == want]
            left = left[got < want]
        return row


@dataclass
class Model:
    languages: list[str]
    tables: list[Table]  # by order, from 1
    prob: list[np.ndarray]  # interpolated log probability of each n-gram
    back: list[np.ndarray]  # log back-off weight of each n-gram as a context
    floor: np.ndarray  # log probability of a character never seen
    limit: np.ndarray  # mean + 4 deviations + slack, by language
    temperature: float = 1.0

    def log_prob(self, code: np.ndarray) -> np.ndarray:
        """Natural log probability of each character (rows) by language, given those before it."""
        size, step = code.size, 1 << 16
        out = np.empty((size, len(self.languages)), dtype=np.float32)
        for start in range(0, size, step):  # blocks that stay in the cache
            lo = max(0, start - ORDER + 1)
            out[start : start + step] = self._block(code[lo : start + step])[start - lo :]
        return out

    def _block(self, code: np.ndarray) -> np.ndarray:
        size, top = code.size, ORDER - 1
        out = np.zeros((size, len(self.languages)), dtype=np.float32)
        left = np.arange(min(top, size))  # no whole context in this block
        if size > top:
            row = self.tables[top].find(grams(code, ORDER))
            np.take(self.prob[top], row, axis=0, out=out[top:], mode="wrap")
            miss = np.flatnonzero(row < 0) + top
            out[miss] = 0
            left = np.concatenate((left, self._back_off(out, code, miss, ORDER)))
        for n in range(top, 0, -1):
            able = left >= n - 1
            short, at = left[~able], left[able]
            row = self.tables[n - 1].find(_grams_at(code, at, n))
            hit = row >= 0
            out[at[hit]] += self.prob[n - 1][row[hit]]
            miss = at[~hit]
            if n == 1:
                out[miss] += self.floor
            else:
                left = np.concatenate((short, self._back_off(out, code, miss, n)))
        return out

    def _back_off(self, out: np.ndarray, code: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Add the weight of the n - 1 characters before each place, where known."""
        row = self.tables[n - 2].find(_grams_at(code, at - 1, n - 1))
        seen = row >= 0
        out[at[seen]] += self.back[n - 2][row[seen]]
        return at

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per character by text and language, characters, letters."""
        if not texts:
            return np.zeros((0, len(self.languages))), np.zeros(0, np.int64), np.zeros(0, np.int64)
        code, begin, end, letters = characters(texts)
        logs = self.log_prob(code)
        edges = np.stack((begin, np.minimum(end, code.size - 1)), axis=1).reshape(-1)
        total = np.add.reduceat(logs, edges, axis=0, dtype=np.float64)[::2]
        n = end - begin
        return -total / n[:, None], n, letters

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, confidence and whether it is accepted, for each text."""
        if not self.languages:
            return [("und", 0.0, False)] * len(texts)
        ce, n, letters = self.score(texts)
        best = np.argmin(ce, axis=1)
        lowest = ce[np.arange(len(texts)), best]
        sure = 1 / np.exp((lowest[:, None] - ce) * np.minimum(n, 200)[:, None] / self.temperature).sum(axis=1)
        fine = lowest <= self.limit[best] + SHORT / np.sqrt(n)
        return [
            (self.languages[b], float(min(1.0, s)), bool(f)) if m else ("und", 0.0, False)
            for b, s, f, m in zip(best.tolist(), sure.tolist(), fine.tolist(), letters.tolist())
        ]


@dataclass
class _Counts:
    """The n-grams of one language, of one order."""

    keys: np.ndarray
    counts: np.ndarray
    suffix: np.ndarray  # hash of all but the first character
    context: np.ndarray  # hash of all but the last character


def _count(code: np.ndarray) -> list[_Counts]:
    out: list[_Counts] = []
    shorter = np.zeros(code.size + 1, dtype=U8)
    for n in range(1, ORDER + 1):
        h = grams(code, n)
        keys, at, counts = np.unique(h, return_index=True, return_counts=True)
        out.append(_Counts(keys, counts, shorter[at + 1] if n > 1 else keys, shorter[at] if n > 1 else keys))
        shorter = h
    for n in range(ORDER - 1):  # below the top order: the number of different characters before
        longer = out[n + 1]
        out[n].counts = np.maximum(1, np.bincount(np.searchsorted(out[n].keys, longer.suffix), minlength=out[n].keys.size))
    return out


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once else 0.5


def train(texts: list[str], langs: list[str]) -> Model:
    """Fit the models and their calibration on labelled texts (held in memory)."""
    names = sorted(set(langs))
    fit: dict[str, list[str]] = {x: [] for x in names}
    kept: list[tuple[str, int]] = []
    seen = dict.fromkeys(names, 0)
    for text, lang in zip(texts, langs):
        seen[lang] += 1
        if seen[lang] % 5:
            fit[lang].append(text)
        else:
            kept.append((text, names.index(lang)))
    counted = [_count(characters(fit[x])[0]) for x in names]
    alphabet = max(2, len(np.unique(np.concatenate([c[0].keys for c in counted]))) + 1) if names else 2
    tables: list[Table] = []
    prob: list[np.ndarray] = []
    back: list[np.ndarray] = []
    floor = np.zeros(len(names), dtype=np.float32)
    for n in range(ORDER if names else 0):
        every = np.concatenate([c[n].keys for c in counted])
        keys, at = np.unique(every, return_index=True)
        table = Table(keys)
        p = np.zeros((keys.size, len(names)))
        if n:
            lower = tables[n - 1].find(np.concatenate([c[n].suffix for c in counted])[at])
            above = tables[n - 1].find(np.concatenate([c[n].context for c in counted])[at])
            weight = np.ones((tables[n - 1].keys.size, len(names)))
        for j, c in enumerate(counted):
            own, d = c[n], _discount(c[n].counts)
            rows = table.find(own.keys)
            if not n:
                total = own.counts.sum()
                left = d * own.keys.size / total
                p[rows, j] = np.maximum(own.counts - d, 0) / total
                p[:, j] += left / alphabet
                floor[j] = np.log(max(left, 1e-9) / alphabet)
            else:
                ctx = tables[n - 1].find(own.context)
                size = tables[n - 1].keys.size
                total = np.bincount(ctx, weights=own.counts, minlength=size)
                kinds = np.bincount(ctx, minlength=size)
                seen = total > 0
                weight[seen, j] = d * kinds[seen] / total[seen]
                p[rows, j] = np.maximum(own.counts - d, 0) / total[ctx]
        if n:
            p += weight[above] * prob[n - 1][lower]
            back.append(np.log(np.maximum(weight, 1e-9)).astype(np.float32))
        tables.append(table)
        prob.append(p)
    model = Model(names, tables, [np.log(np.maximum(x, 1e-30)).astype(np.float32) for x in prob], back, floor, np.full(len(names), np.inf))
    if kept:
        _calibrate(model, kept)
    return model


def _calibrate(m: Model, kept: list[tuple[str, int]]) -> None:
    ce, n, letters = m.score([t for t, _ in kept])
    right = np.array([j for _, j in kept])
    own = ce[np.arange(len(kept)), right]
    best = None
    for t in (1, 2, 4, 8, 16, 32, 64, 128):
        z = -ce * np.minimum(n, 200)[:, None] / t
        z -= z.max(axis=1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(kept)), right]))
        if best is None or loss < best[0]:
            best = (loss, float(t))
    m.temperature = best[1]
    for j in range(len(m.languages)):
        x = own[(right == j) & (letters > 0)]
        if x.size >= 5:
            m.limit[j] = x.mean() + 4 * x.std() + SLACK


def sample(df: DataFrame, key: str, text: str, lang: str, docs: int = DOCS, longest: int = LONGEST, most: int = BYTES) -> DataFrame:
    """A bounded sample of every language: at most ``docs`` texts each, and an equal share of ``most`` bytes, but one text at least."""
    some = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= longest))
    sizes = some.groupBy(F.col(lang).alias("lang")).count()
    n = max(1, sizes.count())
    share_bytes = most * min(n, COLUMNS) // n // n if n > COLUMNS else most // n
    h = F.xxhash64(F.col(key).cast("string"), F.lit("language sample"))
    few = some.select(F.col(text).alias("text"), F.col(lang).alias("lang"), h.alias("h")).join(F.broadcast(sizes) if n <= BROADCAST else sizes, "lang")
    # about twice the sample by hash, then exactly the first by hash: the window sees a bounded number of rows
    share = F.least(F.lit(1.0), (2.0 * docs + 50) / F.col("count"))
    few = few.where((F.col("h") / 2.0**64 + 0.5) < share)
    order = Window.partitionBy("lang").orderBy("h", "text")
    so_far = F.sum(F.octet_length("text").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    few = few.withColumns({"r": F.row_number().over(order), "b": so_far})
    return few.where((F.col("r") == 1) | (F.col("r") <= docs) & (F.col("b") <= share_bytes)).select("text", "lang", "r")


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", docs: int = DOCS) -> Model:
    """Train on a bounded sample of the rows of ``df``."""
    rows = sample(df, key, text, lang, docs).toPandas().sort_values(["lang", "r"])
    return train(rows["text"].tolist(), rows["lang"].tolist())


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (0 to 1) and accepted."""
    own = ["lang_pred", "score", "accepted"]
    kept = df.drop(*[c for c in own if c != text])
    held = df.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    schema = kept.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("accepted")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for whole in batches:
            for batch in arrays.slices(whole, text):
                got = m.predict(batch.column(text).to_pylist())
                more = [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *own])

    return kept.mapInArrow(run, schema)


def held_out(key: Column, folds: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; null keys count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == remainder
