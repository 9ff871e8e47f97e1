"""Benchmark decontamination by template windows.

A text becomes a line of tokens: white-space words without their outer ASCII
marks, lower-cased.  Its template has typed placeholders for numbers, for units
after a number (or grown to it) and for names (capitalised words inside a
sentence).  A capitalised word that opens a sentence may be a name or not, so
windows over one are taken twice, once with it plain and once as a name.  Windows of
``WINDOW`` tokens of the template, and of the plain tokens, are hash-joined with the
benchmark's; a shorter item of at least ``SHORTEST`` tokens is one window of its own
length.  A template window has at least ``PLAIN`` plain tokens, and counts only where
at least ``DENSE`` of all tokens that the windows of its alignment cover are plain.

Slot consistency, both ways: along one alignment of a document with an item, each
value in an item's slots must always stand against the same value in the document's,
and each of the document's against the same of the item's.  Where fewer than
``CONSISTENT`` of the item's values do, or fewer than ``DISTINCT`` of the document's
(two values may become one by chance), the alignment's template windows are left out.
Plain windows match word for word and always count.

An item is found in a document if its covered windows are ``SHARE`` of all, or
``RUN`` in number.

Documents are told apart by two 64-bit hashes of their text, so copies are
judged once and alike.  Only windows that pass a bit table of fixed size leave
the scan (the join that follows is exact); the benchmark is broadcast only
while it has at most ``BROADCAST`` windows, and is shuffled beyond that.

Cases: null and empty texts are clean; items that are null or have fewer than
``SHORTEST`` tokens find nothing; an empty benchmark leaves every document
clean.  Repeated rows get equal results; columns named like a result are
replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm import arrays, scratch

WINDOW, SHORTEST = 8, 5
SHARE, RUN, CONSISTENT, DISTINCT = 0.5, 6, 0.8, 0.6
PLAIN, DENSE = 2, 0.25
BROADCAST = 200_000
BITS = 24
U8 = np.uint64

# Units and number words.
UNITS = (
    "kg g mg lb oz km m cm mm mi miles mile meters metres feet foot inches inch liters litres ml l hours hour h minutes minute min "
    "seconds second s days day weeks week months month years year dollars dollar euros euro cents cent percent % mph kmh degrees "
    "watts volts amps joules newtons bytes kb mb gb tb"
).split()
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
_MARK = arrays.separators(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_DIGIT = arrays.separators(b"0123456789")
_LETTER = arrays.separators(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_STOP = arrays.separators(b".!?:\n")
NUMBER, UNIT, NAME, QUANTITY = (U8(k) for k in (11, 12, 13, 14))  # hashes of the placeholders


def _known(words: list[str]) -> np.ndarray:
    buffer, starts = arrays.joined([w.encode() for w in words])
    return np.sort(arrays.hashes(buffer, starts[:-1], np.diff(starts) - 1))


_UNITS, _NUMBERS = _known(UNITS), _known(NUMBER_WORDS)


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Plain hash and template hash of every token, the first token of each text (one more), and the template with opening names."""
    buffer, starts = arrays.joined(texts, lower=False)
    begin, length, _ = arrays.words(buffer, starts)
    end = begin + length
    last = buffer[end - 1] if begin.size else buffer[:0]
    low, high = begin.copy(), end.copy()
    todo = np.arange(begin.size)
    while todo.size:  # outer marks
        todo = todo[(low[todo] < high[todo])]
        todo = todo[_MARK[buffer[low[todo]]]]
        low[todo] += 1
    todo = np.flatnonzero(low < high)
    while todo.size:
        todo = todo[(low[todo] < high[todo])]
        todo = todo[_MARK[buffer[high[todo] - 1]]]
        high[todo] -= 1
    keep = np.flatnonzero(low < high)
    doc_first = np.zeros(begin.size + 1, dtype=bool)
    doc_first[np.searchsorted(begin, starts[:-1])] = True
    # a sentence begins with a text, after a stop, or on a new line
    line = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(buffer[: starts[-1]] == 10)))
    opens = doc_first[:-1].copy()
    if begin.size > 1:
        opens[1:] |= _STOP[last[:-1]] | (line[begin[1:]] > line[end[:-1]])
    b, n, opens = low[keep], (high - low)[keep], opens[keep]
    first = np.searchsorted(b, starts)
    lowered = np.frombuffer(buffer.tobytes().translate(arrays.LOWER), dtype=np.uint8)
    plain = arrays.hashes(lowered, b, n)
    count = lambda table: (lambda c: c[b + n] - c[b])(np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(table[buffer]))))
    digits, letters = count(_DIGIT), count(_LETTER)
    template = plain.copy()
    lead = buffer[b] if b.size else buffer[:0]
    second = buffer[b + 1] if b.size else buffer[:0]
    upper = ((lead >= 65) & (lead <= 90)) | ((lead == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    template[upper & ~opens] = NAME
    number = ((digits > 0) & (letters == 0)) | np.isin(plain, _NUMBERS)
    grown = np.flatnonzero((digits > 0) & (letters > 0) & _DIGIT[lead] if b.size else np.zeros(0, dtype=bool))
    if grown.size:
        tail = b[grown] + digits[grown]
        fits = np.isin(arrays.hashes(lowered, tail, n[grown] - digits[grown]), _UNITS) & (letters[grown] + digits[grown] == n[grown])
        template[grown[fits]] = QUANTITY
    template[number] = NUMBER
    after = np.zeros(b.size, dtype=bool)
    after[1:] = number[:-1]
    after[first[:-1][first[:-1] < b.size]] = False
    template[after & np.isin(plain, _UNITS) & ~number] = UNIT
    named = np.where(upper & opens & (template > QUANTITY), NAME, template)
    return plain, template, first, named


def windows(plain: np.ndarray, template: np.ndarray, first: np.ndarray, named: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and kind (0 plain, 1 template with a slot, 2 with an opening name) of each window inside a text."""
    n = plain.size - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U8), np.zeros(0, dtype=np.int8)
    at = np.arange(n)
    doc = np.repeat(np.arange(first.size - 1), np.diff(first))
    inside = doc[:n] == doc[size - 1 :]
    held = lambda mask: (lambda c: c[size:] - c[:-size])(np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(mask))))
    fits = lambda k: inside & (k > 0) & (size - k >= PLAIN)
    whole = at[inside]
    typed = np.flatnonzero(fits(held(template <= QUANTITY)))
    opened = np.flatnonzero(fits(held(named <= QUANTITY)) & (held(named != template) > 0))
    place = np.concatenate((whole, typed, opened))
    seed = U8(0x5DEECE66D)
    h = np.concatenate((arrays.windows(plain, size)[whole], arrays.windows(template, size)[typed] ^ seed, arrays.windows(named, size)[opened] ^ seed))
    return place, h, np.repeat(np.array([0, 1, 2], dtype=np.int8), [whole.size, typed.size, opened.size])


def _rows(texts: list[bytes | None], sizes: list[int], bits: np.ndarray | None, only_short: bool = False) -> dict[str, np.ndarray | list]:
    """Text number, place, window size, hash, slot values and slot places (as bits) of windows."""
    plain, template, first, named = tokens(texts)
    out: dict[str, list] = {k: [] for k in ("doc", "place", "size", "h", "slots", "gaps")}
    for size in sizes:
        place, h, kind = windows(plain, template, first, named, size)
        if bits is not None:
            idx = (h >> U8(64 - BITS)).astype(np.int64)
            hit = np.flatnonzero(bits[idx >> 3] >> (idx & 7).astype(np.uint8) & 1)
            place, h, kind = place[hit], h[hit], kind[hit]
        doc = np.searchsorted(first, place, side="right") - 1
        if only_short:  # items: the usual windows, or one of its own length
            n = np.diff(first)[doc]
            fits = np.flatnonzero((n == size) if size < WINDOW else (n >= WINDOW))
            place, h, kind, doc = place[fits], h[fits], kind[fits], doc[fits]
        out["doc"].append(doc)
        out["place"].append(place - first[doc])
        out["size"].append(np.full(place.size, size))
        out["h"].append(h.view(np.int64))
        held, gaps = [], []
        for p, k in zip(place.tolist(), kind.tolist()):
            at = [i for i in range(size) if (template if k == 1 else named)[p + i] <= QUANTITY] if k else []
            held.append([int(plain[p + i].view(np.int64)) for i in at])
            gaps.append(sum(1 << i for i in at))
        out["slots"] += held
        out["gaps"].append(np.array(gaps, dtype=np.int64))
    return {k: np.concatenate(v) if k != "slots" else v for k, v in out.items()}


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """h, item, place, size, slots, gaps and n_windows of every window of every item."""
    schema = f"h long, item {dict(benchmark.dtypes)[item]}, place long, size long, slots array<long>, gaps long, n_windows long"  # plain windows have no slots
    only = benchmark.where(F.col(text).isNotNull() & F.col(item).isNotNull()).select(F.col(item).alias("item"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole):
                raw = arrays.as_bytes(batch.column("text"))
                r = _rows(raw, list(range(SHORTEST, WINDOW + 1)), None, only_short=True)
                n = np.diff(tokens(raw)[2])
                many = np.where(n >= WINDOW, n - WINDOW + 1, 1)[r["doc"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["h"]), batch.column("item").take(pa.array(r["doc"])), pa.array(r["place"]), pa.array(r["size"]), pa.array(r["slots"], pa.list_(pa.int64())), pa.array(r["gaps"]), pa.array(many)],
                    names=["h", "item", "place", "size", "slots", "gaps", "n_windows"],
                )

    return only.mapInArrow(run, schema)


def _bit_table(bench: DataFrame) -> bytes:
    """A bit for each of 2**BITS hash ranges that holds a window; 2 MiB whatever the benchmark's size."""
    place = bench.select(F.shiftrightunsigned("h", 64 - BITS).alias("i"))
    words = place.groupBy(F.expr("cast(i div 64 as int)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(i % 64 as int)))").alias("b"))
    table = np.zeros(1 << (BITS - 6), dtype="<i8")
    got = words.toPandas()
    table[got["w"].to_numpy(dtype=np.int64)] = got["b"].to_numpy(dtype=np.int64)
    return table.tobytes()


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """k1, k2 (hashes of the text), item, covered, n_windows, share and found for each document and item that share a window."""
    spark = docs.sparkSession
    bench, _ = scratch.stored(benchmark_windows(benchmark), "windows")
    size = bench.agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes")).first()  # sizes: WINDOW - SHORTEST + 1 values at most
    sizes = sorted(int(s) for s in size["sizes"])
    held = spark.sparkContext.broadcast(_bit_table(bench) if size["n"] else b"")
    only = docs.where(F.col(text).isNotNull()).select(*keys(text), F.col(text).alias("text"))
    schema = "k1 long, k2 long, h long, at long, own array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, dtype=np.uint8)
        for whole in batches:
            for batch in arrays.slices(whole):
                if not sizes:
                    continue
                r = _rows(arrays.as_bytes(batch.column("text")), sizes, bits)
                doc = pa.array(r["doc"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k1").take(doc), batch.column("k2").take(doc), pa.array(r["h"]), pa.array(r["place"]), pa.array(r["slots"], pa.list_(pa.int64()))],
                    names=["k1", "k2", "h", "at", "own"],
                )

    # windows that pass the bit table are few; written once, they are read by all that follows
    hits, _ = scratch.stored(only.mapInArrow(run, schema), "hits")
    joined = hits.join(F.broadcast(bench) if size["n"] <= BROADCAST else bench, "h").withColumn("line", F.col("at") - F.col("place"))
    along = ["k1", "k2", "item", "line"]
    slot = F.explode_outer(F.arrays_zip("slots", "own")).alias("s")
    values = joined.select(*along, slot).where(F.col("s").isNotNull()).distinct()
    pairs = values.select(*along, F.col("s.slots").alias("theirs"), F.col("s.own").alias("ours"))
    steady = lambda of, name: pairs.groupBy(*along, of).agg(F.count("*").alias("n")).groupBy(*along).agg((F.count("*") / F.sum("n")).alias(name))
    bad = steady("theirs", "c").join(steady("ours", "own_c"), along)
    bits = joined.select(*along, "place", "size", "gaps").distinct()
    at = bits.select(*along, "place", "gaps", F.explode(F.expr("sequence(0L, size - 1)")).alias("j"))
    slot_of = at.groupBy(*along, (F.col("place") + F.col("j")).alias("token")).agg(F.min(F.expr("shiftright(gaps, cast(j as int)) & 1")).alias("slot"))
    thin = slot_of.groupBy(*along).agg(F.avg("slot").alias("s")).where(F.col("s") > 1 - DENSE)
    bad = bad.where((F.col("c") < CONSISTENT) | (F.col("own_c") < DISTINCT)).select(*along).union(thin.select(*along)).distinct().withColumn("c", F.lit(0.0))
    places = joined.groupBy(*along, "place", "n_windows").agg(F.max(F.size("slots") == 0).alias("plain"))
    covered = places.join(bad, along, "left").where(F.col("plain") | F.col("c").isNull())
    each = covered.groupBy("k1", "k2", "item").agg(F.countDistinct("place").alias("covered"), F.max("n_windows").alias("n_windows"))
    share = F.col("covered") / F.col("n_windows")
    return each.select("*", share.alias("share"), ((share >= SHARE) | (F.col("covered") >= RUN)).alias("found"))


def keys(text: str = "text") -> list:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), F.col(text)).alias("k2")]


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Adds contaminated, n_items, items (comma-joined, sorted) and coverage."""
    own = ["contaminated", "n_items", "items", "coverage"]
    kept = docs.drop(*[c for c in own if c != text])
    found = matches(docs, benchmark, text).where("found")
    by_text = found.groupBy("k1", "k2").agg(  # at most the benchmark's items
        F.count("*").alias("_n"), F.array_join(F.array_sort(F.collect_set("item")), ",").alias("_items"), F.max("share").alias("_share"),
    ).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "_n", "_items", "_share")
    k1, k2 = keys(text)
    out = kept.join(by_text, (k1 == F.col("_k1")) & (k2 == F.col("_k2")) & F.col(text).isNotNull(), "left")
    return out.select(
        *[kept[c] for c in kept.columns], F.col("_n").isNotNull().alias("contaminated"), F.coalesce("_n", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("_items", F.lit("")).alias("items"), F.coalesce("_share", F.lit(0.0)).alias("coverage"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no item is found, with their own columns."""
    found = matches(docs, benchmark, text).where("found").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    k1, k2 = keys(text)
    return docs.join(found, (k1 == F.col("_k1")) & (k2 == F.col("_k2")) & F.col(text).isNotNull(), "left_anti")
