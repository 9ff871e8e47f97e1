"""Near-duplicate components by a grouped prefix join on word shingles.

A document's set has the distinct hashes of its runs of ``SIZE`` words (with
fewer words, of the whole sequence).  Two documents link when their sets'
Jaccard similarity is ``SIMILAR`` percent or more; the result has the smallest
doc_id that links reach.

1. Order.  A first scan counts how often the shingles of each of 2**bits hash
   ranges occur: one array for each task, added up by range.  The counts, one byte
   each on a log scale (16 MiB at most), go to every worker.  Shingles are ordered
   by their range's count, then by hash.  Any total order gives exact results;
   this one puts what many texts share last.
2. Sets.  A second scan gives each document's size, its key and its prefix (a
   quarter of the set in that order).  Nothing else of a set leaves the scan.
3. Groups.  Documents with equal sets are one class, and only its smallest id goes
   on.  Class members with the same prefix and size are one group, and only the
   smallest id stands in the lists.  Prefix shingles that occur once end here.
4. Families.  A shingle's list is led by the member in whose order it stands
   first; lists with the same head, with all members of their groups, are a
   family.  Documents that link share a prefix shingle, so a family holds both.
5. Signatures have ``PER_SHINGLE`` to twice as many bits a shingle; each shingle
   flips one bit.  Two sets of sizes a and b that link differ in at most (a + b) / 7
   shingles, and signatures differ in no more bits than sets in shingles, so a pair
   with more different bits cannot link.
6. Rounds.  First every document is checked against the closest of its families'
   heads.  Then, in families with more than one component, the closest pair of each
   two components, and last, whatever the second round found, all pairs that are
   left between different ones and that signatures cannot rule out.  No link between
   components is lost, and pairs inside one are never listed.
7. Checks read whole texts and intersect the sets; a hub with many members is
   salted.  Families of over ``BLOCK`` members are cut into blocks of the head's
   component and blocks of the others; each pair of blocks is one unit of work.

A doc_id stands for one document.  Where rows share one, each row has its own
size, and the one with the smallest text links for all of them.  Rows with a
null doc_id link with nothing and have a null component.

Cases: null texts and texts without words have no shingles and link with
nothing.  An empty table gives an empty result.  Columns besides key and text are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm import arrays, scratch

SIZE, SIMILAR = 5, 75
RANGES, PARTS = (16, 24), 16
SALT, BLOCK, PER_SHINGLE = 2000, 1000, 4
#: Parts of a head's members that meet the head's counts apart from each other.
HEAD_SALTS = 16
PAIRS = 1 << 21
U8 = np.uint64


def _hashes(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, window hashes, and the first word of each text (one entry more)."""
    buffer, starts = arrays.joined(texts)
    begin, length, first = arrays.words(buffer, starts)
    h = arrays.hashes(buffer, begin, length)
    return h, arrays.windows(h, size), first


def _short(h: np.ndarray) -> np.ndarray:
    """The one shingle of a text of fewer words, never equal to another's hash but by chance."""
    return arrays.windows(h, h.size) ^ np.full(1, h.size, dtype=U8) * U8(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes | None], size: int = SIZE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, w, first = _hashes(texts, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            x = np.sort(w[a : b - size + 1])
            out.append(x[np.concatenate((np.ones(1, dtype=bool), x[1:] != x[:-1]))])
        else:
            out.append(_short(h[a:b]) if b > a else np.zeros(0, dtype=U8))
    return out


def prefix(n: int | np.ndarray) -> int | np.ndarray:
    """Places of the prefix of a set of n: n - ceil(0.75 n) + 1."""
    return n - (SIMILAR * n + 99) // 100 + 1


# --- order and sets --------------------------------------------------------------


def _bits(rows: int) -> int:
    """Hash ranges by the number of documents: some 64 for each, within fixed bounds."""
    return int(np.clip(np.ceil(np.log2(max(1, 64 * rows))), *RANGES))


def frequencies(docs: DataFrame, bits: int) -> bytes:
    """For each of 2**bits hash ranges one byte: eight times log2 of how often its shingles occur; zstandard."""
    each = (1 << bits) // PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for whole in batches:
            for batch in arrays.slices(whole):
                h, w, first = _hashes(arrays.as_bytes(batch.column("text")), SIZE)
                if not h.size:
                    continue
                total = np.zeros(1 << bits, dtype=np.int64) if total is None else total
                doc = np.repeat(np.arange(first.size - 1), np.diff(first))
                inside = w[doc[: w.size] == doc[SIZE - 1 :]] if w.size else w
                few = [_short(h[a:b]) for a, b in zip(first[:-1], first[1:]) if 0 < b - a < SIZE]
                np.add.at(total, (np.concatenate([inside, *few]) >> U8(64 - bits)).astype(np.int64), 1)
        if total is not None:
            z = zstandard.ZstdCompressor(level=1)
            yield pa.RecordBatch.from_pydict({"part": np.arange(PARTS), "n": [z.compress(total[k * each : (k + 1) * each].tobytes()) for k in range(PARTS)]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, sums = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for part, n in zip(batch.column("part").to_pylist(), batch.column("n").to_pylist()):
                more = np.frombuffer(z.decompress(n), dtype=np.int64)
                sums[part] = sums[part] + more if part in sums else more
        coded = [np.floor(8 * np.log2(x + 1.0)).clip(0, 255).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.int64()), "code": pa.array([zstandard.ZstdCompressor().compress(c) for c in coded], pa.binary())})

    sums = docs.select("text").mapInArrow(count, "part long, n binary").repartition(PARTS, "part").mapInArrow(add, "part long, code binary")
    table = np.zeros((PARTS, each), dtype=np.uint8)
    for r in sums.collect():  # PARTS rows, 2**bits bytes before compression
        table[r["part"]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["code"]), dtype=np.uint8)
    return zstandard.ZstdCompressor().compress(table.tobytes())


_KEYS = ("id", "n", "k1", "k2", "g1", "g2")


def sets(docs: DataFrame, codes: bytes, bits: int) -> DataFrame:
    """id, n, k1 and k2 (the set's key), g1 and g2 (the prefix's key), and the prefix in order."""
    held = docs.sparkSession.sparkContext.broadcast(codes)  # 16 MiB at most before compression

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = np.frombuffer(zstandard.ZstdDecompressor().decompress(held.value), dtype=np.uint8)
        for whole in batches:
            for batch in arrays.slices(whole):
                found = shingles(arrays.as_bytes(batch.column("text")))
                n = np.array([x.size for x in found], dtype=np.int64)
                flat = np.concatenate([*found, np.zeros(0, dtype=U8)])
                first = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(n)))
                # equal keys stay in the order of the hash, so the order is total
                key = code[(flat >> U8(64 - bits)).astype(np.int64)].astype(U8) << U8(56) | flat >> U8(8)
                cut = [x[np.argsort(key[a : a + x.size], kind="stable")[: prefix(x.size)]] if x.size else x for x, a in zip(found, first.tolist())]
                sums = lambda parts: [np.array([arrays.mix(x ^ s).sum(dtype=U8) for x in parts], dtype=U8).view(np.int64) for s in (U8(0), U8(0xC2B2AE3D27D4EB4F))]
                offsets = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum([c.size for c in cut]))).astype(np.int32)
                probe = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*cut, np.zeros(0, dtype=U8)]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, (n, *sums(found), *sums(cut))), probe], names=[*_KEYS, "probe"])

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in _KEYS) + ", probe array<long>")


# --- signatures --------------------------------------------------------------------


def signature(x: np.ndarray) -> np.ndarray:
    """Parities of the shingles that fall on each bit; the number of bits is a power of two."""
    bits = 1 << max(8, int(np.ceil(np.log2(PER_SHINGLE * max(1, x.size)))))
    flips = np.bincount((x & U8(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view("<u8")


def folded(s: np.ndarray, words: int) -> np.ndarray:
    """Signatures (rows) with fewer bits: of two shingle sets, parities on the lower bits."""
    while s.shape[1] > words:
        s = s[:, : s.shape[1] // 2] ^ s[:, s.shape[1] // 2 :]
    return s


def signatures(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole):
                found = shingles(arrays.as_bytes(batch.column("text")))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([x.size for x in found], pa.int64()), pa.array([signature(x).tobytes() for x in found], pa.binary())], names=["id", "n", "sig"])

    return texts.mapInArrow(run, "id long, n long, sig binary")


def _near(unit: np.ndarray, n: np.ndarray, comp: np.ndarray, sigs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows a < b of one unit and different components whose sets may link, and their different bits.

    Rows come sorted by unit.
    """
    last = np.searchsorted(unit, unit, side="right")
    many = last - np.arange(unit.size) - 1
    words = np.array([len(s) // 8 for s in sigs])
    matrix = {w: np.frombuffer(b"".join(s for s in sigs if len(s) == 8 * w), dtype="<u8").reshape(-1, w) for w in np.unique(words).tolist()}
    at = np.zeros(unit.size, dtype=np.int64)
    for w in matrix:
        at[words == w] = np.arange((words == w).sum())
    edge = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(many)))
    out: list[tuple[np.ndarray, ...]] = []
    lo = 0
    while lo < unit.size:  # about PAIRS pairs at once
        hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + PAIRS, side="right")) - 1)
        a = np.repeat(np.arange(lo, hi), many[lo:hi])
        b = np.arange(a.size) - (edge[a] - edge[lo]) + a + 1
        fits = (comp[a] != comp[b]) & (SIMILAR * n[a] <= 100 * n[b]) & (SIMILAR * n[b] <= 100 * n[a])
        a, b = a[fits], b[fits]
        for wa in matrix:
            for wb in matrix:
                pick = np.flatnonzero((words[a] == wa) & (words[b] == wb))
                w = min(wa, wb)
                fa, fb = folded(matrix[wa], w), folded(matrix[wb], w)
                for i in range(0, pick.size, max(1, (1 << 20) // w)):
                    k = pick[i : i + max(1, (1 << 20) // w)]
                    x = np.bitwise_count(fa[at[a[k]]] ^ fb[at[b[k]]]).sum(axis=1, dtype=np.int64)
                    # 100 overlap >= SIMILAR union bounds the difference by (100 - SIMILAR) / (100 + SIMILAR) of both sizes
                    close = (100 + SIMILAR) * x <= (100 - SIMILAR) * (n[a[k]] + n[b[k]])
                    out.append((a[k[close]], b[k[close]], x[close]))
        lo = hi
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 3


def heads_first(families: DataFrame) -> DataFrame:
    """hub, id: for each document the closest head of its families, if any may link."""
    alone = families.withColumn("component", (F.col("id") != F.col("head")).cast("long")).withColumn("main", F.lit(0))
    found = _dealt(alone, "head")
    return found.groupBy("id").agg(F.min_by("hub", F.struct("x", "hub")).alias("hub")).select("hub", "id")


def candidates(families: DataFrame, comp: DataFrame, closest: bool) -> DataFrame:
    """hub, id: pairs of different components of one family that may link.

    ``families`` (head, id, n, sig).  With ``closest`` only the closest pair of each
    two components of a unit.
    """
    of = families.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    lead = comp.select(F.col("node").alias("head"), F.col("component").alias("main"))
    of = of.join(lead, "head", "left").withColumn("main", F.coalesce("main", "head"))
    return _dealt(of, "closest" if closest else "all").select("hub", "id").distinct()


def _dealt(of: DataFrame, wanted: str) -> DataFrame:
    """hub, id, x (different bits) of pairs of different components in units of bounded size.

    ``of`` has head, id, n, sig, component, and the head's component as main.
    """
    own = F.col("component") == F.col("main")
    size = of.groupBy("head").agg(F.count_if(own).alias("cm"), F.count_if(~own).alias("co"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK)).cast("int")
    size = size.select("head", blocks("cm").alias("bm"), blocks("co").alias("bo"), F.explode(F.sequence(F.lit(0), F.lit(HEAD_SALTS - 1))).alias("salt"))
    salted = of.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(HEAD_SALTS)).cast("int"))
    dealt = salted.join(size, ["head", "salt"]).withColumn("own", own)
    k = F.pmod(F.xxhash64("id"), F.when(F.col("own"), F.col("bm")).otherwise(F.col("bo"))).cast("int")
    # a block of the head's component meets every block of the others (u < 0); those meet each other
    pair = lambda u, v: F.struct(u.cast("int").alias("u"), v.cast("int").alias("v"))
    others = F.sequence(F.lit(0), F.col("bo") - 1)
    meet = F.transform(others, lambda j: pair(-1 - F.col("k"), j))
    among = F.when((F.col("bo") > 1) & F.lit(wanted != "head"), F.transform(others, lambda j: pair(F.least(j, F.col("k")), F.greatest(j, F.col("k"))))).otherwise(F.array().cast("array<struct<u:int,v:int>>"))
    units = F.when(F.col("own"), meet).otherwise(F.concat(F.transform(F.sequence(F.lit(0), F.col("bm") - 1), lambda j: pair(-1 - j, F.col("k"))), among))
    dealt = dealt.withColumn("k", k).select("head", "id", "n", "component", "sig", F.explode(units).alias("p")).select("head", "p.u", "p.v", "id", "n", "component", "sig")
    dealt = dealt.repartition("head", "u", "v").sortWithinPartitions("head", "u", "v")

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        head, u, v, i, n, c = (rows.column(x).to_numpy() for x in ("head", "u", "v", "id", "n", "component"))
        new = np.concatenate((np.zeros(1, dtype=bool), (head[1:] != head[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])))
        unit = np.cumsum(new)
        a, b, x = _near(unit, n, c, rows.column("sig").to_pylist())
        if wanted == "head":  # the head is the one of component 0
            swap = c[a] > c[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            return pa.RecordBatch.from_arrays([pa.array(i[a]), pa.array(i[b]), pa.array(x)], names=["hub", "id", "x"])
        if wanted == "closest":
            order = np.lexsort((i[b], i[a], x, np.maximum(c[a], c[b]), np.minimum(c[a], c[b]), unit[a]))
            a, b = a[order], b[order]
            key = np.stack((unit[a], np.minimum(c[a], c[b]), np.maximum(c[a], c[b])))
            first = np.concatenate((np.ones(min(1, a.size), dtype=bool), (key[:, 1:] != key[:, :-1]).any(axis=0)))
            a, b, x = a[first], b[first], x[first]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(i[a], i[b])), pa.array(np.maximum(i[a], i[b])), pa.array(x)], names=["hub", "id", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole units at a time: the last one of a batch may go on in the next."""
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = [held.column(x).to_numpy() for x in ("head", "u", "v")]
            open_ = int(np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0))[-1]) + 1 if any((k != k[-1]).any() for k in keys) else 0
            if open_:
                yield pairs(held.slice(0, open_))
                held = held.slice(open_)
        if held is not None and held.num_rows:
            yield pairs(held)

    return dealt.mapInArrow(run, "hub long, id long, x long")


# --- checks and components -----------------------------------------------------------


def _check(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Adds ok (whether the pair links) to pairs (hub, id); the hub's text meets its members' in salted lists."""
    degree = pairs.groupBy("hub").agg(F.count("*").alias("d")).select("hub", F.ceil(F.col("d") / SALT).cast("int").alias("salts"))
    salted = pairs.join(degree, "hub").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    member = salted.join(texts, "id").select("hub", "salt", F.lit(1).alias("kind"), "id", "text")
    hubs = degree.join(texts.withColumnRenamed("id", "hub"), "hub")
    hubs = hubs.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), F.col("hub").alias("id"), "text")
    dealt = hubs.unionByName(member).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, dtype=U8)
        for whole in batches:
            for batch in arrays.slices(whole):
                out: list[tuple] = []
                found = shingles(arrays.as_bytes(batch.column("text")))
                for h, kind, i, x in zip(batch.column("hub").to_pylist(), batch.column("kind").to_pylist(), batch.column("id").to_pylist(), found):
                    if not kind:
                        hub, own = h, x
                        continue
                    assert h == hub  # its text came first
                    both = np.intersect1d(own, x, assume_unique=True).size
                    union = own.size + x.size - both
                    out.append((h, i, bool(both) and 100 * both >= SIMILAR * union))
                columns = list(zip(*out)) or [[], [], []]
                types = (pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["hub", "id", "ok"])

    return dealt.mapInArrow(run, "hub long, id long, ok boolean")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """node, component (the smallest node reached) of all nodes with a link.

    Alternating large-star and small-star rounds; each is written to the shared
    folder, and two counts that stay alike end it.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest(left, right).alias("v"), F.least(left, right).alias("u")).where("u < v").distinct()
    edges, path = scratch.stored(edges, "edges")
    last = None
    while True:
        # large star: larger neighbours to the smallest one
        both = edges.select("v", "u").union(edges.select(F.col("u"), F.col("v")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # small star: smaller neighbours, and the node itself, to the smallest one
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = small.select(F.col("u").alias("v"), F.col("m").alias("u")).union(small.select("v", F.col("m").alias("u"))).where("u < v").distinct()
        new, new_path = scratch.stored(small, "edges")
        sign = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        scratch.drop(spark, path)
        edges, path = new, new_path
        if last == tuple(sign):
            break
        last = tuple(sign)
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(edges.select(F.col("u"), F.col("u")).distinct())


def link(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: key, n_shingles, component_id.

    Eager: intermediate tables go to the shared folder, and are deleted when the
    last job that reads them has ended; sizes and components stay, as the result
    reads them.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    bits = _bits(own.count())
    codes = frequencies(own, bits)
    whole = None
    if not own.where("id is not null").groupBy("id").count().where("count > 1").isEmpty():
        whole = scratch.stored(sets(own, codes, bits).select("id", "n"), "sizes")[0]
        own = scratch.stored(own.where("id is not null").groupBy("id").agg(F.min("text").alias("text")), "texts")[0]
    held, held_path = scratch.stored(sets(own, codes, bits), "sets")
    # classes of equal sets; the smallest id stands for a class from here on
    sizes, _ = scratch.stored(held.select(*_KEYS), "sizes")
    small = sizes.where("n > 0 and id is not null")
    classes = small.groupBy("k1", "k2", "n").agg(F.min_by(F.struct("id", "g1", "g2"), "id").alias("r"))
    reps = classes.select("r.*", "n", "k1", "k2")
    same = small.select("id", "k1", "k2", "n").join(reps.select("k1", "k2", "n", F.col("id").alias("hub")), ["k1", "k2", "n"]).where("id != hub").select("hub", "id")
    # equal prefix and size: one group, whose smallest id stands for it in the lists
    hubs = reps.groupBy("g1", "g2", "n").agg(F.min("id").alias("hub"))
    members, members_path = scratch.stored(reps.join(hubs, ["g1", "g2", "n"]).select("hub", "id"), "members")
    stand = members.where("hub = id").select("id")
    # sides that grow with the corpus are joined alike at every size
    lists, lists_path = scratch.stored(held.select("id", "probe").join(stand.hint("merge"), "id", "left_semi"), "probes")
    scratch.drop(spark, held_path)
    places = lists.select(F.col("id").alias("hub"), F.posexplode("probe").alias("place", "h"))
    again, again_path = scratch.stored(lists.select(F.explode("probe").alias("h")).groupBy("h").count().where("count > 1").select("h"), "repeated")
    shared, shared_path = scratch.stored(places.join(again.hint("merge"), "h"), "lists")
    scratch.drop(spark, lists_path, again_path)
    heads = shared.groupBy("h").agg(F.min(F.struct("place", "hub"))["hub"].alias("head"))
    family = shared.join(heads.hint("merge"), "h").select("head", "hub").distinct()
    # families with all members of their groups, and groups that are in no list
    grown = members.where("hub != id").select("hub").distinct()
    every = family.join(members, "hub").select("head", "id").union(members.join(grown, "hub", "left_semi").select(F.col("hub").alias("head"), "id")).distinct()
    every, every_path = scratch.stored(every, "families")
    scratch.drop(spark, shared_path, members_path)
    texts, texts_path = scratch.stored(own.join(every.select("id").distinct().hint("merge"), "id", "left_semi"), "texts")
    full, full_path = scratch.stored(every.join(signatures(texts), "id"), "signed")
    scratch.drop(spark, every_path)

    done, comp, comp_path, used = None, None, None, [texts_path, full_path]
    for round_ in (heads_first, lambda f: candidates(f, comp, True), lambda f: candidates(f, comp, False)):
        found = round_(full)
        found, found_path = scratch.stored(found.join(done, ["hub", "id"], "left_anti") if done else found, "pairs")
        used.append(found_path)
        if comp is not None and found.isEmpty():
            continue  # the closest pairs by signature need not be the closest in truth: the last round looks at all
        links, links_path = scratch.stored(_check(found, texts).where("ok").select("hub", "id"), "links")
        known = comp.select(F.col("component").alias("hub"), F.col("node").alias("id")) if comp else same
        new, new_path = scratch.stored(components(known.union(links), "hub", "id"), "components")
        scratch.drop(spark, links_path, *([comp_path] if comp_path else []))
        comp, comp_path = new, new_path
        pair = found.select(F.least("hub", "id").alias("hub"), F.greatest("hub", "id").alias("id"))
        done = done.union(pair) if done else pair
    scratch.drop(spark, *used)
    slim = whole if whole is not None else sizes.select("id", "n")
    out = slim.join(comp.withColumnRenamed("node", "id"), "id", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that link, directly or not, with a smaller id."""
    found = link(docs, key, text)
    gone = found.where(F.col("component_id") != F.col(key)).select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, F.col(key) == F.col("_gone"), "left_anti")


def oracle() -> str:
    """DuckDB SQL for the registered query: every pair that shares a shingle."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({low}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= {SIZE}
            THEN list_transform(range(1, len(w) - {SIZE - 2}), lambda i: array_to_string(w[i : i + {SIZE - 1}], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id != b.doc_id GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= {SIMILAR} * (nx.n + ny.n - c)),
    r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
    SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.x = d.doc_id GROUP BY d.doc_id"""
