"""Merkle manifest of a data set: a tree for each group, one over the groups' roots.

A leaf is the SHA-256 of a row's columns, each ``-`` if null, else its length in
bytes, a colon and the value; a node is the SHA-256 of its children's lowercase hex
digests.  Every ``FANOUT`` consecutive nodes of a level (the last run may have fewer,
even one) have one parent, until one node is left.

Leaves are hashed where rows are read, by functions of the engine; only keys and
digests go on.  They are sorted by range and numbered from the sizes of the
partitions (``ranked``), which fixes each leaf's place.  Places are cut into aligned
blocks of ``FANOUT ** LEVELS``; in a block the digests stand in one contiguous numpy
matrix of 64 bytes a row, and ``FANOUT`` rows next to each other are the bytes that
make their parent, level by level.  A block gives one node, and its nodes are cut
into blocks again, so a tree of n leaves takes log(n) / log(4096) rounds (``LEVELS`` of ``FANOUT``) and no task
sees more than one block at a time, however many leaves one group has.  On the way
down each block gets the siblings above it in a row of its own, and siblings inside
it are slices of the matrix by index arithmetic.

Rows with equal keys go by their leaf; equal leaves may stand in either order.  A
null group is one of its own, the first; a null key comes first.  Null columns have a
mark of their own, so they differ from empty texts.  An empty table has no leaf and
gives an empty result.  Columns not named are left out and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm import scratch
from caseloom.llm.sqltext import crc32_sql

FANOUT, LEVELS = 8, 4


def hash_of(columns: list[Column]) -> Column:
    """The leaf of these columns."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256)


def parents(matrix: np.ndarray) -> np.ndarray:
    """The next level of digests (n, 64): one hash for each run of ``FANOUT`` rows."""
    flat = matrix.reshape(-1).data
    width = FANOUT * matrix.shape[1]
    made = b"".join(hashlib.sha256(flat[i : i + width]).hexdigest().encode() for i in range(0, matrix.size, width))
    return np.frombuffer(made, dtype=np.uint8).reshape(-1, 64)


def levels(matrix: np.ndarray, total: int, depth: int = LEVELS) -> list[np.ndarray]:
    """Matrices of a block of a tree of ``total`` nodes: up to the root of a tree that fits, else ``depth`` up."""
    out = [np.ascontiguousarray(matrix)]
    while len(out[-1]) > 1 if total <= FANOUT**depth else len(out) <= depth:
        out.append(parents(out[-1]))
    return out


def siblings(steps: list[bytes], i: int) -> list[tuple[bytes, bytes]]:
    """Digests left and right of node ``i`` of the lowest level in its run, level by level; ``steps`` without the top."""
    out = []
    for flat in steps:
        low = i // FANOUT * FANOUT
        out.append((flat[low * 64 : i * 64], flat[(i + 1) * 64 : (low + FANOUT) * 64]))
        i //= FANOUT
    return out


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        leaf = hashlib.sha256(left + leaf + right).hexdigest().encode()
    return leaf


# --- tables ------------------------------------------------------------------------


def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Adds ``i``, the place in the group from 0 on, and ``n``, the group's size.

    Rows are sorted by range and written; places come from the written table's
    partition sizes, so no task numbers a whole group.
    """
    placed = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = placed.withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()})
    held, _ = scratch.stored(placed, name)
    sizes = held.groupBy(group, "_p").agg(F.count("*").alias("_k"), F.min("_m").alias("_low"))
    # a row for each group in each partition
    w = Window.partitionBy(group).orderBy("_p")
    sizes = sizes.withColumns({"_base": F.coalesce(F.sum("_k").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "n": F.sum("_k").over(Window.partitionBy(group))})
    sizes = sizes.select(F.col(group).alias("_g"), F.col("_p").alias("_q"), "_base", "_low", "n")
    out = held.join(sizes, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_q")))
    return out.withColumn("i", F.col("_base") + F.col("_m") - F.col("_low")).drop("_g", "_p", "_q", "_m", "_base", "_low")


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Whole runs of rows with equal keys; the last run of a batch may go on in the next."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        rows = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        start = 0
        for i, key in enumerate(rows):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer("".join(column.to_pylist()).encode(), dtype=np.uint8).reshape(-1, 64)


def _up(nodes: DataFrame, depth: int) -> DataFrame:
    """g, i, n, d of the nodes that blocks of nodes (g, i, n, d) give; a group of one node keeps it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ("g", "b")):
            total = rows.column("n")[0].as_py()
            top = levels(_matrix(rows.column("d")), total, depth)[-1]
            node = {"g": rows.column("g")[0].as_py(), "i": rows.column("b")[0].as_py(), "n": -(-total // FANOUT**depth), "d": top[0].tobytes().decode()}
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in node.items()}, schema=pa.schema([("g", pa.string()), ("i", pa.int64()), ("n", pa.int64()), ("d", pa.string())]))

    cut = nodes.select("g", "i", "n", "d", F.floor(F.col("i") / FANOUT**depth).alias("b"))
    return cut.repartition("g", "b").sortWithinPartitions("g", "b", "i").mapInArrow(run, "g string, i long, n long, d string")


def _down(nodes: DataFrame, above: DataFrame, kept: list[str], leaf: bool, depth: int) -> DataFrame:
    """For each node (g, i, n, d) its siblings up to the root, from those of its block (g, i, left, right, root in ``above``).

    With ``leaf`` the proofs of leaves instead: their hash, and the root from what is
    in the column ``t`` (the row as it is found) where it is not null.
    """
    header = above.select("g", F.col("i").alias("b"), F.lit(-1).cast("long").alias("i"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("d"), "left", "right", "root", "group_root", *[F.lit(None).cast(nodes.schema[k].dataType).alias(k) for k in kept])
    none = F.lit(None).cast("array<string>")
    text = F.lit(None).cast("string")
    rows = nodes.select("g", F.floor(F.col("i") / FANOUT**depth).alias("b"), "i", "n", "d", none.alias("left"), none.alias("right"), text.alias("root"), text.alias("group_root"), *kept)
    dealt = header.unionByName(rows).repartition("g", "b").sortWithinPartitions("g", "b", "i")
    out_names = (*kept, "leaf", "subroot", "root", "proof_sha256", "folded_root", "n_siblings") if leaf else ("g", "i", "left", "right", "root", "group_root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _runs(batches, ("g", "b")):
            root, group_root = whole.column("root")[0].as_py(), whole.column("group_root")[0].as_py()
            upper = [(a.encode(), b.encode()) for a, b in zip(whole.column("left")[0].as_py(), whole.column("right")[0].as_py())]
            rows = whole.slice(1)
            matrix = _matrix(rows.column("d"))
            steps = [m.tobytes() for m in levels(matrix, rows.column("n")[0].as_py(), depth)[:-1]]
            paths = (siblings(steps, i) + upper for i in range(len(matrix)))
            if not leaf:
                found = [([a.decode() for a, _ in p], [b.decode() for _, b in p]) for p in paths]
                made = {"g": rows.column("g"), "i": rows.column("i"), "left": [a for a, _ in found], "right": [b for _, b in found], "root": [root] * len(found), "group_root": [group_root] * len(found)}
                yield from pa.table([pa.array(v, pa.list_(pa.string())) if k in ("left", "right") else v for k, v in made.items()], names=list(made)).combine_chunks().to_batches()
                continue
            proofs, folded, many = [], [], []
            for d, t, path in zip(rows.column("d").to_pylist(), rows.column("t").to_pylist(), paths):
                proofs.append(hashlib.sha256(b"".join(a + b for a, b in path)).hexdigest())
                folded.append(fold((d if t is None else t).encode(), path).decode())
                many.append(sum(len(a) + len(b) for a, b in path) // 64)
            made = [*(rows.column(k) for k in kept), rows.column("d"), [group_root] * len(many), [root] * len(many), proofs, folded, pa.array(many, pa.int64())]
            yield from pa.table(made, names=list(out_names)).combine_chunks().to_batches()

    kinds = ", ".join(f"`{k}` {nodes.schema[k].dataType.simpleString()}" for k in kept)
    proof = f"{kinds}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, n_siblings long"
    return dealt.mapInArrow(run, proof if leaf else "g string, i long, left array<string>, right array<string>, root string, group_root string")


def _tree(nodes: DataFrame, name: str, depth: int) -> list[DataFrame]:
    """The nodes, and the nodes of each round up to one of each group; all but the first are written."""
    out = [nodes]
    while out[-1].where("n > 1").limit(1).count():
        out.append(scratch.stored(_up(out[-1], depth), name)[0])
    return out


def manifest(rows: DataFrame, group: str, key: str, found: Column | None = None, depth: int = LEVELS) -> DataFrame:
    """Proof of each leaf: key, leaf, subroot, root, proof_sha256, folded_root, n_siblings.

    ``rows`` has group, key and ``leaf``; ``found`` is the leaf as it is found now,
    null where it is as before.  folded_root comes from that leaf and the siblings
    of the manifest, so it differs from root where a row has been changed.
    """
    own = rows.select(F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string"))).alias("g"), F.col(key).alias("key"), F.col("leaf").alias("d"), (F.lit(None).cast("string") if found is None else found).alias("t"))
    leaves = ranked(own, "g", ["key", "d"], "leaves")
    trees = _tree(leaves, "nodes", depth)
    roots = trees[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), "d")
    tops = ranked(roots, "g", ["name"], "roots")
    upper = _tree(tops.select("g", "i", "n", "d", "name"), "upper", depth)
    empty = F.array().cast("array<string>")
    path = upper[-1].select("g", "i", empty.alias("left"), empty.alias("right"), F.col("d").alias("root"), F.lit("").alias("group_root"))
    for level in reversed(upper[:-1]):
        path = scratch.stored(_down(level, path, [], False, depth), "paths")[0]
    # the path of each group's root is where the paths of its tree start
    path = tops.select("i", "name", "d").join(path, "i").select(F.col("name").alias("g"), F.lit(0).cast("long").alias("i"), "left", "right", "root", F.col("d").alias("group_root"))
    for level in reversed(trees[1:-1]):
        path = scratch.stored(_down(level, path, [], False, depth), "paths")[0]
    return _down(leaves, path, ["key", "t"], True, depth).drop("t")


def documents_manifest(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), depth: int = LEVELS) -> DataFrame:
    """The registered manifest: leaves of documents by language; every third one by crc32 of its id is tampered with.

    Tampering lower-cases A-Z of the text.
    """
    plain = [F.col(c) for c in columns]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select("doc_id", "lang", hash_of(plain).alias("leaf"), F.when(hit, hash_of([low if c == "text" else F.col(c) for c in columns])).alias("t"))
    return manifest(rows, "lang", "doc_id", F.col("t"), depth).withColumnRenamed("key", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle() -> str:
    """DuckDB SQL for the registered query: trees level by level, then each leaf's way up."""
    part = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    grow = lambda name, start: f"""{name}(g, lv, i, d, n) AS ({start} UNION ALL SELECT g, lv + 1, i // {FANOUT}, sha256(string_agg(d, '' ORDER BY i)), (n + {FANOUT - 1}) // {FANOUT}
      FROM {name} WHERE n > 1 GROUP BY g, lv, i // {FANOUT}, n)"""  # noqa: E731
    # siblings of each node in its run, as one text left and one right of it
    beside = lambda name, t: f"{name} AS (SELECT g, lv, i, coalesce(string_agg(d, '') OVER (l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a, coalesce(string_agg(d, '') OVER (l ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {t} WHERE n > 1 WINDOW l AS (PARTITION BY g, lv, i // {FANOUT} ORDER BY i))"
    return f"""
    WITH RECURSIVE leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf('text')} AS d,
      CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(low)} END AS t FROM documents),
    placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
    {grow('tree', 'SELECT g, 0, i, d, n FROM placed')},
    roots AS (SELECT g, d, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
    {grow('upper_', "SELECT '', 0, i, d, n FROM roots")},
    {beside('near', 'tree')}, {beside('over_', 'upper_')},
    climb(doc_id, g, k, lv, i, top, d, f, p) AS (SELECT doc_id, g, row_number() OVER (), 0, i, 0, d, coalesce(t, d), '' FROM placed
      UNION ALL SELECT c.doc_id, c.g, c.k, c.lv + 1, c.i // {FANOUT}, 0, c.d, sha256(s.a || c.f || s.b), c.p || s.a || s.b FROM climb c JOIN near s ON c.top = 0 AND s.g = c.g AND s.lv = c.lv AND s.i = c.i),
    low_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lv DESC) AS r FROM climb) WHERE r = 1),
    rise(doc_id, k, lv, i, d, sub, f, p) AS (SELECT l.doc_id, l.k, 0, r.i, l.d, r.d, l.f, l.p FROM low_ l JOIN roots r ON r.g = l.g
      UNION ALL SELECT c.doc_id, c.k, c.lv + 1, c.i // {FANOUT}, c.d, c.sub, sha256(s.a || c.f || s.b), c.p || s.a || s.b FROM rise c JOIN over_ s ON s.lv = c.lv AND s.i = c.i),
    done AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lv DESC) AS r FROM rise) WHERE r = 1),
    root AS (SELECT d AS root FROM upper_ WHERE n = 1)
    SELECT doc_id, d AS leaf, sub AS subroot, root, sha256(p) AS proof_sha256, f AS folded_root, length(p) // 64 AS n_siblings, f = root AS verified FROM done, root"""
