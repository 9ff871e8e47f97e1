"""Merkle manifest against a tree built by plain lists, with blocks of one level and of four."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from caseloom.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def tree(nodes):
    """Root and the siblings of each node."""
    paths, where, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, i in enumerate(where):
            low = i // 8 * 8
            paths[k].append((level[low:i], level[i + 1 : low + 8]))
            where[k] = i // 8
        level = [H(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0], paths


def plain(rows):
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, leaf_of(row, row[1])))
    for g in groups.values():
        g.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    sub = {g: tree([d for _, d in groups[g]]) for g in names}
    root, tops = tree([sub[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for (row, leaf), path in zip(groups[g], sub[g][1]):
            found = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                low = None if row[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])
                found = leaf_of(row, low)
            whole = path + top
            for a, b in whole:
                found = H(*a, found, *b)
            proof = H(*(x for a, b in whole for x in a + b))
            out.append((row[0], leaf, sub[g][0], root, proof, found, found == root))
    return sorted(out, key=repr)


def rows_of(n):
    rows = [(7 * k % 1000, f"Text {k} É" if k % 5 else f"low {k}", ["en", "fr", "", None, "én", "z"][min(k % 9, 5)] if k < n - 1 else "alone", "s" if k % 2 else None, k) for k in range(n)]
    return rows + [(1, None, "en", "s", None), (1, None, "en", "s", None), (None, "Null Id", "en", None, 3), (None, "", None, None, 0)]


def got(spark, rows, depth):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", g string, i int")  # columns named like the operator's own
    found = merkle.documents_manifest(df, depth=depth).collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found), key=repr)


@pytest.mark.parametrize("depth", [4, 1])
def test_manifest_equals_plain_trees(spark, depth):
    """With blocks of one level the same tree takes several rounds up and down."""
    rows = rows_of(700)
    assert got(spark, rows, depth) == plain(rows)


def test_small_and_empty(spark):
    for rows in ([(5, "A", "en", "s", 1)], [(5, "A", "en", "s", 1), (6, "b", "fr", "s", 1)], [(k, f"T{k}", "en", "s", k) for k in range(9)]):
        assert got(spark, rows, 4) == plain(rows)
    assert got(spark, [], 4) == []
    one = got(spark, [(5, None, None, None, None)], 4)[0]
    assert one[1] == one[2] == one[3] and one[4] == H() and one[6]


def test_long_text_is_hashed_whole(spark):
    rows = [(1, "Long " * 300_000, "en", "s", 1_500_000), (2, "short", "en", "s", 5)]
    assert got(spark, rows, 4) == plain(rows)
