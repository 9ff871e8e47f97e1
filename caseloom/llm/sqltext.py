"""Pieces of DuckDB SQL that several oracles share."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text, bit by bit."""
    bits = f"list_transform(range(0, 8 * length({text})), lambda k: (ord(substr({text}, k // 8 + 1, 1)) >> (k % 8)) & 1)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"
