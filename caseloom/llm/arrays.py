"""Vectorised tokenising and hashing over Arrow batches.

Texts of a batch are joined into one byte buffer with a separator after each
document; words, hashes and windows are then computed with numpy over the whole
buffer.  Batches are cut so that one buffer stays near ``MAX_BYTES`` (a single
longer text is never cut).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MAX_BYTES = 2 << 20
U8 = np.uint64
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=U8)

#: ASCII A-Z to a-z; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def separators(chars: bytes) -> np.ndarray:
    """A lookup table: True for the bytes that separate words."""
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


#: Space and tab to carriage return: the white space of ``[^\x20\x09-\x0D]+``.
WHITE = separators(b" \t\n\x0b\x0c\r")


def slices(batch: pa.RecordBatch, column: str = "text", most: int = MAX_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts have about ``most`` bytes."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start)
    trim()


def trim() -> None:
    """Give freed memory back: workers outlive their tasks, and share a host."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The texts of a string column as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def joined(texts: list[bytes | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a line feed after each text, and where each text starts.

    ``starts`` has one entry more than there are texts.  Eight zero bytes
    follow, so that eight bytes can be read from any place.
    """
    raw = b"\n".join(x or b"" for x in texts) + b"\n"
    if lower:
        raw = raw.translate(LOWER)
    lengths = np.fromiter((len(x) + 1 if x else 1 for x in texts), dtype=np.int64, count=len(texts))
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lengths, out=starts[1:])
    return np.frombuffer(raw + bytes(8), dtype=np.uint8), starts


def words(buffer: np.ndarray, starts: np.ndarray, table: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and length of each word, and the first word of each text (one entry more)."""
    gap = table[buffer[: starts[-1]]]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if gap.size and not gap[0]:
        edges = np.concatenate((np.zeros(1, dtype=edges.dtype), edges))
    begin, end = edges[0::2], edges[1::2]
    return begin, end - begin, np.searchsorted(begin, starts)


def low_bytes(length: np.ndarray) -> np.ndarray:
    """Masks of the bytes of a range among the eight from its begin on."""
    return _LOW[np.minimum(length, 8)]


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = h ^ (h >> U8(30))
    h *= U8(0xBF58476D1CE4E5B9)
    h ^= h >> U8(27)
    h *= U8(0x94D049BB133111EB)
    h ^= h >> U8(31)
    return h


def hashes(buffer: np.ndarray, begin: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte ranges; equal bytes have equal hashes in every batch."""
    if not begin.size:
        return np.zeros(0, dtype=U8)
    eight = np.ndarray(shape=(buffer.size - 7,), dtype="<u8", buffer=buffer.data, strides=(1,))
    h = mix(length.astype(U8) * U8(0x9E3779B97F4A7C15) + U8(seed))
    h = mix(h ^ (eight[begin] & _LOW[np.minimum(length, 8)]))
    rest, k = np.flatnonzero(length > 8), 8
    while rest.size and k < 64:
        left = length[rest] - k
        h[rest] = mix(h[rest] * U8(3) ^ (eight[begin[rest] + k] & _LOW[np.minimum(left, 8)]))
        rest, k = rest[left > 8], k + 8
    for i in rest.tolist():  # words over 64 bytes
        h[i] = xxhash.xxh64_intdigest(buffer[begin[i] : begin[i] + length[i]].tobytes(), seed)
    return h


_STEP = mix(np.arange(1, 65, dtype=U8) * U8(0xD1B54A32D192ED03)) | U8(1)


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words; the caller keeps those within one text."""
    n = h.size - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U8)
    total = h[:n] * _STEP[0]
    for j in range(1, size):
        total += h[j : j + n] * _STEP[j]
    return mix(total)
