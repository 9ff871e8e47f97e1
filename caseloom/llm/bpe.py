"""Byte-level BPE encoding and decoding with exact merges, in linear time.

Method: bytes are mapped to Latin-1 so that pyahocorasick can find every
vocabulary entry; the longest match at each place is the first candidate.  Two
adjacent tokens are compatible if merging by rank would leave the border
between them alone (memoised).  The encoder appends the longest compatible
token, falls back to the next shorter prefix, and backtracks over places that
turned out to be dead; each place dies at most once, so the time is linear.

Cases: null and empty texts have no ids.  Repeated texts have equal ids.  Rows
and other columns are kept as they are (columns named like a result are
replaced).  Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm import arrays
from caseloom.llm.cache import Cache
from caseloom.llm.subwords import Subwords


class Vocabulary:
    """Ranks, merge tables and the automaton; one per worker process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.auto = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.auto.add_word(token.decode("latin-1"), (len(token), rank))
        self.auto.make_automaton()
        self.pairs: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.shorter: dict[int, int] = {}
        self.fits = lru_cache(maxsize=1 << 16)(self._fits)
        self._learn()
        self.fits.cache_clear()  # it was filled while the tables grew
        self.pieces = Cache(lambda piece: array("I", self.encode_piece(piece.encode())).tobytes(), most=30_000)
        self.parts = Subwords(lambda text: np.frombuffer(self.encode(text), dtype="<u4"), 600_000, 21)

    def _learn(self) -> None:
        """From the ranks alone: which two tokens each token was merged from."""
        for rank, token in self.tokens.items():
            for n in range(len(token) - 1, 0, -1):
                if (head := self.ranks.get(token[:n])) is not None:
                    self.shorter[rank] = head
                    break
        for rank in sorted(self.tokens):
            token = self.tokens[rank]
            head = self.shorter.get(rank)
            while head is not None:
                tail = self.ranks.get(token[len(self.tokens[head]) :])
                if tail is not None and head < rank and tail < rank and self._fits(head, tail):
                    self.pairs[head, tail] = rank
                    self.split[rank] = (head, tail)
                    break
                head = self.shorter.get(head)
            self.split.setdefault(rank, (rank, rank))

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves the border between two tokens alone.

        The two are taken apart again, last merge first, along the border; if
        some pair there merges earlier than what was taken apart, it would have
        been merged across the border.  This is the pair-compatibility test published
        with the linear-time encoder of van Antwerpen and Neubeck (2024).
        """
        limit = 1 << 60
        while True:
            if self.pairs.get((left, right), limit) < limit:
                return False
            if left > right:
                limit, left = left, self.split[left][1]
                if left == limit:
                    limit, right = right + 1, self.split[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, self.split[right][0]
                if right + 1 == limit:
                    limit, left = left, self.split[left][1]
                    if left == limit:
                        return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        latin, fits = piece.decode("latin-1"), self.fits
        # leftmost-longest matches are the answer if each is compatible with the next
        out = [rank for _, (_, rank) in self.auto.iter_long(latin)]
        last = out[0]
        for token in out[1:]:
            if not fits(last, token):
                return self._backtrack(latin)
            last = token
        return out

    def _backtrack(self, latin: str) -> list[int]:
        size = len(latin)
        longest, width = [0] * size, [0] * size
        for end, (n, rank) in self.auto.iter(latin):
            if n > width[end + 1 - n]:
                width[end + 1 - n], longest[end + 1 - n] = n, rank
        alive = bytearray(b"\1") * (size + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        tokens, shorter, fits = self.tokens, self.shorter, self.fits
        while at < size:
            while True:
                end = at + len(tokens[token])
                if alive[end] and (not out or fits(out[-1], token)):
                    out.append(token)
                    at = end
                    token = longest[at] if at < size else -1
                    break
                if token in shorter:
                    token = shorter[token]
                    continue
                alive[at] = 0  # nothing compatible starts here: go back one token
                token = out.pop()
                at -= len(tokens[token])
                break
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.find(text))) if text else b""

    def encode_many(self, texts: list[bytes | None]) -> list[bytes]:
        """The same for many texts, by word parts that were seen before."""
        ids, starts = self.parts.encode(texts)
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a rank file (base64 token, rank); the tables stay for the worker's life."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Vocabulary(ranks, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds ``ids``: the text's token ids as little-endian unsigned 32-bit integers.

    ``path`` names the rank file; it is installed on every worker.  With
    ``decoded`` the ids are decoded again, in the same workers, into that column.
    """
    own = [c for c in (ids, decoded) if c]
    kept = df.drop(*[c for c in own if c != text])
    schema = kept.select("*", *[F.lit(b"").alias(c) for c in own]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, pattern)
        for whole in batches:
            for batch in arrays.slices(whole, text):
                made = [v.encode_many(arrays.as_bytes(batch.column(text)))]
                if decoded:
                    made.append([v.decode(x) for x in made[0]])
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(m, pa.binary()) for m in made)], names=[*batch.schema.names, *own])

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``: the bytes that the ids stand for."""
    kept = df.drop(*[c for c in [out] if c != ids])
    schema = kept.select("*", F.lit(b"").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, pattern)
        for whole in batches:
            for batch in arrays.slices(whole, ids):
                made = pa.array([v.decode(x or b"") for x in arrays.as_bytes(batch.column(ids))], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, out])

    return kept.mapInArrow(run, schema)
