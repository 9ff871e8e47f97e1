"""Token-id files of bit planes.

Ids are cut into blocks of a fixed number of ids.  A block is transposed into
byte planes (or bit planes), each plane is compressed with zstandard, and the
file ends with a chunk index, so that any block of any document can be read
alone.  Layout of a file::

    magic "CLPL1\\0\\0\\0"
    planes of block 0, planes of block 1, ...
    index: per block, offset (u8) and the lengths of its planes (u4 each)
    documents: doc_id (i8), n_tokens (u8) per document, zstandard
    footer: block size u4, planes u4, width u4, blocks u8, ids u8, index offset u8, documents offset u8, documents bytes u8
    crc32 of index and documents (u4), magic

All numbers are little-endian.  Byte planes take ``width`` planes of
``block`` bytes; bit planes take ``8 * width`` planes of ``block / 8`` bytes.

Documents are dealt by ranges of doc_id, then of a hash of the text and the row's
place in the input, so that one doc_id may be spread over many files, and sorted
within each range: the files in order of their number hold the documents in
ascending doc_id order (null ids first).  There are as many files as shuffle
partitions, or more, so that one has about ``FILE_BYTES`` of text.  A file is read
in pieces of about ``PIECE`` ids by the chunk index, one task each.
Files are written under a name of the task attempt and moved when whole; the
manifest names the file that counts, so a task that is run twice leaves the
other unread.

Cases: null and empty texts have the end id alone.  An empty table gives no
file and an empty result.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm import arrays, scratch
from caseloom.llm.subwords import Subwords

MAGIC = b"CLPL1\0\0\0"
FOOTER = struct.Struct("<IIIQQQQQI8s")
BLOCK = 1 << 16
FILE_BYTES, PIECE = 256 << 20, 1 << 22


@lru_cache(maxsize=2)
def encoder(path: str) -> Subwords:
    """The tokenizers library behind the cache of word parts; one per worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    # encode_batch_fast leaves out the offsets, which nobody reads here
    return Subwords(lambda text: np.array(t.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4"))


def to_planes(block: np.ndarray, width: int, bits: bool) -> list[bytes]:
    """The planes of one block of unsigned 32-bit ids, lowest byte (bit) first; an error if an id needs more bytes."""
    if block.size and int(block.max()) >= 1 << 8 * width:
        raise ValueError(f"id {int(block.max())} does not fit into {width} bytes")
    as_bytes = np.ascontiguousarray(block.astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :width]
    if not bits:
        return [np.ascontiguousarray(as_bytes[:, k]).tobytes() for k in range(width)]
    plane = np.unpackbits(as_bytes, axis=1, bitorder="little")
    return [np.packbits(plane[:, k], bitorder="little").tobytes() for k in range(8 * width)]


def from_planes(planes: list[bytes], n: int, width: int, bits: bool) -> np.ndarray:
    out = np.zeros((n, 4), dtype=np.uint8)
    if not bits:
        for k, p in enumerate(planes):
            out[:, k] = np.frombuffer(p, dtype=np.uint8)
    else:
        plane = np.stack([np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        out[:, :width] = np.packbits(plane, axis=1, bitorder="little")
    return out.view("<u4").reshape(-1)


class Writer:
    """Writes one file, block by block; memory holds one block."""

    def __init__(self, stream, width: int, bits: bool, block: int = BLOCK, level: int = 3):
        self.stream, self.width, self.bits, self.block = stream, width, bits, block
        self.z = zstandard.ZstdCompressor(level=level)
        self.index: list[tuple[int, list[int]]] = []
        self.documents: list[bytes] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        stream.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append(struct.pack("<qQ", -(1 << 63) if doc_id is None else doc_id, ids.size))
        self.waiting.append(ids)
        self.n_waiting += ids.size
        self.n_ids += ids.size
        if self.n_waiting >= self.block:
            rest = np.concatenate(self.waiting)
            whole = rest.size - rest.size % self.block
            for i in range(0, whole, self.block):
                self._put(rest[i : i + self.block])
            self.waiting, self.n_waiting = [rest[whole:]], rest.size - whole

    def _put(self, ids: np.ndarray) -> None:
        packed = [self.z.compress(p) for p in to_planes(ids, self.width, self.bits)]
        self.index.append((self.at, [len(p) for p in packed]))
        for p in packed:
            self.stream.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.n_waiting:
            self._put(np.concatenate(self.waiting))
        planes = self.width * (8 if self.bits else 1)
        index = b"".join(struct.pack(f"<Q{planes}I", at, *sizes) for at, sizes in self.index)
        documents = self.z.compress(b"".join(self.documents))
        self.stream.write(index + documents)
        self.stream.write(FOOTER.pack(self.block, planes, self.width, len(self.index), self.n_ids, self.at, self.at + len(index), len(documents), zlib.crc32(index + documents), MAGIC))


class Reader:
    """Random access to a file by its chunk index."""

    def __init__(self, file):
        self.file = file
        file.seek(file.size() - FOOTER.size)
        self.block, planes, self.width, n, self.n_ids, at, doc_at, doc_size, crc, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a plane file")
        file.seek(at)
        tail = file.read(doc_at - at + doc_size)
        if zlib.crc32(tail) != crc:
            raise ValueError("the chunk index is damaged")
        self.bits = planes != self.width
        row = struct.Struct(f"<Q{planes}I")
        self.index = [row.unpack_from(tail, k * row.size) for k in range(n)]
        self.z = zstandard.ZstdDecompressor()
        self.documents = np.frombuffer(self.z.decompress(tail[doc_at - at :]), dtype=[("doc_id", "<i8"), ("n", "<u8")])

    def read_block(self, k: int) -> np.ndarray:
        at, *sizes = self.index[k]
        self.file.seek(at)
        planes = [self.z.decompress(self.file.read(s)) for s in sizes]
        n = min(self.block, self.n_ids - k * self.block)
        return from_planes(planes, n, self.width, self.bits)

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids from ``start`` on, by the blocks that hold them."""
        if not n:
            return np.zeros(0, dtype="<u4")
        first, last = start // self.block, (start + n - 1) // self.block
        ids = np.concatenate([self.read_block(k) for k in range(first, last + 1)])
        return ids[start - first * self.block :][:n]

    def each(self, low: int = 0, high: int | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, first place in this file and ids of every document that starts from ``low`` to before ``high``, one block in memory at a time."""
        starts = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(self.documents["n"].astype(np.int64))))
        first, last = np.searchsorted(starts[:-1], [low, starts[-1] + 1 if high is None else high])
        at = int(starts[first])
        k, rest = at // self.block, np.zeros(0, dtype="<u4")
        if first < last and at % self.block:
            rest, k = self.read_block(k)[at % self.block :], k + 1
        for doc_id, n in self.documents[first:last].tolist():
            parts = [rest]
            have = rest.size
            while have < n:
                parts.append(self.read_block(k))
                have, k = have + parts[-1].size, k + 1
            rest = np.concatenate(parts) if len(parts) > 1 else rest
            yield (None if doc_id == -(1 << 63) else doc_id), at, rest[:n]
            rest, at = rest[n:], at + n


def write(
    df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, folder: str | None = None,
    files: int | None = None, width: int = 2, bits: bool = False, block: int = BLOCK,
) -> DataFrame:
    """Encode, append ``end_id`` and write the files; gives the manifest.

    The manifest has a row for each file: number, file, n_docs, n_tokens, n_bytes.
    ``width`` is the bytes an id takes (2 for up to 65,536 ids).  The manifest is
    written to the shared folder, so the files are there when this returns.
    """
    spark = df.sparkSession
    folder = folder or scratch.new_path(spark, "planes")
    if files is None:
        size = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    schema = "number long, file string, n_docs long, n_tokens long, n_bytes long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        number, name = TaskContext.get().partitionId(), None
        for whole in batches:
            for batch in arrays.slices(whole, text):
                if name is None:
                    store.create_dir(base, recursive=True)
                    name = f"{number:06d}-{uuid.uuid4().hex}.planes"
                    stream = store.open_output_stream(f"{base}/{name}.part")
                    w, docs = Writer(stream, width, bits, block), 0
                ids, at = encoder(path).encode(arrays.as_bytes(batch.column(text)))
                ended, at = np.insert(ids, at[1:], end_id), at + np.arange(at.size)  # the end id after each text
                for k, i in enumerate(batch.column(doc_id).to_pylist()):
                    w.add(i, ended[at[k] : at[k + 1]])
                docs += batch.num_rows
        if name is None:
            return
        w.close()
        size = stream.tell()
        stream.close()
        store.move(f"{base}/{name}.part", f"{base}/{name}")
        yield pa.RecordBatch.from_pydict({"number": [number], "file": [f"{folder}/{name}"], "n_docs": [docs], "n_tokens": [w.n_ids], "n_bytes": [size]})

    only = df.select(F.col(doc_id).cast("long").alias(doc_id), F.col(text).alias(text), F.xxhash64(text).alias("_h"), F.monotonically_increasing_id().alias("_k"))
    dealt = only.repartitionByRange(files, doc_id, "_h", "_k").sortWithinPartitions(doc_id, "_h", "_k").drop("_h", "_k")
    return scratch.stored(dealt.mapInArrow(run, schema), "manifest")[0]


def read(manifest: DataFrame) -> DataFrame:
    """Documents from the files: doc_id, start (ids of all documents before), n_tokens, ids.

    ``ids`` are little-endian unsigned 32-bit integers in a binary column.
    """
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each file: the running sum is over file sizes only
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    placed = placed.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / PIECE).cast("int"))))
    n = manifest.sparkSession.sparkContext.defaultParallelism
    placed = placed.repartition(max(n, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "number", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for file, base, piece in zip(*(batch.column(c).to_pylist() for c in ("file", "base", "piece"))):
                store, name = fs.FileSystem.from_uri(file)
                with store.open_input_file(name) as f:
                    rows: list[tuple] = []
                    held = 0
                    for doc_id, at, ids in Reader(f).each(piece * PIECE, (piece + 1) * PIECE):
                        rows.append((doc_id, base + at, ids.size, ids.tobytes()))
                        held += 4 * ids.size
                        if held > arrays.MAX_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
