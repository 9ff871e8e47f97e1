"""Elements of large JSON arrays and entries of large JSON maps, read in pieces by many tasks.

A file of one JSON array may be larger than any task, and has no line ends that
could be relied on.  Spark's text reader can cut it at every comma, whatever the
file system.  Commas in strings or deeper lists are no borders, though, and a task
that begins in the middle of a file cannot know where it stands.

1. A first pass over the blocks of the files gives each block's effect, for both
   states that it may begin in (inside a string or not): whether it ends in a string,
   how much deeper it ends, and how many commas stand at each depth.
2. These effects are put in a row for each file, a few numbers for each block, which
   gives every block the state, the depth and the number of the element at its start.
3. A second pass cuts each block at the commas that are borders.  What lies between
   two borders of a block is an element; the pieces at the ends of blocks are joined
   with those of their neighbours.

Elements come with their file and number.  A file whose brackets do not match, or of
which an element is not JSON, is malformed as a whole: it gives one row without text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.sources.shared import written

_QUOTE, _ESCAPE, _COMMA = ord('"'), ord("\\"), ord(",")
_OPEN = np.zeros(256, dtype=np.int8)
_OPEN[[ord("["), ord("{")]] = 1
_OPEN[[ord("]"), ord("}")]] = -1
WHITE = b" \t\n\r"


def marks(text: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of commas outside strings, the depth at each (from 0 at the start), and whether the text ends in a string.

    A text never begins after an escape: pieces are cut at commas, which JSON does not escape.
    """
    b = np.frombuffer(text, dtype=np.uint8)
    at = np.arange(b.size)
    plain = np.maximum.accumulate(np.where(b != _ESCAPE, at, -1)) if b.size else at
    quotes = np.flatnonzero(b == _QUOTE)
    before = np.where(quotes > 0, quotes - 1 - plain[quotes - 1], 0)
    quotes = quotes[before % 2 == 0]
    flips = np.zeros(b.size, dtype=np.int64)
    flips[quotes] = 1
    within = (np.cumsum(flips) + inside) % 2 == 1
    step = np.where(within, 0, _OPEN[b])
    depth = np.cumsum(step)
    commas = np.flatnonzero((b == _COMMA) & ~within)
    return commas, depth, bool((quotes.size + inside) % 2)


def _blocks(spark: SparkSession, path: str, joined: bool) -> DataFrame:
    """file, part, start and size of the file of each piece between commas, in their order within a block."""
    raw = spark.read.option("lineSep", ",").text(path)
    at = F.col("_metadata")
    file, none = at["file_path"], F.lit("")
    return raw.select((none if joined else file).alias("file"), (file if joined else none).alias("part"), at["file_block_start"].alias("start"), at["file_size"].alias("size"), "value")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, bytes, int]]:
    """Key of a block, whether it is new, a text of it, and its file's size.

    Commas between pieces are put back: every piece of a file but the first has one before it.
    """
    key = None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("file", "part", "start"))))
        sizes, values = batch.column("size").to_pylist(), batch.column("value").cast(pa.binary()).to_pylist()
        i = 0
        while i < len(keys):
            j = i
            while j < len(keys) and keys[j] == keys[i]:
                j += 1
            new, text = keys[i] != key, b",".join(values[i:j])
            yield keys[i], new, text if new and keys[i][2] == 0 else b"," + text, sizes[i]
            key, i = keys[i], j


_EFFECT = "file string, part string, start long, missing long, ends0 boolean, ends1 boolean, deeper0 long, deeper1 long, depths0 array<long>, counts0 array<long>, depths1 array<long>, counts1 array<long>, head string"


def _effects(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def row() -> pa.RecordBatch:
            made = {"file": [held["key"][0]], "part": [held["key"][1]], "start": [held["key"][2]], "missing": [held["size"] - held["bytes"]], "head": [held["head"]]}
            for h in (0, 1):
                d = held["count"][h]
                made |= {f"ends{h}": [held["in"][h]], f"deeper{h}": [held["depth"][h]], f"depths{h}": [list(d)], f"counts{h}": [list(d.values())]}
            return pa.RecordBatch.from_pydict(made, schema=pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}[k]) for n, k in (x.split(" ") for x in _EFFECT.split(", "))]))

        for key, new, text, size in _texts(batches):
            if new:
                if held:
                    yield row()
                # of the file's size every block takes what it reads, the first one the rest as well
                held = {"key": key, "in": [False, True], "depth": [0, 0], "count": [{}, {}], "head": None, "bytes": 0, "size": size if key[2] == 0 else 0}
            held["bytes"] += len(text)
            if held["head"] is None and text.strip(WHITE):
                held["head"] = chr(text.strip(WHITE)[0])
            for h in (0, 1):
                commas, depth, held["in"][h] = marks(text, held["in"][h])
                levels, many = np.unique(depth[commas] + held["depth"][h], return_counts=True)
                for d, n in zip(levels.tolist(), many.tolist()):
                    held["count"][h][d] = held["count"][h].get(d, 0) + n
                held["depth"][h] += int(depth[-1]) if depth.size else 0
        if held:
            yield row()

    return blocks.mapInArrow(run, _EFFECT)


def _states(rows: list) -> tuple[dict, dict]:
    """What each block begins with (in a string, depth, element), and for each file its first character and whether it ends whole."""
    begin, files = {}, {}
    for r in sorted(rows, key=lambda r: (r["file"], r["part"], r["start"])):
        inside, depth, element, head, missing = files.get(r["file"], (False, 0, 0, None, 0))
        begin[r["file"], r["part"], r["start"]] = (inside, depth, element)
        h = int(inside)
        borders = dict(zip(r[f"depths{h}"], r[f"counts{h}"])).get(1 - depth, 0)
        files[r["file"]] = (r[f"ends{h}"], depth + r[f"deeper{h}"], element + borders, head or r["head"], missing + r["missing"])
    return begin, files


def read_elements(spark: SparkSession, path: str, opening: str = "[", joined: bool = False) -> DataFrame:
    """file, i and text of the elements of every file below ``path``; text is null where a file is malformed.

    ``opening`` is ``[`` for arrays or ``{`` for maps, whose elements are ``"key": value``.
    A file of any other JSON value is one element, the whole file.  With ``joined`` all
    files are the parts of one text, in order of their names.
    """
    blocks = _blocks(spark, path, joined)
    begin, files = _states(_effects(blocks).collect())  # a row for each block of a file
    held = spark.sparkContext.broadcast((begin, {f: x[3] for f, x in files.items()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, files = held.value
        rows: list[tuple] = []
        schema = pa.schema([("file", pa.string()), ("i", pa.int64()), ("part", pa.string()), ("start", pa.int64()), ("text", pa.string()), ("whole", pa.bool_())])

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema) if rows else pa.RecordBatch.from_pylist([], schema=schema)
            rows.clear()
            return made

        key, parts, first, size = None, [], True, 0
        for now, new, text, _ in _texts(batches):
            if new:
                if key is not None:
                    rows.append((key[0], element, key[1], key[2], b"".join(parts).decode("utf-8", "replace"), False))
                key, parts, first = now, [], True
                inside, deep, element = begin[now]
                listed = files[now[0]] == opening
            commas, depth, ends = marks(text, inside)
            low = 0
            for at in commas[depth[commas] + deep == 1].tolist() if listed else []:
                parts.append(text[low:at])
                made = b"".join(parts)
                rows.append((key[0], element, key[1], key[2], made.decode("utf-8", "replace"), not first))
                size += len(made)
                parts, low, first, element = [], at + 1, False, element + 1
            parts.append(text[low:])
            inside, deep = ends, deep + (int(depth[-1]) if depth.size else 0)
            if size > 1 << 21:
                yield flush()
                size = 0
        if key is not None:
            rows.append((key[0], element, key[1], key[2], b"".join(parts).decode("utf-8", "replace"), False))
        yield flush()

    # written once to the shared folder: what follows reads it more than once
    cut = written(blocks.mapInArrow(run, "file string, i long, part string, start long, text string, whole boolean"), "elements")
    ends = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "start", "text"))), lambda x: x["text"]), "")
    each = cut.where("whole").select("file", "i", "text").unionByName(cut.where("NOT whole").groupBy("file", "i").agg(ends.alias("text")))
    # a comma at the very end of a file is in no piece, so a byte is missing there
    info = [(f, x[3], x[2], x[1] == 0 and not x[0] and x[4] == 0) for f, x in files.items()]
    known = spark.createDataFrame(info, "file string, head string, last long, matched boolean")
    listed = F.col("head") == opening
    strip = lambda c, p: F.regexp_replace(c, p, "")
    text = F.when(listed & (F.col("i") == 0), strip("text", r"(?s)\A[ \t\r\n]*[\[{]")).otherwise(F.col("text"))
    named = each.join(known, "file").withColumn("text", text)
    closing = r"[\]][ \t\r\n]*\z" if opening == "[" else r"[}][ \t\r\n]*\z"
    ended = ~listed | (F.col("i") != F.col("last")) | F.col("text").rlike("(?s)" + closing)
    named = named.withColumn("matched", F.col("matched") & ended).withColumn("text", F.when(listed & (F.col("i") == F.col("last")), strip("text", "(?s)" + closing)).otherwise(F.col("text")))
    named = named.withColumn("text", strip(strip("text", r"(?s)\A[ \t\r\n]+"), r"(?s)[ \t\r\n]+\z"))
    empty = listed & (F.col("last") == 0) & (F.col("text") == "")  # an array without elements
    value = F.when(listed & F.lit(opening == "{"), F.concat(F.lit("{"), "text", F.lit("}"))).otherwise(F.col("text"))
    good = F.col("matched") & (empty | F.try_parse_json(value).isNotNull() & (F.col("text") != ""))
    bad = named.where(~good).select("file").distinct()
    whole = named.where(good & ~empty).join(bad, "file", "left_anti").select("file", "i", "text")
    return whole.unionByName(bad.select("file", F.lit(0).cast("long").alias("i"), F.lit(None).cast("string").alias("text")))
