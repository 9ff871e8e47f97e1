"""Python work on batches of rows where some rows make it fail.

A batch that fails is cut into halves, and each half is tried again, until the rows
that fail stand alone.  These go to a quarantine with their own columns and the
error; all others go on.  A batch of n rows with k bad ones takes some k log2(n) more
calls, and none where all is well.

Both outputs are read from one table in the shared folder, so work is done once and
a row is never in both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from caseloom.sources.shared import written

#: Characters of an error that are kept.
MESSAGE = 500


def attempts(batch: pa.RecordBatch, work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch | None, str | None]]:
    """Pieces of a batch in their order: input, and what came of it or the error of a single row."""
    if not batch.num_rows:
        return
    try:
        made = work(batch)
    except Exception as e:  # noqa: BLE001  whatever a row makes the work raise
        if batch.num_rows == 1:
            yield batch, None, f"{type(e).__name__}: {e}"[:MESSAGE]
            return
    else:
        yield batch, made, None
        return
    half = batch.num_rows // 2
    yield from attempts(batch.slice(0, half), work)
    yield from attempts(batch.slice(half), work)


def isolated(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """What ``work`` makes of the rows (``schema``), and the rows that it fails on, with ``error``.

    ``work`` may give any number of rows for a batch.  It must not depend on how rows
    are cut into batches.
    """
    inside = T.StructType([T.StructField("made", schema), T.StructField("row", df.schema), T.StructField("error", T.StringType())])
    fields = to_arrow_schema(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, made, error in attempts(batch, work):
                n = rows.num_rows if made is None else made.num_rows
                whole = pa.nulls(n, fields.field("made").type) if made is None else pa.Table.from_batches([made]).select([f.name for f in schema]).cast(pa.schema(list(fields.field("made").type))).to_struct_array().combine_chunks()
                own = pa.Table.from_batches([rows]).cast(pa.schema(list(fields.field("row").type))).to_struct_array().combine_chunks() if made is None else pa.nulls(n, fields.field("row").type)
                yield pa.RecordBatch.from_arrays([_one(whole), _one(own), pa.array([error] * n, pa.string())], schema=fields)

    held = written(df.mapInArrow(run, inside), "isolated")
    return held.where("error IS NULL").select("made.*"), held.where("error IS NOT NULL").select("row.*", "error")


def _one(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def phrases_by(find: Callable[[str], list[str]]) -> Callable[[DataFrame, str, str], tuple[DataFrame, DataFrame]]:
    """An annotator from a function of one text: gives (key, phrase) of the texts it can take, and the rows of the others with ``error``."""

    def extract(texts: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
        own = texts.select(key, text)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, found = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for phrase in find(t) if t is not None else ():
                    at.append(i)
                    found.append(phrase)
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.string())], names=[key, "phrase"])

        good, bad = isolated(own, work, T.StructType([texts.schema[key], T.StructField("phrase", T.StringType())]))
        return good.where(F.col("phrase").isNotNull()), bad

    return extract
