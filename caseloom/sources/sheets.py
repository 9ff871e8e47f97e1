"""Excel workbooks without a library for them: a sheet's XML is streamed from the zip, row by row.

Spark's binary reader brings the file from any store; a task inflates the sheet as it
reads it and gives Arrow batches, so no sheet is ever a table on the driver.  The
format bounds a sheet at 1,048,576 rows of 16,384 cells.  Several files, or a folder
of them, are read in parallel.

Values become texts: shared, inline and formula texts as they are, whole numbers
without a point, booleans as True and False, and numbers with a date format as
``YYYY-MM-DD HH:MM:SS`` (in the 1900 or the 1904 system).  Errors and empty cells are
null.  Cells may be missing and rows too; a cell's letters say where it stands.
"""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROWS = 2048
# Numbers of built-in date and time formats.
DATES = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _texts(node: ElementTree.Element) -> str:
    """All runs of a text, without phonetic hints."""
    out = []
    for child in node:
        kind = _local(child.tag)
        if kind == "t":
            out.append(child.text or "")
        elif kind == "r":
            out += [t.text or "" for t in child if _local(t.tag) == "t"]
    return "".join(out)


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    found = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, node in ElementTree.iterparse(f):
            if _local(node.tag) == "si":
                found.append(_texts(node))
                node.clear()
    return found


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show dates or times."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own, styles = {}, set()
    for node in root.iter():
        if _local(node.tag) == "numFmt":
            # what stands in quotes or brackets is no part of a date
            own[int(node.get("numFmtId"))] = bool(re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", node.get("formatCode") or ""), re.I))
    for group in root:
        if _local(group.tag) == "cellXfs":
            for i, xf in enumerate(group):
                k = int(xf.get("numFmtId") or 0)
                if own.get(k, k in DATES):
                    styles.add(i)
    return styles


def _sheet_path(book: zipfile.ZipFile, sheet: str | int) -> tuple[str, bool]:
    """The part that holds a sheet, by name or place, and whether dates count from 1904."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    late = any(_local(n.tag) == "workbookPr" and n.get("date1904") in ("1", "true") for n in root)
    sheets = [n for n in root.iter() if _local(n.tag) == "sheet"]
    node = sheets[sheet] if isinstance(sheet, int) else next(n for n in sheets if n.get("name") == sheet)
    wanted = next(v for k, v in node.attrib.items() if _local(k) == "id")
    for n in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if n.get("Id") == wanted:
            target = n.get("Target")
            return (target.lstrip("/") if target.startswith("/") else f"xl/{target}"), late
    raise ValueError(f"no part for sheet {sheet!r}")


def column(reference: str) -> int:
    """The place of a cell, from 0: A1 is 0, AA1 is 26."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def moment(number: float, late: bool) -> str:
    """A date number as text; day 60 of the 1900 system never was, and days before it count one more."""
    if late:
        start = datetime.datetime(1904, 1, 1)
    else:
        start = datetime.datetime(1899, 12, 31 if number < 60 else 30)
    return (start + datetime.timedelta(seconds=round(number * 86_400))).isoformat(" ")


def rows_of(content: bytes, sheet: str | int = 0) -> Iterator[list[str | None]]:
    """Rows of a sheet from its first one on; each as long as its last cell."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        path, late = _sheet_path(book, sheet)
        shared, dates = _shared(book), _date_styles(book)
        with book.open(path) as f:
            row: list[str | None] = []
            last = 0
            for event, node in ElementTree.iterparse(f, events=("start", "end")):
                kind = _local(node.tag)
                if kind == "row" and event == "start":
                    row = []
                elif kind == "c" and event == "end":
                    at = column(node.get("r")) if node.get("r") else len(row)
                    row += [None] * (at - len(row))
                    row.append(_value(node, shared, dates, late))
                    node.clear()
                elif kind == "row" and event == "end":
                    number = int(node.get("r") or last + 1)
                    yield from ([] for _ in range(number - last - 1))
                    yield row
                    last = number
                    node.clear()


def _value(cell: ElementTree.Element, shared: list[str], dates: set[int], late: bool) -> str | None:
    kind, value = cell.get("t") or "n", None
    for child in cell:
        if _local(child.tag) == "v":
            value = child.text
        elif _local(child.tag) == "is":
            return _texts(child)
    if value is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind != "n":
        return value
    number = float(value)
    if int(cell.get("s") or 0) in dates:
        return moment(number, late)
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)


def _names(header: list[str | None]) -> list[str]:
    """Column names; empty ones by their place, later ones of equal name with a number."""
    out: list[str] = []
    for i, name in enumerate(header):
        name = name if name not in (None, "") else f"Unnamed: {i}"
        k, own = 1, name
        while own in out:
            own, k = f"{name}_{k}", k + 1  # a dot would be a path
        out.append(own)
    return out


def read_workbook(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """The rows of one sheet as texts, with the names of its first row; of several files the columns of the first by path.

    Rows without any value are left out; a row that is shorter has nulls.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                yield pa.RecordBatch.from_pydict({"path": [name], "names": [_names(next(rows_of(content, sheet), []))]})

    first = files.mapInArrow(head, "path string, names array<string>").orderBy("path").first()
    names = first["names"] if first else []
    if not names:
        return spark.createDataFrame([], "empty string").drop("empty")

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([pa.field(f"c{i}", pa.string()) for i in range(len(names))])

        def made(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(len(names))], schema=schema)

        for batch in batches:
            for content in batch.column("content"):
                source, held = rows_of(content.as_py(), sheet), []
                where = {n: k for k, n in reversed(list(enumerate(_names(next(source, [])))))}
                at = [where.get(n, -1) for n in names]
                for row in source:
                    out = [row[k] if 0 <= k < len(row) else None for k in at]
                    if any(x is not None for x in out):
                        held.append(out)
                    if len(held) == ROWS:
                        yield made(held)
                        held = []
                if held:
                    yield made(held)

    return files.mapInArrow(body, ", ".join(f"c{i} string" for i in range(len(names)))).toDF(*names)
