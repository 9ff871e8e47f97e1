"""Missing values and white space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTINEL = "Not reported"
# Texts that delimited files use for a missing value.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)
# Characters that count as white space.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space at both ends, all of Unicode's."""
    return F.btrim(c, F.lit(SPACES))


def is_missing(c: Column, *, blank: bool = True, stripped: bool = False, also: tuple[str, ...] = ()) -> Column:
    """Null, the sentinel, and (by option) empty or blank text or further texts."""
    seen = strip(c) if stripped else c
    texts = [SENTINEL, *([""] if blank else []), *also]
    return c.isNull() | seen.isin(*texts)


def without_na(df: DataFrame) -> DataFrame:
    """Texts that stand for a missing value become null, in all string columns."""
    return df.select(*[F.when(~F.col(f"`{n}`").isin(*NA_TEXTS), F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes])


def fill_sentinel(df: DataFrame) -> DataFrame:
    return df.na.fill(SENTINEL)


def bound(value: Column, use) -> Column:
    """``use`` of a value that is found once, however often it is named: inside lambdas and branches each mention is evaluated anew."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def none_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def parts(c: Column, separator: str) -> Column:
    """The stripped, non-empty parts of a delimited text."""
    return F.filter(F.transform(F.split(c, separator, -1), strip), lambda x: x != "")


def ordered_distinct(c: Column) -> Column:
    return F.array_distinct(c)


def sorted_distinct(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))
