"""URL filter: host rules first, then a weighted vocabulary.

Method: one Aho-Corasick automaton over the strict and the soft terms scans the
lower-cased url once; a hit counts only between boundaries (no ASCII letter or
digit on either side).  One strict hit, or ``soft_limit`` distinct soft terms,
block the url.

Cases: a null url, or one without ``://``, has empty host and path, no rule and
no hits, so it is allowed.  Repeated rows are judged alike; an empty table gives
an empty result; every other input column is kept as it is, and columns named
like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vocabulary of the method.
STRICT_TERMS = (
    "casino", "cheap-pills", "escort", "hardcore", "jackpot", "keygen", "malware", "phishing", "porn", "spam-farm",
    "torrent", "viagra", "warez", "xxx",
)
SOFT_TERMS = (
    "adult", "bet", "bonus", "buy", "cheap", "crack", "dating", "deal", "discount", "download", "farm", "free",
    "loan", "pills", "poker", "promo", "spam", "win",
)
SOFT_LIMIT = 2

#: (verdict, host, path) of the registered query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path; empty without one."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; ties go to the longer host, then by name."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def automaton(strict: Sequence[str], soft: Sequence[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, terms in ((1, soft), (0, strict)):  # a term in both lists is strict
        for term in terms:
            a.add_word(term, (kind, term))
    a.make_automaton()
    return a


def hits(a: ahocorasick.Automaton, url: str | None) -> tuple[int, int]:
    """Distinct strict and soft terms between boundaries."""
    if not url:
        return 0, 0
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url) if not url.islower() else url
    word = lambda i: 0 <= i < len(text) and text[i].isascii() and text[i].isalnum()
    found: tuple[set, set] = (set(), set())
    for end, (kind, term) in a.iter(text):
        if not word(end + 1) and not word(end - len(term)):
            found[kind].add(term)
    return len(found[0]), len(found[1])


def filter_urls(
    df: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """Adds host, path, rule, n_strict, n_soft and verdict (the rule's, else the method's)."""
    own = ["host", "path", "rule", "n_strict", "n_soft", "verdict"]
    kept = df.drop(*[c for c in own if c != url])
    host, path = host_path(F.col(url))
    with_host = kept.withColumns({"host": host, "path": path})
    schema = with_host.select("*", F.lit(0).cast("long").alias("n_strict"), F.lit(0).cast("long").alias("n_soft")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(strict, soft)
        for batch in batches:
            found = [hits(a, x) for x in batch.column(url).to_pylist()]
            columns = [*batch.columns, *(pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "n_strict", "n_soft"])

    counted = with_host.mapInArrow(count, schema)
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when((F.col("n_strict") >= 1) | (F.col("n_soft") >= soft_limit), F.lit("block")).otherwise(F.lit("allow"))
    return counted.withColumns({"rule": rule, "verdict": F.coalesce(verdict, by_method)})


def oracle() -> str:
    """DuckDB SQL for the registered query."""
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    any_hit = lambda terms: " + ".join(f"CAST(regexp_matches(l, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS BIGINT)" for t in terms)
    rule, verdict = "NULL", "NULL"
    for kind, h, p in sorted(RULES, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1] + r[2])):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{h + p}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{kind}' ELSE {verdict} END"
    return f"""
    WITH r AS (SELECT page_id, {low.format("coalesce(url, '')")} AS l,
                      regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') AS rest FROM pages),
    h AS (SELECT page_id, l, {low.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
    n AS (SELECT *, {any_hit(STRICT_TERMS)} AS n_strict, {any_hit([t for t in SOFT_TERMS if t not in STRICT_TERMS])} AS n_soft FROM h)
    SELECT page_id, host, path, {rule} AS rule,
           coalesce({verdict}, CASE WHEN n_strict >= 1 OR n_soft >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
           n_strict, n_soft
    FROM n"""
