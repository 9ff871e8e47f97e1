"""Dictionary names in free text: a token trie, scoped negation, and the pieces between.

Texts are cut into tokens and boundaries (marks that end a clause or sentence, line
ends).  ``find`` gives every mention of a name, of whatever length, at whatever
place; of mentions that lie one in another only the longest stays.

The dictionary's names form a trie over tokens.  It is held as sorted arrays: an edge
is (node, token) -> node, and a batch of texts walks it in step: all places that are
still on a path take one more token by one sorted lookup, until none is left.  That
is linear in the places and the depth of the paths that the text itself follows.
Tries are bounded: names are cut into dictionaries of at most ``NAMES``; each is one
pass over the texts, which hands its mentions to the next, so mentions and pieces are the
same for every number of passes.

Negation has a scope.  A boundary or a turning word ("but") ends it.  In it, a cue
before a mention ("no", "denies") or after it ("was ruled out") negates it, and
pseudo cues ("no increase") do not, as of cues that begin at one place only the
longest counts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.sources.shared import written

#: Names of one trie.
NAMES = 500_000
#: Characters of the texts that are walked at once; one longer text is never cut.
CHARS = 1 << 20

#: A token, with marks inside it ("1.5"), or a boundary; wide spaces are plain ones after NFKC.
PATTERN = r"""[^ \t\n\x0B\x0C\r.,;:!?()\[\]{}"]+(?:[.,:][^ \t\n\x0B\x0C\r.,;:!?()\[\]{}"]+)*|[.;:!?\n]"""
TOKEN = re.compile(PATTERN)
BOUNDARY = frozenset(".;:!?\n")

# Cues of negation in clinical English.
BEFORE = (
    "no", "not", "without", "denies", "denied", "denying", "negative for", "absence of", "no evidence of", "no sign of", "no signs of", "free of", "never had", "never",
    "rules out", "ruled out for", "rule out", "lack of", "lacks", "cannot", "neither", "nor",
)
AFTER = ("was ruled out", "were ruled out", "is ruled out", "ruled out", "is absent", "was absent", "were absent", "are absent", "absent", "unlikely", "not present", "was negative", "is negative", "were negative", "not seen", "not found", "excluded")
PSEUDO = ("no increase", "no change", "no further", "not only", "not necessarily", "not certain if", "no doubt", "not cause", "not drain", "gram negative", "without difficulty")
TURNS = ("but", "however", "although", "though", "except", "apart from", "aside from", "nevertheless", "still", "yet", "which", "secondary to", "due to", "because")
#: Words at which a piece between mentions is cut.
FUNCTION = frozenset("a an the and or of with has had have is was were are be been showed shows in on at to for by from as that this his her their".split())


def tokens_of(text: str | None) -> list[str]:
    """Tokens and boundaries of the NFKC, lower-case form."""
    if not text:
        return []
    return TOKEN.findall((text if text.isascii() else unicodedata.normalize("NFKC", text)).lower())


class Trie:
    """Phrases as paths of token numbers; ``value`` of a node is the phrase that ends there, or -1."""

    def __init__(self, phrases: Iterable[list[str]]) -> None:
        self.numbers: dict[str, int] = {}
        step: dict[int, int] = {}
        ends: dict[int, int] = {}
        nodes = 1
        for i, phrase in enumerate(phrases):
            node = 0
            for token in phrase:
                k = self.numbers.setdefault(token, len(self.numbers) + 1)
                edge = node << 32 | k
                if edge not in step:
                    step[edge] = nodes
                    nodes += 1
                node = step[edge]
            if phrase:
                ends.setdefault(node, i)
        edges = np.fromiter(step, dtype=np.int64, count=len(step))
        order = np.argsort(edges)
        self.edges, self.child = edges[order], np.fromiter(step.values(), dtype=np.int64, count=len(step))[order]
        self.value = np.full(nodes, -1, dtype=np.int64)
        self.value[list(ends)] = list(ends.values())

    def number(self, tokens: Iterable[str]) -> np.ndarray:
        get = self.numbers.get
        return np.array([get(t, 0) for t in tokens], dtype=np.int64)

    def longest(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and phrase of the longest phrase from each place that begins one; 0 in ``numbers`` is in no phrase."""
        size, which = np.zeros(numbers.size, dtype=np.int64), np.full(numbers.size, -1, dtype=np.int64)
        at = np.flatnonzero(numbers)
        node, k = np.zeros(at.size, dtype=np.int64), 0
        while at.size and self.edges.size:
            inside = at + k < numbers.size
            at, node = at[inside], node[inside]
            edge = node << 32 | numbers[at + k]
            j = np.minimum(np.searchsorted(self.edges, edge), self.edges.size - 1)
            on = self.edges[j] == edge
            at, node, k = at[on], self.child[j[on]], k + 1
            named = self.value[node] >= 0
            size[at[named]], which[at[named]] = k, self.value[node[named]]
        begin = np.flatnonzero(size)
        return begin, begin + size[begin], which[begin]


def outermost(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each range, in order of begin, lies in none before it."""
    if not begin.size:
        return np.zeros(0, dtype=bool)
    reach = np.concatenate((np.full(1, -1), np.maximum.accumulate(end)[:-1]))
    return end > reach


_CUES = [(w, kind) for kind, ws in (("before", BEFORE), ("after", AFTER), ("pseudo", PSEUDO), ("turn", TURNS)) for w in ws]


class Scopes:
    """The cues of a run of tokens, and what they negate."""

    trie = Trie([w.split() for w, _ in _CUES])
    kinds = np.array([("before", "after", "pseudo", "turn").index(k) for _, k in _CUES])

    def __init__(self, tokens: list[str], bounds: np.ndarray) -> None:
        begin, end, which = self.trie.longest(self.trie.number(tokens))
        kind = self.kinds[which]
        self.cues = begin, end
        turn = begin[kind == 3]
        marks = np.zeros(bounds.size + 1, dtype=np.int64)
        marks[1:] += bounds  # a scope begins after its boundary, and at a turning word
        marks[turn] += 1
        self.scope = np.cumsum(marks)
        n = int(self.scope[-1]) + 1
        self.first_before = np.full(n, np.iinfo(np.int64).max)
        self.last_after = np.full(n, -1)
        for k, at, put, where in ((0, end, np.minimum, self.first_before), (1, begin, np.maximum, self.last_after)):
            mine = kind == k
            put.at(where, self.scope[begin[mine]], at[mine])

    def negates(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A cue that ends before the range, or one that begins after it, in the scope of its first token."""
        s = self.scope[begin]
        return (self.first_before[s] <= begin) | (self.last_after[s] >= end)


def _pieces(tokens: list[str], covered: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of tokens that are in no mention, cut at boundaries, function words and cues."""
    stop = bounds | covered | np.fromiter((t in FUNCTION for t in tokens), dtype=bool, count=len(tokens))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], stop, [True])).astype(np.int8)))
    yield from zip(edges[0::2].tolist(), edges[1::2].tolist())


def _walked(texts: list[str | None], trie: Trie) -> Iterator[tuple]:
    """For each text with tokens: number, tokens, boundaries, and begin, end, name and negation of its mentions.

    Texts of about ``CHARS`` characters walk the trie together, a boundary between each two.
    """
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop] or "") <= CHARS):
            size += len(texts[stop] or "")
            stop += 1
        each = [tokens_of(t) for t in texts[start:stop]]
        flat = [t for ts in each for t in (*ts, "\n")]
        bounds = np.fromiter((t in BOUNDARY for t in flat), dtype=bool, count=len(flat))
        scopes = Scopes(flat, bounds)
        begin, end, which = trie.longest(trie.number(flat))
        keep = outermost(begin, end)
        begin, end, which = begin[keep], end[keep], which[keep]
        no = scopes.negates(begin, end)
        first = np.concatenate(([0], np.cumsum([len(ts) + 1 for ts in each])))
        cut = np.searchsorted(begin, first)
        for i, ts in enumerate(each):
            a, b, low = cut[i], cut[i + 1], first[i]
            yield start + i, ts, bounds[low : low + len(ts)], begin[a:b] - low, end[a:b] - low, which[a:b], no[a:b], _Part(scopes, int(low))
        start = stop


class _Part:
    """The scopes of one text among others."""

    def __init__(self, scopes: Scopes, low: int) -> None:
        self.scopes, self.low = scopes, low

    def negates(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.scopes.negates(begin + self.low, end + self.low)

    def cues(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the cues of a text with so many tokens."""
        begin, end = self.scopes.cues
        a, b = np.searchsorted(begin, (self.low, self.low + size))
        return begin[a:b] - self.low, end[a:b] - self.low


def _tries(names: DataFrame, name: str, most: int) -> Iterator[tuple[Trie, list[str]]]:
    """Tries of at most ``most`` names each; equal token sequences are one name, the first by text."""
    each = names.select(F.col(name).alias("n")).where("n is not null").distinct()
    parts = max(1, -(-each.count() // most))
    for k in range(parts):
        mine = each if parts == 1 else each.where(F.pmod(F.xxhash64("n"), F.lit(parts)) == k)
        found = sorted(r["n"] for r in mine.collect())  # at most about ``most`` names
        yield Trie([[t for t in tokens_of(n)] for n in found]), found


def _hits(found: tuple, names: list[str], before: tuple | None) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Begin, end, name and negation of a text's mentions, with those of the passes before.

    Of mentions that lie one in another the longest stays, of equal ones the first name by
    text: what one trie of all names gives.
    """
    _, _, _, begin, end, which, no, scopes = found
    own = [names[w] for w in which.tolist()]
    if before is None or not before[0]:
        return begin, end, own, no
    kept, reach = [], -1
    for b, e, n in sorted([*zip(begin.tolist(), (-end).tolist(), own), *((b, -e, n) for b, e, n in zip(*before))]):
        if -e > reach:
            kept.append((b, -e, n))
            reach = -e
    begin, end = (np.array([x[k] for x in kept], dtype=np.int64) for k in (0, 1))
    return begin, end, [x[2] for x in kept], scopes.negates(begin, end)


def _texts_of(batch: pa.RecordBatch, trie: Trie, found: list[str]) -> Iterator[tuple]:
    """What ``_walked`` and ``_hits`` give for each text of a batch of key, text and, after the first pass, earlier mentions."""
    before = list(zip(*(batch.column(c).to_pylist() for c in range(2, 5)))) if batch.num_columns > 2 else None
    for walked in _walked(batch.column(1).to_pylist(), trie):
        yield walked, _hits(walked, found, before and before[walked[0]])


def _passes(texts: DataFrame, names: DataFrame, key: str, text: str, name: str, most: int) -> tuple[DataFrame, Broadcast]:
    """The last dictionary, and key and text with the mentions of all dictionaries before it.

    Each of those is a pass of its own, and is written, so a task holds one trie at a time.
    """
    spark, kind = texts.sparkSession, texts.schema[key].dataType.simpleString()
    at = texts.select(key, text)
    held = None
    for each in _tries(names, name, most):
        if held is not None:

            def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
                trie, found = held.value
                for batch in batches:
                    rows = [([], [], [])] * batch.num_rows
                    for walked, (begin, end, own, _) in _texts_of(batch, trie, found):
                        rows[walked[0]] = (begin.tolist(), end.tolist(), own)
                    hits = [pa.array([r[k] for r in rows], pa.list_(t)) for k, t in enumerate((pa.int32(), pa.int32(), pa.string()))]
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *hits], names=[key, text, "_begin", "_end", "_name"])

            at = written(at.mapInArrow(run, f"`{key}` {kind}, `{text}` string, _begin array<int>, _end array<int>, _name array<string>"), "mentions")
        held = spark.sparkContext.broadcast(each)  # bounded by ``most``
    return at, held


def find(texts: DataFrame, names: DataFrame, key: str = "id", text: str = "text", name: str = "name", most: int = NAMES) -> DataFrame:
    """key, begin, end (tokens, from 0), name and negated of every mention.

    Null texts have none.  Names without tokens are never found.  How many passes the
    names take makes no difference to the mentions.
    """
    kind = texts.schema[key].dataType.simpleString()
    at, held = _passes(texts, names, key, text, name, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, found = held.value
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for walked, (begin, end, own, no) in _texts_of(batch, trie, found):
                if begin.size:
                    for column, values in zip(rows, ([walked[0]] * begin.size, begin.tolist(), end.tolist(), own, no.tolist())):
                        column.extend(values)
            taken = batch.column(0).take(pa.array(rows[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([taken, pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.string()), pa.array(rows[4], pa.bool_())], names=[key, "begin", "end", "name", "negated"])

    return at.mapInArrow(run, f"`{key}` {kind}, begin long, end long, name string, negated boolean")


def pieces(texts: DataFrame, names: DataFrame, key: str = "id", text: str = "text", name: str = "name", negated: bool = False, most: int = NAMES) -> DataFrame:
    """key and piece: what stands between mentions of any name, cut at marks, function words and cues.

    For fuzzy matching.  A piece may have any number of words.  With ``negated``
    pieces in the scope of a negation come too.
    """
    kind = texts.schema[key].dataType.simpleString()
    rows, held = _passes(texts, names, key, text, name, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, names = held.value
        for batch in batches:
            at, found = [], []
            for (i, tokens, bounds, *_, scopes), (begin, end, _, _) in _texts_of(batch, trie, names):
                if not tokens:
                    continue
                covered = np.zeros(len(tokens) + 1, dtype=np.int64)
                np.add.at(covered, begin, 1)
                np.add.at(covered, end, -1)
                cues, cue_end = scopes.cues(len(tokens))
                np.add.at(covered, cues, 1)
                np.add.at(covered, cue_end, -1)
                runs = list(_pieces(tokens, np.cumsum(covered)[:-1] > 0, bounds))
                if runs:
                    a, b = (np.array(x, dtype=np.int64) for x in zip(*runs))
                    for p, q, no in zip(a.tolist(), b.tolist(), scopes.negates(a, b).tolist()):
                        if negated or not no:
                            at.append(i)
                            found.append(" ".join(tokens[p:q]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.string())], names=[key, "piece"])

    return rows.mapInArrow(run, f"`{key}` {kind}, piece string")
