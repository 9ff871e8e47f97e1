"""Entities by similarity of term sets, each patient against all of them, without a row for each pair.

A patient's score with an entity is the mean of two best-match averages: over the
patient's terms the best similarity to any of the entity's, and the other way round.
``Profiles`` holds the ontology's closure and the entities' terms as sorted arrays;
a task keeps them and takes one patient after the other:

1. The truth's score s comes first.
2. Ancestors of the patient's terms are taken by falling information.  An ancestor
   that an entity's terms lie below raises what the entity may score; the terms of an
   entity below the first k ancestors are no more than the sum of its counts below
   each, and no less than the largest.  That gives an upper and a lower bound of each
   entity's score.
3. The search ends when what is left cannot lift any entity to s.  Entities surely
   above or below s are counted; only those in between are scored exactly.

So ranks and areas are exact, near-root ancestors (which all entities share, with
next to no information) are one vector each and never a join key, and what leaves a
task is one row for each patient.  The arrays are built for at most ``ROWS`` profile
rows at once; more entities are cut into shards, each a pass over the patients, and
counts of the passes add up.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.sources.shared import written
from caseloom.sources.tables import numbered

#: Profile rows of one shard, and rows of the closure that a task may hold (4 bytes each).
ROWS, CLOSURE = 5_000_000, 40_000_000
#: Profile rows whose ancestors are looked up at once; tasks for each core.
CHUNK, TASKS = 1 << 17, 4
#: Profile rows whose values are gathered at once: they stay in the cache.
CACHED = 1 << 15
#: Patients whose sums over all profiles are made at once, and values that this may hold (8 bytes each).
SIDE, VALUES = 32, 1 << 23
#: An ancestor of more than this share of the vocabulary is a wide one.
WIDE = 1 / 256
DIGITS = 9
MARGIN = 1e-7


def _lists(key: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of key k at ``[starts[k], starts[k + 1])``."""
    order = np.lexsort((value, key))
    return np.searchsorted(key[order], np.arange(n + 1)), value[order]


class Profiles:
    """Closure, information and term sets as arrays.  Terms and entities are numbered in order of their names."""

    def __init__(self, closure: tuple[list, list], ic: tuple[list, list], profiles: tuple[list, list], method: str) -> None:
        self.terms = {t: k for k, t in enumerate(sorted({*closure[0], *closure[1], *profiles[1]}))}
        of = lambda xs: np.fromiter((self.terms[x] for x in xs), dtype=np.int64, count=len(xs))
        told = np.zeros(len(self.terms))
        told[of(ic[0])] = ic[1]
        term, ancestor = of(closure[0]), of(closure[1])
        kept = told[ancestor] > 0  # others add nothing
        names = sorted(set(profiles[0]))
        number = {e: k for k, e in enumerate(names)}
        self._build(*_lists(term[kept], ancestor[kept], len(self.terms)), told, names, np.array([number[e] for e in profiles[0]], dtype=np.int64), of(profiles[1]), method)

    @classmethod
    def of_numbers(cls, *arrays) -> Profiles:
        """The same from what ``_build`` takes; terms are asked for by number, -1 being an unknown one."""
        self = cls.__new__(cls)
        self.terms = None
        self._build(*arrays)
        return self

    def _build(self, up_start: np.ndarray, up: np.ndarray, ic: np.ndarray, names: list[str], entity: np.ndarray, term: np.ndarray, method: str) -> None:
        self.up_start, self.up, self.ic, self.method, self.entities = up_start, up, ic, method, names
        self.number = {e: k for k, e in enumerate(names)}
        n, m = ic.size, len(names)
        rows = np.unique(entity.astype(np.int64) * n + term)
        entity = rows // n
        rows -= entity * n  # terms
        self.start = np.searchsorted(entity, np.arange(m + 1))
        self.size = np.diff(self.start)
        place = np.zeros(n, dtype=np.int32)
        place[rows] = 1
        self.vocabulary = np.flatnonzero(place)
        place[self.vocabulary] = np.arange(self.vocabulary.size)
        self.back = place[rows]
        del rows, entity, place
        self.own = ic[self.vocabulary]
        # runs of whole entities of about CACHED rows
        cuts = np.unique(np.append(np.searchsorted(self.start, np.arange(0, self.back.size, CACHED)), m)).tolist()
        self.runs = list(zip(cuts[:-1], cuts[1:]))
        self.kind = None  # made where it is asked for
        self.buffer = np.empty(max((int(self.start[b] - self.start[a]) for a, b in self.runs), default=0))
        self.mark = np.full(n, -1.0)  # least information of a patient's terms below each ancestor, while they are asked for
        self.asked, self.held = np.zeros(self.vocabulary.size, dtype=bool), np.empty(self.vocabulary.size)  # used again for each patient
        # the vocabulary below each ancestor
        width, at = self._above(self.vocabulary)
        pairs = self.up[at].astype(np.int64)
        pairs <<= 32
        pairs |= np.repeat(np.arange(self.vocabulary.size, dtype=np.int32), width)
        pairs.sort()
        self.under = pairs.astype(np.int32)  # the lower half
        pairs >>= 32
        self.under_start = np.searchsorted(pairs, np.arange(n + 1))
        del pairs, at, width
        self._reach(n, m)

    def _reach(self, n: int, m: int) -> None:
        """The entities below each ancestor, with how many of their terms and the least information of these.

        Made for a run of entities at a time, by one sort of numbers, and kept in the smallest
        types that hold them: ``least`` has places in ``levels``.
        """
        self.levels, code = np.unique(self.own, return_inverse=True)
        if self.method == "resnik":  # asks for no least information
            self.levels, code = np.zeros(1), np.zeros_like(code)
        bits = int(self.levels.size - 1).bit_length()
        cuts = np.unique(np.append(np.searchsorted(self.start, np.arange(0, self.back.size, CHUNK)), m)).tolist()
        kinds = [np.min_scalar_type(x) for x in (m, int(self.size.max(initial=0)), self.levels.size)]
        parts, total = [], np.zeros(n, dtype=np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            held = self.back[self.start[a] : self.start[b]]
            width, at = self._above(self.vocabulary[held])
            wide = (b - a).bit_length()
            key = self.up[at].astype(np.int64)
            key <<= wide
            key |= np.repeat(np.repeat(np.arange(b - a), self.size[a:b]), width)
            key <<= bits
            key |= np.repeat(code[held], width)
            key.sort()
            pair = key >> bits
            first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: pair.size])
            pair = pair[first]
            t = (pair >> wide).astype(np.int32)
            pair &= (1 << wide) - 1
            parts.append((t, (pair + a).astype(kinds[0]), np.diff(first, append=key.size).astype(kinds[1]), (key[first] & ((1 << bits) - 1)).astype(kinds[2]) if bits else None))
            total += np.bincount(t, minlength=n)
        self.below_start = np.append(0, np.cumsum(total))
        size = int(self.below_start[-1])
        self.below, self.many, self.least = np.empty(size, kinds[0]), np.empty(size, kinds[1]), np.empty(size if bits else 0, kinds[2])
        put = self.below_start[:-1].copy()
        for k in range(len(parts)):
            t, e, many, least = parts[k]
            parts[k] = None
            new = np.flatnonzero(np.append(True, t[1:] != t[:-1])[: t.size])
            width = np.diff(new, append=t.size)
            to = np.repeat(put[t[new]] - new, width) + np.arange(t.size)
            put[t[new]] += width
            self.below[to], self.many[to] = e, many
            if bits:
                self.least[to] = least

    def _above(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ancestors each term has, and where they stand in ``up``."""
        width = self.up_start[terms + 1] - self.up_start[terms]
        return width, np.repeat(self.up_start[terms] - np.cumsum(width) + width, width) + np.arange(width.sum())

    def ancestors(self, term: int) -> np.ndarray:
        return self.up[self.up_start[term] : self.up_start[term + 1]]

    def _known(self, terms: list) -> np.ndarray:
        own = [t for t in terms if t >= 0] if self.terms is None else [self.terms[t] for t in terms if t in self.terms]
        return np.array(own, dtype=np.int64)

    def _score(self, m: np.ndarray | float, ia: np.ndarray | float, ib: np.ndarray | float) -> np.ndarray:
        """Similarity by shared (above 0, as all of ``up`` has) and own information: no less for more shared, no more for more of its own."""
        if self.method == "resnik":
            return m
        both = ia + ib
        if self.method == "jc":
            return 1 / (1 + np.maximum(both - 2 * m, 0))
        lin = 2 * m / both
        return lin if self.method == "lin" else lin * -np.expm1(-m)

    def _rising(self, up: np.ndarray) -> list[int]:
        return up[np.argsort(self.ic[up], kind="stable")].tolist()

    def _least(self, at: slice | np.ndarray) -> np.ndarray | float:
        return self.levels[self.least[at]] if self.least.size else float(self.levels[0])

    def _best(self, a: int) -> np.ndarray:
        """Best similarity of a term to any of each entity's: below each ancestor it is the term with least information."""
        best = np.zeros(len(self.entities))
        for t in self._rising(self.ancestors(a)):
            at = slice(self.below_start[t], self.below_start[t + 1])
            e = self.below[at]
            best[e] = self.ic[t] if self.method == "resnik" else np.maximum(best[e], self._score(self.ic[t], self.ic[a], self._least(at)))
        return best

    def _column(self, known: np.ndarray) -> np.ndarray:
        """Best similarity of each term of the vocabulary to any of the patient's: through an ancestor it is the one with least information."""
        least: dict[int, float] = {}
        for a in known[np.argsort(-self.ic[known], kind="stable")].tolist():
            least |= dict.fromkeys(self.ancestors(a).tolist(), self.ic[a])
        column = np.zeros(self.vocabulary.size)
        for t in self._rising(np.fromiter(least, dtype=np.int64, count=len(least))):
            b = self.under[self.under_start[t] : self.under_start[t + 1]]
            column[b] = self.ic[t] if self.method == "resnik" else np.maximum(column[b], self._score(self.ic[t], least[t], self.own[b]))
        return column

    def scores(self, terms: list, which: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
        """Exact scores of these entities, rounded to ``DIGITS``."""
        if not which.size or not terms:
            return np.zeros(which.size)
        if 2 * which.size > len(self.entities) and which.size < len(self.entities):
            return self.scores(terms, np.arange(len(self.entities)), row)[which]
        known, width = self._known(terms), self.size[which]
        if which.size == len(self.entities):  # in order
            sums = self._sums(self._column(known))
        else:
            first = np.cumsum(width) - width
            at = self.back[np.repeat(self.start[which] - first, width) + np.arange(width.sum())]
            sums = np.add.reduceat(self._places(known, at), first)
        own = (self._row(known) if 16 * which.size > len(self.entities) else self._row_of(known, which)) if row is None else row
        return np.round(((own if own.size == which.size else own[which]) / len(terms) + sums / width) / 2, DIGITS)

    def _places(self, known: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``_column`` at these places of the vocabulary, without the others where they are many more."""
        up = np.unique(np.concatenate([np.zeros(0, dtype=self.up.dtype), *(self.ancestors(a) for a in known.tolist())]))
        if 64 * at.size < self.vocabulary.size:
            some = np.unique(at)
        else:
            self.asked[at] = True
            some = np.flatnonzero(self.asked)
            self.asked[some] = False
        terms = self.vocabulary[some]
        if not up.size or int((self.up_start[terms + 1] - self.up_start[terms]).sum()) > self.vocabulary.size + int((self.under_start[up + 1] - self.under_start[up]).sum()):
            return self._column(known)[at]
        for a in known[np.argsort(-self.ic[known], kind="stable")].tolist():
            self.mark[self.ancestors(a)] = self.ic[a]
        width, flat = self._above(terms)
        t = self.up[flat]
        told = self.mark[t]
        self.mark[up] = -1
        hit = np.flatnonzero(told >= 0)
        t, owner = t[hit], np.repeat(np.arange(some.size), width)[hit]
        value = self.ic[t] if self.method == "resnik" else self._score(self.ic[t], told[hit], self.own[some[owner]])
        self.held[some] = 0
        if hit.size:
            new = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            self.held[some[owner[new]]] = np.maximum.reduceat(value, new)
        return self.held[at]

    def _row_of(self, known: np.ndarray, which: np.ndarray) -> np.ndarray:
        """``_row`` of a few entities, looked up below each ancestor."""
        row, asked = np.zeros(which.size), which.astype(self.below.dtype)
        for a in known.tolist():
            best = np.zeros(which.size)
            for t in self._rising(self.ancestors(a)):
                low, high = self.below_start[t], self.below_start[t + 1]
                at = np.searchsorted(self.below[low:high], asked)
                hit = np.flatnonzero(at < high - low)
                hit = hit[self.below[low + at[hit]] == asked[hit]]
                best[hit] = self.ic[t] if self.method == "resnik" else np.maximum(best[hit], self._score(self.ic[t], self.ic[a], self._least(low + at[hit])))
            row += best
        return row

    def _sums(self, column: np.ndarray) -> np.ndarray:
        """Sum of the column's values over the terms of every entity, a run of entities after the other."""
        sums = np.empty(len(self.entities))
        for a, b in self.runs:
            low, high = self.start[a], self.start[b]
            held = self.buffer[: high - low]
            np.take(column, self.back[low:high], out=held, mode="clip")  # numbers are within; the mode saves a copy
            np.add.reduceat(held, self.start[a:b] - low, out=sums[a:b])
        return sums

    def _sort_out(self) -> None:
        """Kinds of terms: of one kind are those with the same wide ancestors and the same information.

        What wide ancestors give depends on the kind alone, so profiles are held as how many
        terms of each kind an entity has.  The entities of each term are for what the others give.
        """
        self.wide = np.diff(self.under_start) > WIDE * self.vocabulary.size
        width, at = self._above(self.vocabulary)
        up, owner = self.up[at], np.repeat(np.arange(self.vocabulary.size), width)
        kept = self.wide[up]
        up, owner = up[kept].astype(np.int32), owner[kept]
        cut = np.searchsorted(owner, np.arange(self.vocabulary.size + 1)).tolist()
        numbers: dict[bytes, int] = {}
        held = memoryview(up).cast("B")
        kind = np.array([numbers.setdefault(bytes(held[4 * a : 4 * b]), len(numbers)) for a, b in zip(cut[:-1], cut[1:])], dtype=np.int64)
        levels, code = (np.zeros(1), 0) if self.method == "resnik" else np.unique(self.own, return_inverse=True)
        _, first, self.kind = np.unique(kind * levels.size + code, return_index=True, return_inverse=True)
        n = first.size
        self.kind_own = self.own[first]
        cut = np.array(cut)
        many = cut[first + 1] - cut[first]
        flat = np.repeat(cut[first] - np.cumsum(many) + many, many) + np.arange(many.sum())
        self.kinds_start, self.kinds = _lists(up[flat], np.repeat(np.arange(n), many), self.ic.size)
        entity = np.repeat(np.arange(len(self.entities)), self.size)
        key, count = np.unique(entity * n + self.kind[self.back], return_counts=True)
        self.row_start = np.searchsorted(key, np.arange(len(self.entities) + 1) * n)
        self.row_kind, self.row_count = key % n, count.astype(np.float64)[None]
        order = np.argsort(self.back, kind="stable")
        self.have = entity[order].astype(self.below.dtype)
        self.have_start = np.append(0, np.cumsum(np.bincount(self.back, minlength=self.vocabulary.size)))
        cuts = np.unique(np.append(np.searchsorted(self.row_start, np.arange(0, key.size, CACHED // 8)), len(self.entities))).tolist()
        self.short = list(zip(cuts[:-1], cuts[1:]))

    def blocks(self, patients: list[list]) -> Iterator[np.ndarray]:
        """``scores`` with all entities, a row for each patient; sums over profiles are made for several patients side by side.

        Profiles are read as kinds of terms, once for all of these patients; each patient's
        ancestors of few terms then add what they give beyond that.
        """
        if self.kind is None:
            self._sort_out()
        side = max(1, min(SIDE, VALUES // max(1, self.kind_own.size)))
        for i in range(0, len(patients), side):
            some = patients[i : i + side]
            known = [self._known(t) for t in some]
            for t, own, sums in zip(some, known, self._side(known)):
                yield np.round((self._row(own) / len(t) + sums / self.size) / 2, DIGITS) if t else np.zeros(len(self.entities))

    def _side(self, known: list[np.ndarray]) -> np.ndarray:
        """Sums over all profiles of the patients' columns, a row for each."""
        values = np.zeros((self.kind_own.size, len(known)))
        for j, k in enumerate(known):
            column = np.zeros(self.kind_own.size)
            for t, least in self._told(k, True):
                c = self.kinds[self.kinds_start[t] : self.kinds_start[t + 1]]
                column[c] = np.maximum(column[c], self.ic[t] if self.method == "resnik" else self._score(self.ic[t], least, self.kind_own[c]))
            values[:, j] = column
        sums = np.zeros((len(self.entities), len(known)))
        buffer = np.empty((max((int(self.row_start[b] - self.row_start[a]) for a, b in self.short), default=0), len(known)))
        for a, b in self.short:
            low = self.row_start[a]
            held = buffer[: self.row_start[b] - low]
            np.take(values, self.row_kind[low : self.row_start[b]], axis=0, out=held, mode="clip")  # numbers are within; the mode saves a copy
            count = self.row_count[:, low : self.row_start[b]]
            cut = (self.row_start[a : b + 1] - low).tolist()
            for e in range(b - a):
                np.dot(count[:, cut[e] : cut[e + 1]], held[cut[e] : cut[e + 1]], out=sums[a + e : a + e + 1])
        sums = np.ascontiguousarray(sums.T)
        for j, k in enumerate(known):
            self._add_narrow(sums[j], values[:, j], self._told(k, False))
        return sums

    def _told(self, known: np.ndarray, wide: bool) -> list[tuple[int, float]]:
        """The ancestors of these terms that are wide ones, or the others, with the least information of the terms below each."""
        least: dict[int, float] = {}
        for a in known[np.argsort(-self.ic[known], kind="stable")].tolist():
            up = self.ancestors(a)
            least |= dict.fromkeys(up[self.wide[up] == wide].tolist(), self.ic[a])
        return list(least.items())

    def _add_narrow(self, sums: np.ndarray, column: np.ndarray, narrow: list[tuple[int, float]]) -> None:
        """Adds what these ancestors give to each entity's sum beyond the values of the kinds."""
        below = [self.under[self.under_start[t] : self.under_start[t + 1]] for t, _ in narrow]
        if not below:
            return
        some = np.unique(np.concatenate(below))
        before = column[self.kind[some]]
        self.held[some] = before
        for (t, least), b in zip(narrow, below):
            self.held[b] = np.maximum(self.held[b], self.ic[t] if self.method == "resnik" else self._score(self.ic[t], least, self.own[b]))
        more = self.held[some] - before
        some, more = some[more > 0], more[more > 0]
        width = self.have_start[some + 1] - self.have_start[some]
        at = np.repeat(self.have_start[some] - np.cumsum(width) + width, width) + np.arange(width.sum())
        sums += np.bincount(self.have[at], np.repeat(more, width), minlength=sums.size)

    def _row(self, known: np.ndarray) -> np.ndarray:
        """Sum of the best similarities of the patient's terms, for each entity."""
        row = np.zeros(len(self.entities))
        for a in known.tolist():
            row += self._best(a)
        return row

    def _bounds(self, terms: list, enough: float, row: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores; the upper ones are only as good as it takes to fall below ``enough``."""
        known, m = self._known(terms), len(self.entities)
        if self.method != "resnik" and (self.ic[known] == 0).any():  # no item has such a term, so what it gives has no bound by information
            return np.full(m, -np.inf), np.full(m, np.inf)
        # what a match through each ancestor may give, to the patient's term a, at most: ic(b) >= ic of the ancestor
        cap = np.zeros(self.ic.size)
        for a in known.tolist():
            np.maximum.at(cap, self.ancestors(a), self._score(self.ic[self.ancestors(a)], self.ic[a], self.ic[self.ancestors(a)]))
        row = self._row(known) if row is None else row
        up = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *(self.ancestors(a) for a in known.tolist())]))
        up = up[np.argsort(-cap[up], kind="stable")]
        values = np.append(cap[up], 0.0)
        share = row / max(1, len(terms))
        most, high = np.zeros(m), np.zeros(m)  # terms of each entity below any of the ancestors so far, and what they give
        alive = open_ = None  # those that may still reach ``enough``, once an ancestor stands above many
        for k, t in enumerate(up.tolist()):
            at, stop = self.below_start[t], self.below_start[t + 1]
            if stop - at > m // 16 and (alive is None or stop - at > alive.size):
                mine = slice(None) if alive is None else alive
                top = high[mine] + values[k] * (self.size[mine] - np.minimum(most[mine], self.size[mine]))
                left = share[mine] + top / self.size[mine] >= 2 * (enough - MARGIN)
                every = np.arange(m) if alive is None else alive
                high[every[~left]] = top[~left]
                alive = every[left]
                if not alive.size:
                    break
                open_ = np.zeros(m, dtype=bool)
                open_[alive] = True
            if alive is not None and stop - at > 16 * alive.size:
                place = np.minimum(np.searchsorted(self.below[at:stop], alive.astype(self.below.dtype)), stop - at - 1) + at
                hit = self.below[place] == alive
                e, n = alive[hit], self.many[place[hit]]
            else:
                e, n = self.below[at:stop].astype(np.intp), self.many[at:stop]
                if alive is not None:
                    keep = open_[e]
                    e, n = e[keep], n[keep]
            size, before = self.size[e], most[e]
            now = before + n
            most[e] = now
            high[e] += values[k] * (np.minimum(now, size) - np.minimum(before, size))
        return share / 2, (share + high / self.size) / 2

    def standing(self, terms: list, truth: str, s: float) -> tuple[int, int, int, int]:
        """Entities but the truth that score more than s, the same, the same with a smaller id, and less."""
        if not self.entities:
            return 0, 0, 0, 0
        row = self._row(self._known(terms))
        low, high = self._bounds(terms, s, row)
        own = self.number.get(truth, -1)
        above, below = low > s + MARGIN, high < s - MARGIN
        if own >= 0:
            above[own] = below[own] = False
        open_ = np.flatnonzero(~above & ~below)
        open_ = open_[open_ != own]
        score = self.scores(terms, open_, row)
        same = open_[score == s]
        names = [self.entities[k] for k in same.tolist()]
        return int(above.sum() + (score > s).sum()), same.size, sum(x < truth for x in names), int(below.sum() + (score < s).sum())


def numbers_of(profiles: DataFrame, closed: DataFrame) -> DataFrame:
    """term and number, from 0 on, of every term of the ontology and the profiles."""
    every = closed.select("term").union(closed.select("ancestor")).union(profiles.select("term")).dropna().distinct()
    return written(numbered(every, ["term"], "number").select("term", (F.col("number") - 1).cast("int").alias("number")), "numbers")


def rows_of(profiles: DataFrame, known: bool) -> DataFrame:
    """The profiles' distinct rows; with ``known`` they are that already, and are not shuffled again."""
    return profiles if known else profiles.select("entity_id", "term").dropna().distinct()


def _shards(profiles: DataFrame, closed: DataFrame, ic: DataFrame, numbers: DataFrame, method: str, rows: int) -> Iterator:
    """Broadcasts for ``Profiles``, one for each shard of entities of about ``rows`` rows, and one of the ontology.

    They go out as numbers; what passes at once is the informative part of the closure
    (checked by ``fits``) or the rows of one shard.
    """
    spark = profiles.sparkSession
    own = written(profiles.join(numbers, "term").select("entity_id", "number"), "profiles")
    told = written(ic.where("ic > 0").join(numbers, "term").select("term", "number", "ic"), "told")
    up = closed.join(told.select(F.col("term").alias("ancestor"), F.col("number").alias("up")), "ancestor").join(numbers, "term")
    lists = up.groupBy("number").agg(F.collect_set("up").alias("up")).toArrow().combine_chunks()
    n = numbers.count()
    width, values = np.zeros(n, dtype=np.int64), np.zeros(0, dtype=np.int32)
    if lists.num_rows:
        held = lists.column("up").combine_chunks()
        number, many = lists.column("number").to_numpy(), np.diff(held.offsets.to_numpy())
        width[number] = many
        order = np.argsort(number)
        at = held.offsets.to_numpy()[:-1][order].astype(np.int64)
        many = many[order].astype(np.int64)
        values = held.values.to_numpy()[np.repeat(at - np.cumsum(many) + many, many) + np.arange(many.sum())]
    information = np.zeros(n)
    got = told.select("number", "ic").toArrow()
    information[got.column("number").to_numpy()] = got.column("ic").to_numpy()
    ontology = spark.sparkContext.broadcast((np.append(0, np.cumsum(width)), values, information))
    parts = max(1, -(-own.count() // rows))
    for k in range(parts):
        mine = (own if parts == 1 else own.where(F.pmod(F.xxhash64("entity_id"), F.lit(parts)) == k)).toArrow()
        coded = mine.column("entity_id").combine_chunks().dictionary_encode() if mine.num_rows else pa.array([], pa.string()).dictionary_encode()
        names = np.array(coded.dictionary.to_pylist(), dtype=object)
        order = np.argsort(names)
        place = np.empty(names.size, dtype=np.int32)
        place[order] = np.arange(names.size)
        yield ontology, spark.sparkContext.broadcast((uuid.uuid4().hex, names[order].tolist(), place[coded.indices.to_numpy()], mine.column("number").to_numpy(), method))


def fits(closed: DataFrame, most: int = CLOSURE) -> bool:
    """Whether a task may hold the ontology's closure."""
    return closed.limit(most + 1).count() <= most


_HELD: dict = {}


def _table(held) -> Profiles:
    """The arrays of a shard's broadcasts, built once in a worker."""
    key, *own = held[1].value
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Profiles.of_numbers(*held[0].value, *own)
    return _HELD[key]


def _sets(patients: DataFrame, numbers: DataFrame) -> DataFrame:
    """id and terms, as numbers (-1: unknown), of each patient."""
    each = patients.select("id", "term").dropna().distinct().join(numbers, "term", "left")
    return each.groupBy("id").agg(F.sort_array(F.collect_list(F.coalesce("number", F.lit(-1)))).alias("terms"))


def _dealt(sets: DataFrame) -> DataFrame:
    """Dealt evenly over all cores: a short row stands for long work, which sizes in bytes do not tell."""
    return sets.repartition(TASKS * sets.sparkSession.sparkContext.defaultParallelism)


def standings(patients: DataFrame, truth: DataFrame, profiles: DataFrame, closed: DataFrame, ic: DataFrame, method: str = "resnik", rows: int = ROWS, numbers: DataFrame | None = None) -> DataFrame:
    """id, ground_truth_gene, rank, score and roc_auc of each patient's true entity among all entities.

    ``patients`` (id, term), ``truth`` (id, entity_id); with ``numbers`` (``numbers_of``)
    the profiles are distinct rows without nulls.  Equal scores rank by
    entity_id; the area is null without another entity.  Patients without a term and
    truths in no profile are left out.
    """
    kind = patients.schema["id"].dataType.simpleString()
    profiles = rows_of(profiles, numbers is not None)
    numbers = numbers_of(profiles, closed) if numbers is None else numbers
    asked = written(_sets(patients, numbers).join(truth.select("id", F.col("entity_id").alias("truth")), "id"), "asked")
    shards = list(_shards(profiles, closed, ic, numbers, method, rows))
    here = lambda k: asked if len(shards) == 1 else asked.where(F.pmod(F.xxhash64("truth"), F.lit(len(shards))) == k)  # noqa: E731  a truth is in one shard
    columns = ("id", "terms", "truth", "s")

    def own(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = _table(held)
            for batch in batches:
                found = [table.scores(t, np.array([table.number[g]]))[0] if g in table.number else None for t, g in zip(batch.column("terms").to_pylist(), batch.column("truth").to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=list(columns))

        return run

    def counted(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = _table(held)
            for batch in batches:
                found = [table.standing(t, g, s) for t, g, s in zip(*(batch.column(c).to_pylist() for c in columns[1:]))]
                numbers = [pa.array([x[k] for x in found], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("truth"), batch.column("s"), *numbers], names=["id", "truth", "s", "above", "same", "first", "below"])

        return run

    united = lambda dfs: dfs[0] if len(dfs) == 1 else dfs[0].unionByName(united(dfs[1:]))
    scored = united([_dealt(here(k)).mapInArrow(own(h), f"id {kind}, terms array<int>, truth string, s double") for k, h in enumerate(shards)]).where("s IS NOT NULL")
    scored = _dealt(written(scored, "scored"))  # read by the pass of each shard, so it is not made again in each
    parts = united([scored.mapInArrow(counted(h), f"id {kind}, truth string, s double, above long, same long, first long, below long") for h in shards])
    total = parts if len(shards) == 1 else parts.groupBy("id", "truth", "s").agg(*[F.sum(c).alias(c) for c in ("above", "same", "first", "below")])
    others = F.col("above") + F.col("same") + F.col("below")
    area = (F.col("below") + 0.5 * F.col("same")) / F.nullif(others, F.lit(0))
    return total.select("id", F.col("truth").alias("ground_truth_gene"), (1 + F.col("above") + F.col("first")).cast("int").alias("rank"), F.col("s").alias("score"), area.alias("roc_auc"))


def totals(patients: DataFrame, profiles: DataFrame, closed: DataFrame, ic: DataFrame, method: str = "resnik", rows: int = ROWS, numbers: DataFrame | None = None) -> DataFrame:
    """entity_id, total and best score of each entity over all patients; a task gives one row for each entity.  ``numbers`` as in ``standings``."""
    profiles = rows_of(profiles, numbers is not None)
    numbers = numbers_of(profiles, closed) if numbers is None else numbers
    sets = _dealt(written(_sets(patients, numbers), "sets"))  # read by the pass of each shard

    def summed(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = _table(held)
            every = np.arange(len(table.entities))
            total, best, seen = np.zeros(every.size), np.zeros(every.size), False
            for batch in batches:
                for s in table.blocks(batch.column("terms").to_pylist()):
                    total += s
                    np.maximum(best, s, out=best)
                    seen = True
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(table.entities, pa.string()), pa.array(total), pa.array(best)], names=["entity_id", "total", "best"])

        return run

    out = None
    for held in _shards(profiles, closed, ic, numbers, method, rows):
        part = sets.mapInArrow(summed(held), "entity_id string, total double, best double")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("entity_id").agg(F.sum("total").alias("total"), F.max("best").alias("best"))
