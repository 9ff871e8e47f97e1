"""Best name for each phrase by the longest common subsequence, one phrase against blocks of names.

The score of a phrase and a name is 200 L / (l1 + l2), L the length of their longest
common subsequence.  ``Names`` holds a dictionary as numpy matrices: how often each
letter occurs in each name, and for each letter the bits of its places in each name,
64 to a word.  For a phrase

1. L is at most the shorter length, so names of other lengths are left aside at once, and
   at most the number of letters in common, so one pass over the letter counts of the
   rest gives an upper bound of every such name's score.  Names are held by length, so
   the rest is one run of them;
2. names are taken in blocks by falling bound; L of a whole block is found bit by bit
   in parallel (Hyyro 2004): one step for each letter of the phrase over all names of
   the block;
3. the search ends when the next bound cannot reach the best score so far.

``bests`` does so for many phrases at once.  Names with like letters stand in groups, and
the letters in common with the most that any name of a group has of each bound the whole
group: a product of matrices for all phrases and groups.  Only pairs within groups that
are left are bounded one by one, and what is still left, over all phrases, goes letter by
letter in step.  Most phrases have no name near enough and end at the groups.

The best name is exact: a bound is never below its score, and names with a bound equal
to the best score are still looked at, so ties go to the name of least order.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

#: Names of the first block and of each later one: a step costs little more for many names than for few.
BLOCK, LATER = 256, 4096
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Names of a group; phrases bounded at once, bytes that these may hold; pairs in step at once; names for which a phrase is searched by itself.
GROUP, BATCH, BYTES, PAIRS, MANY = 24, 4096, 1 << 25, 1 << 18, 4096


class Names:
    """A dictionary of names (word-sorted texts) with an order for ties."""

    def __init__(self, texts: list[str], order: list) -> None:
        rank = sorted(range(len(texts)), key=lambda i: order[i])
        place = {i: k for k, i in enumerate(rank)}
        held = sorted(rank, key=lambda i: len(texts[i]))  # by length, then in order
        self.source = np.array(held, dtype=np.int64)
        self.order = np.array([place[i] for i in held], dtype=np.int64)  # equal scores: the first in order counts
        texts = [texts[i] for i in held]
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        self.letters = {c: k for k, c in enumerate(sorted(set("".join(texts))))}
        self.words = max(1, -(-int(self.length.max(initial=1)) // 64))
        n, m = len(texts), len(self.letters)
        flat = np.array([self.letters[c] for t in texts for c in t], dtype=np.int64)
        owner = np.repeat(np.arange(n), self.length)
        place = np.arange(flat.size) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        counts = np.zeros((m, n), dtype=np.int64)
        np.add.at(counts, (flat, owner), 1)
        self.most = counts.max(axis=1, initial=0).tolist()
        self.counts = counts.astype(np.min_scalar_type(int(counts.max(initial=0))))  # one byte but for very long names
        self.has = (self.counts > 0).astype(self.counts.dtype)
        self.at = np.searchsorted(self.length, np.arange(int(self.length.max(initial=0)) + 2))  # where each length begins
        self.bits = np.zeros((m, self.words, n), dtype=np.uint64)
        np.bitwise_or.at(self.bits, (flat, place // 64, owner), np.uint64(1) << (place % 64).astype(np.uint64))
        if self.length.max(initial=0) <= 32:
            self.bits = self.bits.astype(np.uint32)
        self.wide = -(-self.length // 64)  # words that a name needs
        self._group()

    def _group(self) -> None:
        """Groups of names with like letters: by the counts of frequent letters first, so that rare ones differ within a group."""
        m, n = self.counts.shape
        rising = np.argsort(self.counts.sum(axis=1), kind="stable")  # the last key counts most
        self.grouped = np.lexsort(self.counts[rising]) if m else np.arange(n)
        starts = np.arange(0, n, GROUP)
        self.group_start = np.append(starts, n)
        envelope = np.maximum.reduceat(self.counts[:, self.grouped], starts, axis=1) if n else self.counts
        self.shortest = np.minimum.reduceat(self.length[self.grouped], starts) if n else self.length
        # one row for each letter and each number of times up to the most: products of such rows add up the lesser counts
        self.row_letter = np.repeat(np.arange(m), self.most)
        self.row_times = np.concatenate([np.zeros(0, np.int64), *(np.arange(1, k + 1) for k in self.most)])
        self.envelope = (envelope[self.row_letter] >= self.row_times[:, None]).astype(np.float32)
        self.points = np.array([ord(c) for c in self.letters], dtype=np.uint32)
        self.each = (self.counts[:, self.grouped][self.row_letter] >= self.row_times[:, None]).astype(np.float32)
        # places of each letter, and of none, in names of one word
        self.flat = np.concatenate((self.bits[:, 0], np.zeros((1, n), self.bits.dtype))).ravel() if self.words == 1 else None

    def bounds(self, phrase: str, low: int = 0, high: int | None = None) -> np.ndarray:
        """Letters in common with each name (from ``low`` on, below ``high``)."""
        high = self.length.size if high is None else high
        counts = self.counts[:, low:high]
        kind = counts.dtype
        # sums of the kind the counts have, where none can be larger, go without conversions
        common = np.zeros(counts.shape[1], dtype=kind if len(phrase) <= np.iinfo(kind).max else np.uint16 if len(phrase) < 1 << 16 else np.int64)
        held = np.empty(counts.shape[1], dtype=kind)
        for c, n in Counter(phrase).items():
            k = self.letters.get(c)
            if k is not None:
                common += counts[k] if n >= self.most[k] else self.has[k, low:high] if n == 1 else np.minimum(counts[k], kind.type(n), out=held)
        return common

    def common(self, phrase: str, block: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence with each name of the block."""
        words = max(1, int(self.wide[block].max(initial=1)))
        steps = [self.letters[c] for c in phrase if c in self.letters]
        if words == 1:  # no carry
            at = {k: i for i, k in enumerate(dict.fromkeys(steps))}
            used = self.bits[list(at), 0][:, block]
            kind = self.bits.dtype
            v, u, w = np.full(block.size, kind.type(_ALL >> np.uint64(64 - 8 * kind.itemsize)), dtype=kind), np.empty(block.size, dtype=kind), np.empty(block.size, dtype=kind)
            for k in steps:
                np.bitwise_and(v, used[at[k]], out=u)
                np.add(v, u, out=w)
                np.bitwise_xor(v, u, out=v)  # u is a part of v
                np.bitwise_or(v, w, out=v)
            return np.bitwise_count(~v).astype(np.int64)
        used = {k: self.bits[k, :words][:, block] for k in set(steps)}
        v = np.full((words, block.size), _ALL, dtype=np.uint64)
        for k in steps:
            match = used[k]
            u = v & match
            carry = None
            for w in range(words):
                total = v[w] + u[w]
                over = total < v[w]
                if carry is not None:
                    total += carry
                    over |= total < carry
                v[w] = total | (v[w] & ~u[w])
                carry = over.astype(np.uint64) if w + 1 < words else None
        # bits beyond a name's end match nothing: they stay set
        return np.bitwise_count(~v).sum(axis=0).astype(np.int64)

    def reach(self, length: int, threshold: float) -> tuple[int, int]:
        """The run of names whose length alone lets a phrase of this length reach the threshold."""
        if threshold <= 0 or not self.length.size:
            return 0, self.length.size
        share = threshold / 200.0 - 1e-9
        if share >= 1:
            return 0, 0
        # min(a, b) >= share * (a + b)
        return int(np.searchsorted(self.length, length * share / (1 - share) - 1e-6)), int(np.searchsorted(self.length, length * (1 - share) / share + 1e-6, side="right"))

    def best(self, phrase: str, threshold: float) -> tuple[int, float] | None:
        """Number of the best name (as given) and its score, if that reaches the threshold."""
        if not self.length.size:
            return None
        if not phrase:
            both = np.flatnonzero(self.length == 0)
            return (int(self.source[both[0]]), 100.0) if both.size else None
        low, high = self.reach(len(phrase), threshold)
        if low >= high:
            return None
        common = self.bounds(phrase, low, high)
        a, b = int(self.length[low]), int(self.length[high - 1])
        need = np.ceil(np.arange(a + len(phrase), b + len(phrase) + 1) * (threshold / 200.0) - 1e-6)  # letters, for each length
        reach = np.flatnonzero(common >= np.repeat(need.astype(common.dtype), np.diff(self.at[a : b + 2])))
        if not reach.size:
            return None
        total = self.length[low + reach] + len(phrase)
        bound = 200.0 * common[reach] / total
        order = np.argsort(-bound, kind="stable")
        reach, bound, total = reach[order], bound[order], total[order]
        best, where = threshold, -1
        k = stop = 0
        while stop < reach.size:
            k, stop = stop, stop + (LATER if stop else BLOCK)
            if bound[k] < best:
                break
            some = bound[k:stop] >= best
            block = reach[k:stop][some]
            score = 200.0 * self.common(phrase, low + block) / total[k:stop][some]
            top = score.max()
            equal = low + block[score == top]
            first = int(equal[np.argmin(self.order[equal])])
            if top > best or top == best and (where < 0 or self.order[first] < self.order[where]):
                best, where = float(top), first
        return (int(self.source[where]), best) if where >= 0 else None

    def bests(self, phrases: list[str], threshold: float) -> list[tuple[int, float] | None]:
        """``best`` of each phrase."""
        if threshold <= 0 or not self.letters:
            return [self.best(p, threshold) for p in phrases]
        out: list = [None] * len(phrases)
        length = np.array([len(p) for p in phrases], dtype=np.int64)
        near = {n: n > 0 and np.less(*self.reach(n, threshold)) for n in set(length.tolist())}
        for i in np.flatnonzero(length == 0).tolist():
            out[i] = self.best("", threshold)
        asked = np.flatnonzero(np.array([near[n] for n in length.tolist()], dtype=bool))
        asked = asked[np.argsort(-length[asked], kind="stable")]  # like lengths together
        size = max(1, min(BATCH, BYTES // (4 * max(1, self.row_letter.size, self.shortest.size))))
        for k in range(0, asked.size, size):
            some = asked[k : k + size]
            for i, hit in self._bests([phrases[j] for j in some.tolist()], length[some], threshold):
                out[some[i]] = hit
        return out

    def _bests(self, phrases: list[str], length: np.ndarray, threshold: float) -> list[tuple[int, tuple[int, float]]]:
        """Numbers of phrases, the longest first, and their best names, where there is one."""
        m = len(self.letters)
        points = np.frombuffer("".join(phrases).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = np.minimum(np.searchsorted(self.points, points), m - 1)
        owner, known = np.repeat(np.arange(length.size), length), self.points[code] == points
        owner, code = owner[known], code[known]
        counts = np.bincount(owner * m + code, minlength=length.size * m).reshape(-1, m)
        told = (counts[:, self.row_letter] >= self.row_times).astype(np.float32)
        share = threshold / 200.0
        group, phrase = np.nonzero((told @ self.envelope).T >= ((length + self.shortest[:, None]) * share - 1e-3).astype(np.float32))
        cut = np.searchsorted(group, np.arange(self.shortest.size + 1)).tolist()
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for g in np.flatnonzero(np.diff(cut)).tolist():
            i, j = phrase[cut[g] : cut[g + 1]], slice(self.group_start[g], self.group_start[g + 1])
            need = np.ceil((length[i, None] + self.length[self.grouped[j]]) * share - 1e-6)
            row, column = np.nonzero(told[i] @ self.each[:, j] >= need)
            kept.append((i[row], self.grouped[j][column]))
        i, j = (np.concatenate(x) for x in zip(*kept))
        pairs = np.bincount(i, minlength=length.size)
        alone = pairs > (MANY if self.flat is not None else 0)
        found = [(p, hit) for p in np.flatnonzero(alone).tolist() if (hit := self.best(phrases[p], threshold))]
        many = np.bincount(owner, minlength=length.size)
        steps = np.full((int(many.max(initial=0)), length.size), m, dtype=np.int64)
        steps[np.arange(owner.size) - np.repeat(np.cumsum(many) - many, many), owner] = code
        steps *= self.length.size
        part = np.cumsum(np.where(alone, 0, pairs)) // PAIRS  # phrases that go together
        for k in np.unique(part[i[~alone[i]]]).tolist():
            mine = ~alone[i] & (part[i] == k)
            found += self._in_step(i[mine], j[mine], length, many, steps, threshold)
        return found

    def _in_step(self, i: np.ndarray, j: np.ndarray, length: np.ndarray, many: np.ndarray, steps: np.ndarray, threshold: float) -> list[tuple[int, tuple[int, float]]]:
        """The best of these pairs of phrase and name for each phrase; ``steps`` has the place of each of a phrase's ``many`` known letters in ``flat``."""
        order = np.argsort(-many[i], kind="stable")  # by falling number of letters
        i, j = i[order], j[order]
        kind = self.bits.dtype
        v = np.full(i.size, kind.type(_ALL >> np.uint64(64 - 8 * kind.itemsize)), dtype=kind)
        stop = np.searchsorted(-many[i], -np.arange(int(many[i].max(initial=0))), side="left")  # pairs with more letters than so many
        for k, n in enumerate(stop.tolist()):
            used = self.flat[steps[k][i[:n]] + j[:n]]
            at = v[:n]
            np.bitwise_and(at, used, out=used)
            total = at + used
            np.bitwise_xor(at, used, out=at)
            np.bitwise_or(at, total, out=at)
        score = 200.0 * np.bitwise_count(~v).astype(np.int64) / (length[i] + self.length[j])
        good = np.flatnonzero(score >= threshold)
        good = good[np.lexsort((self.order[j[good]], -score[good], i[good]))]
        first = good[np.append(True, i[good][1:] != i[good][:-1])[: good.size]]
        return [(p, (int(self.source[n]), x)) for p, n, x in zip(i[first].tolist(), j[first].tolist(), score[first].tolist())]
