"""Subword ids of many texts at once, with a cache of word parts in numpy.

Texts are cut where no match of the byte-level split pattern can cross: before
a single space or line feed between non-spaces, after such a line feed, and
before the marks that end a word after a letter or digit.  The parts' 64-bit
hashes are looked up in an open-addressing table that grows with its entries; a
hit counts only if length and bytes agree (first and last eight bytes, and for
parts of over 16 bytes a second hash).  Parts not known are given to the
tokenizer, many in one text; a text with a part whose hash another part holds goes
to the tokenizer whole, and so do texts with other white space.  Words are taken
``CHUNK`` at a time, so a text of any length needs a bounded table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from caseloom.llm import arrays

U8 = np.uint64
_GAP = arrays.separators(b" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f")
_MARK = arrays.separators(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_ALNUM = arrays.separators(bytes(b for b in range(128) if chr(b).isalnum()))
_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")  # where other white space begins
_LED = U8(0xA0761D6478BD642F)
CHUNK = 400_000


class Subwords:
    """``encode`` gives the ids of a text; about ``most`` parts are kept, in 2**bits places."""

    def __init__(self, encode: Callable[[str], np.ndarray], most: int = 1_500_000, bits: int = 22):
        self.encode_text, self.most, self.bits = encode, most, bits
        self.line = encode("\n")
        assert self.line.size == 1
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(1 << self.bits, dtype=U8)
        self.entry = np.zeros(1 << self.bits, dtype=np.int32)
        self.marks = np.zeros((3, 1 << 20), dtype=U8)  # length and lead, first bytes, last bytes (or second hash)
        self.offset = np.zeros(1 << 20, dtype=np.int64)
        self.length = np.zeros(1 << 20, dtype=np.int64)
        self.arena = np.zeros(1 << 22, dtype="<u4")
        self.n = self.used = 0
        self._append(self.line)  # entry 0

    def _append(self, ids: np.ndarray) -> None:
        if self.n == self.offset.size:
            self.offset, self.length = (np.concatenate((x, np.zeros_like(x))) for x in (self.offset, self.length))
            self.marks = np.concatenate((self.marks, np.zeros_like(self.marks)), axis=1)
        while self.used + ids.size > self.arena.size:
            self.arena = np.concatenate((self.arena, np.zeros_like(self.arena)))
        self.arena[self.used : self.used + ids.size] = ids
        self.offset[self.n], self.length[self.n] = self.used, ids.size
        self.n, self.used = self.n + 1, self.used + ids.size

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, or -1."""
        at = (keys >> U8(64 - self.bits)).astype(np.int64)
        got = self.key[at]
        out = np.where(got == keys, self.entry[at], np.int32(-1))
        left = np.flatnonzero((got != keys) & (got != 0))
        mask = (1 << self.bits) - 1
        while left.size:
            at[left] = (at[left] + 1) & mask
            got = self.key[at[left]]
            hit = got == keys[left]
            out[left[hit]] = self.entry[at[left[hit]]]
            left = left[~hit & (got != 0)]
        return out

    def _insert(self, keys: np.ndarray, entries: np.ndarray) -> None:
        at = (keys >> U8(64 - self.bits)).astype(np.int64)
        left, mask = np.arange(keys.size), (1 << self.bits) - 1
        while left.size:
            free = self.key[at[left]] == 0
            put = left[free]
            self.key[at[put]] = keys[put]
            won = self.key[at[put]] == keys[put]
            self.entry[at[put[won]]] = entries[put[won]]
            left = np.concatenate((left[~free], put[~won]))
            at[left] = (at[left] + 1) & mask

    def _grow(self) -> None:
        """Twice the places, with all entries put in again."""
        held = self.key != 0
        keys, entries = self.key[held], self.entry[held]
        self.bits += 1
        self.key, self.entry = np.zeros(1 << self.bits, dtype=U8), np.zeros(1 << self.bits, dtype=np.int32)
        self._insert(keys, entries)

    def _learn(self, keys: np.ndarray, parts: list[bytes], led: np.ndarray, marks: np.ndarray) -> None:
        first = self.n
        while 2 * (self.n + keys.size) > 1 << self.bits:
            self._grow()
        order = []
        for lead in (True, False):
            which = np.flatnonzero(led == lead).tolist()
            if not which:
                continue
            ids = self.encode_text("\n".join([" " + parts[i].decode() for i in which] if lead else [parts[i].decode() for i in which]))
            ends = np.flatnonzero(ids == self.line[0])
            begin = 0
            for i, end in zip(which, [*ends.tolist(), ids.size], strict=True):
                self._append(ids[begin:end])
                order.append(i)
                begin = end + 1
        self.marks[:, first : self.n] = marks[:, order]
        self._insert(keys[order], np.arange(first, self.n, dtype=np.int32))

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one entry more)."""
        buffer, starts = arrays.joined(texts, lower=False)
        gap = _GAP[buffer[: starts[-1]]]
        twice = np.flatnonzero(gap[1:] & gap[:-1]) + 1
        strange = np.flatnonzero(gap & (buffer[: starts[-1]] != 32) & (buffer[: starts[-1]] != 10))
        odd = np.zeros(len(texts) + 1, dtype=bool)
        odd[np.searchsorted(starts, np.concatenate((twice, twice - 1, strange)), side="right") - 1] = True
        odd[0] |= bool(gap.size and gap[0])
        raw = buffer.tobytes()
        if any(w in raw for w in _WIDE):
            for i, x in enumerate(texts):
                odd[i] |= bool(x) and any(w in x for w in _WIDE)
        begin, length, first = arrays.words(buffer, starts, _GAP)
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        keep = np.flatnonzero(~odd[doc])
        begin, length, doc = begin[keep], length[keep], doc[keep]
        end = begin + length
        high = end.copy()
        todo = np.flatnonzero(_MARK[buffer[high - 1]]) if high.size else np.zeros(0, dtype=np.int64)
        while todo.size:
            high[todo] -= 1
            todo = todo[high[todo] > begin[todo]]
            todo = todo[_MARK[buffer[high[todo] - 1]]]
        last, before = buffer[high - 1], buffer[np.maximum(high - 2, 0)]
        letter = _ALNUM[last] | ((before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7) & (high - begin >= 2))
        high = np.where((high > begin) & letter, high, end)
        head = np.ones(begin.size, dtype=bool)  # the first word of its text
        head[1:] = doc[1:] != doc[:-1]
        led = (buffer[np.maximum(begin - 1, 0)] == 32) & ~head
        feed = ~led & ~head
        tail = high < end
        done = [self._ids(buffer, raw, *(x[i : i + CHUNK] for x in (begin, high, end, led, feed)), odd, doc[i : i + CHUNK]) for i in range(0, begin.size, CHUNK)]
        ids = np.concatenate([d[0] for d in done]) if done else np.zeros(0, dtype="<u4")
        owner, count = (np.concatenate([d[k] for d in done]) if done else np.zeros(0, dtype=np.int64) for k in (1, 2))
        of_doc = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
        slow = [i for i in np.flatnonzero(odd[:-1]).tolist() if texts[i]]  # parts before the odd one are replaced too
        if slow:
            cut = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(of_doc)))
            parts = [ids[cut[i] : cut[i + 1]] for i in range(len(texts))]
            for i in slow:
                parts[i] = self.encode_text(texts[i].decode())
                of_doc[i] = parts[i].size
            ids = np.concatenate(parts)
        return ids, np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(of_doc)))

    def _ids(
        self, buffer: np.ndarray, raw: bytes, begin: np.ndarray, high: np.ndarray, end: np.ndarray, led: np.ndarray, feed: np.ndarray, odd: np.ndarray, doc: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of some words, and the text and number of ids of each of their parts; marks texts as odd."""
        if self.n > self.most:
            self.clear()
        tail = high < end
        # parts in order: a line feed, the word, its marks
        many = 1 + feed.astype(np.int64) + tail
        place = np.cumsum(many) - many
        total = int(many.sum())
        at_word, at_tail = place + feed, (place + feed + 1)[tail]
        b, n, lead = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64), np.zeros(total, dtype=bool)
        b[at_word], n[at_word], lead[at_word] = begin, high - begin, led
        b[at_tail], n[at_tail] = high[tail], (end - high)[tail]
        asked = np.ones(total, dtype=bool)
        asked[place[feed]] = False
        asked = np.flatnonzero(asked)
        b, n, lead = b[asked], n[asked], lead[asked]
        key = self.keys_of(buffer, b, n) ^ np.where(lead, _LED, U8(0)) | U8(1)
        marks = _marks(buffer, b, n, lead)
        found = self._find(key)
        missing = np.flatnonzero(found < 0)
        if missing.size:
            keys, at = np.unique(key[missing], return_index=True)
            at = missing[at]
            self._learn(keys, [raw[x : x + y] for x, y in zip(b[at].tolist(), n[at].tolist())], lead[at], marks[:, at])
            found[missing] = self._find(key[missing])
        of = np.repeat(doc, many)
        other = (self.marks[:, found] != marks).any(axis=0)
        odd[of[asked[other]]] = True
        entry = np.zeros(total, dtype=np.int32)
        entry[asked] = found
        count = self.length[entry] * ~odd[of]  # a text that is odd by now goes to the tokenizer whole
        upto = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(count)))
        return self.arena[np.repeat(self.offset[entry] - upto[:-1], count) + np.arange(upto[-1])], of, count

    keys_of = staticmethod(arrays.hashes)


def _marks(buffer: np.ndarray, begin: np.ndarray, length: np.ndarray, led: np.ndarray) -> np.ndarray:
    """What tells byte ranges apart besides their hash: exact for up to 16 bytes."""
    eight = np.ndarray(shape=(buffer.size - 7,), dtype="<u8", buffer=buffer.data, strides=(1,))
    head = eight[begin] & arrays.low_bytes(length)
    last = eight[begin + np.maximum(length - 8, 0)] & arrays.low_bytes(length)
    long = np.flatnonzero(length > 16)
    last[long] = arrays.hashes(buffer, begin[long], length[long], seed=99)
    return np.stack((length.astype(U8) * U8(2) + led.astype(U8), head, last))
