"""FLAC media columns: encode, decode, seek, all frames of a batch at once.

Encoder: 8-bit mono streams of blocks of ``BLOCK`` samples (the last block of a
stream may be shorter).  Each block takes the cheapest of a constant, fixed
predictors of order 0 to 2, a quantised linear predictor of order ``LPC`` and
verbatim samples; residuals are Rice coded.  A stream has STREAMINFO with the
MD5 of its samples and a SEEKTABLE with a point for every frame.

Decoder: any FLAC stream of 4 to 24 bits and up to eight channels.  CRC-8 of
each frame header and CRC-16 of each frame are verified, and the MD5 of the
samples where the stream names one; a failure raises ``FlacError``.  All frames
of a batch are decoded in step, one sample of every frame at a time.  Frame
places come from the seek table if it has them all, else from sync codes whose
checksums hold.

Samples are stored as unsigned 8-bit bytes in the ``pcm`` column (byte - 128 is
the signed sample), which is the common form of 8-bit PCM.

Cases: a null payload has null media; null media give null pcm; an empty
payload is a stream without frames.  Equal payloads have equal streams.  Other
columns are kept, columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm import arrays

BLOCK = 4608
LPC = 4
PRECISION = 12
RATE = 8000
SLICE = 4 << 20
U8 = np.uint64


class FlacError(ValueError):
    """A damaged stream, or one that this decoder does not know."""


# --- checksums -----------------------------------------------------------------


def _crc_table(poly: int, bits: int) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint32)
    for b in range(256):
        c = b << (bits - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly if c >> (bits - 1) else c << 1) & ((1 << bits) - 1)
        table[b] = c
    return table


_CRC8 = _crc_table(0x07, 8).tolist()
_CRC16 = _crc_table(0x8005, 16)


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8[c ^ b]
    return c


class _Crc16:
    """CRC-16 of many byte ranges: the checksum is linear, so each byte's share
    depends on the byte and on its distance to the end only."""

    def __init__(self) -> None:
        self.table = _CRC16.astype(np.uint16)[None, :]

    def grow(self, most: int) -> None:
        rows = [self.table]
        last = self.table[-1].astype(np.uint32)
        for _ in range(most - len(self.table)):
            last = ((last << 8) & 0xFFFF) ^ _CRC16[last >> 8]
            rows.append(last.astype(np.uint16)[None, :])
        self.table = np.concatenate(rows)

    def __call__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Checksum of each range; ranges follow each other without a gap."""
        size = end - begin
        if size.max(initial=0) > 1 << 17:  # such frames come from other encoders only
            return np.array([self._slow(data[b:e].tobytes()) for b, e in zip(begin.tolist(), end.tolist())], dtype=np.uint16)
        if size.max(initial=0) > len(self.table):
            self.grow(int(size.max()))
        far = np.repeat(end, size) - 1 - np.arange(begin[0], end[-1])
        share = self.table.reshape(-1).take(far * 256 + data[begin[0] : end[-1]])
        return np.bitwise_xor.reduceat(share, begin - begin[0])

    @staticmethod
    def _slow(data: bytes) -> int:
        c = 0
        for b in data:
            c = ((c << 8) & 0xFFFF) ^ int(_CRC16[(c >> 8) ^ b])
        return c


_crc16 = _Crc16()


# --- encoder -------------------------------------------------------------------


def _predictor(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients (frames, LPC) and shifts, by Levinson and Durbin."""
    n = x.shape[1]
    t = (np.arange(n, dtype=np.float32) * 2 + 1 - n) / n
    w = x * (1 - t * t)
    r = np.stack([np.einsum("ij,ij->i", w[:, : n - k], w[:, k:]) for k in range(LPC + 1)], axis=1).astype(np.float64)
    r[:, 0] = r[:, 0] * (1 + 1e-6) + 1
    a = np.zeros((len(x), LPC))
    err = r[:, 0].copy()
    for i in range(LPC):
        k = (r[:, i + 1] - np.einsum("ij,ij->i", a[:, :i], r[:, i:0:-1])) / err
        head = a[:, :i].copy()
        a[:, :i] = head - k[:, None] * head[:, ::-1]
        a[:, i] = k
        err *= np.maximum(1 - k * k, 1e-9)
    top = np.maximum(np.abs(a).max(axis=1), 1e-9)
    shift = np.clip(PRECISION - 1 - np.ceil(np.log2(top)).astype(np.int64), 0, 15)
    most = (1 << (PRECISION - 1)) - 1
    return np.clip(np.rint(a * (1 << shift)[:, None]), -most, most).astype(np.int64), shift


def _utf8(number: int) -> bytes:
    """The frame number in the extended UTF-8 of frame headers."""
    if number < 0x80:
        return bytes([number])
    tail = []
    while number >= 1 << (6 - len(tail)):
        tail.append(0x80 | number & 0x3F)
        number >>= 6
    return bytes([(0xFF << (7 - len(tail))) & 0xFF | number, *reversed(tail)])


_SIZE_CODE = {192: 1} | {576 << k: 2 + k for k in range(4)}


def _header(number: int, size: int) -> bytes:
    code = _SIZE_CODE.get(size, 7)
    head = bytes([0xFF, 0xF8, code << 4 | 4, 0x02]) + _utf8(number) + (struct.pack(">H", size - 1) if code == 7 else b"")
    return head + bytes([crc8(head)])


def _pack(value: np.ndarray, width: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each row (a frame), each row from a byte border on: bytes and where rows begin.

    A field has at most 32 bits that are set; a longer width means zeros before
    them.  ``lead`` bytes are left free at the begin of each row.
    """
    row_bits = width.sum(axis=1)
    row_bytes = lead + (row_bits + 7) // 8
    begin = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(row_bytes)))
    end = np.cumsum(width, axis=1) + ((begin[:-1] + lead) * 8)[:, None]
    low = end.reshape(-1)  # the 32 bits before the end, seen from 32 bits before the buffer
    word, s = low >> 5, (low & 31).astype(U8)
    v = value.reshape(-1) << (U8(32) - s)
    n = int(begin[-1] // 4 + 4)
    words = np.bincount(word, weights=(v >> U8(32)).astype(np.float64), minlength=n)
    words[1:] += np.bincount(word, weights=(v & U8(0xFFFFFFFF)).astype(np.float64), minlength=n)[:-1]
    return words.astype(">u4").view(np.uint8)[4:], begin


def _encode_group(x: np.ndarray, numbers: list[int]) -> list[bytes]:
    """Frames of blocks of one size; x is (frames, samples), signed."""
    n_frames, size = x.shape
    x = x.astype(np.int32)
    head = [_header(k, size) for k in numbers]
    out: list[bytes] = [b""] * n_frames
    d1 = x[:, 1:] - x[:, :-1]
    d2 = d1[:, 1:] - d1[:, :-1]
    coef, shift = _predictor(x.astype(np.float32))
    pred = np.zeros((n_frames, size - LPC), dtype=np.int32)
    for j in range(LPC):
        pred += coef[:, j : j + 1].astype(np.int32) * x[:, LPC - 1 - j : size - 1 - j]
    lpc = x[:, LPC:] - (pred >> shift[:, None].astype(np.int32))
    constant = ~d1.any(axis=1)
    cost = np.stack([np.abs(r[:, -(size - LPC) :]).sum(axis=1, dtype=np.int64) for r in (x, d1, d2, lpc)], axis=1)
    cost[:, 3] += 8 * LPC  # the coefficients
    kind = np.argmin(cost, axis=1)
    parts = 4 if size % 4 == 0 and size // 4 > LPC else 1
    raw_bytes = (x + 128).astype(np.uint8) ^ 0x80  # two's complement

    def put(rows: np.ndarray, body: np.ndarray, begin: np.ndarray) -> None:
        buffer = body[: begin[-1]].copy()
        for i, b in zip(rows.tolist(), begin[:-1].tolist()):
            buffer[b : b + len(head[i])] = np.frombuffer(head[i], dtype=np.uint8)
        sums = _crc16(buffer, begin[:-1], begin[1:])
        raw = buffer.tobytes()
        for i, b, e, c in zip(rows.tolist(), begin[:-1].tolist(), begin[1:].tolist(), sums.tolist()):
            out[i] = raw[b:e] + struct.pack(">H", c)

    verbatim = constant.copy()
    for k, (order, r) in enumerate(((0, x), (1, d1), (2, d2), (LPC, lpc))):
        rows = np.flatnonzero((kind == k) & ~constant)
        if not rows.size:
            continue
        r = r[rows]
        u = ((r << 1) ^ (r >> 31)).astype(np.int64)
        values, widths = [], []

        def field(v, w, m=len(rows)) -> None:
            values.append(np.broadcast_to(np.asarray(v, dtype=np.int64).reshape(-1, 1), (m, 1)))
            widths.append(np.full((m, 1), w, dtype=np.int64))

        field((8 + order) << 1 if k < 3 else (32 + LPC - 1) << 1, 8)
        for j in range(order):
            field(x[rows, j] & 0xFF, 8)
        if k == 3:
            field(PRECISION - 1, 4)
            field(shift[rows], 5)
            for j in range(LPC):
                field(coef[rows, j] & ((1 << PRECISION) - 1), PRECISION)
        field(parts.bit_length() - 1, 6)  # method 0 and the partition order
        step = size // parts
        for p in range(parts):
            part = u[:, max(0, p * step - order) : (p + 1) * step - order]
            mean = part.mean(axis=1)
            rice = np.clip(np.rint(np.log2(np.maximum(0.7 * mean, 0.5))), 0, 14).astype(np.int64)[:, None]
            field(rice, 4)
            values.append((1 << rice) | (part & ((1 << rice) - 1)))
            widths.append((part >> rice) + 1 + rice)
        value, width = np.concatenate(values, axis=1), np.concatenate(widths, axis=1)
        plain = width.sum(axis=1) >= 8 * (size + 1)
        verbatim[rows[plain]] = True
        rows = rows[~plain]
        if rows.size:
            lead = np.array([len(head[i]) for i in rows.tolist()])
            put(rows, *_pack(value[~plain].astype(U8), width[~plain], lead))
    for i in np.flatnonzero(verbatim).tolist():
        frame = head[i] + (b"\x00" + raw_bytes[i, :1].tobytes() if constant[i] else b"\x02" + raw_bytes[i].tobytes())
        out[i] = frame + struct.pack(">H", int(_crc16(np.frombuffer(frame, dtype=np.uint8), np.array([0]), np.array([len(frame)]))[0]))
    return out


def encode_many(payloads: list[bytes | None]) -> list[bytes | None]:
    """A FLAC stream for each payload of unsigned 8-bit samples."""
    groups: dict[int, list[tuple[int, int]]] = {}
    frames: list[list[bytes]] = []
    for i, p in enumerate(payloads):
        n = len(p) if p else 0
        frames.append([b""] * -(-n // BLOCK))
        for k in range(len(frames[-1])):
            groups.setdefault(min(BLOCK, n - k * BLOCK), []).append((i, k))
    for size, members in groups.items():
        most = max(1, (1 << 20) // size)
        for at in range(0, len(members), most):
            some = members[at : at + most]
            x = np.frombuffer(b"".join(payloads[i][k * BLOCK : k * BLOCK + size] for i, k in some), dtype=np.uint8)
            x = (x.astype(np.int16) - 128).reshape(len(some), size)
            made = [_tiny(row, k) for row, (_, k) in zip(x, some)] if size < 16 else _encode_group(x, [k for _, k in some])
            for (i, k), frame in zip(some, made):
                frames[i][k] = frame
    return [None if p is None else _stream(p, f) for p, f in zip(payloads, frames)]


def _tiny(x: np.ndarray, number: int) -> bytes:
    """A verbatim frame for a last block too short to predict."""
    frame = _header(number, len(x)) + b"\x02" + x.astype(np.int8).tobytes()
    return frame + struct.pack(">H", int(_crc16(np.frombuffer(frame, dtype=np.uint8), np.array([0]), np.array([len(frame)]))[0]))


def _stream(payload: bytes, frames: list[bytes]) -> bytes:
    n = len(payload)
    block = BLOCK if n > BLOCK else max(16, n)
    signed = bytes(payload).translate(_FLIP)
    sizes = [len(f) for f in frames] or [0]
    packed = RATE << 44 | 0 << 41 | 7 << 36 | n
    info = struct.pack(">HH", block, block) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + packed.to_bytes(8, "big") + hashlib.md5(signed).digest()
    at, points = 0, []
    for k, f in enumerate(frames):
        points.append(struct.pack(">QQH", k * BLOCK, at, min(BLOCK, n - k * BLOCK)))
        at += len(f)
    table = b"".join(points)
    return b"fLaC" + b"\x00" + (34).to_bytes(3, "big") + info + b"\x83" + len(table).to_bytes(3, "big") + table + b"".join(frames)


_FLIP = bytes(b ^ 0x80 for b in range(256))


# --- decoder -------------------------------------------------------------------


@dataclass
class Stream:
    """What the metadata say, and where the frames are."""

    channels: int
    bits: int
    samples: int
    md5: bytes
    points: list[tuple[int, int, int]]  # sample, offset from the first frame, samples
    first: int  # place of the first frame


def metadata(data: bytes) -> Stream:
    if data[:4] != b"fLaC":
        raise FlacError("no FLAC stream")
    at, last, s = 4, False, None
    points: list[tuple[int, int, int]] = []
    while not last:
        if at + 4 > len(data):
            raise FlacError("the metadata end early")
        last, kind, size = bool(data[at] & 0x80), data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        body = data[at + 4 : at + 4 + size]
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            s = Stream((packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & ((1 << 36) - 1), body[18:34], points, 0)
        elif kind == 3:
            points += [p for p in struct.iter_unpack(">QQH", body) if p[0] != (1 << 64) - 1]
        at += 4 + size
    if s is None:
        raise FlacError("no STREAMINFO")
    s.first = at
    return s


_RATE_EXTRA = {12: 1, 13: 2, 14: 2}
_BITS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24}


@dataclass
class Frame:
    begin: int
    end: int
    body: int  # bit of the first subframe
    size: int
    channels: int  # the header's channel code
    bits: int


def header(data: bytes, at: int, bits: int) -> Frame | None:
    """The frame header at a place, or None if there is none or its CRC-8 is wrong."""
    if data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8 or at + 6 > len(data):
        return None
    size_code, rate_code, channels, bits_code = data[at + 2] >> 4, data[at + 2] & 15, data[at + 3] >> 4, data[at + 3] >> 1 & 7
    if not size_code or rate_code == 15 or channels > 10 or bits_code == 3 or data[at + 3] & 1:
        return None
    lead = data[at + 4]
    more = 0 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length() - 1
    p = at + 5 + more
    if size_code == 1:
        size = 192
    elif size_code < 6:
        size = 576 << (size_code - 2)
    elif size_code < 8:
        n = size_code - 5
        size = int.from_bytes(data[p : p + n], "big") + 1
        p += n
    else:
        size = 256 << (size_code - 8)
    p += _RATE_EXTRA.get(rate_code, 0)
    if p >= len(data) or crc8(data[at:p]) != data[p]:
        return None
    return Frame(at, 0, (p + 1) * 8, size, channels, _BITS.get(bits_code, bits))


def frames_of(data: bytes, s: Stream) -> list[Frame]:
    """All frames; by the seek table if it covers the stream, else by sync codes."""
    places = [s.first + off for _, off, _ in s.points]
    if not (s.points and s.points[0][:2] == (0, 0) and sum(n for _, _, n in s.points) == s.samples):
        places = _scan(data, s)
    out = []
    for begin, end in zip(places, [*places[1:], len(data)]):
        f = header(data, begin, s.bits) if end <= len(data) and begin + 6 <= end else None
        if f is None:
            raise FlacError(f"bad frame header at byte {begin}")
        f.end = end
        out.append(f)
    return out


def _scan(data: bytes, s: Stream) -> list[int]:
    """Frame places by sync codes: a frame ends where its CRC-16 holds."""
    found, at = [], s.first
    while at + 6 <= len(data):
        if header(data, at, s.bits) is None:
            raise FlacError(f"bad frame header at byte {at}")
        found.append(at)
        nxt, c, p = at + 2, 0, at
        while True:
            nxt = data.find(b"\xff", nxt)
            end = len(data) if nxt < 0 else nxt
            if nxt < 0 or header(data + bytes(16), nxt, s.bits) is not None:
                for b in data[p:end]:
                    c = ((c << 8) & 0xFFFF) ^ int(_CRC16[(c >> 8) ^ b])
                p = end
                if not c:
                    break
                if nxt < 0:
                    raise FlacError(f"CRC-16 of the frame at byte {at} is wrong")
            nxt += 1
        at = end
    return found


class _Bits:
    """Big-endian bit reader at many places at once."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate((data, np.zeros(16, dtype=np.uint8)))
        self.padded = padded
        self.view = np.ndarray(shape=(padded.size - 8,), dtype="<u8", buffer=padded.data, strides=(1,))

    def window(self, at: np.ndarray) -> np.ndarray:
        """57 bits or more from each place on, at the top of a 64-bit word."""
        return self.view[at >> 3].byteswap() << (at & 7).astype(U8)

    def read(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """n bits (0 to 56) at each place, unsigned; the places move on."""
        n = np.broadcast_to(np.asarray(n, dtype=np.int64), at.shape)
        w = self.window(at)
        v = np.where(n > 0, w >> ((64 - np.maximum(n, 1)).astype(U8)), U8(0)).astype(np.int64)
        at += n
        return v

    def signed(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        v = self.read(at, n)
        n = np.broadcast_to(np.asarray(n, dtype=np.int64), v.shape)
        return np.where(n > 0, v - ((v >> np.maximum(n - 1, 0) & 1) << n), 0)


_ZEROS = np.array([16] + [16 - v.bit_length() for v in range(1, 1 << 16)], dtype=np.int64)


def _subframes(bits: _Bits, at: np.ndarray, size: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """One subframe of each lane; lanes are sorted by falling size.  Gives (samples, lanes); places move on."""
    lanes, most = at.size, int(size[0])
    x = np.zeros((most, lanes), dtype=np.int32 if int(depth.max()) <= 16 else np.int64)
    head = bits.read(at, 8)
    if (head >> 7).any():
        raise FlacError("bad subframe header")
    wasted = np.zeros(lanes, dtype=np.int64)
    for i in np.flatnonzero(head & 1).tolist():
        one = at[i : i + 1].copy()
        while True:
            wasted[i] += 1
            if bits.read(one, 1)[0]:
                break
        at[i] = one[0]
    depth = depth - wasted
    kind = head >> 1 & 63
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    if (~(fixed | lpc | (kind <= 1))).any():
        raise FlacError("unknown subframe")
    order = np.where(fixed, kind - 8, np.where(lpc, kind - 31, 0))
    same = np.flatnonzero(kind == 0)
    if same.size:
        p = at[same]
        v = bits.signed(p, depth[same])
        at[same] = p
        x[:, same] = v
    plain = np.flatnonzero(kind == 1)
    if plain.size:
        p = at[plain]
        for t in range(int(size[plain].max())):
            on = size[plain] > t
            q = p[on]
            x[t, plain[on]] = bits.signed(q, depth[plain[on]])
            p[on] = q
        at[plain] = p
    coded = np.flatnonzero(fixed | lpc)
    if coded.size:
        p, o, n, d = at[coded], order[coded], size[coded], depth[coded]
        y = x if coded.size == lanes else np.zeros((most, coded.size), dtype=x.dtype)
        for t in range(int(o.max(initial=0))):
            on = np.flatnonzero(o > t)
            q = p[on]
            y[t, on] = bits.signed(q, d[on])
            p[on] = q
        shift = np.zeros(coded.size, dtype=np.int64)
        coef = np.zeros((int(o.max(initial=0)) or 1, coded.size), dtype=np.int64)
        on = np.flatnonzero(lpc[coded])
        if on.size:
            q = p[on]
            precision = bits.read(q, 4) + 1
            shift[on] = bits.signed(q, 5)
            for j in range(int(o[on].max())):
                has = np.flatnonzero(o[on] > j)
                r = q[has]
                coef[j, on[has]] = bits.signed(r, precision[has])
                q[has] = r
            p[on] = q
        _FIXED = {1: (1,), 2: (2, -1), 3: (3, -3, 1), 4: (4, -6, 4, -1)}
        for i in np.flatnonzero(fixed[coded] & (o > 0)).tolist():
            coef[: o[i], i] = _FIXED[int(o[i])]
        _residual(bits, p, o, n, y)
        _restore(y, o, n, coef, shift, int(d.max()))
        at[coded] = p
        if y is not x:
            x[:, coded] = y
    if wasted.any():
        x <<= wasted.astype(x.dtype)
    return x


def _residual(bits: _Bits, p: np.ndarray, order: np.ndarray, size: np.ndarray, y: np.ndarray) -> None:
    """Rice codes of all lanes in step: one sample of each lane at a time."""
    method = bits.read(p, 2)
    if (method > 1).any():
        raise FlacError("unknown residual coding")
    part = size >> bits.read(p, 4)
    wide = 4 + method
    escape = (1 << wide) - 1
    rice = np.zeros(p.size, dtype=np.int64)
    raw = np.full(p.size, -1, dtype=np.int64)  # bits of escaped partitions
    border = order.copy()  # where the next partition begins: at the order first
    nxt = part.copy()
    any_raw = False
    view, zeros = bits.view, _ZEROS
    live = p.size
    for t in range(int(order.min()), y.shape[0]):
        while live and size[live - 1] <= t:
            live -= 1
        if not live:
            break
        new = np.flatnonzero(border[:live] == t)
        if new.size:
            q = p[new]
            k = bits.read(q, wide[new])
            esc = k == escape[new]
            raw[new] = -1
            if esc.any():
                r = q[esc]
                raw[new[esc]] = bits.read(r, 5)
                q[esc] = r
                k[esc] = 0
            any_raw = bool((raw >= 0).any())
            rice[new] = k
            p[new] = q
            border[new] = nxt[new]
            nxt[new] += part[new]
        # lanes still in their warm-up samples wait
        if t < 32 and (order[:live] > t).any():
            on = np.flatnonzero(order[:live] <= t)
            q, k, e = p[on], rice[on], raw[on]
        else:
            on, q, k, e = None, p[:live], rice[:live], raw[:live]
        w = view[q >> 3].byteswap() << (q & 7).astype(U8)
        z = zeros.take((w >> U8(48)).astype(np.int64))
        far = np.flatnonzero(z == 16)
        if far.size:  # long runs of zeros
            for i in far.tolist():
                if e[i] >= 0:
                    continue
                at = int(q[i]) + 16
                while True:
                    v = int(view[at >> 3].byteswap()) << (at & 7) & ((1 << 64) - 1)
                    if v >> 8:
                        at += 64 - v.bit_length()
                        break
                    at += 56
                    if at >> 3 >= view.size - 8:
                        raise FlacError("a residual does not end")
                z[i] = at - int(q[i])
            w = view[(q + z) >> 3].byteswap() << ((q + z) & 7).astype(U8)
            u = (w << U8(1)) >> (U8(63) - k.astype(U8)) >> U8(1)
        else:
            u = (w << (z + 1).astype(U8)) >> (U8(63) - k.astype(U8)) >> U8(1)
        u = (z << k) | u.astype(np.int64)
        v = (u >> 1) ^ -(u & 1)
        step = z + 1 + k
        if any_raw:
            is_raw = np.flatnonzero(e >= 0)
            if is_raw.size:
                r = q[is_raw].copy()
                v[is_raw] = bits.signed(r, e[is_raw])
                step[is_raw] = e[is_raw]
        if on is None:
            y[t, :live] = v
            p[:live] += step
        else:
            y[t, on] = v
            p[on] += step


def _restore(y: np.ndarray, order: np.ndarray, size: np.ndarray, coef: np.ndarray, shift: np.ndarray, depth: int) -> None:
    """Add the prediction to the residuals, in step."""
    kind = y.dtype.type if depth <= 12 else np.int64
    for o in np.unique(order[order > 0]).tolist():
        lanes = np.flatnonzero(order == o)
        z = np.ascontiguousarray(y[:, lanes], dtype=kind)
        c, s, n = coef[:o, lanes].astype(kind), shift[lanes].astype(kind), size[lanes]
        live = lanes.size
        for t in range(o, y.shape[0]):
            while live and n[live - 1] <= t:
                live -= 1
            if not live:
                break
            total = c[0, :live] * z[t - 1, :live]
            for j in range(1, o):
                total += c[j, :live] * z[t - 1 - j, :live]
            z[t, :live] += total >> s[:live]
        y[:, lanes] = z


def decode_frames(data: np.ndarray, frames: list[Frame]) -> list[np.ndarray]:
    """Samples (samples, channels) of each frame of a byte buffer, checksums verified."""
    if not frames:
        return []
    begin, end = (np.array([getattr(f, k) for f in frames], dtype=np.int64) for k in ("begin", "end"))
    order = np.argsort(begin)
    b, e = begin[order], end[order]
    runs = np.concatenate((np.zeros(1, dtype=np.int64), np.flatnonzero(b[1:] != e[:-1]) + 1, [len(b)]))
    for i, j in zip(runs[:-1].tolist(), runs[1:].tolist()):
        wrong = np.flatnonzero(_crc16(data, b[i:j], e[i:j]))
        if wrong.size:
            raise FlacError(f"CRC-16 of {wrong.size} frames is wrong")
    bits = _Bits(data)
    out: list[np.ndarray] = [np.zeros(0)] * len(frames)
    for code in {f.channels for f in frames}:
        which = sorted((i for i, f in enumerate(frames) if f.channels == code), key=lambda i: -frames[i].size)
        size = np.array([frames[i].size for i in which], dtype=np.int64)
        depth = np.array([frames[i].bits for i in which], dtype=np.int64)
        at = np.array([frames[i].body for i in which], dtype=np.int64)
        n = code + 1 if code < 8 else 2
        side = {8: 1, 9: 0, 10: 1}.get(code, -1)
        got = [_subframes(bits, at, size, depth + (c == side)) for c in range(n)]
        if code == 8:
            got[1] = got[0] - got[1]
        elif code == 9:
            got[0] = got[0] + got[1]
        elif code == 10:
            mid = (got[0].astype(np.int64) << 1) | (got[1] & 1)
            got = [(mid + got[1]) >> 1, (mid - got[1]) >> 1]
        if n == 1:
            lanes = np.ascontiguousarray(got[0].T)
            for k, i in enumerate(which):
                out[i] = lanes[k, : frames[i].size, None]
        else:
            for k, i in enumerate(which):
                out[i] = np.stack([g[: frames[i].size, k] for g in got], axis=1)
    return out


@dataclass
class Decoded:
    pcm: bytes  # unsigned bytes for 8 bits, else signed little-endian, interleaved
    blocks: list[tuple[int, int, int]]  # sample offset, samples, byte offset in the stream
    samples: np.ndarray


def decode_many(streams: list[bytes | None]) -> list[Decoded | None]:
    """Decode whole streams, all their frames in step."""
    data = np.frombuffer(b"".join(s or b"" for s in streams), dtype=np.uint8)
    infos, frames, base = [], [], 0
    for s in streams:
        if s is None:
            infos.append(None)
            continue
        info = metadata(s)
        own = frames_of(s, info)
        infos.append((info, base, len(frames), len(own)))
        for f in own:
            frames.append(Frame(f.begin + base, f.end + base, f.body + 8 * base, f.size, f.channels, f.bits))
        base += len(s)
    got = decode_frames(data, frames)
    out: list[Decoded | None] = []
    for s, info in zip(streams, infos):
        if info is None:
            out.append(None)
            continue
        meta, base, first, n = info
        parts = got[first : first + n]
        x = np.concatenate(parts) if parts else np.zeros((0, meta.channels), dtype=np.int32)
        width = (meta.bits + 7) // 8
        raw = _raw(x, width)
        if meta.samples and len(x) != meta.samples:
            raise FlacError("the number of samples is wrong")
        if any(meta.md5) and hashlib.md5(raw).digest() != meta.md5:
            raise FlacError("the MD5 of the samples is wrong")
        at, blocks = 0, []
        for f in frames[first : first + n]:
            blocks.append((at, f.size, f.begin - base))
            at += f.size
        out.append(Decoded(raw.translate(_FLIP) if width == 1 else raw, blocks, x))
    return out


def _raw(x: np.ndarray, width: int) -> bytes:
    """Signed little-endian samples of ``width`` bytes."""
    if width == 1:
        return x.astype(np.int8).tobytes()
    if width == 2:
        return x.astype("<i2").tobytes()
    return np.ascontiguousarray(x.astype("<i4")).view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def read_range(stream: bytes, start: int, n: int) -> np.ndarray:
    """Samples from ``start`` on, decoding only the frames that hold them."""
    info = metadata(stream)
    frames = frames_of(stream, info)
    at, wanted, skip = 0, [], None
    for f in frames:
        if at < start + n and at + f.size > start:
            skip = start - at if skip is None else skip
            wanted.append(f)
        at += f.size
    got = decode_frames(np.frombuffer(stream, dtype=np.uint8), wanted)
    return np.concatenate(got)[skip : skip + n] if got else np.zeros((0, info.channels), dtype=np.int32)


def features(d: Decoded) -> str:
    """Frames, peak, root mean square and zero crossings of the first channel."""
    x = d.samples[:, 0].astype(np.int64) if d.samples.size else np.zeros(0, dtype=np.int64)
    n = max(1, x.size)
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"frames={len(d.blocks)};peak={int(np.abs(x).max(initial=0))};rms={(float((x * x).sum()) / n) ** 0.5:.3f};crossings={crossings}"


# --- columns -------------------------------------------------------------------

BLOCKS = "array<struct<sample_offset: bigint, n_samples: bigint, byte_offset: bigint>>"


def encode(df: DataFrame, payload: str = "payload", media: str = "media") -> DataFrame:
    """Adds ``media``: the payload's bytes, as unsigned 8-bit samples, in a FLAC stream."""
    kept = df.drop(*[c for c in [media] if c != payload])
    schema = kept.select("*", F.lit(None).cast("binary").alias(media)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, payload, SLICE):
                made = pa.array(encode_many(arrays.as_bytes(batch.column(payload))), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, media])

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, media: str = "media") -> DataFrame:
    """Adds ``pcm`` (bytes), ``blocks`` (sample and byte offsets of each frame) and ``feature``."""
    own = ["pcm", "blocks", "feature"]
    kept = df.drop(*[c for c in own if c != media])
    schema = kept.select("*", F.lit(None).cast("binary").alias("pcm"), F.lit(None).cast(BLOCKS).alias("blocks"), F.lit(None).cast("string").alias("feature")).schema
    shape = pa.list_(pa.struct([(k, pa.int64()) for k in ("sample_offset", "n_samples", "byte_offset")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, media, SLICE):
                got = decode_many(arrays.as_bytes(batch.column(media)))
                more = [
                    pa.array([d and d.pcm for d in got], pa.binary()),
                    pa.array([d and [dict(zip(("sample_offset", "n_samples", "byte_offset"), b)) for b in d.blocks] for d in got], shape),
                    pa.array([d and features(d) for d in got], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *own])

    return kept.mapInArrow(run, schema)


def pcm_blocks(decoded: DataFrame, key: str) -> DataFrame:
    """One row for each 8-bit mono block: key, block, sample_offset, n_samples, byte_offset, pcm."""
    each = decoded.select(key, "pcm", F.posexplode("blocks").alias("block", "b"))
    return each.select(
        key, F.col("block").cast("long").alias("block"), "b.*",
        F.expr("substring(pcm, cast(b.sample_offset + 1 as int), cast(b.n_samples as int))").alias("pcm"),
    )
