"""Conversation structure repair by a dynamic programme over retained turns.

A conversation should have the roles ``(s?(ua)+)?`` by their initials: maybe one
system turn, then user and assistant in turn.  Edits: K keep, R give another role
(user or assistant), D delete, I insert an empty turn.  Blank turns (nothing but
white space) and duplicates (role and text seen before) must be deleted; a truncated
turn (its last character does not end a sentence) that stays costs more.

The programme goes over turns that stay.  ``deleted`` is the prefix sum of the cost
of deleting all; for each state (no turn yet, or the last role) ``low`` has the least
cost less that sum, so the price of the gap between two turns that stay is a
difference of sums, and a turn looks at four running minima in place of all turns
before it.  The pair of roles says what must be inserted.  Of equal costs the
audit (the initials of the edits) that comes first by bytes wins; two audits of the
same turns in the same state are never one the beginning of the other, so partial
audits may be compared.

Spark's part: rows are sorted by range of (conversation, turn), so one long
conversation spreads over tasks.  A conversation that lies inside one partition and
one block is repaired where it is read.  Others (the two at a partition's ends, and
those of over ``BLOCK`` turns or ``BYTES`` bytes) become blocks.  Turns seen in an
earlier block are found by a join of digests; each block gives a table of least
costs from any state to any other and the order of their audits, a few numbers a
block; these tables are put in a row for each conversation, which fixes the
states at each block's ends, and the blocks are repaired independently again.

Equal turns go by role, then by the first 64 characters of the text, then by a hash
of it.  Nulls in role and text count as one space; a null conversation is one of its
own; null turns come first and count in no gap.  Repeated rows are duplicates.  Rows
with ``present`` false only say that the conversation exists.  An empty table gives
an empty result.  Columns besides those named are left out; names given may be any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm import scratch
from caseloom.llm.sqltext import crc32_sql

REROLE, DELETE, INSERT, TRUNCATION = 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
BLOCK, BYTES = 1024, 1 << 20
STATES = ("", "s", "u", "a")
ROLES = {"u": "user", "a": "assistant"}
#: Roles to insert between two that stay; pairs that are not here cannot be neighbours.
BETWEEN = {("", "s"): "", ("", "u"): "", ("", "a"): "u", ("s", "u"): "", ("s", "a"): "u", ("u", "a"): "", ("u", "u"): "a", ("a", "u"): "", ("a", "a"): "u"}
#: Roles to insert after the last one that stays.
CLOSING = {"": "", "s": "ua", "u": "a", "a": ""}
LEGAL = ("su", "ua", "au")
NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# --- one conversation ------------------------------------------------------------


def paths(initials: list[str], codes: bytes, start: str = "") -> dict[str, tuple[int, str]]:
    """For each state that can be reached from ``start``: least cost, and the first of its audits."""
    low = {start: (0, 0, "")}  # state -> least cost less deletions, turns it covers, audit
    deleted = 0
    for j, (role, code) in enumerate(zip(initials, codes)):
        if code not in (BLANK, DUPLICATE):
            found = []
            for new in "sua":
                if role != new and new == "s":
                    continue  # no turn becomes a system turn
                own = (0 if role == new else REROLE) + (TRUNCATION if code == TRUNCATED else 0)
                best = None
                for old, (v, i, audit) in low.items():
                    between = BETWEEN.get((old, new))
                    if between is None:
                        continue
                    cost = v + deleted + INSERT * len(between) + own
                    if best is None or cost <= best[0]:
                        written = audit + "D" * (j - i) + "I" * len(between) + ("K" if role == new else "R")
                        best = min(best or (cost, written), (cost, written))
                if best:
                    found.append((new, *best))
            for new, cost, audit in found:
                v, now = cost - deleted - DELETE, low.get(new)
                if now is None or v < now[0] or v == now[0] and audit < now[2] + "D" * (j + 1 - now[1]):
                    low[new] = (v, j + 1, audit)
        deleted += DELETE
    return {s: (v + deleted, audit + "D" * (len(initials) - i)) for s, (v, i, audit) in low.items()}


def applied(roles: list[str], texts: list[str], audit: str, last: str = "") -> tuple[list[str], list[str], str]:
    """Roles and texts after the edits, and the letter of each; ``last`` is the role before them."""
    out_roles, out_texts, letters, k = [], [], [], 0
    for letter in audit:
        if letter == "D":
            k += 1
            continue
        due = "a" if last == "u" else "u"
        role, text = ROLES[due], ""
        if letter != "I":
            role, text, k = (roles[k] if letter == "K" else role), texts[k], k + 1
        last = role[:1]
        out_roles.append(role)
        out_texts.append(text)
        letters.append(letter)
    return out_roles, out_texts, "".join(letters)


def digest(role: str, text: str) -> bytes:
    return xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"))


def plain_code(text: str) -> int:
    """The fault that a turn has by itself."""
    core = text.strip(WHITE)
    return BLANK if not core else FINE if core[-1] in ".!?" else TRUNCATED


def with_duplicates(codes: list[int] | bytes, digests: list[bytes], known: set[bytes]) -> bytes:
    """Codes where turns seen before, here or in ``known``, are duplicates; ``known`` grows."""
    out = bytearray(codes)
    for i, d in enumerate(digests):
        if out[i] != BLANK and d in known:
            out[i] = DUPLICATE
        known.add(d)
    return bytes(out)


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


class _Turns:
    """The turns of one conversation, or of a block of it, in order."""

    def __init__(self) -> None:
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns: list[int] = []  # distinct, rising
        self.size = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def full(self, block: int) -> bool:
        return len(self.roles) >= block or self.size >= BYTES


# --- tables ------------------------------------------------------------------------

_PIECE = ", ".join(f"{n} long" for n in NUMBERS) + ", audit string, roles array<string>, texts array<string>, letters string"
_RAW = "initials array<string>, codes binary, digests binary, low long, high long, turns long"
_STRINGS = pa.list_(pa.string())


def _batch(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in types.items()], names=list(types))


_TYPES = {
    **{n: pa.int64() for n in NUMBERS}, "audit": pa.string(), "roles": _STRINGS, "texts": _STRINGS, "letters": pa.string(),
    "initials": _STRINGS, "codes": pa.binary(), "digests": pa.binary(), "low": pa.int64(), "high": pa.int64(), "turns": pa.int64(),
}


def _read(rows: DataFrame, kind: str, block: int) -> DataFrame:
    """Pieces of whole conversations (``whole``), and blocks of the others, from sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = TaskContext.get().partitionId() << 32, 0
        types = None
        out: list[dict] = []
        key, conv, held, first, cut = None, None, _Turns(), True, False

        def close(whole: bool) -> None:
            nonlocal held, n
            row = dict.fromkeys(types)
            row |= {"_c": key, "conv": conv, "seq": at + n, "whole": whole, "roles": held.roles, "texts": held.texts}
            own = [plain_code(t) for t in held.texts]
            digests = [digest(r, t) for r, t in zip(held.roles, held.texts)]
            initials = [r[:1] for r in held.roles]
            if whole:
                codes = with_duplicates(own, digests, set())
                ways = paths(initials, codes)
                cost, audit = min((c + INSERT * len(CLOSING[s]), a + "I" * len(CLOSING[s])) for s, (c, a) in ways.items())
                roles, texts, letters = applied(held.roles, held.texts, audit)
                gaps = held.turns[-1] - held.turns[0] + 1 - len(held.turns) if held.turns else 0
                row |= {"gaps": gaps, "illegal": illegal_pairs(initials), "cost": cost, "audit": audit, "roles": roles, "texts": texts, "letters": letters}
                row |= {"blank": codes.count(BLANK), "duplicate": codes.count(DUPLICATE), "truncated": codes.count(TRUNCATED)}
            else:
                row |= {"initials": initials, "codes": bytes(own), "digests": b"".join(digests), "turns": len(held.turns)}
                row |= {"low": held.turns[0] if held.turns else None, "high": held.turns[-1] if held.turns else None}
            out.append(row)
            held, n = _Turns(), n + 1

        def flush() -> pa.RecordBatch:
            made = _batch({c: [r[c] for r in out] for c in types}, types)
            out.clear()
            return made

        for batch in batches:
            if types is None:
                types = {"_c": pa.string(), "conv": batch.schema.field("conv").type, "seq": pa.int64(), "whole": pa.bool_(), **_TYPES}
            size = 0
            for c, v, turn, role, text, present in zip(*(batch.column(x).to_pylist() for x in ("_c", "conv", "turn", "role", "text", "present"))):
                if c != key:
                    if key is not None:
                        close(not first and not cut)
                        first = False
                    key, conv, cut = c, v, False
                if present:
                    if held.full(block):
                        close(False)
                        cut = True
                    held.add(turn, role, text)
                    size += len(text)
                if size > BYTES:
                    if out:
                        yield flush()
                    size = 0
            if out:
                yield flush()
        if key is not None:
            close(False)  # it may go on in the next partition
            yield flush()

    return rows.mapInArrow(run, f"_c string, conv {kind}, seq long, whole boolean, {_PIECE}, {_RAW}")


def _earlier(blocks: DataFrame) -> DataFrame:
    """_c, seq, known: digests of a block that an earlier block of its conversation has."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, s, d in zip(*(batch.column(x).to_pylist() for x in ("_c", "seq", "digests"))):
                own = list({d[i : i + 16] for i in range(0, len(d), 16)})
                yield _batch({"_c": [c] * len(own), "seq": [s] * len(own), "d": own}, {"_c": pa.string(), "seq": pa.int64(), "d": pa.binary()})

    seen = blocks.select("_c", "seq", "digests").mapInArrow(each, "_c string, seq long, d binary")
    again = seen.groupBy("_c", "d").agg(F.min("seq").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = seen.join(again.select("_c", "d", "first"), ["_c", "d"]).where("seq > first")
    return later.groupBy("_c", "seq").agg(F.collect_list("d").alias("known"))  # no more than the turns of a block


def _ways(blocks: DataFrame) -> DataFrame:
    """For each block its final codes, and least costs between states with the order of their audits."""
    names = ("_c", "seq", "initials", "codes", "digests", "low", "high", "turns", "known")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, s, initials, codes, digests, low, high, turns, known in zip(*(batch.column(x).to_pylist() for x in names)):
                codes = with_duplicates(codes, [digests[i : i + 16] for i in range(0, len(digests), 16)], set(known or ()))
                costs, ranks = np.full((4, 4), -1), np.zeros((4, 4), dtype=np.int64)
                for i, start in enumerate(STATES):
                    found = paths(initials, codes, start)
                    order = sorted(found, key=lambda e: found[e][1])
                    for end, (cost, _) in found.items():
                        costs[i, STATES.index(end)], ranks[i, STATES.index(end)] = cost, order.index(end)
                yield pa.RecordBatch.from_pylist(
                    [{
                        "_c": c, "seq": s, "codes": codes, "low": low, "high": high, "turns": turns, "illegal": illegal_pairs(initials),
                        "head": initials[0] if initials else None, "tail": initials[-1] if initials else None, "costs": costs.ravel().tolist(), "ranks": ranks.ravel().tolist(),
                    }],
                    schema=pa.schema([
                        ("_c", pa.string()), ("seq", pa.int64()), ("codes", pa.binary()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("illegal", pa.int64()),
                        ("head", pa.string()), ("tail", pa.string()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())),
                    ]),
                )

    schema = "_c string, seq long, codes binary, low long, high long, turns long, illegal long, head string, tail string, costs array<long>, ranks array<long>"
    return blocks.select(*names).mapInArrow(run, schema)


class _Row:
    """The blocks of one conversation, put in a row: a few numbers for each."""

    def __init__(self, key: str) -> None:
        self.key, self.seqs, self.back = key, [], []
        self.now = {0: (0, 0)}  # state -> cost, rank among audits
        self.low = self.high = self.tail = None
        self.turns = self.illegal = 0

    def add(self, seq, costs, ranks, low, high, turns, illegal, head, tail) -> None:
        best: dict[int, tuple] = {}
        for i, (cost, rank) in self.now.items():
            for o in range(4):
                if costs[4 * i + o] >= 0:
                    best[o] = min(best.get(o, (1 << 62,)), (cost + costs[4 * i + o], rank, ranks[4 * i + o], i))
        order = sorted(best, key=lambda o: best[o][1:3])
        self.seqs.append(seq)
        self.back.append({o: x[3] for o, x in best.items()})
        self.now = {o: (x[0], order.index(o)) for o, x in best.items()}
        if low is not None:
            self.turns += turns - (self.high == low)
            self.low, self.high = low if self.low is None else self.low, high
        if head is not None:
            self.illegal += illegal + (self.tail is not None and self.tail + head not in LEGAL)
            self.tail = tail

    def rows(self) -> list[dict]:
        """The states at the ends of each block; the last one carries the conversation's numbers."""
        cost, _, end = min((cost + INSERT * len(CLOSING[STATES[o]]), rank, o) for o, (cost, rank) in self.now.items())
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        out = []
        for k in range(len(self.seqs) - 1, -1, -1):
            last = k == len(self.seqs) - 1
            start = self.back[k][end]
            numbers = {"gaps": gaps, "illegal": self.illegal, "cost": cost} if last else {"gaps": 0, "illegal": 0, "cost": 0}
            out.append({"_c": self.key, "seq": self.seqs[k], "start": STATES[start], "end": STATES[end], "last": last, **numbers})
            end = start
        return out


def _joined(ways: DataFrame) -> DataFrame:
    names = ("seq", "costs", "ranks", "low", "high", "turns", "illegal", "head", "tail")
    schema = pa.schema([("_c", pa.string()), ("seq", pa.int64()), ("start", pa.string()), ("end", pa.string()), ("last", pa.bool_()), ("gaps", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = None
        for batch in batches:
            for c, *values in zip(*(batch.column(x).to_pylist() for x in ("_c", *names))):
                if row is None or row.key != c:
                    if row is not None:
                        yield pa.RecordBatch.from_pylist(row.rows(), schema=schema)
                    row = _Row(c)
                row.add(*values)
        if row is not None:
            yield pa.RecordBatch.from_pylist(row.rows(), schema=schema)

    dealt = ways.select("_c", *names).repartition("_c").sortWithinPartitions("_c", "seq")
    return dealt.mapInArrow(run, "_c string, seq long, start string, end string, last boolean, gaps long, illegal long, cost long")


def _mended(blocks: DataFrame, kind: str) -> DataFrame:
    """Blocks with their codes and the states at their ends, to pieces."""
    names = ("_c", "conv", "seq", "roles", "texts", "initials", "codes", "start", "end", "last", "gaps", "illegal", "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = {"_c": pa.string(), "conv": batch.schema.field("conv").type, "seq": pa.int64(), "whole": pa.bool_(), **dict(list(_TYPES.items())[: len(NUMBERS) + 4])}
            for c, conv, seq, roles, texts, initials, codes, start, end, last, gaps, illegal, cost in zip(*(batch.column(x).to_pylist() for x in names)):
                audit = paths(initials, codes, start)[end][1] + "I" * (len(CLOSING[end]) if last else 0)
                new_roles, new_texts, letters = applied(roles, texts, audit, start)
                row = {
                    "_c": c, "conv": conv, "seq": seq, "whole": False, "gaps": gaps, "blank": codes.count(BLANK), "duplicate": codes.count(DUPLICATE),
                    "truncated": codes.count(TRUNCATED), "illegal": illegal, "cost": cost, "audit": audit, "roles": new_roles, "texts": new_texts, "letters": letters,
                }
                yield _batch({k: [v] for k, v in row.items()}, types)

    return blocks.select(*names).mapInArrow(run, f"_c string, conv {kind}, seq long, whole boolean, {_PIECE}")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None, block: int = BLOCK) -> DataFrame:
    """Pieces of repaired conversations, in the order of ``seq``.

    conv, seq, whole (the conversation's only piece), gaps, blank, duplicate,
    truncated, illegal and cost (they add up over a conversation's pieces), audit,
    and the turns that come out: roles, texts and the letter of each.  Eager: read
    rows go to the shared folder, as the result does.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.when(F.col(conv).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(conv).cast("string")))
    own = rows.select(
        key.alias("_c"), F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"),
        (F.lit(True) if present is None else present).alias("present"),
    )
    kind = own.schema["conv"].dataType.simpleString()
    order = [F.col("_c"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.xxhash64("text")]
    read, path = scratch.stored(_read(own.repartitionByRange(*order).sortWithinPartitions(*order), kind, block), "turns")
    piece = ["_c", "conv", "seq", "whole", *NUMBERS, "audit", "roles", "texts", "letters"]
    whole, blocks = read.where("whole").select(*piece), read.where("NOT whole")
    ways, ways_path = scratch.stored(_ways(blocks.join(_earlier(blocks), ["_c", "seq"], "left")), "ways")
    settled = blocks.drop("codes", *NUMBERS).join(ways.select("_c", "seq", "codes").join(_joined(ways), ["_c", "seq"]), ["_c", "seq"])
    mended, _ = scratch.stored(_mended(settled, kind), "mended")
    scratch.drop(rows.sparkSession, ways_path)
    return whole.unionByName(mended.select(*piece)).drop("_c")


def turns(pieces: DataFrame) -> DataFrame:
    """One row for each turn that comes out: conv, seq, pos, role, text, edit; in order of seq and pos."""
    each = pieces.select("conv", "seq", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "t"), "letters")
    return each.select("conv", "seq", "pos", F.col("t.roles").alias("role"), F.col("t.texts").alias("text"), F.col("letters").substr(F.col("pos") + 1, F.lit(1)).alias("edit"))


def summaries(pieces: DataFrame) -> DataFrame:
    """One row for each conversation: its numbers, its audit, and the digest of its turns as ``role:text`` lines.

    A digest is sequential, so the pieces of a long conversation pass one task, one
    after the other; it holds one piece, and the audit.
    """
    names = ("conv", "audit", "roles", "texts", *NUMBERS)
    kind = pieces.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha, lines, types = None, hashlib.sha256(), False, None

        def done() -> pa.RecordBatch:
            row = {"conv": held[0], **held[1], "audit": "".join(held[2]), "repaired_sha256": sha.hexdigest()}
            return _batch({k: [row[k]] for k in types}, types)

        for batch in batches:
            types = {"conv": batch.schema.field("conv").type, **{n: pa.int64() for n in NUMBERS}, "audit": pa.string(), "repaired_sha256": pa.string()}
            for conv, audit, roles, texts, *numbers in zip(*(batch.column(x).to_pylist() for x in names)):
                if held is None or held[0] != conv:
                    if held is not None:
                        yield done()
                    held, sha, lines = (conv, dict.fromkeys(NUMBERS, 0), []), hashlib.sha256(), False
                for n, x in zip(NUMBERS, numbers):
                    held[1][n] += x
                held[2].append(audit)
                for role, text in zip(roles, texts):
                    sha.update(("\n" if lines else "").encode() + f"{role}:{text}".encode())
                    lines = True
        if held is not None:
            yield done()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            made = [hashlib.sha256("\n".join(f"{a}:{b}" for a, b in zip(r["roles"], r["texts"])).encode()).hexdigest() for r in rows]
            columns = [batch.column(c) for c in ("conv", *NUMBERS, "audit")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.string())], names=["conv", *NUMBERS, "audit", "repaired_sha256"])

    schema = f"conv {kind}, " + ", ".join(f"{n} long" for n in NUMBERS) + ", audit string, repaired_sha256 string"
    whole = pieces.where("whole").select(*names).mapInArrow(each, schema)
    parts = pieces.where("NOT whole").select(*names, "seq").repartition("conv").sortWithinPartitions("conv", "seq")
    return whole.unionByName(parts.mapInArrow(run, schema))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text and present, with faults by crc32(``conv:turn``) % 20: 0 drops a turn (present is
    false), 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 gives it to the user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    new_text = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.regexp_replace("_t", "[.!?]", "")).otherwise(F.col("_t"))
    out = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), space(role).alias("_r"), space(text).alias("_t"), fault.alias("_f"))
    copies = F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.select(
        "conv", "turn", F.when(F.col("_f") == 4, "user").otherwise(F.col("_r")).alias("role"), new_text.alias("text"), (F.col("_f") != 0).alias("present"), F.explode(copies).alias("_k")
    ).drop("_k")


# --- SQL -------------------------------------------------------------------------------


def oracle() -> str:
    """DuckDB SQL for the registered query: the same programme, turn by turn, in a recursive query.

    Each step has cost and audit of the four states; a turn that is deleted adds to all.
    """
    own = f"CASE f WHEN 3 THEN {TRUNCATION} ELSE 0 END"

    def into(new: str) -> str:
        """Cost and audit of a turn that stays as ``new``, the least of all states before."""
        price = f"CASE WHEN i = '{new}' THEN 0 ELSE {REROLE} END + {own}"
        letter = f"CASE WHEN i = '{new}' THEN 'K' ELSE 'R' END"
        ways = [f"{{'c': d{s or 'n'}.c + {INSERT * len(b)} + {price}, 'a': d{s or 'n'}.a || '{'I' * len(b)}' || {letter}}}" for (s, n), b in BETWEEN.items() if n == new]
        return ", ".join(f"CASE WHEN d{s or 'n'} IS NOT NULL THEN {w} END" for (s, _), w in zip([k for k in BETWEEN if k[1] == new], ways))

    gone = lambda s: f"CASE WHEN d{s} IS NOT NULL THEN {{'c': d{s}.c + {DELETE}, 'a': d{s}.a || 'D'}} END"
    least = lambda *xs: f"list_sort(list_filter([{', '.join(xs)}], lambda x: x IS NOT NULL))[1]"
    step = {
        "n": gone("n"), "s": f"CASE WHEN f NOT IN (1, 2) AND i = 's' THEN {least(gone('s'), into('s'))} ELSE {gone('s')} END",
        "u": f"CASE WHEN f NOT IN (1, 2) THEN {least(gone('u'), into('u'))} ELSE {gone('u')} END",
        "a": f"CASE WHEN f NOT IN (1, 2) THEN {least(gone('a'), into('a'))} ELSE {gone('a')} END",
    }
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    ends = ", ".join(f"CASE WHEN d{s or 'n'} IS NOT NULL THEN {{'c': d{s or 'n'}.c + {INSERT * len(c)}, 'a': d{s or 'n'}.a || '{'I' * len(c)}'}} END" for s, c in CLOSING.items())
    state = "STRUCT(c BIGINT, a VARCHAR)"
    return f"""
    WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS h FROM conversations),
    rows_ AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE h WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM raw WHERE h <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS j, trim(text, {white}) AS core, left(role, 1) AS i FROM rows_),
    faults AS (SELECT *, CASE WHEN core = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY j) > 1 THEN 2 WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f,
      lag(i) OVER (PARTITION BY conv_id ORDER BY j) || i AS pair FROM placed),
    dp(conv_id, j, dn, ds, du, da) AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT), CAST({{'c': 0, 'a': ''}} AS {state}), CAST(NULL AS {state}), CAST(NULL AS {state}), CAST(NULL AS {state}) FROM conversations
      UNION ALL SELECT dp.conv_id, dp.j + 1, CAST({step['n']} AS {state}), CAST({step['s']} AS {state}), CAST({step['u']} AS {state}), CAST({step['a']} AS {state})
      FROM dp JOIN faults x ON x.conv_id IS NOT DISTINCT FROM dp.conv_id AND x.j = dp.j + 1),
    best AS (SELECT conv_id, {least(ends)} AS w FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY j DESC) AS r FROM dp) WHERE r = 1),
    tokens AS (SELECT conv_id, unnest(string_split(regexp_replace(w.a, '(.)', '\\1|', 'g'), '|')) AS e, generate_subscripts(string_split(regexp_replace(w.a, '(.)', '\\1|', 'g'), '|'), 1) AS k FROM best),
    edits AS (SELECT *, count_if(e <> 'I') OVER w AS j, count_if(e <> 'D') OVER w AS p FROM tokens WHERE e <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
    stays AS (SELECT e.conv_id, e.k, e.p, e.e, x.role, x.text, max(CASE WHEN e.p = 1 AND e.e = 'K' AND x.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS s
      FROM edits e LEFT JOIN faults x ON x.conv_id IS NOT DISTINCT FROM e.conv_id AND x.j = e.j AND e.e <> 'I' WHERE e.e <> 'D'),
    lines AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (p - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS t FROM stays GROUP BY conv_id),
    sums AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count_if(f = 1) AS blank, count_if(f = 2) AS duplicate, count_if(f = 3) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
    SELECT b.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
      CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, w.c AS cost, w.a AS audit, sha256(coalesce(t, '')) AS repaired_sha256
    FROM best b LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM b.conv_id"""
