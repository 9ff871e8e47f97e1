"""Conversation repair against all edit scripts, with and without cuts into blocks."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from caseloom.llm import conversations as V

GOOD = re.compile(r"(s?(ua)+)?\Z")
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    """First fault of each (role, text)."""
    out, seen = [], set()
    for role, text in rows:
        core = text.strip(WHITE)
        out.append(1 if not core else 2 if (role, text) in seen else 3 if core[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(rows):
    """Cost, audit and turns of the cheapest edit script, by trying every script of keep, rerole and delete with inserts."""
    best = None
    for kinds in product("KRD", repeat=len(rows)):
        if any(f in (1, 2) and k != "D" for f, k in zip(faults(rows), kinds)):
            continue
        for ins in product(range(3), repeat=len(rows) + 1):  # more than two inserts in one place are never needed
            audit = "".join("I" * i + k for i, k in zip(ins, kinds)) + "I" * ins[-1]
            price = sum({"K": 0, "R": 2, "D": 3}[k] for k in kinds) + 2 * sum(ins) + sum(f == 3 and k != "D" for f, k in zip(faults(rows), kinds))
            if best and (price, audit) >= best[:2]:
                continue
            it, made = iter(rows), []
            for letter in audit:
                row = next(it) if letter != "I" else (None, "")
                if letter != "D":
                    made.append((row[0] if letter == "K" else None, row[1]))
            # free roles are user or assistant, whatever fits
            free = [k for k, (r, _) in enumerate(made) if r is None]
            for roles in product(("user", "assistant"), repeat=len(free)):
                named = [r for r, _ in made]
                for k, r in zip(free, roles):
                    named[k] = r
                if GOOD.match("".join(r[:1] or "-" for r in named)):
                    best = (price, audit, [(r, t) for r, (_, t) in zip(named, made)])
                    break
    return best


def test_programme_equals_all_scripts():
    r = random.Random(2)
    for _ in range(60):
        rows = [(r.choice(["user", "assistant", "system", "user", "", "tool"]), r.choice(["a.", "b.", "c", "", "d!", "e?", "a."])) for _ in range(r.randint(0, 3))]
        want = cheapest(rows)
        codes = V.with_duplicates([V.plain_code(t) for _, t in rows], [V.digest(*x) for x in rows], set())
        assert list(codes) == faults(rows)
        ways = V.paths([x[:1] for x, _ in rows], codes)
        cost, audit = min((c + 2 * len(V.CLOSING[s]), a + "I" * len(V.CLOSING[s])) for s, (c, a) in ways.items())
        roles, texts, _ = V.applied([x for x, _ in rows], [t for _, t in rows], audit)
        assert (cost, audit, list(zip(roles, texts))) == want


def plain(rows):
    """One row for each conversation of (conv, turn, role, text, present), by the programme over all its turns at once."""
    out = {}
    for conv in {x[0] for x in rows}:
        mine = sorted((x for x in rows if x[0] == conv and x[4]), key=lambda x: (x[1] is not None, x[1] or 0, " " if x[2] is None else x[2], " " if x[3] is None else x[3]))
        turns = [(" " if x[2] is None else x[2], " " if x[3] is None else x[3]) for x in mine]
        codes = faults(turns)
        ways = V.paths([a[:1] for a, _ in turns], bytes(codes))
        cost, audit = min((c + 2 * len(V.CLOSING[s]), a + "I" * len(V.CLOSING[s])) for s, (c, a) in ways.items())
        roles, texts, _ = V.applied([a for a, _ in turns], [t for _, t in turns], audit)
        places = {x[1] for x in mine if x[1] is not None}
        pairs = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:]))
        sha = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in zip(roles, texts)).encode()).hexdigest()
        out[conv] = (max(places) - min(places) + 1 - len(places) if places else 0, codes.count(1), codes.count(2), codes.count(3), pairs, cost, audit, sha)
    return out


def rows_of(seed):
    r = random.Random(seed)
    rows = []
    for c in [*range(30), None]:
        for k in range(60 if c == 7 else r.randint(1, 8)):
            rows.append((c, r.choice([k, k, k + 1, None]), r.choice(["user", "assistant", "user", "assistant", "system", None, ""]), r.choice(["hi.", "yes!", None, "", " \n", "no end", f"t{k}.", "é?"]), r.random() > 0.1))
    rows += [(99, 1, "user", "gone.", False), (98, None, "user", "x" * 5000 + ".", True), (97, 3, "assistant", "only.", True), (97, 3, "assistant", "only.", True)]
    r.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn int, role string, text string, here boolean"
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("block", [1024, 3, 1])
def test_repair_in_blocks_of_any_size(spark, block):
    rows = rows_of(block)
    df = spark.createDataFrame([(*x, "extra") for x in rows], SCHEMA + ", conv string")  # a column named like one of the result's
    got = V.summaries(V.repair(df, present=F.col("here"), block=block)).collect()
    assert {x.conv: tuple(x[f] for f in FIELDS) for x in got} == plain(rows)
    assert len(got) == len({x[0] for x in rows})


def test_turns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "a."), (1, 1, "assistant", "b."), (1, 2, "user", "c")], "conv_id long, turn long, role string, text string")
    got = [(r.role, r.text, r.edit) for r in V.turns(V.repair(df)).orderBy("seq", "pos").collect()]
    assert len(got) % 2 == 0 and {r for r, _, _ in got} == {"user", "assistant"}
    assert V.summaries(V.repair(df.limit(0))).count() == 0
    assert V.summaries(V.repair(df.selectExpr("cast(conv_id as string) as conv_id", "turn", "role", "text"))).first().conv == "1"


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in (0, 1, None)] + [(None, 5, None, None)]
    got = V.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if f == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(f, text), f != 0)
        want += [row] * (2 if f == 3 else 1)
    assert sorted(map(str, (tuple(x) for x in got))) == sorted(map(str, want))
