"""Conversation repair against a plain search over all cheap edits."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import cache

import pytest

from nightly.llm import conversations
from tests.conftest import DATA

SCHEMA = "conv_id long, turn long, role string, text string"
WS = " \t\n\x0b\f\r"


def facts(rows):
    """Faults, number of gaps and of illegal neighbours of rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        last = text.rstrip(WS)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None)
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return faults, gaps, sum(p not in ("su", "ua", "au") for p in pairs)


def plain(rows):
    """Least (cost, audit) and the repaired lines, by recursion over turns and the role before."""
    faults, gaps, illegal = facts(rows)
    may = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    @cache
    def best(i, before, inserted):
        found = [(0, "", ())] if i == len(rows) and before in ("", "a") else []
        if inserted < 2:
            for r in "ua":
                if r in may[before] and (got := best(i, r, inserted + 1)):
                    found.append((got[0] + 5, "I" + got[1], (full[r] + ":", *got[2])))
        if i < len(rows):
            _, role, text = rows[i]
            if got := best(i + 1, before, 0):
                found.append((got[0] + 2, "D" + got[1], got[2]))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                if role[:1] and role[:1] in may[before] and (got := best(i + 1, role[:1], 0)):
                    found.append((got[0] + extra, "K" + got[1], (f"{role}:{text}", *got[2])))
                for r in "ua":
                    if r in may[before] and (got := best(i + 1, r, 0)):
                        found.append((got[0] + extra + 1, "R" + got[1], (f"{full[r]}:{text}", *got[2])))
        return min(found) if found else None

    cost, audit, lines = best(0, "", 0)
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def expected(rows):
    by = {}
    for c, *r in rows:
        by.setdefault(c, []).append((r[0], " " if r[1] is None else r[1], " " if r[2] is None else r[2]))
    return {c: plain(ordered(r)) for c, r in by.items()}


def random_rows(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["a.", "b!", "c", " ", "", "d? \n", None, "same.", "e " + str(t) + "."])
            rows.append((c, rng.choice([t, t, t, t + 3, None]), role, text))
    return rows


@pytest.mark.parametrize("max_rows", [1000, 3])
def test_least_audits(spark, max_rows):
    rng = random.Random(3)
    rows = random_rows(rng, 150)
    rows += [(None, t, "user", f"{t}.") for t in range(5)] + [(200, 1, "user", "x.")] * 6 + [(201, 1, "system", "x.")]
    rows += [(202, t, ("user", "assistant")[t % 2], f"long {t}.") for t in range(60) if t % 7]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", edit string, _block int").repartition(5)
    got = conversations.report(conversations.repair(df, max_rows), df).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == expected(rows)
    assert len(got) == len(expected(rows))


def test_blocks_agree_with_whole_conversations(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a", "b", "c", "d"]) * rng.randint(1, 9) + rng.choice(["", "."])) for c in range(3) for t in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    cut = conversations.report(conversations.repair(df, 37), df)
    assert sorted(cut.collect()) == sorted(conversations.report(conversations.repair(df), df).collect())


def test_turns_of_the_repair(spark):
    rows = [(1, 0, "user", "Hi."), (1, 2, "user", "And"), (1, 3, "assistant", "Yes."), (1, 4, "assistant", "")]
    got = conversations.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("block", "seq").collect()
    assert [(r["edit"], r["turn"], r["role"], r["text"], r["fault"], r["cost"]) for r in got] == [
        ("K", 0, "user", "Hi.", None, 0), ("D", 2, "user", "And", "truncated", 2), ("K", 3, "assistant", "Yes.", None, 0), ("D", 4, "assistant", "", "blank", 2),
    ]
    assert conversations.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if h == 1 else "".join(x for x in text if x not in ".!?") if h == 2 else text
        hurt += [(c, t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    want = expected(hurt)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {c: want.get(c, nothing) for c in {r[0] for r in rows}}
    got = conversations.op11_conversation_repair(spark, DATA).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(want)
