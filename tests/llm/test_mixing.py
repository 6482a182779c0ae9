"""The mix against a plain version that names every document taken."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from nightly.llm import mixing
from tests.llm.helpers import documents, prose

WEIGHTS = {("domain0",): 2.0, ("domain1", "de"): 3.0, ("other", None): 2.0, ("domain2", "x"): 0.0}


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def poured(total, children, capacity, weights):
    """Water filling, one child after the other is found full."""
    share = dict.fromkeys(children, 0.0)
    open_ = [c for c in children if capacity[c] > 0 and weights.get(c, 1.0) > 0]
    left = min(total, sum(capacity[c] for c in open_))
    while open_:
        unit = left / sum(weights.get(c, 1.0) for c in open_)
        full = [c for c in open_ if weights.get(c, 1.0) * unit >= capacity[c]]
        for c in full or open_:
            share[c] = capacity[c] if full else weights.get(c, 1.0) * unit
        if not full:
            break
        left -= sum(capacity[c] for c in full)
        open_ = [c for c in open_ if c not in full]
    return share


def plain(rows, keys, share, epochs, seed):
    """Copies of every row number; ``keys`` gives the order keys of epoch 0, 1, ... of a row."""
    leaves = defaultdict(list)
    for i, (_, text, lang, source) in enumerate(rows):
        end = re.search(r"(\d{1,9})$", source or "")
        leaves[(f"domain{int(end[1]) % 3}" if end else "other", lang, source)].append((i, count(text)))
    capacity = defaultdict(float)
    for path, held in leaves.items():
        for d in range(4):
            capacity[path[:d]] += epochs * sum(n for _, n in held)
    budget = {(): share * sum(count(t) for _, t, _, _ in rows)}
    for d in range(3):
        for node in [n for n in budget if len(n) == d]:
            below = {p[: d + 1] for p in leaves if p[:d] == node}
            budget |= poured(budget[node], below, capacity, WEIGHTS)
    copies = {}
    for path, held in leaves.items():
        tokens = sum(n for _, n in held)
        if not tokens:
            copies |= {i: int(all(WEIGHTS.get(path[:d], 1.0) > 0 for d in (1, 2, 3))) for i, _ in held}
            continue
        full, rest = divmod(int(budget[path] + 1e-6), tokens)
        before = 0
        for i, n in sorted(held, key=lambda r: keys[r[0]][full]):
            copies[i] = full + (before < rest)
            before += n
    return {i: n for i, n in copies.items() if n}


@pytest.mark.parametrize("share, epochs", [(1.0, 1), (0.5, 2), (0.9, 3), (0.05, 1)])
def test_every_document_taken(spark, share, epochs):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        lang, source = rng.choice(["de", "en", "", None]), rng.choice(["s0", "s1", "s4", "", None, "web"])
        rows.append((i, prose(rng, rng.randint(1, 60)) if rng.random() > 0.1 else rng.choice(["", None, " "]), lang, source))
    rows += [(1000, "", "empty", "s2"), (1001, None, "empty", "s2"), (1002, None, None, "none9"), (1003, " ", "x", "s2"), (1004, "a b", "x", "s5")]
    df = documents(spark, rows, extra=True).repartition(4)
    key = [F.xxhash64(F.lit(1), F.lit(e).cast("long"), F.col("doc_id"), F.lit(None).cast("string")).alias(f"k{e}") for e in range(epochs + 1)]
    unsigned = lambda v: v % (1 << 64)
    order = {r[0]: [unsigned(v) for v in r[1:]] for r in df.select("doc_id", *key).collect()}
    want = plain(rows, [order[r[0]] for r in rows], share, epochs, 1)
    got = {r["doc_id"]: r["mix_copies"] for r in mixing.mix(df, WEIGHTS, share, epochs).collect()}
    assert got == {rows[i][0]: n for i, n in want.items()}
    if share == 1.0:
        assert set(got) == {r[0] for r in rows} - {1003, 1004}
