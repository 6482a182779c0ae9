"""Ranked search against a plain scan, and bounds against exact scores."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from nightly.llm import lexical
from tests.llm.helpers import documents, odd, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, top=20):
    bags = [(i, words(t)) for i, t in docs]
    bags = [(i, w, Counter(w)) for i, w in bags if w]
    n, length = len(bags), sum(len(w) for _, w, _ in bags)
    df = Counter(t for _, _, c in bags for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, w, c in bags:
            m = 75 + (25 * len(w) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if s and i is not None:
                scores.append((-s, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:top])]
    return sorted(out)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = odd(rng) + [(100 + i, prose(rng, rng.randint(1, 120))) for i in range(250)]
    same = prose(rng, 40)
    rows += [(1000 + i, same) for i in range(60)] + [(2000, "Über-Größe 中文 ÜBER über; a1b2"), (2000, "another text"), (2001, "gogo " * 400)]
    items = [(i, prose(rng, rng.randint(3, 30))) for i in range(8)]
    items += [(50, same), (51, "über größe über 中文"), (52, None), (53, " .,"), (54, "nowhere-to-be-found"), (None, same), (55, same), (55, same), (56, "gogo a1b2")]
    return rows, items


@pytest.mark.parametrize("size, first, batch", [(2000, 64, 1 << 20), (5, 2, 400)])
def test_ranks_equal_a_plain_scan(spark, corpus, monkeypatch, size, first, batch):
    rows, items = corpus
    monkeypatch.setattr(lexical, "ROUND", size)
    monkeypatch.setattr(lexical, "FIRST", first)
    monkeypatch.setattr(lexical, "GROWTH", 3)
    got = lexical.search(documents(spark, rows, extra=True).repartition(6), items_of(spark, items), batch_bytes=batch)
    want = plain(rows, sorted({(i, t) for i, t in items if i is not None and t}))
    assert sorted(map(tuple, got.collect())) == want


def test_no_rows(spark, corpus):
    rows, items = corpus
    assert lexical.search(documents(spark, []), items_of(spark, items)).count() == 0
    assert lexical.search(documents(spark, rows), items_of(spark, [])).count() == 0
    assert lexical.search(documents(spark, [(1, None), (2, "")]), items_of(spark, items)).count() == 0


def test_a_bound_is_never_below_the_score():
    rng = random.Random(7)
    texts = [prose(rng, rng.randint(1, 2000)) for _ in range(60)] + ["gogo " * 300 + "jo"]
    held = [Counter(lexical.terms(t)) for t in texts]
    items = lexical.Items([(i, prose(rng, 20)) for i in range(30)] + [(99, "gogo jo jo")])
    n, length = len(texts), sum(sum(c.values()) for c in held)
    items.weigh(n, length, {i: sum(t in c for c in held) for i, t in enumerate(items.terms)})
    size = np.array([sum(c.values()) for c in held])
    bounds = np.zeros((len(texts), len(items.ids)), np.int64)
    for at, b in lexical._bounds(items, size, [lexical.sketch(c) for c in held]):
        bounds[at] = b
    exact = np.zeros_like(bounds)
    for d, c in enumerate(held):
        tf = np.array([c[t] for t in items.terms])
        value = items.weight * (10**9 * tf // (1000 * tf + 12 * items.damping(size[d : d + 1])))
        exact[d] = np.add.reduceat(value[items.term] * items.times, items.begin)
    assert (bounds >= exact).all()
    assert bounds.sum() < 1.6 * exact.sum()
