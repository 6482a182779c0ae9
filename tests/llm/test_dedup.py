"""Substring deduplication, Jaccard join, components and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nightly.llm import fingerprints, jaccard, substrings
from nightly.llm.components import components
from nightly.session import scratch_root
from tests.llm.helpers import documents, odd, prose


def brute_removal(rows):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - 49):
                key = tuple(w[i : i + 50])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 49):
            if d is not None and first[tuple(w[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removal(df):
    got = substrings.deduplicate(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    return sorted((tuple(r) for r in got), key=str)


def passages(rng, n=60):
    """Documents that share passages, some of them overlapping, shifted or changed by a word."""
    base = [prose(rng, 120).split() for _ in range(4)]
    rows = []
    for d in rng.sample(range(1000), n):
        words = prose(rng, rng.randint(0, 60)).split()
        for _ in range(rng.randint(0, 3)):
            b = rng.choice(base)
            at = rng.randint(0, 60)
            piece = b[at : at + rng.randint(45, 70)]
            if rng.random() < 0.3:
                piece[rng.randrange(len(piece))] = "changed"
            words += piece + prose(rng, rng.randint(0, 20)).split()
        rows.append((d, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_is_exact(spark, seed):
    rows = passages(random.Random(seed))
    assert removal(documents(spark, rows, extra=True)) == brute_removal(rows)


def test_removal_of_odd_rows(spark):
    rows = odd(random.Random(3))
    assert removal(documents(spark, rows)) == brute_removal(rows)
    assert removal(documents(spark, [])) == []


def test_words_are_split_at_ascii_blanks_only():
    assert substrings.split_words("a b\x1cc\x0bd") == ["a b\x1cc".encode(), b"d"]


def test_factors_name_their_reference(spark):
    rng = random.Random(4)
    a, b = prose(rng, 70), prose(rng, 90)
    rows = documents(spark, [(1, a), (2, b), (3, f"new {b} and {a} end")])
    got = {r["doc_id"]: r["factors"] for r in substrings.deduplicate(rows).collect()}
    assert got[1] == got[2] == []
    assert [(f["start"], f["words"], f["ref_doc"], f["ref_start"]) for f in got[3]] == [(1, 90, 2, 0), (92, 70, 1, 0)]


def shingle_set(text, k):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w)} - {()} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute_groups(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    low = [d for d, _ in rows]
    changed = True
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] is not None and rows[j][0] is not None
        and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    pairs += [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] is not None and rows[i] == rows[j]]
    while changed:
        changed = False
        for i, j in pairs:
            if low[i] != low[j]:
                low[i] = low[j] = min(low[i], low[j])
                changed = True
    return sorted(((d, len(s), c) for (d, _), s, c in zip(rows, sets, low)), key=str)


def near_copies(rng, n):
    """Clusters whose members drift from a base, so that stars, chains and misses near the threshold occur."""
    rows, d = [], 0
    for _ in range(4):
        base = prose(rng, rng.choice([3, 30, 80, 150])).split()
        for _ in range(n):
            w = list(rng.choice([base, base, rows[-1][1].split() if rows else base]))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                if w:
                    w[rng.randrange(len(w))] = prose(rng, 1)
            d += rng.randint(1, 3)
            rows.append((d, " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80)])
def test_groups_are_exact(spark, seed, k, percent):
    rows = near_copies(random.Random(seed), 45)
    got = jaccard.join_similar(documents(spark, rows, extra=True), k, percent).collect()
    want = brute_groups(rows, k, percent)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert len({c for _, _, c in want}) < len(rows)


def test_groups_with_frequent_tokens(spark, monkeypatch):
    rows = near_copies(random.Random(7), 40)
    monkeypatch.setattr(jaccard, "hot_tokens", lambda described: np.unique(np.concatenate([jaccard.shingles(t) for _, t in rows[::3]])))
    got = jaccard.join_similar(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(rows, 4, 85)


def test_tokens_rare_in_every_chunk_are_found_frequent(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_CHUNK", 100)
    rng = random.Random(11)
    early = next(p for p in iter(lambda: prose(rng, 4), None) if jaccard.shingles(p)[0] < 1 << 59)
    rows = [(d, f"{prose(rng, 20)} {early} {prose(rng, 20)}") for d in range(300)]
    described = jaccard.describe(documents(spark, rows).withColumn("tag", F.hash("text")))
    assert jaccard.shingles(early)[0] in jaccard.hot_tokens(described)
    got = jaccard.join_similar(documents(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted((d, len(jaccard.shingles(t)), d) for d, t in rows)


def test_near_duplicates_leave_one_table(spark):
    rows = near_copies(random.Random(3), 20)
    root = scratch_root(spark)
    before = set(os.listdir(root)) if os.path.exists(root) else set()
    kept = corpus_pipeline.keep_one_of_each_group(spark, documents(spark, rows), "")
    assert {name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before} == {"near-duplicates"}
    low = {d: c for d, _, c in brute_groups(rows, corpus_pipeline.SHINGLE, corpus_pipeline.SIMILARITY)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, c in low.items() if d == c)


def test_groups_of_odd_rows(spark):
    rows = odd(random.Random(5))
    got = sorted((tuple(r) for r in jaccard.join_similar(documents(spark, rows)).collect()), key=str)
    assert got == brute_groups(rows, 4, 85)
    assert jaccard.join_similar(documents(spark, [])).collect() == []


def test_least_overlap_is_the_threshold():
    for a in range(1, 60):
        for b in range(1, 60):
            least = min((i for i in range(min(a, b) + 1) if 100 * i >= 85 * (a + b - i)), default=None)
            if least is not None:
                assert jaccard.least_overlap(a, b) == least


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, j) for j in range(8, 30)] + [(3, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 30)}


def plain_winnow(values, w):
    out = []
    for i in range(max(1, len(values) - w + 1) if values else 0):
        part = values[i : i + w]
        at = i + max(j for j, v in enumerate(part) if v == min(part))
        if not out or out[-1] != at:
            out.append(at)
    return out


def test_winnowing_keeps_the_rightmost_smallest(spark):
    rng = random.Random(6)
    texts = [prose(rng, n) for n in (0, 1, 4, 5, 6, 9, 11, 13, 40, 400)] + ["a b " * 60, None]
    df = documents(spark, list(enumerate(texts)))
    df = df.withColumn("p", fingerprints.winnow()).select("text", fingerprints.positions("p").alias("p"))
    grams = {}
    for r in df.collect():
        for hash_, at in r["p"]:
            gram = tuple(r["text"].split()[at : at + 5])
            assert grams.setdefault(gram, hash_) == hash_  # a gram has one hash wherever it stands
    for r in df.collect():
        w = (r["text"] or "").split()
        all_grams = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        assert len(r["p"]) == len({at for _, at in r["p"]})
        ats = [at for _, at in r["p"]]
        assert ats == sorted(ats)
        for i in range(len(all_grams) - 7):  # every window has one of its grams
            assert any(i <= at < i + 8 for at in ats)
        known = [grams.get(g) for g in all_grams]
        if all(v is not None for v in known):
            assert ats == plain_winnow(known, 8)


def test_edits_and_likeness(spark):
    rng = random.Random(8)
    rows = [(5, prose(rng, 200)), (9, prose(rng, 150)), (11, None), (12, "ab"), (20, "x" * 3000), (21, prose(rng, 300))]
    got = {r["doc_id"]: r for r in fingerprints.compare_edits(documents(spark, rows + [(None, "gone")], extra=True)).collect()}
    texts = [(d, t or "") for d, t in rows]
    for i, (d, t) in enumerate(texts):
        m = len(t) // 3
        edited = t[: len(t) - m] + texts[i - 1][1][:m]
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d]["n_chars"] == len(t)
    assert got[5]["near_edited"] > 0.3 and got[21]["near_next"] == 0.0 and got[11]["near_edited"] == 1.0
    assert len(got) == len(rows) and fingerprints.compare_edits(documents(spark, [])).collect() == []
    # an edited text that is another document's text has that document's fingerprint
    whole = prose(rng, 700)
    one, other = whole[:900], whole[:600] + "z" * 300
    alike = {r["doc_id"]: r for r in fingerprints.compare_edits(documents(spark, [(1, one), (2, other), (3, whole[:700] + "q" * 350)])).collect()}
    assert alike[2]["edited_sha256"] == hashlib.sha256((other[:600] + one[:300]).encode()).hexdigest()
    short = {r["doc_id"]: r for r in fingerprints.compare_edits(documents(spark, [(1, "ab"), (2, one), (3, one[:600] + "ab")])).collect()}
    assert short[2]["edited_sha256"] == hashlib.sha256((one[:600] + "ab").encode()).hexdigest()
    assert short[2]["edited_fingerprint"] == short[3]["fingerprint"]
    twice = fingerprints.compare_edits(documents(spark, [(1, "a b c"), (1, "a b c"), (2, "d e f g h i")])).collect()
    assert len(twice) == 3 and len({r["fingerprint"] for r in twice if r["doc_id"] == 1}) == 1


def test_short_texts_and_texts_without_blanks_keep_fingerprints(spark):
    rng = random.Random(9)
    texts = [prose(rng, n)[:c] for n in (4, 8, 15, 30, 90) for c in (13, 38, 39, 40, 134, 135, 136, 518, 519, 520) if c < 9 * n]
    texts += ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n)) for n in (12, 900)] + ["".join(rng.choice("abcdefghijkl\U0001F600") for _ in range(5000))]
    got = {r["doc_id"]: r for r in fingerprints.compare_edits(documents(spark, list(enumerate(texts)))).collect()}
    assert all(got[i]["near_edited"] > 0 for i, t in enumerate(texts) if len(t) >= 12)


def every_gram(df, text="text"):
    """All grams of a text as fingerprints, hashed by Spark."""
    gram = f"shiftleft(xxhash64(substring(encode(t, 'utf-32'), 4 * i + 1, 32)) & 2147483647, 32) - i"
    found = f"if(t = '', array(), transform(sequence(0, greatest(length(t) - 8, 0)), i -> {gram}))"
    return df.withColumn("all", F.expr(f"transform(array({fingerprints.plain(text)}), t -> {found})[0]"))


def hash_of(x):
    return -(-x >> 32)


def width_of(n):
    return 64 if n >= 512 else 16 if n >= 128 else 4 if n >= 32 else 1


def picked(prints, w):
    return [prints[i] for i in plain_winnow([hash_of(x) for x in prints], w)]


def test_character_windows_are_nested_and_guarantee_runs(spark):
    rng = random.Random(10)
    texts = [prose(rng, n) for n in (3, 9, 20, 60, 200)] + ["ab", "", "x" * 600, "a  b\n" * 40]
    df = every_gram(documents(spark, list(enumerate(texts)))).withColumn("own", fingerprints.winnow_chars())
    wide = df.withColumn("wide", F.expr(fingerprints.coarsened("own", "size(all)", "64")))
    for r in wide.select("text", "all", "own", "wide").collect():
        n = len(" ".join(r["text"].split())) - 7
        assert len(r["all"]) == (max(1, n) if r["text"] else 0)
        assert r["own"] == picked(r["all"], width_of(n))
        if n < 512:
            assert r["wide"] == picked(r["all"], 64)


def test_smallest_of_the_widest_window_by_blocks(spark):
    rng = random.Random(13)
    made = []
    for n in [*range(64, 90), 127, 128, 129, 135, 136, 137, 500, 1001]:
        made += [[rng.randrange(1 << 31) for _ in range(n)] for _ in range(4)] + [[rng.randrange(3) for _ in range(n)], [7] * n, list(range(n)), list(range(n, 0, -1))]
        made.append([abs(i % 61 - 30) * 9 + rng.randrange(20) for i in range(n)])
    rows = [(i, [(h << 32) - at for at, h in enumerate(x)]) for i, x in enumerate(made)]
    df = spark.createDataFrame(rows, "id int, v array<long>").withColumn("got", F.expr(f"array_distinct({fingerprints.smallest_of_widest('v')})"))
    for r in df.collect():
        assert r["got"] == list(dict.fromkeys(min(r["v"][i : i + 64]) for i in range(len(r["v"]) - 63))), r["id"]


def test_blanks_are_collapsed_once_for_prints_and_grams(spark):
    texts = ["", " ", "a", " a  b\t", "a\tb\n\nc \x0b\x0c\rd", "\u00a0 x\u2003 y", "a \n b" * 9, "\n\n", "x \t", "one two  three"]
    df = documents(spark, list(enumerate(texts)))
    for r in df.withColumn("p", F.expr(fingerprints.plain("text"))).collect():
        assert r["p"] == re.sub("[ \t-\r]+", " ", r["text"]).strip(" ")
    plan = fingerprints.compare_edits(df)._jdf.queryExecution().optimizedPlan().toString()
    # of the text, of the start an edited text keeps and of the edited text; the text stands on both sides of a join
    assert plan.count("regexp_replace(") <= 4


def test_edited_fingerprints_are_those_of_the_edited_text(spark):
    rng = random.Random(11)
    sizes = [0, 1, 30, 130, 500, 519, 520, 600, 700, 779, 780, 790, 900, 1500, 5000]
    texts = [prose(rng, n // 4 + 3)[:n] for n in sizes] + ["x" * 3000, " \n ab" * 400 + "  ", "a" * 700 + " " * 900 + prose(rng, 300)]
    rows = [(i, a, b) for i, a in enumerate(texts) for b in (texts[i - 1], texts[-3], texts[i // 2])]
    df = spark.createDataFrame([(i, a, a[: len(a) - len(a) // 3] + b[: len(a) // 3]) for i, a, b in rows], "id long, text string, edited string")
    df = df.withColumn("own", fingerprints.winnow_chars("text"))
    df = df.withColumn("got", fingerprints.winnow_edited("text", "edited", "(length(text) - cast(floor(length(text) / 3) as int))", "own"))
    for r in df.withColumn("want", fingerprints.winnow_chars("edited")).collect():
        assert r["got"] == r["want"], (len(r["text"]), len(r["edited"]))


def test_likeness_equals_a_plain_version_and_has_no_steps(spark):
    rng = random.Random(12)
    texts, pairs = [], []
    for n in [*range(1, 60, 7), 126, 127, 134, 135, 136, 300, 518, 519, 520, 521, 800, 1300, 2000]:
        one = prose(rng, n // 3 + 3)[:n].replace("  ", " ")
        texts += [one, one[:-1], one[: n // 2] + "#" + one[n // 2 + 1 :]]
    rows = [(i, t, u) for i, t in enumerate(texts) for u in texts[max(0, i - 2) : i + 3]]
    df = every_gram(spark.createDataFrame(rows, "id long, text string, other string"))
    left = df.withColumnRenamed("all", "x")
    both = every_gram(left, "other").withColumnRenamed("all", "y")
    for name, text in (("a", "text"), ("b", "other")):
        both = both.withColumn(name, F.struct(fingerprints.winnow_chars(text).alias("prints"), F.expr(fingerprints.grams(fingerprints.plain(text))).alias("grams")))
    both = both.withColumn("near", fingerprints.likeness_of("a", "b"))
    for r in both.collect():
        w = max(width_of(len(" ".join(t.split())) - 7) for t in (r["text"], r["other"]))
        p, q = ({hash_of(v) for v in picked(g, w)} for g in (r["x"], r["y"]))
        want = len(p & q) / len(p | q) if p | q else 1.0
        assert abs(r["near"] - want) < 1e-12
        if r["text"][:-1] == r["other"] and len(r["text"]) >= 100:
            assert r["near"] > 0.7
