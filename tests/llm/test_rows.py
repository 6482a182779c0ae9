"""Classifiers, mixing, token files, WARC, decontamination and the pipeline on small tables."""

from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nightly.llm import common, decontaminate, language, mixing, quality, token_files, toxicity, warc
from tests.conftest import DATA
from tests.llm.helpers import SCHEMA, documents, odd, prose

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def rated(spark):
    """Prose against shouting; every tenth prose text has an insult from a made-up list."""
    rng = random.Random(1)
    docs, rates = [], []
    for i in range(1200):
        good, rude = rng.random() < 0.7, rng.random() < 0.3
        words = prose(rng, rng.randint(30, 90)).split()
        if not good:
            words = [w.upper() + "!!" for w in words]
        if rude:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["zugblat", "idiot", "krofel"])
        docs.append((i, " ".join(words)))
        if i % 2:
            rates.append((i, int(good), int(rude)))
    return documents(spark, docs).cache(), marks(spark, rates).cache()


def accuracy(scored, labels, column, cut):
    both = scored.join(labels, "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect()
    return np.mean([(r["s"] >= cut) == bool(r[column]) for r in both])


def test_quality_holds_out(spark, rated):
    model = quality.fit(*rated, steps=400)
    assert 0.5 < model.prior < 0.9
    assert accuracy(quality.score(rated[0], model, "s"), rated[1], "quality", 0.3) > 0.97


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    p = rng.normal(2, 1, (4000, 3))
    u = np.vstack([rng.normal(2, 1, (2400, 3)), rng.normal(-2, 1, (1600, 3))])
    rng.shuffle(u)
    assert abs(quality.estimate_prior(p, u) - 0.6) < 0.06


def test_toxicity_holds_out(spark, rated):
    model = toxicity.fit(*rated, trees=5)
    assert {"zugblat", "krofel"} <= model.lexicon
    assert accuracy(toxicity.score(rated[0], model, "s"), rated[1], "toxic", 0.5) > 0.97


def test_hidden_insults():
    x = toxicity.features(["you are an 1d10t", "you are an i*iot", "m o r o n here", "fine text", None, " "])
    at = toxicity.FEATURES.index("hidden_insults")
    assert (x[:3, at] > 0).all() and (x[3:, at] == 0).all() and not x[4:].any()


def test_classifiers_on_odd_rows(spark, rated):
    rows = odd(random.Random(2))
    docs = documents(spark, rows, extra=True)
    q, t = quality.fit(*rated, steps=50), toxicity.fit(*rated, trees=2)
    for out, column in ((quality.score(docs, q, "score"), "score"), (toxicity.score(docs, t, "score"), "score")):
        got = out.collect()
        assert len(got) == len(rows) and all(0 <= r[column] <= 1 for r in got)
        assert out.columns.count("score") == 1 and set(docs.columns) <= set(out.columns)
        by_text = {}
        for r in got:
            assert by_text.setdefault(r["text"], r[column]) == r[column]
    none = documents(spark, [])
    empty = marks(spark, [])
    assert quality.score(none, quality.fit(none, empty)).collect() == []
    assert quality.score(docs, quality.fit(docs, empty), "s").where("s <> 0.5").isEmpty()
    assert toxicity.score(none, toxicity.fit(none, empty)).collect() == []
    assert toxicity.score(docs, toxicity.fit(docs, empty), "s").where("s <> 0").isEmpty()


def test_language(spark):
    rng = random.Random(3)
    kinds = {"aa": "an ber cor del en", "bb": "øk æl ån ist rød", "cc": "zz xq kw vy jj"}
    rows = []
    for i in range(300):
        lang = rng.choice(list(kinds))
        text = " ".join("".join(rng.choices(kinds[lang].split(), k=2)) for _ in range(20))
        rows.append((i, text, lang, None))
    df = documents(spark, rows)
    model = language.fit(df.where("doc_id < 200"))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, model).collect()}
    assert np.mean([found[i] == lang for i, _, lang, _ in rows[200:]]) > 0.99
    counts = {(r["lang"], r["bucket"]): r["n"] for r in language.count_grams(df).collect()}
    assert {k: n for (k, b), n in counts.items() if b == -1} == dict(Counter(r[2] for r in rows))
    odd_rows = documents(spark, odd(rng) + [(50, "123 !!"), (51, "é")], extra=True)
    got = language.identify(odd_rows, model, "lang_pred", "score").collect()
    assert len(got) == len(odd(rng)) + 2
    for r in got:
        assert (r["lang_pred"] == "und") == (not language.has_letter(r["text"])) and 0 <= r["score"] <= 1
    nothing = language.fit(documents(spark, []))
    assert {r["lang_pred"] for r in language.identify(odd_rows, nothing).collect()} == {"und"}


# --- mixing


def brute_mix(rows, weights, share, epochs):
    leaves = Counter()
    for d, text, lang, source in rows:
        n = int("".join(c for c in (source or "")[-1:] if c.isdigit()) or -1)
        leaves[(f"domain{n % 3}" if n >= 0 else "other", lang or "", source or "")] += len((text or "").split())
    return leaves, mixing.budgets(dict(leaves), weights, share * sum(leaves.values()), epochs)


def test_budgets_go_to_siblings_first():
    leaves = {("a", "x", "1"): 100, ("a", "x", "2"): 10, ("a", "y", "3"): 1000, ("b", "x", "4"): 50}
    got = mixing.budgets(leaves, {}, 400, 1)
    assert got == {("a", "x", "1"): 100, ("a", "x", "2"): 10, ("a", "y", "3"): 240, ("b", "x", "4"): 50}
    assert sum(mixing.budgets(leaves, {}, 10_000, 2).values()) == 2 * 1160
    assert mixing.budgets({}, {}, 10, 1) == {}


def test_mix_meets_budgets(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(1, 40)), rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", None])) for i in range(900)]
    leaves, want = brute_mix(rows, {("domain0",): 3.0}, 0.6, 2)
    out = mixing.mix(documents(spark, rows, extra=True), {("domain0",): 3.0}, 0.6, 2).collect()
    assert len({r["doc_id"] for r in out}) == len(out)
    taken, longest = Counter(), Counter()
    for r in out:
        leaf = (r["mix_domain"], r["lang"] or "", r["source"] or "")
        taken[leaf] += r["mix_copies"] * r["mix_tokens"]
        assert r["mix_tokens"] == len(r["text"].split())
    for d, text, lang, source in rows:
        longest[(lang or "", source or "")] = max(longest[(lang or "", source or "")], len(text.split()))
    for leaf, budget in want.items():
        assert budget <= taken[leaf] < budget + longest[leaf[1:]] or taken[leaf] == budget == 0
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(documents(spark, rows, extra=True), {("domain0",): 3.0}, 0.6, 2).collect()))


def test_mix_of_odd_rows(spark):
    rows = odd(random.Random(5))
    full = mixing.mix(documents(spark, rows), {}, 1.0, 1)
    assert full.where("mix_copies <> 1").isEmpty() and full.count() == len(rows)
    assert mixing.mix(documents(spark, [])).collect() == []


# --- token files


def test_token_files_round_trip(spark, folder):
    rng = random.Random(6)
    texts = ["it's 12, don't <|endoftext|> x", "日本 語\n", "a  b \n\n c\t", "x" * 30_000, prose(rng, 60_000), "\n", " ", "A \n B", "ÀÉ ñ¼²"]
    rows = [(i, t) for i, t in enumerate(texts, 20)] + [r for r in odd(rng) if r[0] is not None] + [(None, "no id")]
    path = f"{folder}/tokens"
    token_files.write_tokens(documents(spark, rows, extra=True), path, BPE, shard_bytes=60_000)
    got = token_files.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    tok = tokenizers.Tokenizer.from_file(BPE)
    want = sorted((-1 if d is None else d, tuple(tok.encode(t or "", add_special_tokens=False).ids) + (0,)) for d, t in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], tuple(r["ids"])) for r in got) == want
    assert [-1 if r["doc_id"] is None else r["doc_id"] for r in got] == [d for d, _ in want]
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    assert len([f for f in os.listdir(path) if f.startswith("tokens-")]) > 2
    assert not [f for f in os.listdir(path) if f.endswith(".tmp")]


def test_token_files_of_nothing(spark, folder):
    token_files.write_tokens(documents(spark, []), f"{folder}/none", BPE)
    assert token_files.read_tokens(spark, f"{folder}/none").collect() == []


def test_packing_all_widths():
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 3], np.uint32)
    sizes = np.array([3, 0, 1, 4])
    control, data, cb, db = token_files.pack(ranks, sizes)
    assert cb.tolist() == [1, 0, 1, 1] and int(db.sum()) == len(data)
    assert token_files.unpack(control, data, sizes).tolist() == ranks.tolist()


# --- WARC


def test_warc_round_trip(spark, folder):
    rng = random.Random(7)
    rows = [(i, f"http://x/{i}", prose(rng, 40)) for i in range(60)]
    rows += [(100, None, None), (101, "u\r\nEvil: 1", ""), (90, "v", rows[5][2]), (-4, "w", rows[5][2]), (95, "é ü", "é" * 5000), (None, "n", "null id"), (7, "again", rows[7][2])]
    rng.shuffle(rows)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as shard", "1 as first_id")
    a, b = f"{folder}/a", f"{folder}/b"
    manifest = warc.write_warc(pages, a, shard_bytes=6000, roll_bytes=1500)
    assert warc.write_warc(pages.repartition(7), b, shard_bytes=6000, roll_bytes=1500) == manifest  # same bytes on every run
    assert len(manifest["files"]) > 4
    got = warc.read_warc(spark, a).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    payload = {i: (h or "") for i, _, h in rows}
    for r in got:
        h = payload[r["page_id"]]
        assert r["payload_bytes"] == len(h.encode()) and r["payload_digest"] == warc.base32_sha1(h.encode())
        if r["record_type"] == "response":
            assert r["html"] == h and r["refers_to"] is None and first.get(h, r["page_id"]) == r["page_id"]
        else:
            assert r["refers_to"] == first[h]
    assert Counter(r["record_type"] for r in got if r["page_id"] == 7) == {"response": 1, "revisit": 1}
    assert sum(r["record_type"] == "revisit" for r in got) == 4


def test_warc_of_nothing_and_damage(spark, folder):
    schema = "page_id long, url string, html string"
    warc.write_warc(spark.createDataFrame([], schema), f"{folder}/e")
    assert warc.read_warc(spark, f"{folder}/e").collect() == []
    warc.write_warc(spark.createDataFrame([(1, "u", "text")], schema), f"{folder}/d")
    name = next(f for f in os.listdir(f"{folder}/d") if f.endswith(".gz"))
    with open(f"{folder}/d/{name}", "r+b") as f:
        f.seek(30)
        f.write(b"\xff")
    with pytest.raises(Exception, match="differs from the manifest"):
        warc.read_warc(spark, f"{folder}/d").collect()


def test_record_ids_hold_page_ids():
    for i in (0, 1, -1, 7, 2**62, -(2**63), 2**63 - 1, None):
        assert warc.page_of(warc.record_id(i)) == i


# --- decontamination


def leaks(docs, items):
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.find_leaks(docs, items).collect()}


def test_leaks(spark):
    rng = random.Random(8)
    q = "If Maria buys 12 apples for 3 dollars and then John buys 15 apples for 3 dollars, how many apples does Maria have?"
    other = prose(rng, 40)
    items = spark.createDataFrame([(1, q), (2, other), (3, None), (None, q), (4, "")], "item_id long, text string")
    new = q.replace("Maria", "Anna").replace("12", "31").replace("3 dollars", "5 euros")
    rows = [
        (10, f"{prose(rng, 30)} {q} {prose(rng, 20)}"), (11, f"He said: {new}"), (12, q.replace("does Maria", "does Peter")),
        (13, f"{prose(rng, 9)} {other.upper()}, yes"), (14, prose(rng, 200)), (15, " ".join(other.split()[:12])), (16, other + " " + q),
    ]
    got = leaks(documents(spark, rows + odd(rng), extra=True), items)
    assert got == {(10, 1): "verbatim", (11, 1): "reparameterised", (13, 2): "verbatim", (16, 1): "verbatim", (16, 2): "verbatim"}
    assert leaks(documents(spark, []), items) == {} and leaks(documents(spark, rows), items.limit(0)) == {}
    kept = decontaminate.remove_leaks(documents(spark, rows + [(None, q), (10, "other text")]), items)
    assert sorted((str(r["doc_id"]), r["text"][:5]) for r in kept.collect()) == sorted(
        [(str(d), t[:5]) for d, t in rows if d in (12, 14, 15)] + [("None", q[:5]), ("10", "other")]
    )


TOM = "Tom has 5 apples. Tom gives 2 apples to Ann. Ann eats 1 apple. How many apples does Tom have?"


def items_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "item_id long, text string")


def test_leaks_with_names_at_sentence_starts_and_long_excerpts(spark):
    rng = random.Random(10)
    long = prose(rng, 220)
    new = TOM.replace("Tom", "Max").replace("Ann", "Eve").replace("5", "9")
    rows = [(1, new), (2, f"{prose(rng, 20)}. {new} {prose(rng, 20)}"), (3, f"{prose(rng, 50)} {' '.join(long.split()[60:160])} {prose(rng, 50)}"), (4, " ".join(long.split()[:20]))]
    got = leaks(documents(spark, rows), items_of(spark, TOM, long))
    assert got == {(1, 1): "reparameterised", (2, 1): "reparameterised", (3, 2): "verbatim"}


def test_leaks_at_any_place_and_with_inserted_words(spark):
    rng = random.Random(11)
    q = "If Maria buys 12 apples for 3 dollars and then John buys 15 apples for 3 dollars, how many apples does Maria have?"
    pears = "Tom has 3 apples and 5 pears in the basket. How many pieces of fruit are in the basket of Tom?"
    twice = "A box holds 2 red balls and 2 green balls. How many balls are in the box after one ball is taken out of it?"
    other = q.replace("does Maria", "does Peter")
    rows = [
        (1, f"{other} {prose(rng, 30)} {q}"), (2, q.replace("and then", "and then on the same day").replace("Maria", "Anna")),
        (3, pears.replace("3", "4").replace("5", "4")), (4, twice.replace("2 red", "3 red").replace("2 green", "5 green")), (5, other), (6, f"{other} {other}"),
    ]
    got = leaks(documents(spark, rows), items_of(spark, q, pears, twice))
    assert got == {(1, 1): "verbatim", (2, 1): "reparameterised", (3, 2): "reparameterised", (4, 3): "reparameterised"}


def test_leaks_of_items_with_few_words(spark):
    rng = random.Random(12)
    sort, title = "Sort: 5 3 9 1 7 2 8 6 4", "Old Man And Sea By Ernest Hemingway Of Oak Park"
    rows = [(1, f"{prose(rng, 30)} {sort} {prose(rng, 9)}"), (2, "Sort: 4 3 9 2 7 1 8 6 5"), (3, f"{prose(rng, 9)} {title.lower()} {prose(rng, 9)}"), (4, "1 2 3 4 5 6 7 8 9")]
    assert leaks(documents(spark, rows), items_of(spark, sort, title)) == {(1, 1): "verbatim", (3, 2): "verbatim"}


# --- pipeline


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "token_files"]
    docs = corpus_pipeline.table(spark, DATA, "documents")
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, DATA), f"test-{name}")
        assert docs.columns == columns and docs.exceptAll(before).isEmpty()
        sizes.append(docs.count())
        if name == "near_duplicates":
            from tests.llm.test_dedup import brute_groups

            groups = brute_groups([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
            assert {r["doc_id"] for r in docs.collect()} == {d for d, _, c in groups if d == c}
        if name == "decontamination":
            items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
            has = {r["doc_id"] for r in before.collect() if any(i in " ".join(r["text"].lower().split()) for i in items)}
            assert {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in docs.collect()} == has
    out = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    tok = tokenizers.Tokenizer.from_file(BPE)
    assert {r["doc_id"]: r["n_tokens"] for r in out} == {r["doc_id"]: len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    assert all(a > b for a, b in zip(sizes, sizes[1:]))


def test_pipeline_stages_take_odd_rows(spark, folder):
    rows = [r for r in odd(random.Random(9))]
    docs = documents(spark, rows)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for table in (docs, documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES:
            table = corpus_pipeline.materialize(stage(spark, table, folder), "odd")
        assert table.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_schema_of_documents_is_the_given_one(spark):
    assert documents(spark, []).schema == spark.createDataFrame([], SCHEMA).schema


def test_pre_tokens_of_equal_hash_keep_their_own_ids():
    """A word over two letters and its complement have equal polynomial hashes modulo 2^64 from 1,024 letters on."""
    encoder = token_files.Encoder(BPE)
    for n in (9, 10, 11, 12):
        a, b = "a", "b"
        for _ in range(n):
            a, b = a + b, b + a
        for texts in ([a, b], [a + " " + b], [b, a + " " + a + " x " + b, "x"]):
            ids, sizes = encoder.encode(texts)
            want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
            assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))


def test_new_pre_tokens_are_learned_many_at_once(monkeypatch):
    """Pre-tokens were once cut out of the text and learned one by one, which was over half of the time to encode it."""
    monkeypatch.setattr(token_files, "_ASKED", 9, raising=False)
    encoder = token_files.Encoder(BPE)
    cut, whole = [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda text: cut.append(text) or whole(text))
    texts = ["One longerwordthanthat, two  two\n\n\t three ", "Größe Æther ŉ ɏ 12345 \x00\xa0\x85 !?", "x" * 300, "", None, "One two \xad\xff <|endoftext| >", "it's 漢字", " "]
    for _ in range(2):
        ids, sizes = encoder.encode(texts)
        want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
    assert not cut


def test_encoder_keeps_what_it_meets_again_and_no_more(monkeypatch):
    """Everything was once forgotten together, so that common words were learned anew; as many as a million were kept."""
    monkeypatch.setattr(token_files, "_MEMO", 300)
    encoder = token_files.Encoder(BPE)
    rng = random.Random(12)
    asked, ask = Counter(), encoder._ask

    def counted(x, begin, end):
        asked.update("".join(map(chr, x[a:b])) for a, b in zip(begin, end))
        return ask(x, begin, end)

    monkeypatch.setattr(encoder, "_ask", counted)
    for i in range(40):
        text = " the house of" + "".join(f" {''.join(rng.choices('abcdé', k=9))}" for _ in range(50)) + " the house, of"
        ids, sizes = encoder.encode([text, None, text[:40]])
        want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in (text, "", text[:40])]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
        assert len(encoder.stops) - 1 <= 300 and len(encoder.keys) <= 1 << 12
    assert asked[" the"] == asked[" house"] == asked[" of"] == 1
    monkeypatch.setattr(token_files, "_MEMO", 20)  # more than fits is met again
    for _ in range(3):
        ids, _ = encoder.encode([text])
        assert ids.tolist() == want[0]


def test_long_texts_are_worked_on_few_at_once():
    batch = pa.record_batch({"text": ["x" * 100_000] * 7 + [None, "y" * 900_000, "é" * 200_000, ""]})
    slices = list(token_files._small(iter([batch.slice(1)]), "text"))
    assert pa.Table.from_batches(slices).to_pylist() == batch.slice(1).to_pylist()
    assert max(map(len, slices)) <= 3 and all(s.num_rows == 1 or sum(len((t or "").encode()) for t in s["text"].to_pylist()) <= 1 << 18 for s in slices)


def test_texts_are_read_and_encoded_once(spark, folder):
    """They were once encoded to count the ids and again to write them, and read two more times to find the ranges."""
    rng = random.Random(8)
    rows = [(i, prose(rng, 40)) for i in range(60)] + [(None, "no id"), (7, None), (8, "")]
    read = spark.sparkContext.accumulator(0)
    df = documents(spark, rows).withColumn("text", F.udf(lambda t: read.add(1) or t)("text"))
    token_files.write_tokens(df, f"{folder}/once", BPE, shard_bytes=2000)
    assert read.value == len(rows)
    got = token_files.read_tokens(spark, f"{folder}/once", with_ids=True).collect()
    tok = tokenizers.Tokenizer.from_file(BPE)
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in got) == sorted((d or -1, tok.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in rows)


def test_ranks_follow_the_counts_of_all_tasks(spark, folder):
    rng = random.Random(9)
    rows = [(i, prose(rng, 30)) for i in range(90)]
    token_files.write_tokens(documents(spark, rows).repartition(5), f"{folder}/ranks", BPE)
    tok = tokenizers.Tokenizer.from_file(BPE)
    n = np.zeros(tok.get_vocab_size(), np.int64)
    for _, text in rows:
        np.add.at(n, tok.encode(text, add_special_tokens=False).ids + [0], 1)
    ranks = np.fromfile(f"{folder}/ranks/ranks.bin", "<u4")
    assert ranks.tolist() == sorted(range(len(n)), key=lambda i: (-n[i], i))


def test_ids_of_large_vocabularies_take_four_bytes():
    assert token_files.id_kind(1 << 16).itemsize == 2 and token_files.id_kind((1 << 16) + 1).itemsize == 4


def test_ranges_are_bounded_and_files_roll(spark, folder, monkeypatch):
    rng = random.Random(3)
    rows = [(i, prose(rng, 60)) for i in range(300)] + [(None, prose(rng, 60)) for _ in range(100)]
    df = documents(spark, rows).repartition(4)
    token_files.write_tokens(df, f"{folder}/many", BPE, shard_bytes=6000)
    many = token_files.read_tokens(spark, f"{folder}/many", with_ids=True).collect()
    monkeypatch.setattr(common, "MAX_RANGES", 3)
    monkeypatch.setattr(common, "MAX_SAMPLE", 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    done = token_files.write_tokens(df, f"{folder}/few", BPE, shard_bytes=6000)
    few = token_files.read_tokens(spark, f"{folder}/few", with_ids=True).collect()
    assert len(done["bounds"]) == 2 and len(done["files"]) > 3
    assert sorted(map(str, few)) == sorted(map(str, many)) and len(few) == 400
    at = 0
    for r in sorted(few, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]


def test_warc_members_are_found_in_slices(monkeypatch):
    import gzip

    blocks = [os.urandom(n) for n in (0, 1, 50, 400, 7, 90)]
    data = b"".join(gzip.compress(f"WARC/1.1\r\nContent-Length: {len(b)}\r\n\r\n".encode() + b + b"\r\n\r\n") for b in blocks)
    for size in (1, 3, 64, 1 << 16):
        monkeypatch.setattr(warc, "_SLICE", size)
        assert [b for _, b in warc.parse(data)] == blocks
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse(data[:-9]))


def test_all_blanks_part_words():
    assert language._points("ab\tcd\n\x0bef").tolist() == language._points("ab cd ef").tolist()


def test_patterns_look_at_one_character_first_and_find_the_same(spark):
    first = re.compile(r"^(?:\(\?=\\d\)|\(\?!\[a-z \]\)|\(\?=\[[a-zA-Z]+\]\))")
    found = decontaminate.patterns()
    assert all(first.match(p) or p.startswith((r"([$€£])", r"(\x01n")) for p, _ in found)
    texts = ["Tom has FIVE apples, Ann 12.5kg. One-two, tHree5 x7 7x 1,000.00 $5 3/4 été Été", "ſix K İstanbul sevené éseven _nine_ ten", "(a) [b] c-d e!? 5! !5 -5 £5 % €", "١٢ ½ 中文 Ab😀Cd 😀", "\u0001nfive Eight hundred  miles\televen\n.", "", "A"]
    rng = random.Random(14)
    texts += ["".join(rng.choice("aZ \t.,!-%$5éÉ中" + w) for _ in range(60) for w in [rng.choice(["one", " Ten ", "Km", "Bob"])]) for _ in range(60)]
    out = "text"
    for p, by in found:
        out = f"regexp_replace({out}, {decontaminate._quoted(first.sub('', p, count=1))}, '{by}')"
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    df = df.withColumn("want", F.expr(f"filter(split(lower({out}), '[\\\\s]+'), x -> length(x) > 0)")).withColumn("got", decontaminate.tokens("text"))
    for r in df.collect():
        assert r["got"] == r["want"], r["text"]
