"""Token counts against the library itself."""

from __future__ import annotations

import random

import pytest

from nightly.llm import token_counts
from tests.conftest import DATA
from tests.llm.helpers import documents, odd, prose

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(texts, path=PATH):
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(model.encode(t or "")) for t in texts]
    made = tokenizers.Tokenizer.from_file(path)
    return [len(made.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_every_character_near_the_cut():
    counter = token_counts.TokenCounter(PATH)
    texts = [s for i in range(0x250) for c in [chr(i)] for s in (c, f"a{c}b", f"'{c}s 1{c}", f"{c}{c} {c}")]
    assert [counter.count(t) for t in texts] == plain(texts)


def test_random_mixtures():
    rng = random.Random(1)
    parts = [chr(i) for i in range(0x180)] + list("'''sstredvml  \n\t") * 8
    parts += ["<|endoftext|>", "<|startoftext|>", "<|endof", "ΑΣ", "Σ", "é", "́", "中文", " ", "　", "🙂", "İ", "ﬁ", "‍"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(5000)]
    counter = token_counts.TokenCounter(PATH, {"s": 1})
    assert [counter.count(t) for t in texts] == plain(texts)


def test_a_full_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 7)
    texts = [prose(random.Random(i), 40) for i in range(20)]
    assert [token_counts.TokenCounter(PATH).count(t) for t in texts] == plain(texts)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_rows(spark, name, monkeypatch):
    monkeypatch.setattr(token_counts, "TABLE", 50)
    rows = odd(random.Random(2)) + [(20, "it's <|endoftext|>'s 中文 a"), (21, "word " * 3000)]
    path = public_tokenizers.path(name)
    got = token_counts.count_tokens(documents(spark, rows, extra=True).repartition(5), path, limit=1000)
    key = lambda r: (r[0] or -1, *r[1:])
    n = plain([t for _, t in rows], path)
    want = [(i, len((t or "").encode()), k, k > 1000) for (i, t), k in zip(rows, n)]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert token_counts.count_tokens(documents(spark, []), path).count() == 0


def test_query(spark):
    got = token_counts.op12_token_counts(spark, DATA).toPandas().set_index("doc_id")["n_tokens"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").toPandas().set_index("doc_id")["text"]
    assert got.sort_index().tolist() == plain(docs.sort_index().tolist())


def test_table_holds_the_most_frequent(spark):
    rows = [(i, "alpha " * 5 + "beta " * 3 + f"rare{i}") for i in range(50)]
    assert token_counts.frequent(documents(spark, rows).repartition(7), PATH)[:3] == ["alpha", "beta", "rare"]
    assert token_counts.frequent(documents(spark, []), PATH) == []
