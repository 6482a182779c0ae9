"""Substring deduplication by relative Lempel-Ziv parsing against an index of reference blocks.

Every document is cut into reference blocks: a window of ``WINDOW`` words belongs to the smallest hash of its ``GRAM``-word
grams (the last one of ties), and the windows one gram leads in a row are a block. Equal windows have equal leaders, so a
copy of a passage is found under the same block keys wherever it stands, and only windows under one key can be equal.

* Blocks under a key that only one document has are done: no factor starts there.
* A block whose whole content was seen in a smaller document is one factor, a copy of that reference.
* Where contents under a key differ (the ends of copied passages), factors may begin or end inside the block. One
  block per distinct content is opened, and its windows are compared hash by hash.

Per document, the copied windows are chained greedily into factors while the reference goes on at the same distance; as
every window has a verdict of its own, windows that run over a factor boundary are checked too. Factors are at least one
window long; their words go. No group of copies is gathered: verdicts come from aggregates that are combined before
their shuffles, and are joined back over plain exchanges that AQE can split. Window and content hashes are 64 bits on top
of a 64-bit block key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from nightly.llm.common import query, table
from nightly.session import materialize

WINDOW, GRAM = 50, 12
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_BLOCK = "key long, doc_id long, tag int, first int, n int, content long"


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, unchanged."""
    return text.encode().split() if text else []


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            one = np.array([1], np.uint64)
            self.up = np.cumprod(np.concatenate([one, np.full(n - 1, _BASE, np.uint64)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([one, np.full(n - 1, _BACK, np.uint64)]), dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


class Rolling:
    """Hashes of word ranges of one document."""

    def __init__(self, words: list[bytes]) -> None:
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        up, self.down = _POWERS.get(len(words) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)], dtype=np.uint64)])

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])


def cut_blocks(rolling: Rolling) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, first window, number of windows and content hash of every block of a document."""
    grams = rolling.all(GRAM)
    span = WINDOW - GRAM + 1
    windows = len(grams) - span + 1
    back = grams[::-1]
    parts = []
    for at in range(0, windows, 1 << 18):
        view = np.lib.stride_tricks.sliding_window_view(back[at : at + (1 << 18) + span - 1], span)
        lowest = view.argmin(axis=1)
        parts.append(lowest + np.arange(at, at + len(lowest)))
    leader = (len(grams) - 1 - np.concatenate(parts))[::-1]  # last smallest gram of every window
    first = np.flatnonzero(np.concatenate([[True], leader[1:] != leader[:-1]]))
    end = np.append(first[1:], windows)
    return grams[leader[first]], first, end - first, rolling.ranges(first, end + WINDOW - 1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def blocks(docs: DataFrame) -> DataFrame:
    """All blocks of all documents; texts shorter than a window have none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, tag, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "tag", "text"))):
                words = split_words(text)
                if len(words) >= WINDOW:
                    key, first, n, content = cut_blocks(Rolling(words))
                    out.append((key, np.full(len(key), doc), np.full(len(key), tag, np.int32), first.astype(np.int32), n.astype(np.int32), content))
            if out:
                key, doc, tag, first, n, content = map(np.concatenate, zip(*out))
                yield pa.record_batch({"key": _signed(key), "doc_id": pa.array(doc), "tag": pa.array(tag), "first": pa.array(first), "n": pa.array(n), "content": _signed(content)})

    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "tag", "text").mapInArrow(cut, _BLOCK)


def _windows_of(docs: DataFrame, opened: DataFrame) -> DataFrame:
    """Hash of every window of the opened blocks: key, content, at, window, doc_id, first."""
    lists = opened.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("key", "content", "first", "n")).alias("blocks"))
    texts = docs.select("doc_id", "tag", "text").join(lists, ["doc_id", "tag"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, found in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "blocks"))):
                windows = Rolling(split_words(text)).all(WINDOW)
                size = np.array([b["n"] for b in found])
                first = np.repeat([b["first"] for b in found], size)
                at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                yield pa.record_batch({
                    "key": pa.array(np.repeat([b["key"] for b in found], size)), "content": pa.array(np.repeat([b["content"] for b in found], size)),
                    "at": pa.array(at.astype(np.int32)), "window": _signed(windows[first + at]), "doc_id": pa.array(np.full(len(at), doc)),
                    "first": pa.array(first.astype(np.int32)),
                })

    return texts.select("doc_id", "text", "blocks").mapInArrow(hashes, "key long, content long, at int, window long, doc_id long, first int")


def copied_windows(docs: DataFrame) -> DataFrame:
    """Runs of windows that also start in a smaller document: doc_id, tag, first, n, ref_doc, ref_first.

    ``docs`` has doc_id, text and ``tag``, which tells rows of one doc_id with different texts apart.
    """
    parts = materialize(blocks(docs), "lz-blocks")
    shared = parts.groupBy("key").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")).where("_low < _high")
    shared = materialize(shared.select("key"), "lz-keys")
    parts = materialize(parts.join(shared, "key"), "lz-shared")
    origin = parts.groupBy("key", "content").agg(F.min(F.struct("doc_id", "tag", "first", "n")).alias("o"))
    origin = materialize(origin.select("key", "content", F.col("o.doc_id").alias("ref_doc"), F.col("o.tag").alias("ref_tag"), F.col("o.first").alias("ref_first"), F.col("o.n").alias("ref_n")), "lz-origins")
    known = parts.join(origin, ["key", "content"])
    whole = known.where("doc_id > ref_doc").select("doc_id", "tag", "first", "n", "ref_doc", "ref_first")

    differ = origin.groupBy("key").agg(F.min("content").alias("_a"), F.max("content").alias("_b")).where("_a < _b").select("key")
    opened = origin.join(differ, "key").select("key", "content", F.col("ref_doc").alias("doc_id"), F.col("ref_tag").alias("tag"), F.col("ref_first").alias("first"), F.col("ref_n").alias("n"))
    windows = materialize(_windows_of(docs, opened), "lz-windows")
    smallest = windows.groupBy("key", "window").agg(
        F.min(F.struct("doc_id", (F.col("first") + F.col("at")).alias("at"))).alias("w"), F.count("*").alias("_n")
    ).where("_n > 1")
    smallest = materialize(smallest.select("key", "window", F.col("w.doc_id").alias("ref_doc"), F.col("w.at").alias("ref_at")), "lz-smallest")
    seen = windows.join(smallest, ["key", "window"]).where("ref_doc < doc_id")
    seen = seen.groupBy("key", "content").agg(F.collect_list(F.struct("at", "ref_doc", "ref_at")).alias("seen"))
    seen = materialize(seen, "lz-seen")  # at most WINDOW entries a content
    single = known.where("doc_id = ref_doc").select("key", "content", "doc_id", "tag", "first").join(seen, ["key", "content"])
    single = single.select("doc_id", "tag", "first", F.explode("seen").alias("s")).where("s.ref_doc < doc_id")
    single = single.select("doc_id", "tag", (F.col("first") + F.col("s.at")).alias("first"), F.lit(1).alias("n"), "s.ref_doc", F.col("s.ref_at").alias("ref_first"))
    return whole.unionByName(single)


def chain(runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, words, ref_doc, ref_start) from runs (first window, windows, ref_doc, ref_first)."""
    out: list[list[int]] = []
    for first, n, ref, at in sorted(runs):
        last = out[-1] if out else None
        if last and last[2] == ref and at - first == last[3] - last[0] and first <= last[0] + last[1] - WINDOW + 1:
            last[1] = max(last[1], first + n + WINDOW - 1 - last[0])
        else:
            out.append([first, n + WINDOW - 1, ref, at])
    return [tuple(f) for f in out]


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept text, factors.

    A window of 50 words counts as copied if its words also start in a document with a smaller doc_id, judged on the texts
    as they came; every word under a copied window goes. NULL and empty texts have no words. Rows without doc_id are kept
    whole and are nobody's reference. Repeated rows do not remove each other, as neither has the smaller doc_id. Other
    columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.hash("text").alias("tag"))
    runs = copied_windows(docs).dropDuplicates(["doc_id", "tag", "first", "n"])
    runs = runs.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("first", "n", "ref_doc", "ref_first")).alias("runs"))
    runs = materialize(runs, "lz-runs")
    both = docs.join(runs, ["doc_id", "tag"], "left").select("doc_id", "text", "runs")
    factor = "array<struct<start:int,words:int,ref_doc:long,ref_start:int>>"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
        for batch in batches:
            n_words, removed, digests, texts, factors = [], [], [], [], []
            for text, found in zip(batch["text"].to_pylist(), batch["runs"].to_pylist()):
                words = split_words(text)
                made = chain([(r["first"], r["n"], r["ref_doc"], r["ref_first"]) for r in found or ()])
                gone = np.zeros(len(words), bool)
                for start, n, _, _ in made:
                    gone[start : start + n] = True
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if made else b" ".join(words)
                n_words.append(len(words))
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode())
                factors.append([dict(zip(("start", "words", "ref_doc", "ref_start"), f)) for f in made])
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(texts, pa.string()), "factors": pa.array(factors, kind),
            })

    return both.mapInArrow(remove, f"doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, factors {factor}")


ORACLE = """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS m FROM p),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY m) AS low FROM h) WHERE low < doc_id),
t AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w WHERE len(ws) > 0),
c AS (SELECT t.doc_id, t.i, t.word,
  max(d.i) OVER (PARTITION BY t.doc_id ORDER BY t.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM t LEFT JOIN d ON t.doc_id = d.doc_id AND t.i = d.i),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM c GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""


@query(ORACLE)
def op7_substring_lz(spark: SparkSession, sf: str) -> DataFrame:
    return deduplicate(table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
