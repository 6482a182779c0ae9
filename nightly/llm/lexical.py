"""Ranked lexical search by hashed max-sketches: upper bounds of all documents, then exact scores in descending order of bound.

Index. A document's sketch has two rows of bytes. A term's hash names one place in each, and a place keeps the greatest
frequency of its terms (255 stands for "255 or more"). The impact of a term in a document grows with its frequency and is
else fixed by the document's length, so the smaller of a term's two places gives an upper bound of its impact, and a term
that is missing most often meets an empty place. A sketch is 4 to 8 places a row for every distinct term wide, so that long
documents have bounds as tight as short ones. The same pass over the texts counts documents, terms and, for the query's
terms, the documents that hold them.

Search. Items are taken in batches of at most BATCH_BYTES of text, which is what is broadcast. One pass over the sketches
looks all terms of a batch up and keeps the FIRST greatest bounds of each item; those documents are scored exactly and give
every item a threshold, the score of its last place. A second pass opens the documents whose bound reaches the threshold.
They are scored in descending order of bound, about a ROUND an item first, more in every later round, each round with the
thresholds of those before; what falls below its threshold is never scored. A document that is not scored has a bound, so a
score, below that of the last place, and ties with it are scored, so the ranks are exact.

Per-task summaries of the first pass are merged a few at a time; thresholds and one batch of items are what the driver holds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from nightly.llm.common import merge_rows, query, small_batches, table
from nightly.session import materialize

TOP = 20  # ranks of an item
FIRST = 64  # greatest bounds scored to get thresholds
ROUND = 2_000  # candidates of an item scored before its threshold is set anew; grows by GROWTH
GROWTH = 8
BATCH_BYTES = 1 << 20  # text of the items searched at once
BROADCAST_PAIRS = 200_000  # more candidates than these meet their texts by a shuffled join
_CELLS = 1 << 20  # numbers worked on at once
_FULL = 1_000_000  # no impact reaches this

# Bytes that part terms become blanks, capital letters small ones.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Items:
    """The items of one batch, their distinct terms, and per item the terms with how often it repeats them."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in rows]
        counts = [Counter(terms(t)) for _, t in rows]
        self.terms = sorted(set().union(*counts))
        self.place = {t: i for i, t in enumerate(self.terms)}
        self.begin = np.cumsum([0, *(len(c) for c in counts)])[:-1]
        self.term = np.array([self.place[t] for c in counts for t in c], np.int64)
        self.times = np.array([n for c in counts for n in c.values()], np.int64)
        self.hash = np.array([xxhash.xxh3_64_intdigest(t) for t in self.terms], np.uint64)

    def weigh(self, n: int, length: int, df: dict[int, int]) -> None:
        self.n, self.length = n, length
        self.weight = np.array([weight(n, df.get(i, 0)) for i in range(len(self.terms))], np.int64)

    def damping(self, size: np.ndarray) -> np.ndarray:
        return 75 + 25 * size.astype(np.int64) * self.n // max(1, self.length)


def sketch(counts: Counter) -> bytes:
    """The two rows of a document's term counts."""
    width = 1 << max(5, (4 * len(counts) - 1).bit_length())
    tf = np.fromiter(counts.values(), np.int64, len(counts))
    order = np.argsort(tf, kind="stable")  # of equal places the last, so the greatest, is kept
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts))[order]
    out = np.zeros(2 * width, np.uint8)
    top = np.minimum(tf[order], 255).astype(np.uint8)
    out[(h & np.uint64(width - 1)).astype(np.int64)] = top
    out[width + (h >> np.uint64(32) & np.uint64(width - 1)).astype(np.int64)] = top
    return out.tobytes()


def _look(docs: DataFrame, items: Items, sketches: bool) -> DataFrame:
    """Rows of kind 0: a document's number of terms and sketch; of kind 1: a term of the batch (doc_id) and its documents (n);
    of kind 2: documents with a term (doc_id) and their terms (n)."""
    place = items.place

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, with_terms, length = np.zeros(len(place), np.int64), 0, 0

        def rows(kind, doc_id, tag, n, held):
            return pa.record_batch({"kind": pa.array(np.full(len(n), kind, np.int32)), "doc_id": doc_id, "tag": tag, "n": pa.array(n, pa.int64()), "held": held})

        for batch in batches:
            n, held = [], []
            for text in batch["text"].to_pylist():
                words = terms(text)
                counts = Counter(words)
                n.append(len(words))
                with_terms += bool(words)
                length += len(words)
                found = [place[t] for t in counts.keys() & place.keys()]
                df[found] += 1
                held.append(sketch(counts) if sketches and words else None)
            if sketches:
                yield rows(0, batch["doc_id"], batch["tag"], n, pa.array(held, pa.binary()))
        at = np.flatnonzero(df)
        for kind, ids, n in ((1, at, df[at]), (2, [with_terms], [length])):
            yield rows(kind, pa.array(ids, pa.int64()), pa.nulls(len(n), pa.int64()), n, pa.nulls(len(n), pa.binary()))

    return docs.mapInArrow(look, "kind int, doc_id long, tag long, n long, held binary")


def _bounds(items: Items, size: np.ndarray, held: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and the upper bounds of these documents for every item, a block of documents at a time."""
    width = np.array([len(s) // 2 for s in held], np.int64)
    step = max(1, _CELLS // max(1, len(items.term), len(items.terms)))
    for w in np.unique(width):
        every = np.flatnonzero(width == w)
        p = (items.hash & np.uint64(w - 1)).astype(np.int64), w + (items.hash >> np.uint64(32) & np.uint64(w - 1)).astype(np.int64)
        # wide sketches are few at a time too
        for at in np.array_split(every, -(-len(every) // max(1, min(step, (1 << 24) // int(w))))):
            s = np.frombuffer(b"".join(held[i] for i in at), np.uint8).reshape(len(at), 2 * w)
            tf = np.minimum(s[:, p[0]], s[:, p[1]])
            row, col = np.nonzero(tf)
            t = tf[row, col].astype(np.int64)
            impact = np.where(t == 255, _FULL, 1_000_000_000 * t // (1000 * t + 12 * items.damping(size[at])[row]))
            value = np.zeros(tf.shape, np.int64)
            value[row, col] = impact * items.weight[col]
            yield at, np.add.reduceat(value[:, items.term] * items.times, items.begin, axis=1)


def _best(bounds: np.ndarray, ids: np.ndarray, tags: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The greatest bounds of every item (column) with their documents."""
    if len(bounds) > keep:
        at = np.argpartition(-bounds, keep - 1, axis=0)[:keep]
        bounds, ids, tags = (np.take_along_axis(x, at, axis=0) for x in (bounds, ids, tags))
    return bounds, ids, tags


def first_candidates(sketches: DataFrame, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item number, doc_id and tag of the FIRST greatest bounds above 0 of every item."""
    shared = sketches.sparkSession.sparkContext.broadcast(items)
    schema = "bounds binary, ids binary, tags binary"

    def row(best) -> pa.RecordBatch:
        return pa.record_batch({n: pa.array([x.astype("<i8").tobytes()]) for n, x in zip(("bounds", "ids", "tags"), best)})

    def none(n: int):
        return tuple(np.zeros((0, n), np.int64) for _ in range(3))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        best = none(len(items.ids))
        for batch in batches:
            ids, tags, size = (batch[c].to_numpy() for c in ("doc_id", "tag", "n"))
            for at, b in _bounds(items, size, batch["held"].to_pylist()):
                wide = [np.broadcast_to(x[at, None], b.shape) for x in (ids, tags)]
                best = _best(*(np.concatenate(x) for x in zip(best, (b, *wide))), FIRST)
        yield row(best)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(shared.value.ids)
        best = none(n)
        for batch in batches:
            for held in zip(*(batch[c].to_pylist() for c in ("bounds", "ids", "tags"))):
                one = [np.frombuffer(h, "<i8").reshape(-1, n) for h in held]
                best = _best(*(np.concatenate(x) for x in zip(best, one)), FIRST)
        yield row(best)

    found = merge_rows(sketches.select("doc_id", "tag", "n", "held").mapInArrow(look, schema), merge, "search-first")
    if found is None:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    bounds, ids, tags = (np.frombuffer(found[c], "<i8").reshape(-1, len(items.ids)) for c in ("bounds", "ids", "tags"))
    at, item = np.nonzero(bounds > 0)
    return item, ids[at, item], tags[at, item]


def open_candidates(sketches: DataFrame, items: Items, threshold: np.ndarray) -> DataFrame:
    """item, doc_id, tag, bound of every document whose bound is above 0 and reaches the item's threshold."""
    shared = sketches.sparkSession.sparkContext.broadcast((items, threshold))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, threshold = shared.value
        least = np.maximum(threshold, 1)
        for batch in batches:
            ids, tags, size = (batch[c].to_numpy() for c in ("doc_id", "tag", "n"))
            for at, b in _bounds(items, size, batch["held"].to_pylist()):
                row, item = np.nonzero(b >= least)
                yield pa.record_batch({"item": pa.array(item.astype(np.int32)), "doc_id": pa.array(ids[at[row]]), "tag": pa.array(tags[at[row]]), "bound": pa.array(b[row, item])})

    return sketches.select("doc_id", "tag", "n", "held").mapInArrow(look, "item int, doc_id long, tag long, bound long").distinct()


def rescore(docs: DataFrame, pairs: DataFrame, items: Items, few: bool) -> DataFrame:
    """item, doc_id, score (above 0) of the pairs (item, doc_id, tag), from the whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    wanted = pairs.groupBy("doc_id", "tag").agg(F.collect_set("item").alias("items"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        ends = np.append(items.begin[1:], len(items.term))
        for batch in batches:
            got: list[tuple[int, int, int]] = []
            for doc_id, text, some in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch["items"].to_pylist()):
                words = terms(text)
                counts = Counter(words)
                tf = np.zeros(len(items.terms), np.int64)
                for t in counts.keys() & items.place.keys():
                    tf[items.place[t]] = counts[t]
                value = items.weight * (1_000_000_000 * tf // (1000 * tf + 12 * items.damping(np.array([len(words)]))))
                for i in some:
                    own = slice(items.begin[i], ends[i])
                    got.append((i, doc_id, int((value[items.term[own]] * items.times[own]).sum())))
            item, ids, points = zip(*got) if got else ((), (), ())
            yield pa.record_batch({"item": pa.array(item, pa.int32()), "doc_id": pa.array(ids, pa.int64()), "score": pa.array(points, pa.int64())})

    both = docs.join(F.broadcast(wanted) if few else wanted, ["doc_id", "tag"]).select("doc_id", "text", "items")
    return both.mapInArrow(score, "item int, doc_id long, score long").where("score > 0")


def _ranked(scores: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search(docs: DataFrame, sketches: DataFrame, items: Items, top: int) -> DataFrame:
    """item, rank, doc_id, score of one batch of items."""
    spark = docs.sparkSession
    scored: list[DataFrame] = []
    threshold = np.zeros(len(items.ids), np.int64)

    def settle(pairs: DataFrame, few: bool) -> None:
        """Score the pairs; an item with enough scores has that of its last place as its threshold."""
        scored.append(materialize(rescore(docs, pairs, items, few), "search-scores"))
        best = materialize(_ranked(reduce(DataFrame.unionAll, scored), top).select("item", "doc_id", "score", "rank"), "search-best")
        scored[:] = [best.select("item", "doc_id", "score")]
        for r in best.where(F.col("rank") == top).collect():
            threshold[r["item"]] = r["score"]

    item, ids, tags = first_candidates(sketches, items)
    at = spark.createDataFrame(list(zip(item.tolist(), ids.tolist(), tags.tolist())), "item int, doc_id long, tag long")
    first = materialize(at.distinct(), "search-pairs")
    settle(first, True)
    left = materialize(open_candidates(sketches, items, threshold).join(first, ["item", "doc_id", "tag"], "left_anti"), "search-open")
    size = ROUND
    while True:
        # about ``size`` candidates of every item, those with the greatest bounds
        counts = left.groupBy("item").agg(F.count("*").alias("_n"), F.percentile_approx("bound", F.array(*[F.lit(1 - 2.0**-k) for k in range(32)]), 10_000).alias("_q"))
        counts = counts.collect()
        if not counts:
            break
        level = {r["item"]: r["_q"][0] if r["_n"] <= size else r["_q"][max(0, math.floor(math.log2(r["_n"] / size)))] for r in counts}
        levels = spark.createDataFrame(list(level.items()), "item int, _level long")
        now = left.join(F.broadcast(levels), "item").where(F.col("bound") >= F.col("_level"))
        now = materialize(now.select("item", "doc_id", "tag"), "search-pairs")
        settle(now, now.count() <= BROADCAST_PAIRS)
        least = spark.createDataFrame([(i, level.get(i, 0), int(t)) for i, t in enumerate(threshold)], "item int, _level long, _least long")
        rest = left.join(F.broadcast(least), "item").where((F.col("bound") < F.col("_level")) & (F.col("bound") >= F.col("_least")))
        left = materialize(rest.select("item", "doc_id", "tag", "bound"), "search-open")
        size *= GROWTH
    return _ranked(scored[0], top)


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents (doc_id, text) of every item (item_id, text), scores above 0.

    Documents without a term are in no result and in no count. Rows without doc_id count in the statistics but are not
    ranked. Repeated rows and different texts under one doc_id are documents of their own. Items without a term, NULL and
    empty ones too, and items without item_id have no rows; items of equal id and text are one; different texts under one
    item_id are ranked apart. Other columns are ignored. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("tag", F.xxhash64("text"))
    queries = queries.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna().distinct()
    batches = 1 + (queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // batch_bytes
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(batches))
    sketches, found = None, []
    for batch in range(batches):
        rows = sorted((r["item_id"], r["text"]) for r in queries.where(number == batch).collect())
        items = Items([r for r in rows if terms(r[1])])
        if not items.ids:
            continue
        looked = materialize(_look(docs, items, sketches is None), "search-sketches")
        if sketches is None:
            sketches = looked.where("kind = 0 and n > 0 and doc_id is not null")
        df = {r["doc_id"]: r["n"] for r in looked.where("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("n")).collect()}
        whole = looked.where("kind = 2").agg(F.sum("doc_id").alias("n"), F.sum("n").alias("length")).first()
        items.weigh(whole["n"] or 0, whole["length"] or 0, df)
        ids = spark.createDataFrame(list(enumerate(items.ids)), "item int, item_id long")
        got = _search(docs, sketches, items, top).join(F.broadcast(ids), "item")
        found.append(got.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, found)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
g AS (SELECT count(*) AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
p AS (SELECT doc_id, len(ts) AS n, unnest(ts) AS t FROM d),
f AS (SELECT doc_id, t, any_value(n) AS n, count(*) AS tf FROM p WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
w AS (SELECT t, floor(1000 * ln((2 * g.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, g GROUP BY t, g.n),
s AS (SELECT f.doc_id, f.t, w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * f.n * g.n) // g.l))) AS v FROM f JOIN w ON f.t = w.t, g),
r AS (SELECT q.item_id, s.doc_id, sum(v)::BIGINT AS score FROM q JOIN s ON q.t = s.t GROUP BY ALL HAVING sum(v) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM r QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""


@query(ORACLE)
def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
