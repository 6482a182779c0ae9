"""N-gram Jaccard join by a token-group matrix: all links with 100 * intersection >= percent * union, exactly.

Equal sets are one node. Tokens (hashes of 4-word shingles) have one global order, tokens of many documents last. Two
linked sets share a token among the first few of both (prefix filter), so a matrix of those tokens against groups is
enough to find every group a query can have a link to.

1. Partition. Per token, the set with the fewest rare tokens leads; every set of the token is checked against the leader.
   Verified links are stars; their components are the groups. Copies of one text end in one group this way, so no pair
   within a group needs to be looked at.
2. Matrix. Per token and group: the smallest set and the most tokens a member has left behind the token. Of a query and a
   group of another component these bound the overlap from above; groups below the threshold stay closed.
3. Open groups. Queries meet the members of qualifying groups that pass the same bound one by one; the pairs are checked on
   whole sets and the final components are taken over all verified links.

Every step is an aggregate that is combined before its shuffle or a join of plain exchanges that AQE can split. Broadcast
are the list of frequent tokens, at most HOT_TOKENS longs (any list gives the same result; it only saves work), and the
ids of documents to check while they are at most BROADCAST_IDS. Tokens are 64-bit hashes. Of the tables on the way only what
later steps read is kept on disk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightly.llm.common import clear_worker, query, table
from nightly.llm.components import components
from nightly.session import materialize, materialize_alone

SHINGLE, SIMILARITY = 4, 85
HOT_TOKENS = 500_000
BROADCAST_IDS = 500_000  # more documents to check than these are joined by a shuffle
_CHUNK = 1 << 20  # tokens counted at once
_SAMPLE = 4  # of one in so many sets the first tokens are counted however rare they are
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text; of the whole sequence if it is shorter."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - k + 1
    g = h[:n].copy()
    for i in range(1, k):
        g *= np.uint64(0x9E3779B97F4A7C15)
        g += h[i : i + n]
    g = (g ^ g >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(g ^ g >> np.uint64(29))


def least_overlap(a: int, b: int, percent: int = SIMILARITY) -> int:
    """Smallest intersection of linked sets of these sizes: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = SIMILARITY) -> int:
    """A set and any smaller or equal one it is linked with share one of so many first tokens of it."""
    return n - least_overlap(n, -(-percent * n // 100), percent) + 1


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def describe(docs: DataFrame, k: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """Rows of kind 0: a document's set size and 128-bit digest; of kinds 1 and 2: a token (d1) and in how many sets (n).

    Kind 1 has the tokens that are frequent among the sets of a chunk. A token may be rare in every chunk and still meet
    thousands of sets of a large table, so kind 2 has all that stand first, or may once frequent ones stand last, in a sample.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker()
        pool: list[np.ndarray] = []
        sample: list[np.ndarray] = []
        seen: set[bytes] = set()
        size = 0

        def counts(kind: int, sets: list[np.ndarray], least: int) -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(sets), return_counts=True)
            use = n >= least
            m = int(use.sum())
            none = pa.nulls(m, pa.int64())
            return pa.record_batch({"kind": pa.array(np.full(m, kind, np.int32)), "doc_id": none, "tag": pa.nulls(m, pa.int32()), "n": pa.array(n[use]), "d1": _long(token[use]), "d2": none})

        def counted() -> Iterator[pa.RecordBatch]:
            yield counts(1, pool, 4)
            if sample:
                yield counts(2, sample, 1)

        for batch in batches:
            n, digests = [], []
            for text in batch["text"].to_pylist():
                s = shingles(text, k)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                if len(s) and digests[-1] not in seen:
                    seen.add(digests[-1])
                    pool.append(s)
                    size += len(s)
                    if digests[-1][0] % _SAMPLE == 0:
                        sample.append(s[: prefix_length(len(s), percent) * 5 // 4 + 8])
            pair = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.record_batch({"kind": pa.array(np.zeros(len(n), np.int32)), "doc_id": batch["doc_id"], "tag": batch["tag"], "n": pa.array(n, pa.int64()), "d1": pa.array(pair[:, 0]), "d2": pa.array(pair[:, 1])})
            if size >= _CHUNK:
                yield from counted()
                pool, sample, seen, size = [], [], set(), 0
        if pool:
            yield from counted()

    return docs.select("doc_id", "tag", "text").mapInArrow(look, "kind int, doc_id long, tag int, n long, d1 long, d2 long")


def hot_tokens(described: DataFrame, least: int = 32, sampled: int = 4) -> np.ndarray:
    """The most frequent tokens, at most HOT_TOKENS: in ``least`` sets of the chunks or ``sampled`` ones of the sample."""
    n = [F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)) for kind in (1, 2)]
    counts = described.where("kind > 0").groupBy("d1").agg(n[0].alias("_chunks"), n[1].alias("_sample"))
    counts = counts.where((F.col("_chunks") >= least) | (F.col("_sample") >= sampled))
    counts = materialize(counts.select("d1", F.greatest("_chunks", F.col("_sample") * _SAMPLE).alias("n")), "join-frequent")
    return np.sort(counts.orderBy(F.desc("n"), "d1").limit(HOT_TOKENS).toPandas()["d1"].to_numpy(dtype=np.int64).view(np.uint64))


def prefixes(docs: DataFrame, hot: np.ndarray, k: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """Per document: set size, number of rare tokens, and its first tokens in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker()
        hot = shared.value
        for batch in batches:
            size, rare, tokens = [], [], []
            for text in batch["text"].to_pylist():
                s = shingles(text, k)
                often = np.zeros(len(s), bool)
                if len(hot) and len(s):
                    often = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s
                size.append(len(s))
                rare.append(len(s) - int(often.sum()))
                tokens.append(np.concatenate([s[~often], s[often]])[: prefix_length(len(s), percent)] if len(s) else s)
            ends = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
            flat = _long(np.concatenate(tokens)) if tokens else pa.array([], pa.int64())
            yield pa.record_batch({"doc_id": batch["doc_id"], "tag": batch["tag"], "n": pa.array(size, pa.int32()), "rare": pa.array(rare, pa.int32()), "tokens": pa.ListArray.from_arrays(pa.array(ends), flat)})

    return docs.select("doc_id", "tag", "text").mapInArrow(cut, "doc_id long, tag int, n int, rare int, tokens array<long>")


def _overlap(a: Column, b: Column, percent: int) -> Column:
    return F.ceil((a + b) * percent / (100 + percent) - F.lit(1e-9))


def _may_link(x: str, y: str, percent: int) -> Column:
    """Bound on two sets that meet in a token: sizes fit, the token stands early enough, and enough is left behind it."""
    n, m, i, j = (F.col(c) for c in (f"{x}.n", f"{y}.n", f"{x}.pos", f"{y}.pos"))
    low, high = F.least(n, m), F.greatest(n, m)
    small_pos = F.when(n < m, i).when(m < n, j).otherwise(F.least(i, j))
    early = small_pos < low - _overlap(low, low, percent) + 1
    return (100 * low >= percent * high) & early & (F.least(n - i, m - j) >= _overlap(n, m, percent))


def verify(pairs: DataFrame, sets: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            a, b = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            if len(a) > len(b):
                a, b = b, a
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            out.append(int((b[at] == a).sum()) >= least_overlap(len(a), len(b), percent))
        return pd.Series(out, dtype=bool)

    left = pairs.join(sets.withColumnsRenamed({"node": "a", "set": "_x"}), "a")
    return left.join(sets.withColumnsRenamed({"node": "b", "set": "_y"}), "b").where(linked("_x", "_y")).select("a", "b")


def join_similar(docs: DataFrame, k: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``; links have a Jaccard similarity of ``percent``.

    NULL, empty and blank texts have no shingles and stand alone. Rows without doc_id are linked with nothing and have a
    NULL component. Repeated rows are one node; different texts under one doc_id are nodes of their own, with that id.
    Other columns are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.hash("text").alias("tag"))
    hot: list[np.ndarray] = []

    def look() -> DataFrame:
        described = materialize(describe(docs, k, percent), "join-tokens")
        hot.append(hot_tokens(described))
        return described.where("kind = 0").drop("kind")

    rows = materialize_alone(docs.sparkSession, look, "join-sets")
    named = rows.where("n > 0 and doc_id is not null")
    classes = named.groupBy("d1", "d2", "n").agg(F.min(F.struct("doc_id", "tag")).alias("node"))
    classes = materialize(classes, "join-classes")

    found = materialize_alone(docs.sparkSession, lambda: _nodes_found(docs, classes, hot[0], k, percent), "join-found")
    known = rows.join(classes, ["d1", "d2", "n"], "left").join(found, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("_low", "node.doc_id", "doc_id"))
    return known.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _nodes_found(docs: DataFrame, classes: DataFrame, hot: np.ndarray, k: int, percent: int) -> DataFrame:
    """``node, _low`` for every linked node: the smallest doc_id of its component."""
    spark = docs.sparkSession
    first = prefixes(docs.where("doc_id is not null"), hot, k, percent)
    first = first.withColumn("node", F.struct("doc_id", "tag")).drop("doc_id", "tag").join(classes.select("node"), "node")
    first = materialize(first.dropDuplicates(["node"]), "join-prefixes")
    posts = first.select("node", "n", "rare", F.posexplode("tokens").alias("pos", "token"))
    entry = F.struct("rare", "node", "n", "pos")
    lead = posts.groupBy("token").agg(F.min(entry).alias("l"), F.count("*").alias("_c")).where("_c > 1").drop("_c")
    met = materialize_alone(spark, lambda: posts.join(materialize(lead, "join-leaders"), "token"), "join-met")

    stars = met.withColumn("x", F.struct("n", "pos")).where((F.col("node") != F.col("l.node")) & _may_link("x", "l", percent))
    stars = stars.select(F.col("node").alias("a"), F.col("l.node").alias("b"))
    links = materialize_alone(spark, lambda: _links(docs, first, stars, k, percent), "join-links")
    group = materialize_alone(spark, lambda: components(links), "join-groups")

    member = met.join(group.withColumnRenamed("label", "group"), "node", "left").select(
        "token", "node", "n", "pos", F.coalesce("group", "node").alias("group")
    )
    member = materialize(member, "join-members")
    matrix = member.groupBy("token", "group").agg(
        F.min("n").alias("small"), F.max("n").alias("large"), F.max(F.col("n") - F.col("pos")).alias("left")
    )
    several = matrix.groupBy("token").agg(F.min("group").alias("_a"), F.max("group").alias("_b")).where("_a < _b").select("token")
    matrix = materialize(matrix.join(materialize(several, "join-several"), "token"), "join-matrix")
    x, y = matrix.alias("x"), matrix.alias("y")
    reach = F.least(F.col("x.left"), F.col("y.left")) >= _overlap(F.col("x.small"), F.col("y.small"), percent)
    fits = (100 * F.col("y.large") >= percent * F.col("x.small")) & (100 * F.col("x.large") >= percent * F.col("y.small"))
    opened = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.group") < F.col("y.group")) & reach & fits)
    opened = materialize(opened.select(F.col("x.token").alias("token"), F.col("x.group").alias("g"), F.col("y.group").alias("h")), "join-opened")
    x = member.alias("x").join(opened, (F.col("x.token") == opened["token"]) & (F.col("x.group") == F.col("g"))).select(
        F.struct("x.node", "x.n", "x.pos").alias("x"), opened["token"].alias("token"), "h"
    )
    y = member.alias("m").select(F.struct("m.node", "m.n", "m.pos").alias("y"), F.col("m.token").alias("_t"), F.col("m.group").alias("_h"))
    pairs = x.join(y, (F.col("token") == F.col("_t")) & (F.col("h") == F.col("_h")) & _may_link("x", "y", percent))
    pairs = pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    links = links.unionAll(materialize_alone(spark, lambda: _links(docs, first, pairs, k, percent), "join-links"))
    return components(links).select("node", F.col("label.doc_id").alias("_low"))


def _links(docs: DataFrame, first: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The linked ones of candidate pairs (a, b).

    First tokens are compared before whole sets: a common token outside the common first ones stands behind the first tokens
    of the set whose first tokens end earlier, so the overlap is at most their common ones plus the rest of one set.
    """
    pairs = materialize(pairs.distinct(), "join-pairs")
    for side, name in (("a", "x"), ("b", "y")):
        own = first.select(F.col("node").alias(side), F.struct("n", "tokens").alias(name))
        pairs = pairs.join(own, side)
    common = F.size(F.array_intersect("x.tokens", "y.tokens"))
    rest = F.greatest(F.col("x.n") - F.size("x.tokens"), F.col("y.n") - F.size("y.tokens"))
    pairs = pairs.where(common + rest >= _overlap(F.col("x.n"), F.col("y.n"), percent)).select("a", "b")
    pairs = materialize(pairs, "join-likely")
    wanted = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "join-wanted")
    return verify(pairs, _sets(docs, wanted, k), percent)


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Whole sets of the wanted nodes as sorted longs, written once."""
    ids = wanted.select("node.doc_id", "node.tag")
    few = ids.count() <= BROADCAST_IDS

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker()
        for batch in batches:
            held = pa.array([shingles(t, k).tobytes() for t in batch["text"].to_pylist()], pa.binary())
            yield pa.record_batch({"doc_id": batch["doc_id"], "tag": batch["tag"], "set": held})

    texts = docs.join(F.broadcast(ids) if few else ids, ["doc_id", "tag"]).select("doc_id", "tag", "text")
    found = texts.mapInArrow(compute, "doc_id long, tag int, set binary").dropDuplicates(["doc_id", "tag"])
    return materialize(found.select(F.struct("doc_id", "tag").alias("node"), "set"), "join-whole-sets")


ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS t FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * i >= 85 * (a.n + b.n - i)),
r AS (SELECT doc_id AS x, doc_id AS c FROM documents UNION SELECT l.y, r.c FROM r JOIN l ON r.x = l.x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN r ON r.x = w.doc_id GROUP BY ALL
"""


@query(ORACLE)
def op10_jaccard_groups(spark: SparkSession, sf: str) -> DataFrame:
    return join_similar(table(spark, sf, "documents"))
