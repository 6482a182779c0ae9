"""Mixing sources to target weights by hierarchical budgeting.

The corpus is a tree domain -> language -> source. A token budget goes down the tree in proportion to node weights. A
node never gets more than its subtree can give (tokens x epochs); what it cannot take goes to its siblings, and reaches
the siblings of its parent only when the whole family is full. Each leaf then takes whole epochs and, of one more, the
token-prefix of an order seeded by epoch: documents are taken while the tokens before them are below the rest.

The prefix needs no sort of a leaf. Order keys are hashes; an aggregate sums tokens per leaf and hash range (4,096 a leaf),
running sums find the range the prefix ends in, and only that range's rows, one in 4,096, are ordered. The plan that is
broadcast has one row per leaf; more than MAX_LEAVES leaves are refused.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from nightly.llm.common import query, table
from nightly.session import materialize

MAX_LEAVES = 50_000
RANGES = 4096
LEVELS = ("domain", "lang", "source")

# Target weights of the registered query by domain; nodes that are not named weigh 1.
WEIGHTS = {("domain0",): 2.0, ("domain1",): 1.0, ("domain2",): 1.0, ("domain0", "en"): 3.0, ("domain1", "de"): 2.0}


def words(text: str = "text") -> Column:
    """Words between blanks; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def domain(source: str = "source") -> Column:
    """Domain of a source: the number at its end modulo 3; ``other`` without one."""
    number = F.regexp_extract(F.col(source), "(\\d{1,9})$", 1)
    return F.when(F.length(number) > 0, F.concat(F.lit("domain"), (number.cast("long") % 3).cast("string"))).otherwise("other")


def _node(column: str) -> Column:
    """Name of a node, never NULL: that of NULL is empty, others begin with a mark."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def pour(total: float, weights: dict, capacity: dict) -> dict:
    """Split ``total`` by weight, no share above its capacity; shortages go to the rest by weight."""
    out = dict.fromkeys(weights, 0.0)
    open_ = {k for k in weights if capacity[k] > 0 and weights[k] > 0}
    left = min(total, sum(capacity[k] for k in open_))
    while open_ and left > 0:
        unit = left / sum(weights[k] for k in open_)
        full = {k for k in open_ if weights[k] * unit >= capacity[k]}
        if not full:
            out.update({k: weights[k] * unit for k in open_})
            break
        out.update({k: float(capacity[k]) for k in full})
        left -= sum(capacity[k] for k in full)
        open_ -= full
    return out


def budgets(leaves: dict[tuple, int], weights: dict[tuple, float], total: float, epochs: float) -> dict[tuple, int]:
    """Whole tokens per leaf (a path of node names), from the tokens each leaf has."""
    depth = len(next(iter(leaves), ()))
    capacity: dict[tuple, float] = defaultdict(float)
    children: dict[tuple, set] = defaultdict(set)
    for path, tokens in leaves.items():
        for i in range(depth + 1):
            capacity[path[:i]] += tokens * epochs
            if i < depth:
                children[path[:i]].add(path[: i + 1])
    share = {(): float(total)}
    for i in range(depth):
        for node in [n for n in share if len(n) == i]:
            below = sorted(children[node], key=str)
            share |= pour(share[node], {c: weights.get(c, 1.0) for c in below}, {c: capacity[c] for c in below})
    return {path: int(share[path] + 1e-6) for path in leaves}


def _placed(docs: DataFrame, tokens: Column, epoch: Column | int, seed: int) -> DataFrame:
    """``docs`` as ``_row`` with leaf, tokens, and the order key and its range in an epoch."""
    key = F.xxhash64(F.lit(seed), epoch, F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text")))
    return docs.select("*", tokens.alias("_tokens"), key.alias("_key")).withColumn("_range", F.shiftrightunsigned("_key", 52).cast("int"))


def mix(docs: DataFrame, weights: dict[tuple, float] | None = None, share: float = 0.5, epochs: int = 2, seed: int = 1) -> DataFrame:
    """Rows of ``docs`` that the mix takes, with ``mix_domain``, ``mix_tokens`` and ``mix_copies``.

    ``share`` is the budget as a share of all tokens, ``epochs`` how often a document may be used at most. NULL language
    and source are nodes of their own (None in ``weights``), apart from empty ones. Texts without words cost nothing and are
    taken where the prefix passes them; a leaf without any word is taken once, unless a node above it weighs nothing. Rows
    without doc_id are ordered by their text; repeated rows are rows of their own, in a fixed order but for equal ones,
    which are alike. Columns of ``docs`` named like the three results are replaced. An empty table gives no rows.
    """
    weights = WEIGHTS if weights is None else weights
    docs = docs.drop("mix_domain", "mix_tokens", "mix_copies")
    leaf = [domain().alias("_l0"), _node("lang").alias("_l1"), _node("source").alias("_l2")]
    keys = ["_l0", "_l1", "_l2"]
    lean = docs.select("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")).alias("text"), *leaf, words().alias("_n"))
    lean = materialize(lean, "mix-leaves")
    totals = lean.groupBy(*keys).agg(F.sum("_n").alias("n")).limit(MAX_LEAVES + 1).collect()
    if len(totals) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} leaves")
    coded = {(r["_l0"], *(r[k][1:] if r[k] else None for k in keys[1:])): tuple(r[k] for k in keys) for r in totals}
    have = {p: r["n"] for p, r in zip(coded, totals)}
    want = budgets(have, weights, share * sum(have.values()), epochs)
    weighs = {p: all(weights.get(p[:i], 1.0) > 0 for i in range(1, len(p) + 1)) for p in have}
    rows = [(*coded[p], *(divmod(want[p], n) if n else (int(weighs[p] and share > 0), 0))) for p, n in have.items()]
    plan = docs.sparkSession.createDataFrame(rows, "_l0 string, _l1 string, _l2 string, _full long, _rest long")
    plan = F.broadcast(plan)  # at most MAX_LEAVES rows

    placed = _placed(lean.join(plan, keys), F.col("_n"), F.col("_full"), seed)
    sums = placed.groupBy(*keys, "_rest", "_range").agg(F.sum("_tokens").alias("_sum"))
    running = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    edges = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(running), F.lit(0)))
    edges = edges.where((F.col("_before") + F.col("_sum") >= F.col("_rest")) & (F.col("_rest") > 0))
    edges = edges.groupBy(*keys).agg(F.min_by(F.struct("_range", "_before"), "_range").alias("e"))
    edges = edges.select(*keys, F.col("e._range").alias("_edge"), F.col("e._before").alias("_before"))
    full_plan = F.broadcast(materialize(plan.join(F.broadcast(edges), keys, "left"), "mix-plan"))  # one row per leaf

    every = docs.withColumn("_row", F.struct(*docs.columns)).select("_row", "doc_id", "text", *leaf)
    every = _placed(every.join(full_plan, keys), words(), F.col("_full"), seed)
    inside = every.where((F.col("_edge").isNull()) | (F.col("_range") != F.col("_edge")))
    inside = inside.withColumn("_in", F.coalesce(F.col("_range") < F.col("_edge"), F.lit(False)))
    order = Window.partitionBy(*keys).orderBy("_key", "doc_id", "_tokens", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1)
    edge = every.where(F.col("_range") == F.col("_edge"))
    start = F.col("_before") + F.coalesce(F.sum("_tokens").over(order), F.lit(0))
    edge = edge.withColumn("_in", start < F.col("_rest"))
    out = inside.unionByName(edge).withColumn("mix_copies", F.col("_full") + F.col("_in").cast("long")).where("mix_copies > 0")
    return out.select("_row.*", F.col("_l0").alias("mix_domain"), F.col("_tokens").alias("mix_tokens"), "mix_copies")


@query()
def op9_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    out = mix(table(spark, sf, "documents"))
    return out.select("doc_id", "mix_domain", "lang", "source", "mix_tokens", "mix_copies")
