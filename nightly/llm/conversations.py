"""Repair of the structure of conversations: cheapest edits by dynamic programming, the least audit by prefix doubling.

After repair the roles of a conversation are an optional system turn and then user and assistant in turns, or nothing. A turn
may be kept (K), given the role user or assistant (R), deleted (D), and empty turns may be inserted (I). A node is a place
between two turns together with what came before it (nothing, system, user, assistant); arcs are edits. Letters of a node's
arcs differ, and each letter leads to one node.

1. Costs. From the last turn to the first, the least cost from every node to an accepted end, for many conversations at once.
2. Ranks. Every node points along its optimal arc with the least letter. Nodes are ranked by the first 1, 2, 4, ... letters of
   their audits: the rank for twice the length is the rank of the pair (own rank, rank of the node the pointer leads to), and
   pointers are doubled. Of a node's optimal arcs that with the least pair (letter, rank of the node behind) is the least path.
3. Paths. The doubled pointers of a start node, taken by the binary digits of 0, 1, 2, ..., are the nodes of its path.

Conversations of more than MAX_ROWS turns are cut: their turns are range-partitioned by their order into blocks, each block
gives a 4 x 4 matrix of costs from what came before it to what it ends with, products of these give the costs behind every
block, and blocks pass on where the least path leaves them. Both ways give the same edits. Nothing of such a conversation but
a few numbers a block is brought together here; a digest of a whole conversation, as in the query, is one value by nature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightly.functions.frame import join_keys
from nightly.llm.common import query, small_batches, table
from nightly.session import materialize

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5  # costs; keeping costs nothing
MAX_ROWS = 100_000  # turns of a conversation that are worked on by one task at once
BROADCAST_LARGE = 20_000  # more cut conversations than these are found by a shuffled join
_PENDING = 20_000  # turns collected before a group of conversations is worked on
_BLANK = " \t\n\x0b\f\r"

_INF = 1 << 60
LETTERS = "DIKR"  # in ASCII order, which is the order of the codes
# What came before a place: 0 nothing, 1 system, 2 user, 3 assistant. Where a kept turn of role s, u, a or another leads.
_KEEP = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
_NEXT = np.array([2, 2, 3, 2])  # where a turn of the role that may follow leads
_ROLE = np.array(["", "", "user", "assistant"], dtype=object)


def _relax(h: np.ndarray) -> np.ndarray:
    """Costs with turns inserted at the same place; two in a row at most are of use."""
    for _ in range(2):
        h = np.minimum(h, INSERT + h[..., _NEXT])
    return h


ACCEPTED = _relax(np.array([0, _INF, _INF, 0]))


def costs(size: np.ndarray, role: np.ndarray, gone: np.ndarray, extra: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least cost from every node; group g has size[g] turns and size[g] + 1 places, and ``end[g]`` holds behind its last turn."""
    first = np.cumsum(size) - size
    place = first + np.arange(len(size))
    out = np.empty((int(size.sum()) + len(size), 4), np.int64)
    order = np.argsort(-size, kind="stable")
    size, first, place, now = size[order], first[order], place[order], end[order].astype(np.int64)
    out[place + size] = now
    for j in range(1, int(size[0]) + 1 if len(size) else 1):
        live = int(np.searchsorted(-size, -j, side="right"))
        row, after = (first + size)[:live] - j, now[:live]
        to = _KEEP[:, role[row]].T
        held = extra[row, None]
        keep = np.where((to < 0) | gone[row, None], _INF, np.take_along_axis(after, np.maximum(to, 0), 1) + held)
        other = np.where(gone[row, None], _INF, after[:, _NEXT] + REROLE + held)
        now[:live] = _relax(np.minimum(np.minimum(after + DELETE, keep), other))
        out[(place + size)[:live] - j] = now[:live]
    return np.minimum(out, _INF)


class Paths:
    """The least path from what came before every group (``entry``): letters, nodes' turns and states, and where it ends."""

    def __init__(self, size, role, gone, extra, end, last, entry) -> None:
        n = len(size)
        h = costs(size, role, gone, extra, end)
        place = np.cumsum(size) - size + np.arange(n)
        final = np.zeros(len(h), bool)
        final[place + size] = True
        turn = np.flatnonzero(~final)  # the place before every turn
        base = 4 * np.arange(len(h))[:, None]
        cost = np.full((4, len(h), 4), _INF)
        goal = np.zeros((4, len(h), 4), np.int64)
        to = _KEEP[:, role].T
        after = h[turn + 1]
        cost[0, turn], goal[0, turn] = after + DELETE, base[turn + 1] + np.arange(4)
        cost[1], goal[1] = h[:, _NEXT] + INSERT, base + _NEXT
        behind = np.zeros(len(h), bool)  # turns inserted behind a block belong to the next one
        behind[(place + size)[~last]] = True
        cost[1, behind] = _INF
        cost[2, turn] = np.where((to < 0) | gone[:, None], _INF, np.take_along_axis(after, np.maximum(to, 0), 1) + extra[:, None])
        goal[2, turn] = base[turn + 1] + np.maximum(to, 0)
        cost[3, turn] = np.where(gone[:, None], _INF, after[:, _NEXT] + REROLE + extra[:, None])
        goal[3, turn] = base[turn + 1] + _NEXT
        best = (cost == h) & (h < _INF)
        best, goal = best.reshape(4, -1), goal.reshape(4, -1)
        start = 4 * place + entry
        pointers, ranks, steps = self._double(best, goal, start)
        # ranks of all lengths are known: the least pair (letter, rank behind) of every node
        key = np.where(best, np.arange(4)[:, None] * (ranks.max(initial=0) + 1) + ranks[goal], _INF)
        letter = np.where(best.any(axis=0), key.argmin(axis=0), -1)

        length = steps[start]
        self.owner = np.repeat(np.arange(n), length)
        at = np.arange(len(self.owner)) - np.repeat(np.cumsum(length) - length, length)
        node = start[self.owner]
        for k, ptr in enumerate(pointers):
            use = (at >> k & 1).astype(bool)
            node[use] = ptr[node[use]]
        self.letter = letter[node]
        self.turn = np.where(self.letter == 1, -1, node // 4 - self.owner)  # number of the turn among all groups' turns
        self.state = goal[self.letter, node] % 4
        self.exit = pointers[-1][start] % 4 if pointers else start % 4
        self.length = length

    @staticmethod
    def _double(best: np.ndarray, goal: np.ndarray, start: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Doubled pointers, ranks by whole audits, and lengths of the audits of all nodes whose path ends."""
        some = best.any(axis=0)
        letter = best.argmax(axis=0)
        node = np.arange(best.shape[1])
        ptr = np.where(some, goal[letter, node], node)
        rank, steps = np.where(some, letter + 1, 0), some.astype(np.int64)
        pointers = [ptr]
        while some[ptr].any():
            rank = np.unique(rank * (rank.max() + 1) + rank[ptr], return_inverse=True)[1].reshape(-1)
            steps, ptr = steps + steps[ptr], ptr[ptr]
            pointers.append(ptr)
        return pointers, rank, steps


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _prepared(turns: DataFrame) -> DataFrame:
    """Turns with NULL roles and texts as one space; fault 1 blank, 3 truncated, else 0; code of the role's first letter."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    ended = F.right(F.rtrim("text", F.lit(_BLANK)), F.lit(1))
    fault = F.when(ended == "", 1).when(~ended.isin(".", "!", "?"), 3).otherwise(0)
    initial = F.left("role", F.lit(1))
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return rows.withColumns({"_fault": fault.cast("int"), "_code": code.cast("int")})


# Of a whole conversation. A block of one knows what precedes it: state, role code, turn, and turns seen in earlier blocks;
# and the costs behind it.
_WHOLE = {"_block": "int", "_entry": "int", "_end": "array<long>", "_before": "int", "_turn": "long", "_seen": "boolean"}


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups (conv_id, _block) of rows that come in order, about _PENDING rows at once."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows < _PENDING:
            continue
        all_rows = pa.concat_tables(held)
        cut = int(_starts(all_rows)[-1])
        if cut:
            yield all_rows.slice(0, cut)
        held = [all_rows.slice(cut)]
        rows = all_rows.num_rows - cut
    if rows:
        yield pa.concat_tables(held)


def _numbers(column: pa.ChunkedArray, missing: int) -> np.ndarray:
    return column.fill_null(missing).to_numpy()


def _starts(rows: pa.Table) -> np.ndarray:
    """First row of every group."""
    new = np.ones(rows.num_rows, bool)
    same = np.ones(rows.num_rows - 1, bool)
    for name in ("conv_id", "_block"):
        known, x = rows[name].is_valid().to_numpy(), _numbers(rows[name], 0)
        same &= (x[1:] == x[:-1]) & (known[1:] == known[:-1])
    new[1:] = ~same
    return np.flatnonzero(new)


def _facts(rows: pa.Table) -> dict[str, np.ndarray]:
    """Sizes of the groups and, per turn, role code, fault (2: seen earlier), whether it must go, and extra cost."""
    first = _starts(rows)
    size = np.diff(np.append(first, rows.num_rows))
    group = np.repeat(np.arange(len(size)), size)
    role, text = (rows[c].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64) for c in ("role", "text"))
    key = (group * (role.max() + 1) + role) * (text.max() + 1) + text
    seen = np.ones(len(key), bool)
    seen[np.unique(key, return_index=True)[1]] = False
    seen |= rows["_seen"].fill_null(False).to_numpy()
    fault = rows["_fault"].to_numpy().copy()
    fault[seen & (fault != 1)] = 2
    gone = (fault == 1) | (fault == 2)
    return {"first": first, "size": size, "role": rows["_code"].to_numpy(), "fault": fault, "gone": gone, "extra": np.where(fault == 3, TRUNCATED, 0)}


def _ends(rows: pa.Table, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs behind every group, and whether a group ends its conversation."""
    last = ~rows["_end"].is_valid().to_numpy()[first]
    given = rows["_end"].take(pa.array(first)).to_pylist()
    return np.array([ACCEPTED if g is None else g for g in given], np.int64).reshape(-1, 4), last


EDITS = "conv_id long, block int, seq int, turn long, edit string, fault string, illegal boolean, new_turn boolean, cost long, role string, text string"
_FAULTS = pa.array([None, "blank", "duplicate", "truncated"])


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches):
        f = _facts(rows)
        end, last = _ends(rows, f["first"])
        entry = rows["_entry"].to_numpy()[f["first"]]
        p = Paths(f["size"], f["role"], f["gone"], f["extra"], end, last, entry)
        source = pa.array(p.turn, mask=p.turn < 0)
        named = (p.letter == 1) | (p.letter == 3)
        turn, missing = _numbers(rows["turn"], 0), ~rows["turn"].is_valid().to_numpy()
        before = np.concatenate([[0], turn[:-1]])
        known = np.concatenate([[False], ~missing[:-1]])
        code = np.concatenate([[0], f["role"][:-1]])
        first = f["first"]
        before[first], known[first] = _numbers(rows["_turn"], 0)[first], rows["_turn"].is_valid().to_numpy()[first]
        code[first] = _numbers(rows["_before"], -1)[first]
        fits = ((code == 0) & (f["role"] == 1)) | ((code == 1) & (f["role"] == 2)) | ((code == 2) & (f["role"] == 1))
        illegal = (code >= 0) & ~fits
        new_turn = ~missing & (~known | (turn != before))
        cost = np.choose(p.letter, [DELETE, INSERT, 0, REROLE]) + np.where((p.letter > 1) & (f["fault"][p.turn] == 3), TRUNCATED, 0)
        role = pc.if_else(pa.array(named), pa.array(_ROLE[p.state], pa.string()), rows["role"].take(source))
        owner = pa.array(first[p.owner])
        yield pa.record_batch({
            "conv_id": _one(rows["conv_id"].take(owner)), "block": _one(rows["_block"].take(owner)),
            "seq": pa.array(np.arange(len(p.owner)) - np.repeat(np.cumsum(p.length) - p.length, p.length), pa.int32()),
            "turn": _one(rows["turn"].take(source)), "edit": pa.array(list(LETTERS)).take(pa.array(p.letter)),
            "fault": _FAULTS.take(pa.array(f["fault"])).take(source), "illegal": pa.array(illegal).take(source),
            "new_turn": pa.array(new_turn).take(source), "cost": pa.array(cost, pa.int64()), "role": _one(role),
            "text": _one(rows["text"].take(source).fill_null("")),
        })


def _one(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _sorted(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, *_order())


def repair(turns: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The cheapest edits of every conversation, of equally cheap ones those with the ASCII-least audit.

    One row per edit, in order of (block, seq): edit (K, R, D or I), the role and text after it, what was found at the turn
    (fault: blank, duplicate, truncated; illegal: its role may not follow the one before; new_turn: another number than the
    turn before has) and the cost. Turns are taken by ``turn``, NULLs first, equal ones by role and text. NULL roles and texts
    are one space. Turns without conv_id are one conversation. Repeated rows are duplicates. Other columns are ignored. An
    empty table gives no rows.
    """
    rows = _prepared(turns)
    counts = rows.groupBy("conv_id").agg(F.count("*").alias("_n")).where(F.col("_n") > max_rows)
    large = materialize(counts, "large-conversations")
    found = large.agg(F.count("*").alias("keys"), F.sum("_n").alias("rows")).first()
    if not found["keys"]:
        return _edits_of_whole(rows)
    ids = large.select(F.col("conv_id").alias("_id"))
    same = F.col("conv_id").eqNullSafe(F.col("_id"))
    ids = F.broadcast(ids) if found["keys"] <= BROADCAST_LARGE else ids
    return _edits_of_whole(rows.join(ids, same, "left_anti")).unionAll(
        _edits_of_blocks(rows.join(ids, same, "left_semi"), -(-found["rows"] // max_rows))
    )


def _edits_of_whole(rows: DataFrame) -> DataFrame:
    context = {c: F.lit(0 if c in ("_block", "_entry") else None).cast(kind).alias(c) for c, kind in _WHOLE.items()}
    return _sorted(rows.withColumns(context), "conv_id").mapInArrow(_edit, EDITS)


def _edits_of_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Edits of the conversations that are cut. Equal turns fall into one block, as blocks are cut by what they are ordered by."""
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.left("text", F.lit(64))]
    both = (F.xxhash64("role", "text"), F.xxhash64("text", "role", F.lit(1)))
    cut = rows.withColumns({"_d1": both[0], "_d2": both[1], "_at": F.struct(F.col("turn").isNotNull().alias("known"), "turn")})
    cut = materialize(cut.repartitionByRange(max(2, blocks), *by).withColumn("_block", F.spark_partition_id()), "blocks")
    lead = cut.groupBy("conv_id", "_d1", "_d2").agg(F.min("_at").alias("_lead"))
    keys = ["conv_id", "_d1", "_d2"]
    cut = join_keys(cut, lead, keys).withColumn("_seen", F.col("_at") > F.col("_lead")).drop("_d1", "_d2", "_at", "_lead")
    cut = materialize(cut, "blocks")
    key = ["conv_id", "_block"]

    summaries = materialize(_sorted(cut, *key).mapInArrow(_summaries, _SUMMARY), "block-costs")
    seams = materialize(summaries.groupBy("conv_id").applyInArrow(_seams, _SEAM), "block-seams")
    context = join_keys(cut, seams, key).withColumn("_entry", F.lit(0))
    exits = materialize(_sorted(context, *key).mapInArrow(_exits, "conv_id long, _block int, exits array<int>"), "block-exits")
    entries = materialize(exits.groupBy("conv_id").applyInArrow(_entries, "conv_id long, _block int, _entry int"), "block-entries")
    return _sorted(join_keys(context.drop("_entry"), entries, key), *key).mapInArrow(_edit, EDITS)


_SUMMARY = "conv_id long, _block int, costs array<long>, code int, last long"
_SEAM = "conv_id long, _block int, _end array<long>, _before int, _turn long"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the costs from every state before it to every state behind it, and the role code and number of its last turn."""
    for rows in _groups(batches):
        f = _facts(rows)
        place = np.cumsum(f["size"]) - f["size"] + np.arange(len(f["size"]))
        to = []
        for state in range(4):
            end = np.full((len(f["size"]), 4), _INF)
            end[:, state] = 0
            to.append(costs(f["size"], f["role"], f["gone"], f["extra"], end)[place])
        first = pa.array(f["first"])
        last = f["first"] + f["size"] - 1
        yield pa.record_batch({
            "conv_id": _one(rows["conv_id"].take(first)), "_block": _one(rows["_block"].take(first)),
            "costs": pa.array(np.stack(to, axis=2).reshape(len(place), 16).tolist(), pa.list_(pa.int64())),
            "code": pa.array(f["role"][last], pa.int32()), "last": _one(rows["turn"].take(pa.array(last))),
        })


def _seams(blocks: pa.Table) -> pa.Table:
    """Costs behind every block of one conversation, and the last turn before it."""
    blocks = blocks.sort_by("_block")
    step = np.array(blocks["costs"].to_pylist(), np.int64).reshape(-1, 4, 4)
    ends: list[list[int] | None] = [None]
    h = ACCEPTED
    for m in step[:0:-1]:
        h = np.minimum((m + h).min(axis=1), _INF)
        ends.append(h.tolist())
    code, last = blocks["code"].to_pylist(), blocks["last"].to_pylist()
    return pa.table({
        "conv_id": blocks["conv_id"], "_block": blocks["_block"], "_end": pa.array(ends[::-1], pa.list_(pa.int64())),
        "_before": pa.array([None, *code[:-1]], pa.int32()), "_turn": pa.array([None, *last[:-1]], pa.int64()),
    })


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and state before it the state the least path leaves it with."""
    for rows in _groups(batches):
        f = _facts(rows)
        end, last = _ends(rows, f["first"])
        out = [Paths(f["size"], f["role"], f["gone"], f["extra"], end, last, state).exit for state in range(4)]
        first = pa.array(f["first"])
        yield pa.record_batch({
            "conv_id": _one(rows["conv_id"].take(first)), "_block": _one(rows["_block"].take(first)),
            "exits": pa.array(np.stack(out, axis=1).tolist(), pa.list_(pa.int32())),
        })


def _entries(blocks: pa.Table) -> pa.Table:
    blocks = blocks.sort_by("_block")
    state, out = 0, []
    for exits in blocks["exits"].to_pylist():
        out.append(state)
        state = exits[state]
    return pa.table({"conv_id": blocks["conv_id"], "_block": blocks["_block"], "_entry": pa.array(out, pa.int32())})


def report(edits: DataFrame, conversations: DataFrame) -> DataFrame:
    """Counts of faults, the audit and the SHA-256 of the repaired conversation for every conv_id of ``conversations``."""
    steps = F.array_sort(F.collect_list(F.struct("block", "seq", "edit", F.concat("role", F.lit(":"), "text").alias("line"))))
    kept = F.transform(F.filter("_steps", lambda x: x["edit"] != "D"), lambda x: x["line"])
    span = F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn")
    found = edits.groupBy(F.col("conv_id").alias("_id")).agg(
        F.coalesce(span, F.lit(0)).alias("gaps"),
        *[F.count_if(F.col("fault") == n).alias(n) for n in ("blank", "duplicate", "truncated")],
        F.count_if("illegal").alias("illegal"), F.sum("cost").alias("cost"), steps.alias("_steps"),
    )
    found = found.withColumns({
        "audit": F.array_join(F.transform("_steps", lambda x: x["edit"]), ""), "repaired_sha256": F.sha2(F.array_join(kept, "\n"), 256),
    })
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    both = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit(""), 256)
    return both.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults by crc32 of their id modulo 20: 0 lost, 1 emptied, 2 without [.!?], 3 repeated, 4 of the role user."""
    space = F.lit(" ")
    at = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(at.cast("binary")) % 20).alias("_h"))
    text = F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.where("_h <> 0").withColumns({"text": text, "role": F.when(F.col("_h") == 4, "user").otherwise(F.col("role"))})
    times = F.when(F.col("_h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(times).alias("_copy")).drop("_copy")


ORACLE = r"""
WITH RECURSIVE b8 AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS crc),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id FROM conversations),
z AS (SELECT h.*, xor(list_reduce(list_transform(string_split(id, ''), lambda x: ord(x)::BIGINT),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS h FROM h, b8),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM z, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault, left(role, 1) AS r,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM n),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS m FROM f GROUP BY conv_id),
k AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) v(q, r, t)),
x AS (SELECT * FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) v(q, t, role)),
e AS (SELECT q, q AS t, 0 AS cost, '' AS audit, [] ::VARCHAR[] AS lines FROM x UNION ALL SELECT q, t, 5, 'I', [role || ':'] FROM x
    UNION ALL SELECT a.q, b.t, 10, 'II', [a.role || ':', b.role || ':'] FROM x a JOIN x b ON a.t = b.q),
s AS (SELECT conv_id, 0::BIGINT AS i, e.t AS q, {'cost': e.cost, 'audit': e.audit, 'lines': e.lines} AS best FROM c, e WHERE e.q = 0
    UNION ALL
    SELECT o.conv_id, o.i, e.t, min({'cost': o.cost + e.cost, 'audit': o.audit || e.audit, 'lines': list_concat(o.lines, e.lines)}) FROM (
        SELECT s.conv_id, f.i, s.q, best.cost + 2 AS cost, best.audit || 'D' AS audit, best.lines AS lines FROM s JOIN f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1
        UNION ALL SELECT s.conv_id, f.i, k.t, best.cost + CASE fault WHEN 3 THEN 5 ELSE 0 END, best.audit || 'K', list_append(best.lines, role || ':' || text)
            FROM s JOIN f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1 JOIN k ON k.q = s.q AND k.r = f.r WHERE fault IN (0, 3)
        UNION ALL SELECT s.conv_id, f.i, x.t, best.cost + CASE fault WHEN 3 THEN 6 ELSE 1 END, best.audit || 'R', list_append(best.lines, x.role || ':' || text)
            FROM s JOIN f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1 JOIN x ON x.q = s.q WHERE fault IN (0, 3)) o
    JOIN e ON e.q = o.q GROUP BY o.conv_id, o.i, e.t),
b AS (SELECT s.conv_id, min(best) AS best FROM s JOIN c ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.m WHERE q IN (0, 3) GROUP BY s.conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
"""


@query(ORACLE)
def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    turns = table(spark, sf, "conversations")
    return report(repair(damaged(turns)), turns)
