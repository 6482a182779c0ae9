"""Document fingerprints by winnowing, as Spark SQL expressions.

Words are hashed, a rolling window of K words gives the gram hashes, and of every W consecutive grams the smallest is
kept, the rightmost of ties. Hash and position share one long (hash above, falling position below), so the smallest long is
the right one and its position stays at hand. Any run of W + K - 1 words two texts share leaves a fingerprint in both.
``winnow_chars`` does the same over grams of characters, which the query uses: short texts and texts without blanks have grams.

A lambda over a one-element array binds an intermediate array; without it the optimiser would put its expression into
the inner lambda and evaluate it once per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from nightly.llm.common import query, table
from nightly.session import materialize

K, W = 5, 8  # guarantee: 12 words


CHARS = 8  # characters of a gram


def _bind(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def winnow(text: str = "text", k: int = K, w: int = W) -> Column:
    """Fingerprints of a text as sorted-by-position longs: 31 bits of hash, 32 bits of negated word position.

    A text with fewer than ``k`` words has one gram of all its words; one with fewer than ``w`` grams keeps their smallest.
    NULL, empty and blank texts have an empty array.
    """
    words = f"filter(split(coalesce({text}, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), x -> length(x) > 0)"
    hashes = f"transform({words}, x -> xxhash64(x))"
    gram = ", ".join(["h[i]", *(f"get(h, i + {j})" for j in range(1, k))])
    grams = _bind("h", hashes, f"if(size(h) = 0, array(), transform(sequence(0, greatest(size(h) - {k}, 0)), i -> shiftleft(xxhash64({gram}) & 2147483647, 32) - i))")
    low, width = grams, 1
    while width < w:  # smallest of 2, 4, ... grams; fewer than that have one smallest
        step = min(width, w - width)
        pair = f"transform(sequence(0, size(g) - {step + 1}), i -> least(g[i], g[i + {step}]))"
        low = _bind("g", low, f"if(size(g) = 0, g, if(size(g) <= {step}, array(array_min(g)), {pair}))")
        width += step
    return F.expr(f"coalesce(array_distinct({low}), array())")


def plain(text: str) -> str:
    """The text as it is cut into grams: blanks collapsed to one, none at the ends."""
    # single blanks are no matches, so that little is replaced
    return f"trim(regexp_replace(coalesce({text}, ''), '[\\\\x09-\\\\x0D][\\\\x20\\\\x09-\\\\x0D]*|\\\\x20[\\\\x20\\\\x09-\\\\x0D]+', ' '))"


# Window by the number of grams: from so many on, the smallest of every so many.
LEVELS = ((0, 1), (32, 4), (128, 16), (512, 64))
WIDEST = LEVELS[-1][1]


BLOCK = 8  # blocks of so many grams, in which the smallest of the widest window are looked for


def smallest_of_widest(g: str) -> str:
    """Smallest of every WIDEST elements of an array of distinct longs that has as many at least, in order.

    The windows that begin in one block share the whole blocks after it and, but for the last block of a text, so does the first
    window of the next block. Where the smallest ``c`` of those is smaller than both ends, it is that of all these windows. Where
    one end has smaller ones, those count that no window reaches without a still smaller one of that end. Else each window looks
    at what it has of both ends.
    """
    def some(array: str, first: str, n: int) -> str:  # so few are read faster one by one than cut out as an array
        return ", ".join([f"get({array}, {first})", *(f"get({array}, {first} + {j})" for j in range(1, n))])

    def below(first: str, among: str) -> str:
        found = f"filter(array({some('g', first, BLOCK)}), x -> x < c)"
        return _bind("s", found, f"if(size(s) = 1, s, filter(s, (x, i) -> x = array_min({among})))")

    shared = WIDEST // BLOCK - 1
    first, last = f"{BLOCK} * k", f"{BLOCK} * k + {WIDEST}"
    ends = f"array({some('g', first, BLOCK)}, c, {some('g', last, BLOCK - 1)})"
    each = _bind("e", ends, f"transform(sequence(0, least({BLOCK - 1}, size(g) - {WIDEST} - {BLOCK} * k)), r -> least({some('e', 'r', BLOCK + 1)}))")
    one_end = f"if(c < get(m, k + {shared + 1}), concat({below(first, f'slice(s, i + 1, {BLOCK})')}, array(c)), concat(array(c), {below(last, 'slice(s, 1, i + 1)')}))"
    beside = f"if(c > least(get(m, k), get(m, k + {shared + 1})), if(size(g) < {last} + {BLOCK} or c > greatest(get(m, k), get(m, k + {shared + 1})), {each}, {one_end}), array(c))"
    block = _bind("c", f"least({some('m', 'k + 1', shared)})", beside)
    found = f"flatten(transform(sequence(0, cast((size(g) - {WIDEST}) / {BLOCK} as int)), k -> {block}))"
    return _bind("g", g, _bind("m", f"transform(sequence(0, size(g) - 1, {BLOCK}), i -> least({some('g', 'i', BLOCK)}))", found))


def _winnowed(collapsed: str, k: int, level: bool) -> str:
    """Fingerprints of a collapsed text, with the window its own length gives or, of long parts of texts, the widest."""
    # four bytes a character, so that a gram is cut out without counting from the start
    gram = f"shiftleft(xxhash64(substring(b, at, {4 * k})) & 2147483647, 32) - i"
    every = f"if(length(b) = 0, array(), transform(sequence(1, greatest(length(b) - {4 * k - 1}, 1), 4), (at, i) -> {gram}))"
    low = "g"
    for (least, _), (_, step) in zip(LEVELS[1:-1], LEVELS):
        four = f"transform(sequence(0, size(g) - {3 * step + 1}), i -> least(g[i], g[i + {step}], g[i + {2 * step}], g[i + {3 * step}]))"
        low = _bind("g", low, f"if(n < {least}, g, {four})")
    widest = smallest_of_widest("g")
    chosen = f"if(size(g) < {LEVELS[-1][0]}, {_bind('n', 'size(g)', low)}, {widest})" if level else widest
    found = _bind("b", f"encode({collapsed}, 'utf-32')", _bind("g", every, chosen))
    return f"coalesce(array_distinct({found}), array())"


def grams(collapsed: str, k: int = CHARS) -> str:
    return f"(length({collapsed}) - {k - 1})"


def winnow_chars(text: str = "text", k: int = CHARS) -> Column:
    """Fingerprints as above over grams of ``k`` characters; positions count characters with blanks collapsed to one.

    The smallest of every 64 grams is kept, of texts with fewer than 512 grams of every 16, under 128 of every 4, under 32 all:
    a function of the text alone. A run of w + k - 1 characters two texts share, w the wider of their windows, leaves a
    fingerprint in both; `coarsened` takes the narrower one's to the wider window. A text shorter than a gram is one gram;
    NULL, empty and blank texts have an empty array.
    """
    return counted_prints(text, k)["prints"]


def counted_prints(text: str = "text", k: int = CHARS) -> Column:
    """Struct (prints, grams): `winnow_chars` of a text and its number of grams; blanks are collapsed once for both."""
    return F.expr(_bind("t", plain(text), f"named_struct('prints', {_winnowed('t', k, True)}, 'grams', {grams('t', k)})"))


def _edited_prints(text: str, edited: str, kept: str, own: str, count: str, k: int = CHARS) -> Column:
    """Struct (prints, grams): `winnow_chars` of ``edited`` and its number of grams.

    The first ``kept`` characters of it are those of ``text``, whose fingerprints are ``own`` and grams ``count``. Windows that lie in the common
    start keep what they have; only the grams from the last such window on are hashed.
    """
    def found(p: str, e: str) -> str:
        # of a fingerprint the first window it is taken from: behind a smaller one before it, or as soon as it is reached
        first = f"if(i = 0, 0, if({own}[i - 1] < x, {_at(f'{own}[i - 1]')} + 1, {_at('x')} - {WIDEST - 1}))"
        inside = f"filter({own}, (x, i) -> {first} <= {p} - {WIDEST})"
        tail = _winnowed(f"substring({e}, {p} - {WIDEST - 2})", k, False)
        rest = f"if({grams(e, k)} - {p} < 1, array(), transform({tail}, x -> x - ({p} - {WIDEST - 1})))"
        return f"array_distinct(concat({inside}, {rest}))"

    least = LEVELS[-1][0]
    same = f"o >= {least} and {grams('e', k)} >= {least} and p >= {WIDEST}"
    start = f"substring({text}, 1, {kept})"
    prints = _bind("o", count, _bind("p", grams(plain(start), k), f"if({same}, {found('p', 'e')}, {_winnowed('e', k, True)})"))
    return F.expr(_bind("e", plain(edited), f"named_struct('prints', {prints}, 'grams', {grams('e', k)})"))


def winnow_edited(text: str, edited: str, kept: str, own: str, k: int = CHARS) -> Column:
    """`winnow_chars` of a text whose start is that of another one with known fingerprints."""
    return _edited_prints(text, edited, kept, own, grams(plain(text), k), k)["prints"]


def window(count: str) -> str:
    """Window of a text with so many grams."""
    cases = "".join(f" when {count} >= {least} then {width}" for least, width in LEVELS[:0:-1])
    return f"(case{cases} else {LEVELS[0][1]} end)"


def coarsened(prints: str, count: str, width: str) -> str:
    """Fingerprints of a text of ``count`` grams with a wider window than its own.

    One stays if so many grams in a row have none smaller: its distance to the next smaller ones on both sides, or to the ends
    of the text, tells. Of a text with fewer grams the smallest stays.
    """
    def nearest(part: str, pick: str, none: str) -> str:
        return f"coalesce({pick}(transform(filter({part}, y -> y < x), y -> {_at('y')})), {none})"

    left = nearest(f"slice({prints}, 1, i)", "array_max", "-1")
    right = nearest(f"slice({prints}, i + 1, size({prints}))", "array_min", count)
    return f"if({count} < {width}, filter({prints}, x -> x = array_min({prints})), filter({prints}, (x, i) -> {right} - {left} - 1 >= {width}))"


# Hash and position of a fingerprint x.
_HASH = "shiftright(x + 4294967295, 32)"


def _at(x: str) -> str:
    """Position in a fingerprint."""
    return f"cast(shiftleft(shiftright({x} + 4294967295, 32), 32) - {x} as int)"


_AT = _at("x")


def positions(prints: str) -> Column:
    """(hash, position of the first word or character) of every fingerprint, in order of the text."""
    return F.expr(f"transform({prints}, x -> struct(cast({_HASH} as int) as hash, cast({_AT} as int) as position))")


def hashes(prints: str) -> Column:
    """Distinct hashes of a fingerprint."""
    return F.expr(f"array_distinct(transform({prints}, x -> cast({_HASH} as int)))")


def _text_sql(prints: str) -> str:
    return f"array_join(transform({prints}, x -> concat(hex({_HASH}), '@', {_AT})), ' ')"


def as_text(prints: str) -> Column:
    """``hash@position`` of every fingerprint, by one blank; two equal texts give equal strings."""
    return F.expr(_text_sql(prints))


def likeness(a: str, b: str) -> Column:
    """Share of common hashes among all of two hash arrays; 1 if both are empty, 0 if one is."""
    common, both = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(common / (both - common)).cast("double")


def at_wider_window(a: str, b: str) -> str:
    """Distinct hashes a and b of two structs (prints, grams) at the wider of their windows, so that no length is a step.

    Both are names of bound values, as they stand here several times.
    """
    wide = f"greatest({window(f'{a}.grams')}, {window(f'{b}.grams')})"

    def taken(x: str) -> str:
        held = f"if({window(f'{x}.grams')} < w, {coarsened(f'{x}.prints', f'{x}.grams', 'w')}, {x}.prints)"
        return f"array_distinct(transform({held}, x -> cast({_HASH} as int)))"

    return _bind("w", wide, f"named_struct('a', {taken(a)}, 'b', {taken(b)})")


def _likeness_sql(a: str, b: str) -> str:
    both = _bind("v", f"named_struct('both', size(h.a) + size(h.b), 'common', size(array_intersect(h.a, h.b)))",
                 "if(v.both = 0, 1.0D, v.common / cast(v.both - v.common as double))")
    return _bind("h", at_wider_window(a, b), both)


def likeness_of(a: str, b: str) -> Column:
    """Likeness of two columns of structs (prints, grams)."""
    return F.expr(_bind("p", a, _bind("q", b, _likeness_sql("p", "q"))))


def readers(docs: DataFrame) -> DataFrame:
    """doc_id, reader, third: the document whose next one this is, and the third of that one's characters.

    Next is the following id in descending order; after the last comes the first. Ids are dealt to ranges and written with
    their range, as range numbers must not change when a task is run again; each row looks one row ahead within its range
    and the last row of a range takes the first of the following range, from one row per range.
    """
    ids = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.floor(F.max(F.coalesce(F.length("text"), F.lit(0))) / 3).cast("int").alias("third"))
    ranged = ids.repartitionByRange("doc_id").select("doc_id", "third", F.spark_partition_id().alias("part"))
    ranged = materialize(ranged, "fingerprint-ids")
    one = F.struct("doc_id", "third")
    ahead = F.lead(one).over(Window.partitionBy("part").orderBy("doc_id"))
    ends = ranged.groupBy("part").agg(F.min(one).alias("_first"))
    order = Window.orderBy("part")  # one row per range, at most as many as shuffle partitions
    start = F.first("_first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("part", F.coalesce(F.lead("_first").over(order), start).alias("_after"))
    found = ranged.withColumn("_ahead", ahead).join(F.broadcast(ends), "part")
    found = found.select("doc_id", F.coalesce("_ahead", "_after").alias("r"))
    return materialize(found.select("doc_id", F.col("r.doc_id").alias("reader"), F.col("r.third").alias("third")), "fingerprint-pairs")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last floor(n / 3) characters replaced by as many (or all) of the next document's first. NULL is
    an empty text. Repeated doc_ids each get a row; as a next document the smallest of their starts and fingerprints count.
    Rows without doc_id have no place in the order and are left out. Other columns are ignored.

    Texts are fingerprinted inside the scan and shuffled once, by doc_id; both uses below share that exchange. Only a third
    of each text and its hashes travel to the reader.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = docs.where(F.col("doc_id").isNotNull()).withColumn("_own", counted_prints("text"))
    heads = base.join(readers(docs).hint("merge"), "doc_id").select(
        F.col("reader").alias("doc_id"), F.expr("substring(text, 1, third)").alias("_head"), F.col("_own").alias("_next")
    )
    heads = heads.groupBy("doc_id").agg(F.min(F.struct("_head", "_next")).alias("_n"))
    both = base.hint("merge").join(heads, "doc_id")
    kept = "(length(text) - cast(floor(length(text) / 3) as int))"
    edited = F.expr(f"concat(substring(text, 1, {kept}), substring(_n._head, 1, cast(floor(length(text) / 3) as int)))")
    both = both.select("doc_id", "text", edited.alias("edited"), "_own", F.col("_n._next").alias("_next"))
    both = both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        F.col("_own").alias("_a"), _edited_prints("text", "edited", kept, "_own.prints", "_own.grams").alias("_b"), "_next",
    )
    # One bound expression: as columns the fingerprints would be worked out anew wherever they stand.
    parts = f"named_struct('f', {_text_sql('a.prints')}, 'e', {_text_sql('b.prints')}, 'ab', {_likeness_sql('a', 'b')}, 'an', {_likeness_sql('a', 'c')})"
    done = both.withColumn("_r", F.expr(_bind("a", "_a", _bind("b", "_b", _bind("c", "_next", parts)))))
    return done.select(
        "doc_id", "n_chars", "edited_sha256", F.col("_r.f").alias("fingerprint"), F.col("_r.e").alias("edited_fingerprint"),
        F.col("_r.ab").alias("near_edited"), F.col("_r.an").alias("near_next"),
    )


@query()
def op5_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    return compare_edits(table(spark, sf, "documents"))
