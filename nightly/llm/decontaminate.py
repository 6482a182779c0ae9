"""Benchmark decontamination by template canonicalisation, as Spark SQL expressions.

Numbers, names and units become typed slots, the other words are lower-cased without punctuation. Windows of WIDTH template
tokens are hashed, once by slot types and once by slot values, so that windows with few words are still found verbatim
(item windows with fewer than LITERALS words by values only); the distinct windows of each document meet those of the benchmark items in a hash join. A document is
a candidate for an item if a share of the item's windows, or as many as a run of RUN tokens has, occur in it. For candidates
the two texts are laid over each other at every distance at which windows agree; windows up to SLACK tokens off belong to the
same place, each at its own distance. A place with enough windows, or a run of them, is a leak if its names turn into the
document's by a one-to-one substitution. Numbers and units need only stand where the item has some. Only slots inside
agreeing windows are compared. Equal values mean a verbatim copy, changed ones a re-parameterised question; names that follow
no substitution mean a text of the same form about something else, which stays unless another place of the document passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from nightly.llm.common import query, table
from nightly.session import materialize

WIDTH = 6  # tokens per window
LITERALS = 2  # least tokens of an item's window that are no slots
COVERAGE = 0.5  # least share of an item's windows
RUN = 24  # or so many tokens of an item in a row, however long the item is
SLACK = 16  # most tokens inserted or left out between windows of one place
BROADCAST_WINDOWS = 1_000_000  # more windows than these are joined by a shuffle

# Words read as numbers, and units that may follow a number.
NUMBER_WORDS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).replace(" ", "|")
UNITS = (
    "mm|cm|m|km|inch|inches|feet|foot|ft|yards?|miles?|mg|g|kg|grams?|kilograms?|pounds?|lbs?|oz|ml|l|lit(?:er|re)s?|gallons?|"
    "s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|mph|kph|km/h|percent|%|dollars?|euros?|cents?|usd|eur|"
    "volts?|watts?|amps?|hz|joules?|newtons?|degrees?"
)
# Words that begin sentences and are no names.
OPENERS = (
    "the|a|an|and|or|but|if|then|when|while|where|who|whose|why|how|what|which|there|here|this|that|these|those|it|its|he|she|they|we|"
    "you|i|his|her|their|our|your|my|in|on|at|by|for|from|of|to|with|after|before|during|each|every|all|both|some|no|not|is|are|was|were|"
    "do|does|did|has|have|had|can|could|should|would|find|let|suppose|assume|given|because|since|so|as|"
    f"{NUMBER_WORDS}"
)
_SLOT = "\\u0001"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def patterns() -> tuple[tuple[str, str], ...]:
    """Patterns and what replaces them, in this order.

    Each first looks at one character, which rules out most places before what is slower to look at.
    """
    begins = "".join(sorted({w[0] for w in NUMBER_WORDS.split("|")}))
    return (
        # a capitalised word inside a sentence or, in small letters but for the first, anywhere; then amounts of money, numbers, units behind them
        (rf"(?![a-z ])(?=\p{{Lu}})(?<![\p{{L}}\d\x01])(?!(?i:{OPENERS})(?!\p{{L}}))(?:(?<=[\p{{Ll}},;] )(\p{{Lu}}\p{{L}}+)|(\p{{Lu}}\p{{Ll}}\p{{L}}*))", f"{_SLOT}p$1$2"),
        (r"([$€£])(?=\d)", f" {_SLOT}u$1 "),
        (r"(?=\d)(?<![\p{L}\d])(\d+(?:[.,:/]\d+)*)", f" {_SLOT}n$1 "),
        (rf"(?=[{begins}{begins.upper()}])(?<![\p{{L}}\d\x01])(?i:({NUMBER_WORDS}))(?![\p{{L}}\d])", f"{_SLOT}n$1"),
        (rf"(\x01n[^\s]+ *)(?i:({UNITS}))(?![\p{{L}}\d])", f"$1 {_SLOT}u$2 "),
        (r"(?![a-z ])[^\p{L}\p{N}\x01\s$€£%]+(?!\d)", " "),
    )


def tokens(text: str) -> Column:
    """Words of a text; a slot is a mark, its type (n, u, p) and its value. NULL has none."""
    out = f"coalesce({text}, '')"
    for pattern, by in patterns():
        out = f"regexp_replace({out}, {_quoted(pattern)}, '{by}')"
    return F.expr(f"filter(split(lower({out}), '[\\\\s]+'), x -> length(x) > 0)")


def template_hashes(toks: str) -> Column:
    """Hash of the template form of every token: slots by type, words by themselves."""
    return F.expr(f"transform({toks}, x -> xxhash64(if(startswith(x, '{_SLOT}'), substring(x, 1, 2), x)))")


def value_hashes(toks: str) -> Column:
    """Hash of every token, slots by their value."""
    return F.expr(f"transform({toks}, x -> xxhash64(if(startswith(x, '{_SLOT}'), substring(x, 3), x)))")


def window_hashes(hashes: str) -> Column:
    """Hash of every window; of all tokens if there are fewer than a window has."""
    parts = ", ".join(f"get({hashes}, i + {j})" for j in range(WIDTH))
    return F.expr(f"if(size({hashes}) = 0, array(), transform(sequence(0, greatest(size({hashes}) - {WIDTH}, 0)), i -> xxhash64({parts})))")


def _windows(df: DataFrame, *keys: str) -> DataFrame:
    """``keys``, tokens and hashes of all windows, by template and by values; the two are equal where a window has no slot.

    Each step is a projection the next refers to more than once, so it stays.
    """
    out = df.select(*keys, tokens("text").alias("toks")).withColumn("_h", template_hashes("toks")).withColumn("_v", value_hashes("toks"))
    return out.withColumn("windows", window_hashes("_h")).withColumn("values", window_hashes("_v")).drop("_h", "_v")


def item_texts(benchmark: DataFrame) -> DataFrame:
    """item_id, a key of item and text, tokens and windows of every distinct text of every item."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("item_id is not null").distinct()
    return _windows(items.withColumn("item_key", F.xxhash64("item_id", "text")), "item_id", "item_key")


def item_windows(texts: DataFrame) -> DataFrame:
    """item_id, item_key, position and hashes of every window, and the number of positions per item.

    Every window has the hash of its values, one with enough words also that of its template.
    """
    words = f"size(filter(slice(toks, i + 1, {WIDTH}), x -> not startswith(x, '{_SLOT}')))"
    both = f"if({words} >= if(size(toks) < {WIDTH}, 1, {LITERALS}), array_distinct(array(windows[i], values[i])), array(values[i]))"
    at = texts.where(F.size("windows") > 0).select("item_id", "item_key", F.size("windows").cast("long").alias("item_windows"), F.posexplode(F.expr(f"transform(sequence(0, size(windows) - 1), i -> {both})")).alias("item_pos", "_both"))
    return at.select("item_id", "item_key", "item_windows", "item_pos", F.explode("_both").alias("window"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, tag, item_id, matched, item_windows, slots, changed, kind for every leaked item of every document.

    ``tag`` is a hash of the text, which tells rows of one doc_id apart; repeated rows give one result. NULL and empty texts
    and items match nothing; items shorter than a window match only documents of the same template; rows without doc_id and
    items without item_id are not looked at. Other columns are ignored. Empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.hash("text").alias("tag")).where(F.col("doc_id").isNotNull())
    texts_of_items = materialize(item_texts(benchmark), "leak-item-texts")
    items = materialize(item_windows(texts_of_items), "leak-items")
    small = items.count() <= BROADCAST_WINDOWS
    every = _windows(docs, "doc_id", "tag").select("doc_id", "tag", F.explode(F.expr("array_distinct(concat(windows, values))")).alias("window"))
    met = every.join(F.broadcast(items) if small else items, "window")
    met = met.groupBy("doc_id", "tag", "item_key", "item_id", "item_windows").agg(F.countDistinct("item_pos").alias("matched"))
    found = materialize(met.where((F.col("matched") >= coverage * F.col("item_windows")) | (F.col("matched") > RUN - WIDTH)), "leak-candidates")

    texts = docs.join(found.select("doc_id", "tag").distinct(), ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"])
    texts = materialize(_windows(texts, "doc_id", "tag"), "leak-texts")
    places = texts.select("doc_id", "tag", F.size("windows").alias("_m"), F.posexplode(F.expr("concat(windows, values)")).alias("pos", "window"))
    places = places.withColumn("pos", F.col("pos") % F.col("_m"))
    laid = places.join(F.broadcast(items) if small else items, "window").join(found, ["doc_id", "tag", "item_key", "item_id", "item_windows"])
    pair = ["doc_id", "tag", "item_key"]
    laid = laid.groupBy(*pair, "item_id", "item_windows", "matched", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(F.collect_set("item_pos").alias("at"))
    near = Window.partitionBy(*pair).orderBy("shift").rangeBetween(-SLACK, SLACK)
    least = F.least(F.ceil(coverage * F.col("item_windows")), F.lit(RUN - WIDTH + 1))
    laid = laid.withColumn("_n", F.sum(F.size("at")).over(near)).withColumn("_near", F.collect_list(F.struct("shift", "at")).over(near)).where(F.col("_n") >= least)
    laid = laid.withColumn("_at", F.expr("array_sort(array_distinct(flatten(_near.at)))"))
    run = F.expr(f"exists(_at, p -> array_contains(_at, p + {RUN - WIDTH}) and size(filter(_at, q -> q between p and p + {RUN - WIDTH})) = {RUN - WIDTH + 1})")
    laid = laid.where((F.size("_at") >= coverage * F.col("item_windows")) | run)
    nearest = "array_min(transform(filter(_near, x -> array_contains(x.at, p)), x -> struct(abs(x.shift - shift) as far, x.shift as shift))).shift"
    laid = laid.select(*pair, "item_id", "item_windows", "matched", "shift", F.expr(f"transform(_at, p -> struct(p as pos, {nearest} as shift))").alias("_hits"))

    both = laid.join(texts.select("doc_id", "tag", "toks"), ["doc_id", "tag"]).join(texts_of_items.select("item_key", F.col("toks").alias("item")), "item_key")
    value = f"if(startswith({{0}}, '{_SLOT}'), substring({{0}}, 3), {{0}})"
    inside = f"flatten(transform(_hits, h -> transform(sequence(0, {WIDTH - 1}), j -> struct(h.pos + j as i, get(item, h.pos + j) as a, get(toks, h.pos + h.shift + j) as b))))"
    slots = f"filter(array_distinct({inside}), s -> startswith(s.a, '{_SLOT}'))"
    both = both.withColumn("_slots", F.expr(f"transform({slots}, s -> struct(s.i as i, substring(s.a, 2, 1) as kind, {value.format('s.a')} as a, {value.format('s.b')} as b))"))
    both = both.withColumn("_names", F.expr("array_distinct(transform(filter(_slots, s -> s.kind = 'p'), s -> struct(s.a as a, s.b as b)))"))
    one_to_one = F.expr("size(_names) = size(array_distinct(_names.a)) and size(_names) = size(array_distinct(_names.b))")
    both = both.where(one_to_one).withColumn("slots", F.size("_slots")).withColumn("changed", F.expr("size(filter(_slots, s -> s.a <> s.b))"))
    # of the places of a pair: verbatim, then the most windows, then the first
    rank = F.struct((F.col("changed") > 0).alias("_c"), (-F.size("_hits")).alias("_h"), F.col("shift").alias("_s"))
    both = both.groupBy("doc_id", "tag", "item_id").agg(F.min(F.struct(rank.alias("_rank"), "matched", "item_windows", "slots", "changed")).alias("_best"))
    both = both.select("doc_id", "tag", "item_id", "_best.matched", "_best.item_windows", "_best.slots", "_best.changed")
    return both.withColumn("kind", F.when(F.col("changed") == 0, "verbatim").otherwise("reparameterised"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that leak an item; rows without doc_id stay."""
    leaks = find_leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).distinct()
    leaks = materialize(leaks, "leaks")
    return docs.join(leaks, (docs["doc_id"] == F.col("_id")) & (F.hash(docs["text"]) == F.col("_tag")), "left_anti")


@query()
def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("tag")
