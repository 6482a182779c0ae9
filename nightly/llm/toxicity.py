"""Toxicity by gradient-boosted trees over dense features with isotonic calibration.

Features per text: densities of insults (plain, and after undoing obfuscation), profanity, threats and of a lexicon
learned from the labels (words of any language that sit in toxic documents far more often than in others), insults close
to a second person, second-person rate, capitals, punctuation runs and obfuscation marks. At most ``sample`` labelled
documents of the learning folds are used (a documented bound), three quarters for Spark's boosted trees and a quarter for
the isotonic curve. The lexicon is cross-fitted: each half of the rows is described with words learned from the other
half, so neither trees nor curve see words fitted to their own rows; texts to score are described with the words of all.
Scoring is row by row over whole texts, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from nightly.llm.common import bounded_ids, fold, query, table
from nightly.session import materialize

FEATURES = (
    "insults insult_density hidden_insults hidden_density profanity_density threat_density near_second_person "
    "second_person capitals shouted_words exclaim_runs punctuation obfuscated_words learned learned_density log_words"
).split()

# A short list of common English insults, profanity and threat words.
INSULTS = frozenset(
    "ass asshole bastard bitch clown coward creep cretin crook cunt degenerate dickhead dimwit disgrace disgusting "
    "douche dumb dumbass dunce fool freak garbage idiot idiots idiotic imbecile jackass jerk liar loser losers lunatic "
    "moron morons moronic pathetic pig prick psycho rat retard retarded scum scumbag shameful sicko slut stupid swine "
    "thug traitor trash troll twat ugly useless vermin vile waste weirdo whore wimp worthless".split()
)
PROFANITY = frozenset("bloody bullshit crap damn damned fuck fucked fucker fucking goddamn piss pissed shit shitty".split())
THREATS = frozenset("beat burn choke destroy die drown hang hurt kill murder punch shoot slap smash stab strangle".split())
SECOND = frozenset("you your yours yourself ur u du dich dir dein deine tu toi ton ta vous votre tú ti usted".split())

# Characters commonly written in place of letters.
_UNDO = str.maketrans("013457@$!|", "oieastasil")
_STRIP = ".,;:!?\"'()[]{}<>#$%&*-_~`|/\\"
_SPACED = re.compile(r"(?:(?<=\s)|^)((?:\w[\s.\-_*]){3,}\w)(?=\s|$|[.,!?])")
_RUN = re.compile(r"[!?]{2,}")
_SHAPE = re.compile(r"[a-zà-ÿ][*@$0-9!|]+[a-zà-ÿ]", re.I)


def _plain(word: str) -> str:
    """A word without obfuscation: look-alikes undone, marks between letters and repeated letters removed."""
    word = word.translate(_UNDO)
    word = re.sub(r"[^a-zà-ÿ]", "", word)
    return re.sub(r"(.)\1{2,}", r"\1", word)


def _hidden(word: str) -> bool:
    if word in INSULTS:
        return False
    plain = _plain(word)
    if plain in INSULTS:
        return True
    # one starred-out run: the letters around it must fit one insult of the same length
    if "*" in word and len(word) > 3 and word[0].isalpha():
        shape = re.compile(re.sub(r"(?:\\\*)", ".", re.escape(word)))
        return any(len(x) == len(word) and shape.fullmatch(x) for x in INSULTS)
    return False


def bare_words(text: str | None) -> list[str]:
    """Distinct lower-case words without the punctuation around them."""
    return sorted({w.strip(_STRIP) for w in (text or "").lower().split()} - {""})


def features(texts, lexicon: frozenset[str] = frozenset()) -> np.ndarray:
    """One row per text; NULL, empty and blank texts are all zero."""
    out = np.zeros((len(texts), len(FEATURES)))
    known: dict[str, int] = {}  # word -> bits: 1 insult, 2 hidden insult, 4 profanity, 8 threat, 16 second person, 32 marked, 64 learned
    for row, text in zip(out, texts):
        if not text or text.isspace():
            continue
        words = text.lower().split()
        bits = []
        for w in words:
            b = known.get(w)
            if b is None:
                bare = w.strip(_STRIP)
                marked = bool(_SHAPE.search(w))
                b = (bare in INSULTS) + 4 * (bare in PROFANITY) + 8 * (bare in THREATS) + 16 * (bare in SECOND) + 32 * marked + 64 * (bare in lexicon)
                if not b & 1 and (marked or not bare.isalpha()) and _hidden(bare):
                    b |= 2
                if len(known) < 200_000:  # a memo of words already classified
                    known[w] = b
            bits.append(b)
        bits = np.array(bits)
        spaced = sum(re.sub(r"[^a-zà-ÿ]", "", m.group(1).lower()) in INSULTS for m in _SPACED.finditer(text))
        plain, hidden = (bits & 1).astype(bool), (bits & 2).astype(bool)
        count, insults, masked = len(words), int(plain.sum()), int(hidden.sum()) + spaced
        second = np.flatnonzero(bits & 16)
        bad = np.flatnonzero(plain | hidden)
        near = 0
        if len(second) and len(bad):
            at = np.searchsorted(second, bad)
            left = np.abs(bad - second[np.clip(at - 1, 0, len(second) - 1)])
            right = np.abs(second[np.clip(at, 0, len(second) - 1)] - bad)
            near = int((np.minimum(left, right) <= 4).sum())
        raw = text.encode("utf-8", "replace")
        hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        upper, letters = hist[65:91].sum(), max(1, hist[65:91].sum() + hist[97:123].sum() + hist[192:].sum())
        shouted = sum(w.isupper() and len(w) > 2 for w in text.split())
        row[:] = (
            np.log1p(insults), insults / count, np.log1p(masked), masked / count, (bits & 4).astype(bool).mean(),
            (bits & 8).astype(bool).mean(), near / count, len(second) / count, upper / letters, shouted / count,
            sum(1 for _ in _RUN.finditer(text)) / count, (hist[33:48].sum() + hist[58:65].sum()) / len(raw),
            (bits & 32).astype(bool).mean(), np.log1p((bits & 64).astype(bool).sum()), (bits & 64).astype(bool).mean(),
            np.log1p(count),
        )
    return out


def _features(lexicon: frozenset[str]):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(list(features(texts, lexicon)))

    return of


@F.pandas_udf(T.ArrayType(T.StringType()))
def _bare_words(texts: pd.Series) -> pd.Series:
    return texts.map(bare_words)


@dataclass
class Model:
    """Learned words, trees and calibration; ``share`` is the score where only one class (or nothing) was labelled."""

    lexicon: frozenset[str]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    share: float


def learn_lexicon(rows: DataFrame, words: int = 5_000, purity: float = 0.87) -> frozenset[str]:
    """At most ``words`` words nearly all of whose texts are toxic.

    ``rows`` has ``text`` and ``_toxic``. A word is taken if its smoothed share of toxic texts reaches ``purity`` and it
    is in at least 3 toxic texts and in more than one of 150; equal texts count once, so copies do not make a word sure.
    """
    rows = rows.groupBy("text").agg(F.max("_toxic").alias("_toxic"))
    toxic = rows.agg(F.coalesce(F.sum("_toxic"), F.lit(0.0))).first()[0]
    seen = rows.select("_toxic", F.explode(_bare_words("text")).alias("word")).groupBy("word").agg(
        F.sum("_toxic").alias("a"), F.count("*").alias("n")
    )
    share = (F.col("a") + 0.5) / (F.col("n") + 1.0)
    found = seen.where((F.col("a") >= max(3.0, toxic / 150)) & (share >= purity))
    return frozenset(r["word"] for r in found.orderBy(F.desc("a"), "word").limit(words).collect())


def fit(docs: DataFrame, labels: DataFrame, sample: int = 40_000, trees: int = 20, depth: int = 4, seed: int = 5) -> Model:
    """Lexicon, trees and calibration from ``labels.toxic`` of rows outside the held-out fold."""
    learn = F.coalesce(fold(F.col("doc_id"), 5) != 0, F.lit(False)) & F.col("toxic").isNotNull()
    chosen = bounded_ids(labels.where(learn), sample, seed)
    marks = labels.where(learn).groupBy("doc_id").agg(F.max("toxic").cast("double").alias("_toxic"))
    ids = F.broadcast(marks.join(F.broadcast(chosen), "doc_id"))  # at most `sample` rows
    rows = docs.select("doc_id", "text").join(ids, "doc_id")
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(8)))
    rows = materialize(rows, "toxicity-sample")
    share = {r["_toxic"]: r["n"] for r in rows.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    rate = share.get(1.0, 0) / max(1, sum(share.values()))
    if len(share) < 2 or min(share.values()) < 10:
        return Model(frozenset(), None, None, rate)
    halves = [rows.where(F.col("_part") % 2 == h) for h in (0, 1)]
    words = [learn_lexicon(half) for half in halves]
    described = [half.select("_toxic", "_part", _features(w)("text").alias("_x")) for half, w in zip(halves, words[::-1])]
    dense = materialize(described[0].unionAll(described[1]), "toxicity-features")
    dense = dense.select("_toxic", "_part", array_to_vector("_x").alias("_features"))
    gbt = GBTClassifier(
        featuresCol="_features", labelCol="_toxic", maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=32,
        subsamplingRate=0.8, minInstancesPerNode=5, seed=seed,
    )
    model = gbt.fit(dense.where("_part < 6").coalesce(4))
    held = model.transform(dense.where("_part >= 6")).select("_toxic", vector_to_array("probability")[1].alias("_s"))
    curve = IsotonicRegression(featuresCol="_s", labelCol="_toxic", predictionCol="_c").fit(held)
    return Model(learn_lexicon(rows), model, curve, rate)


def score(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """``docs`` with a calibrated probability for every row; NULL and empty texts score as texts without words.

    The isotonic curve is a step function; a hundredth of the tree score is blended in, so that texts on one step keep
    the trees' order. Rows stay one for one; other columns are not looked at and one named like the score is replaced.
    """
    if model.trees is None:
        return docs.withColumn(column, F.lit(model.share))
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c != column]
    dense = array_to_vector(_features(model.lexicon)("text"))
    out = docs.select(F.struct(*docs.columns).alias("_row"), dense.alias("_features"))
    out = model.curve.transform(model.trees.transform(out).withColumn("_s", vector_to_array("probability")[1]))
    return out.select(*kept, (0.99 * F.col("_c") + 0.01 * F.col("_s")).alias(column))


@query()
def op8_toxicity_gbt(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = score(docs.select("doc_id", "text"), fit(docs, labels), "score")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
