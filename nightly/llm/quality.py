"""Quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text are all the learner sees; labels 0 are never used. The class prior
is estimated from the two samples (best-bin estimator), then a small network minimises the non-negative unbiased risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]),    l(z) = log(1 + exp(-z)),

whose minimiser is the log-odds of quality, so the sigmoid of the network is the score. Fitting takes at most
``sample`` positives and ``sample`` unlabelled documents (a documented bound); scoring covers every whole text inside
the scan, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from nightly.llm.common import bounded_ids, clear_worker, fold, query, table

FEATURES = (
    "log_bytes log_words word_bytes upper digits spaces lines pipes symbols exclaims stops other_punct non_ascii "
    "distinct_words repeated_next title_words distinct_lines words_with_symbol no_text"
).split()

_SYMBOLS = np.frombuffer(b"#$%&*@^~=+<>\\_", np.uint8)
_PUNCT = np.frombuffer(b"\"'()[]{}:;/-?`", np.uint8)
_MARKED = tuple(b"#$%&*|!")


def features(texts) -> np.ndarray:
    """One row of dense features per text; a NULL or empty text has only ``no_text`` set."""
    out = np.zeros((len(texts), len(FEATURES)))
    for row, text in zip(out, texts):
        raw = text.encode("utf-8", "replace") if text else b""
        words = raw.split()
        if not words:
            row[-1] = 1.0
            continue
        hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        n, upper, lower, accents = len(raw), hist[65:91].sum(), hist[97:123].sum(), hist[192:].sum()
        letters = max(1, upper + lower + accents)
        count, lines = len(words), raw.split(b"\n")
        row[:] = (
            np.log1p(n), np.log1p(count), min(n / count, 60.0) / 10, upper / letters, hist[48:58].sum() / n,
            (hist[32] + hist[9]) / n, hist[10] / count, hist[124] / count, hist[_SYMBOLS].sum() / count,
            hist[33] / count, (hist[46] + hist[44]) / count, hist[_PUNCT].sum() / count, accents / letters,
            len(set(words)) / count, sum(map(bytes.__eq__, words, words[1:])) / count,
            sum(65 <= w[0] <= 90 for w in words) / count, len(set(lines)) / len(lines),
            sum(w[-1] in _MARKED for w in words) / count, 0.0,
        )
    return out


@dataclass
class Model:
    """Standardisation and weights of a network with one hidden layer; ``prior`` as estimated."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.odds(x), -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _network(p: np.ndarray, u: np.ndarray, prior: float | None, hidden: int, steps: int, seed: int) -> Model:
    """Adam on the non-negative risk; ``prior=None`` fits plain positives against unlabelled."""
    rng = np.random.default_rng(seed)
    both = np.vstack([p, u])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))
    d = p.shape[1]
    theta = [rng.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    first, second = ([np.zeros_like(t) for t in theta] for _ in range(2))
    for step in range(1, steps + 1):
        a, b = p[rng.integers(0, len(p), 512)], u[rng.integers(0, len(u), 512)]
        x = np.vstack([a, b])
        h = np.tanh(x @ theta[0] + theta[1])
        f = h @ theta[2] + theta[3]
        fa, fb = f[: len(a)], f[len(a) :]
        if prior is None:
            grad = np.concatenate([-_sigmoid(-fa), _sigmoid(fb)]) / len(a)
        else:
            negative = np.logaddexp(0, fb).mean() - prior * np.logaddexp(0, fa).mean()
            if negative >= 0:
                grad = np.concatenate([prior * (-_sigmoid(-fa) - _sigmoid(fa)) / len(a), _sigmoid(fb) / len(b)])
            else:  # step back from the over-fitted unlabelled part
                grad = np.concatenate([prior * _sigmoid(fa) / len(a), -_sigmoid(fb) / len(b)])
        back = np.outer(grad, theta[2]) * (1 - h * h)
        grads = [x.T @ back + 1e-4 * theta[0], back.sum(axis=0), h.T @ grad + 1e-4 * theta[2], np.array([grad.sum()])]
        rate = 0.01 * (1 - 0.9 * step / steps)
        for t, g, m, v in zip(theta, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            t -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, theta[0], theta[1], theta[2], float(theta[3][0]), prior or 0.5)


def estimate_prior(p: np.ndarray, u: np.ndarray, seed: int = 11, steps: int = 400) -> float:
    """Share of positives in ``u``: the smallest ratio of unlabelled to positive mass above a score.

    A classifier is fitted on one half; on the other half the threshold with the best bound on the ratio is taken.
    """
    if min(len(p), len(u)) < 20:
        return 0.5
    model = _network(p[::2], u[::2], None, 8, steps, seed)
    sp, su = np.sort(model.odds(p[1::2])), np.sort(model.odds(u[1::2]))
    cuts = np.quantile(sp, np.linspace(0, 0.98, 99))
    qp = 1 - np.searchsorted(sp, cuts) / len(sp)
    qu = 1 - np.searchsorted(su, cuts) / len(su)
    slack = np.sqrt(np.log(40) / 2 / len(su)) + 1.01 * np.sqrt(np.log(40) / 2 / len(sp))
    best = int(np.argmin((qu + slack) / qp))
    return float(np.clip(qu[best] / qp[best], 0.02, 0.98))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, seed: int = 7, steps: int = 1500) -> Model | None:
    """Fit on ``labels.quality = 1`` and unlabelled rows outside the held-out fold; None without positives."""
    learn = F.coalesce(fold(F.col("doc_id"), 5) != 0, F.lit(False))
    trusted = bounded_ids(labels.where((F.col("quality") == 1) & learn), sample, seed).withColumn("_p", F.lit(1))
    wild = bounded_ids(docs.where(learn), sample, seed + 1).withColumn("_p", F.lit(0))
    ids = F.broadcast(trusted.unionAll(wild))  # at most 2 * sample ids
    rows = docs.select("doc_id", "text").join(ids, "doc_id").select("_p", "doc_id", _features("text").alias("x"))
    got = rows.toPandas().sort_values(["_p", "doc_id"], kind="stable")
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), len(FEATURES))
    p, u = x[got["_p"] == 1], x[got["_p"] == 0]
    if not len(p) or not len(u):
        return None
    return _network(p, u, estimate_prior(p, u), 16, steps, seed)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features(texts: pd.Series) -> pd.Series:
    return pd.Series(list(features(texts)))


def score(docs: DataFrame, model: Model | None, column: str = "quality_score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row, 0.5 where nothing could be learned.

    Rows are kept one for one, repeated ones too; a NULL, empty or blank text is scored by the model as a text without
    words. Other columns are not looked at; one named like the score is replaced.
    """

    @F.pandas_udf(T.DoubleType())
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        clear_worker()
        for texts in parts:
            yield pd.Series(model.score(features(texts)) if model else np.full(len(texts), 0.5), dtype=float)

    return docs.withColumn(column, scored("text"))


@query()
def op1_quality_pu(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = score(docs.select("doc_id", "text"), fit(docs, labels), "score")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
