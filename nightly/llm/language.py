"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting runs over all learning documents: every task adds up the hashed 1- to 3-grams of its texts per language and
emits one row per language and bucket that occurs, so what is shuffled is bounded by tasks x languages x buckets. The
log-probability matrix (languages x buckets, at most MAX_LANGUAGES x BUCKETS doubles) goes to every task; a batch is
scored in numpy by gathering the rows of its n-grams and adding them up per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from nightly.llm.common import fold, query, table

BUCKETS = 1 << 14
MAX_LANGUAGES = 256
UNDETERMINED = "und"
_SLICE = 1 << 19  # code points worked on at once

_M1, _M2, _M3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)


def _buckets(x: np.ndarray) -> np.ndarray:
    """Bucket of every 1-, 2- and 3-gram of a run of code points."""
    a = x * _M1
    b = (a[:-1] + x[1:] * _M2) * _M3 + np.uint32(1)
    c = (b[:-1] + x[2:] * _M1) * _M2 + np.uint32(2)
    return np.concatenate([h >> np.uint32(18) for h in (a * _M3, b, c)])


def _points(text: str) -> np.ndarray:
    """Lower-case code points between two blanks, digits, marks and runs of blanks dropped."""
    x = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    x = np.where((x >= 9) & (x <= 13), np.uint32(32), x)
    x = x[(x > 127) | (x == 32) | ((x >= 97) & (x <= 122))]
    return x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])] if len(x) else x


def _slices(x: np.ndarray) -> Iterator[np.ndarray]:
    for at in range(0, max(1, len(x)), _SLICE):
        part = x[at : at + _SLICE + 2]
        if len(part) > 2:
            yield part


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability per text; ``und`` with 0 for a text that is NULL or has no letter."""
        names, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            if not self.languages or not has_letter(text):
                names.append(UNDETERMINED)
                continue
            total, grams = self.log_prior.copy(), 0
            for part in _slices(_points(text)):
                count = np.bincount(_buckets(part), minlength=BUCKETS)
                used = np.flatnonzero(count)
                total += count[used] @ self.log_prob[used]
                grams += len(part)
            best = int(np.argmax(total))
            names.append(self.languages[best])
            scores[i] = 1.0 / np.exp(np.minimum(total - total[best], 0)).sum()
        return names, scores


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, bucket, n, and the number of documents under bucket -1, over all rows with a language."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                into = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                into[BUCKETS] += 1
                for part in _slices(_points(text or "")):
                    into[:BUCKETS] += np.bincount(_buckets(part), minlength=BUCKETS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            bucket = np.where(at == BUCKETS, -1, at).astype(np.int32)
            yield pa.record_batch({"lang": pa.array([lang] * len(at)), "bucket": pa.array(bucket), "n": pa.array(n[at])})

    part = docs.where(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(tally, "lang string, bucket int, n long")
    return part.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, smoothing: float = 0.5) -> Model:
    """Model of all rows with a language; more than MAX_LANGUAGES languages are refused, as the matrix must stay small."""
    counts = count_grams(docs).toPandas()
    languages = sorted(counts["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the matrix is made for {MAX_LANGUAGES}")
    row = counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=np.int64)
    grams, seen = np.full((BUCKETS, len(languages)), smoothing), np.ones(len(languages))
    grid = counts["bucket"].to_numpy() >= 0
    n = counts["n"].to_numpy(dtype=float)
    np.add.at(grams, (counts["bucket"].to_numpy()[grid], row[grid]), n[grid])
    np.add.at(seen, row[~grid], n[~grid])
    return Model(languages, np.log(seen / seen.sum()), np.log(grams / grams.sum(axis=0)))


def identify(docs: DataFrame, model: Model, label: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """``docs`` with the predicted language and its probability for every row.

    Rows stay one for one, repeated ones too; ties go to the first language in order. Other columns are not looked at;
    columns named like the two results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predicted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            names, scores = shared.value.predict(texts)
            yield pd.DataFrame({"lang": pd.Series(names, dtype=object), "score": scores})

    kept = [c for c in docs.columns if c not in (label, score)]
    found = docs.select(*kept, predicted("text").alias("_found"))
    return found.select(*kept, F.col("_found.lang").alias(label), F.col("_found.score").alias(score))


@query()
def op6_language_nb(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = fold(F.col("doc_id"), 4) == 2
    model = fit(docs.where(F.coalesce(~held, F.lit(False))))
    out = identify(docs.select("doc_id", "text"), model, "lang_pred", "score")
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
