"""Corpus pipeline over `documents`: quality, near duplicates, benchmark leaks, source mix, token files.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. The first four return the columns of
`documents`; the last writes token files and returns one row per document in them: doc_id, start, n_tokens, ids_crc32.
Rows without doc_id pass every stage; NULL and empty texts are judged as texts without words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightly.llm import decontaminate, jaccard, mixing, quality, token_files
from nightly.llm.common import small_batches, table
from nightly.session import materialize, materialize_alone, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Documents whose probability of good quality is below this go, as in the query of the classifier.
LEAST_QUALITY = 0.3
# Near duplicates: share of common five-word shingles in percent.
SHINGLE, SIMILARITY = 5, 80
# Text handed to a Python worker at once, as memory of the executors is what long texts run out of first.
BATCH_MB = 4
# Share of the remaining tokens the mix may take, each document once.
MIX_SHARE = 0.8


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    small_batches(spark, BATCH_MB)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, "_quality").where(F.col("_quality") >= LEAST_QUALITY).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every component of near duplicates; of rows of one doc_id all."""
    small_batches(spark, BATCH_MB)

    def others() -> DataFrame:
        found = jaccard.join_similar(docs, SHINGLE, SIMILARITY)
        return found.where("component_id <> doc_id").select(F.col("doc_id").alias("_id")).distinct()

    extra = materialize_alone(spark, others, "near-duplicates")
    return docs.join(extra, docs["doc_id"] == extra["_id"], "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark, verbatim or re-parameterised."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the source budgets take."""
    return mixing.mix(docs, share=MIX_SHARE, epochs=1).select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, as read back from them."""
    import public_tokenizers

    small_batches(spark, BATCH_MB)
    path = scratch_path(spark, "corpus-tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

# The classifier is trained, so SQL cannot give these rows; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
