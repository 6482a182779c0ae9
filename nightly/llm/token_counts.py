"""Token counts of whole texts by a two-tier lookup inside the tasks; pre-tokens are never shuffled.

The tokenizer splits a text into pre-tokens that are encoded independently of each other, so a text's count is the sum over
its pre-tokens. First tier: lengths of the corpus's frequent pre-tokens in one broadcast table. Second tier: a cache of the
task, filled by the tokenizer with every pre-token the table lacks.

The table is found by one pass in which every task counts its pre-tokens in a bounded summary; summaries (one row per task)
are merged some at a time until one is left. A summary that is full forgets its rarest pre-tokens. The table only decides
which tier answers: with any table, an empty one too, the counts are the tokenizer's.

The cut is that of a lower-casing tokenizer with word ends: letters in a row, single digits, other characters in a row, English
contractions, white space dropped. Characters up to U+017F have had their classes in every Unicode version in use and are cut
here; a run without white space that holds another character or a special token is counted by the tokenizer as a whole, which
is the same because no pre-token, composed character or special token spans white space. Tokenizers of another make
(other .json files, sentencepiece .model files) count whole texts by their library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from nightly.llm.common import merge_rows, query, small_batches, table
from nightly.llm.token_files import _byte_letters

LIMIT = 2048  # tokens of a document above which it is over the limit
TABLE = 131_072  # pre-tokens in the broadcast table
SUMMARY = 262_144  # pre-tokens a task counts before it forgets the rarer half
CACHE = 200_000  # pre-tokens a task remembers besides the table
LONGEST = 64  # characters of a pre-token that is remembered

_KNOWN = [chr(i) for i in range(0x180)]
_BLANK = "\t-\r \x85\xa0"
_LETTERS = "".join(c for c in _KNOWN if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(c for c in _KNOWN if unicodedata.category(c)[0] == "N")
# Fixed value: the contractions the tokenizer's own pattern names, in its order.
_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANK}{_LETTERS}{_NUMBERS}]+")
_RUN = re.compile(rf"[^{_BLANK}]+")


def _word_ends(path: str) -> bool:
    """Whether the file is a tokenizer of the make that is cut here."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    kinds = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
    split = ((made["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    pattern = split.get("pattern", {}).get("Regex")
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in made["added_tokens"])
    return kinds == ["NFC", "Replace", "Lowercase"] and plain and pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Lengths(dict):
    """Number of tokens of a piece; missing ones are asked of the tokenizer and remembered while there is room."""

    def __init__(self, length: Callable[[str], int], known: dict[str, int] | None = None) -> None:
        super().__init__(known or {})
        self.length, self.known, self.room = length, known or {}, CACHE

    def __missing__(self, piece: str) -> int:
        n = self.length(piece)
        if len(piece) <= LONGEST:
            if not self.room:
                self.clear()
                self.update(self.known)
                self.room = CACHE
            self.room -= 1
            self[piece] = n
        return n


class TokenCounter:
    """Counts the tokens of texts as the library for ``path`` does, without added special tokens."""

    def __init__(self, path: str, known: dict[str, int] | None = None) -> None:
        self.odd = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.length = lambda text: len(model.encode(text, num_threads=1))
            return
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        self.length = lambda text: len(made.encode(text, add_special_tokens=False).ids)
        if _word_ends(path):
            self.odd = re.compile("[^\x00-įı-ſ]")
            self.special = [t.content for t in made.get_added_tokens_decoder().values()]
            letters, model = _byte_letters(), made.model
            self.words = Lengths(lambda word: len(model.tokenize(word.encode().decode("latin-1").translate(letters))), known)
            self.runs = Lengths(self.length)

    def _unusual(self, text: str) -> bool:
        return self.odd.search(text) is not None or any(s in text for s in self.special)

    def pieces(self, text: str) -> tuple[list[str], list[str]]:
        """Pre-tokens, and runs without white space that the tokenizer is asked about as they stand."""
        runs: list[str] = []
        if self._unusual(text):
            usual: list[str] = []
            for run in _RUN.findall(text):
                (runs if self._unusual(run) else usual).append(run)
            text = " ".join(usual)
        return _CUT.findall(text.lower()), runs

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.odd is None:
            return self.length(text)
        words, runs = self.pieces(text)
        return sum(map(self.words.__getitem__, words)) + sum(map(self.runs.__getitem__, runs))


def _forget(counts: Counter, keep: int) -> Counter:
    return Counter(dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:keep]))


def _summary(counts: Counter) -> pa.RecordBatch:
    best = _forget(counts, TABLE)
    return pa.record_batch({"words": pa.array([" ".join(best)]), "counts": pa.array([np.fromiter(best.values(), "<i8", len(best)).tobytes()])})


def frequent(docs: DataFrame, path: str) -> list[str]:
    """The pre-tokens of the broadcast table, most frequent first; those met once are left out."""
    schema = "words string, counts binary"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, counts = TokenCounter(path), Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                if text:
                    counts.update(counter.pieces(text)[0])
                    if len(counts) > SUMMARY:
                        counts = _forget(counts, SUMMARY // 2)
        yield _summary(Counter({w: n for w, n in counts.items() if len(w) <= LONGEST}))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for words, n in zip(batch["words"].to_pylist(), batch["counts"].to_pylist()):
                counts.update(dict(zip(words.split(" "), np.frombuffer(n, "<i8").tolist())) if words else {})
                if len(counts) > SUMMARY:
                    counts = _forget(counts, SUMMARY // 2)
        yield _summary(counts)

    row = merge_rows(docs.select("text").mapInArrow(look, schema), merge, "token-summaries")
    if row is None or not row["words"]:
        return []
    return [w for w, n in zip(row["words"].split(" "), np.frombuffer(row["counts"], "<i8").tolist()) if n > 1]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for every row of ``docs``.

    NULL and empty texts have no bytes and no tokens. Repeated rows and rows without doc_id are counted one by one. Other
    columns are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known: dict[str, int] = {}
    if _word_ends(path):
        counter = TokenCounter(path)
        known = {w: counter.words.length(w) for w in frequent(docs, path)}
    lengths = np.fromiter(known.values(), np.uint8, len(known))  # at most LONGEST characters of at most 2 bytes
    shared = docs.sparkSession.sparkContext.broadcast((" ".join(known), lengths))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, lengths = shared.value
        counter = TokenCounter(path, dict(zip(words.split(" "), lengths.tolist())) if words else {})
        for batch in batches:
            n = [counter.count(text) for text in batch["text"].to_pylist()]
            yield pa.record_batch({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": pa.array(n, pa.int64())})

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = docs.select("doc_id", size.alias("n_bytes"), "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


@query()
def op12_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    return count_tokens(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
