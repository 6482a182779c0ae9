"""Token ids of whole texts in frequency-ranked, byte-aligned, variable-length files.

Texts are encoded once: a first pass keeps the ids in a compressed table and counts every id of the corpus, a second replaces
them by their rank by frequency, so common ids take one byte. The table is deleted when the files are written.
Each rank is stored in 1 to 4 bytes; the lengths stand apart as 2-bit codes, four to a control byte, and a reader finds
all offsets of a block by one table lookup per control byte and a running sum. Documents are dealt to tasks by ranges
of doc_id that depend on the table alone and sorted inside them; a task rolls files by size, which are renamed into place and
named by a manifest.

Layout of a shard, little-endian: magic ``FRVB0001``; documents, ids, data bytes (3 x uint64); per document a flag
(uint8, 1: no doc_id), doc_id (int64) and number of ids (uint32); control bytes, every document from a new byte; data bytes.
``ranks.bin`` holds the id of every rank (uint32).

Texts are cut into the tokenizer's pre-tokens with numpy (character classes and a running hash), and the tokenizer is asked
once per distinct pre-token and worker, up to ``_MEMO`` kept ones, of which those not met again go first. Equal hashes only propose: characters of every pre-token are
compared with those its ids were made from, and where they differ the tokenizer is asked. Texts with characters, contractions or special tokens
that this cut does not cover go to the tokenizer whole; both ways give the tokenizer's ids.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from nightly.llm.common import WORKER_CACHES, clear_worker, filesystem, put_file, query, range_bounds, ranges_of, table
from nightly.session import job, materialize, scratch_path

MAGIC = b"FRVB0001"
MANIFEST = "MANIFEST.json"
END_ID = 0
_HEAD = np.dtype("<u8")
_MEMO = 500_000  # distinct pre-tokens a worker keeps
_ROWS = 256  # rows encoded at once, and bytes of their texts or ids, more if one alone is longer
_BYTES = 1 << 18
_PIECE = 1 << 17  # code points per piece of a long text
_GROUP = 1 << 18  # code points worked on at once
_ASKED = 1 << 14  # code points of new pre-tokens whose tokens are held at once, more if one alone is longer
_IDS = 1 << 18  # ids read at once, more if one document has more

# Characters below this have had the same class in every Unicode version since 5.0.
_KNOWN = 0x250
_BEYOND = re.compile(r"[^\x00-ɏ]")
_CONTRACTION = re.compile(r"'(?:[stmd]|re|ve|ll)")
_LETTER, _NUMBER, _SPACE, _OTHER, _STOP = range(5)


def _classes() -> np.ndarray:
    import unicodedata

    out = np.full(_KNOWN + 1, _OTHER, np.uint8)
    for i in range(_KNOWN):
        kind = unicodedata.category(chr(i))[0]
        out[i] = _LETTER if kind == "L" else _NUMBER if kind == "N" else _OTHER
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = _SPACE
    out[_KNOWN] = _STOP
    return out


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _slow(text: str) -> bool:
    """Whether the text has something that the cut does not cover."""
    if not text.isascii() and _BEYOND.search(text):
        return True
    return "'" in text and _CONTRACTION.search(text) is not None or "<|endoftext|>" in text


class Encoder:
    """Ids of texts, equal to ``tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.classes = _classes()
        self.letters = _byte_letters()
        # Stand-ins of the one or two bytes of every known character, 0 for no second one; a stop becomes a blank, which is none.
        self.stand_ins = np.zeros((_KNOWN + 1, 2), np.uint32)
        for i in range(_KNOWN):
            made = [ord(self.letters[b]) for b in chr(i).encode()]
            self.stand_ins[i, : len(made)] = made
        self.stand_ins[_KNOWN, 0] = ord(" ")
        rng = np.random.default_rng(3)
        self.salt = rng.integers(1, 1 << 63, _KNOWN + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self.inverse = np.zeros(0, np.uint64)
        self.forget()

    def forget(self) -> None:
        """Pre-tokens are known by hash, in an open-addressing table (0: free) with the slots of their ids and characters."""
        self.keys, self.slots = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.int32)
        self.flat, self.ends = array("I"), array("I", [0])
        self.chars, self.stops = array("H"), array("I", [0])
        self.met = bytearray()  # whether a slot was asked for again

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key, -1 for new ones."""
        out = np.full(len(keys), -1, np.int64)
        mask = len(self.keys) - 1
        rest, at = np.arange(len(keys)), (keys & np.uint64(mask)).astype(np.int64)
        while len(rest):
            held = self.keys[at]
            hit = held == keys[rest]
            out[rest[hit]] = self.slots[at[hit]]
            on = (held != 0) & ~hit
            rest, at = rest[on], (at[on] + 1) & mask
        return out

    def _put(self, keys: np.ndarray, slots: np.ndarray) -> None:
        """Add distinct keys that are not in the table, which is at most half full, after their characters were added."""
        if 2 * (len(self.stops) - 1) > len(self.keys):
            used = np.flatnonzero(self.keys)
            keys, slots = np.concatenate([self.keys[used], keys]), np.concatenate([self.slots[used], slots])
            size = 1 << (2 * len(keys)).bit_length()
            self.keys, self.slots = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        mask = len(self.keys) - 1
        rest, at = np.arange(len(keys)), (keys & np.uint64(mask)).astype(np.int64)
        while len(rest):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[rest[free]]
            own = self.keys[at] == keys[rest]
            self.slots[at[own]] = slots[rest[own]]
            rest, at = rest[~own], (at[~own] + 1) & mask

    def _shed(self) -> None:
        """Forget the pre-tokens that were not met again, and all if over half of them were."""
        at = np.flatnonzero(self.keys)
        keys, slot = self.keys[at], self.slots[at]
        again = np.frombuffer(self.met, bool)[slot]
        keys, slot = keys[again], slot[again]
        if len(keys) > _MEMO // 2:
            return self.forget()
        ids, ends = _runs(self.flat, self.ends, slot)
        chars, stops = _runs(self.chars, self.stops, slot)
        self.forget()
        self.flat.frombytes(ids.tobytes())
        self.ends.frombytes(ends.tobytes())
        self.chars.frombytes(chars.tobytes())
        self.stops.frombytes(stops.tobytes())
        self.met.extend(bytes(len(keys)))
        self._put(keys, np.arange(len(keys), dtype=np.int32))

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            base = np.uint64(0x9E3779B97F4A7C15)
            back = np.uint64(pow(int(base), -1, 1 << 64))
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base)]), dtype=np.uint64)
            self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, back)]), dtype=np.uint64)

    def _ids(self, text: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(text.encode().decode("latin-1").translate(self.letters))]

    def _ask(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens of ``x`` in a row, and how many each has; before and after all there is a stop."""
        size = end - begin + 1
        reach = np.cumsum(size)
        at = np.repeat(begin - reach + size, size) + np.arange(int(reach[-1]))
        at[reach - 1] = 0
        made = self.stand_ins[x[at]].reshape(-1)
        words = made[made > 0].tobytes().decode("utf-32-le")[:-1].split(" ")
        tokens = [*map(self.tokenizer.model.tokenize, words)]
        return np.array([t.id for word in tokens for t in word], np.uint32), np.fromiter(map(len, tokens), np.int64, len(tokens))

    def _learn(self, keys: np.ndarray, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        size = end - begin
        reach = np.cumsum(size)
        lo, slot = 0, len(self.ends) - 1
        while lo < len(keys):
            hi = max(lo + 1, int(np.searchsorted(reach, reach[lo] - size[lo] + _ASKED, side="right")))
            ids, n = self._ask(x, begin[lo:hi], end[lo:hi])
            self.ends.frombytes((np.cumsum(n) + len(self.flat)).astype(np.uint32).tobytes())
            self.flat.frombytes(ids.tobytes())
            lo = hi
        at = np.repeat(begin - reach + size, size) + np.arange(int(reach[-1]))
        self.stops.frombytes((reach + len(self.chars)).astype(np.uint32).tobytes())
        self.chars.frombytes(x[at].astype(np.uint16).tobytes())
        self.met.extend(bytes(len(keys)))
        self._put(keys, np.arange(slot, slot + len(keys), dtype=np.int32))

    def _group(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has."""
        joined = chr(_KNOWN) + chr(_KNOWN).join(pieces) + chr(_KNOWN)
        x = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        c = self.classes[x]
        start = np.empty(len(x), bool)
        start[0] = True
        np.not_equal(c[1:], c[:-1], out=start[1:])
        start |= c == _STOP
        after = np.flatnonzero((c[:-1] == _SPACE) & (c[1:] < _STOP) & (c[1:] != _SPACE)) + 1  # a word after blanks
        start[after - 1] = True
        start[after] = x[after - 1] != 32  # one space belongs to the word
        begin = np.flatnonzero(start)
        self._grow(len(x))
        total = np.concatenate([[np.uint64(0)], np.cumsum(self.salt[x] * self.powers[: len(x)], dtype=np.uint64)])
        end = np.append(begin[1:], len(x))
        stop = c[begin] == _STOP
        piece = np.cumsum(stop)[~stop] - 1
        begin, end = begin[~stop], end[~stop]
        h = (total[end] - total[begin]) * self.inverse[begin]
        h ^= h >> np.uint64(32)
        h[h == 0] = 1
        codes, distinct = pd.factorize(h)
        if len(self.ends) + len(distinct) > _MEMO:
            self._shed()
        at = self._find(distinct)
        np.frombuffer(self.met, bool)[at[at >= 0]] = True
        new = np.flatnonzero(at < 0)
        if len(new):
            first = np.full(len(distinct), -1, np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            grown = len(self.ends) - 1
            self._learn(distinct[new], x, begin[first[new]], end[first[new]])
            at[new] = grown + np.arange(len(new))
        ends = np.frombuffer(self.ends, np.uint32)
        flat = np.frombuffer(self.flat, np.uint32)
        low = ends[at].astype(np.int64)
        size = ends[at + 1] - low
        low, size = low[codes], size[codes]
        wrong = self._differing(x, c != _STOP, begin, end, at[codes])
        if len(wrong):
            return self._corrected(joined, begin, end, piece, len(pieces), low, size, flat, wrong)
        out = np.repeat(low - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        ids = flat[out]
        per_piece = np.bincount(piece, weights=size, minlength=len(pieces)).astype(np.int64)
        del ends, flat
        return ids, per_piece

    def _differing(self, x: np.ndarray, inside: np.ndarray, begin: np.ndarray, end: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Pre-tokens whose characters are not those their slot was learned from; ``inside`` marks the characters of all."""
        chars, stops = np.frombuffer(self.chars, np.uint16), np.frombuffer(self.stops, np.uint32)
        length, first = end - begin, stops[slot].astype(np.int64)
        same = length == stops[slot + 1] - first
        wrong = np.flatnonzero(~same)
        if len(wrong):
            inside = inside.copy()
            for i in wrong.tolist():
                inside[begin[i] : end[i]] = False
            first, length = first[same], length[same]
        reach = np.cumsum(length)
        at = np.repeat((first - reach + length).astype(np.int32), length)
        at += np.arange(len(at), dtype=np.int32)
        off = np.flatnonzero(chars[at] != x[inside])
        if len(off):
            more = np.unique(np.searchsorted(reach, off, side="right"))
            wrong = np.concatenate([wrong, np.flatnonzero(same)[more]])
        return wrong

    def _corrected(self, joined, begin, end, piece, pieces, low, size, flat, wrong) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens where some have the hash of another one."""
        ids = [flat[a : a + n] for a, n in zip(low.tolist(), size.tolist())]
        size = size.copy()
        for i in wrong.tolist():
            ids[i] = np.array(self._ids(joined[begin[i] : end[i]]), np.uint32)
            size[i] = len(ids[i])
        return np.concatenate(ids), np.bincount(piece, weights=size, minlength=pieces).astype(np.int64)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each; NULL is an empty text."""
        parts: list[np.ndarray] = []
        sizes = np.zeros(len(texts), np.int64)
        pieces: list[str] = []
        owner: list[int] = []
        pending = 0

        def flush() -> None:
            nonlocal pieces, owner, pending
            if pieces:
                ids, n = self._group(pieces)
                parts.append(ids)
                np.add.at(sizes, owner, n)
            pieces, owner, pending = [], [], 0

        for i, text in enumerate(texts):
            if not text:
                continue
            if _slow(text):
                flush()
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                parts.append(np.array(ids, dtype=np.uint32))
                sizes[i] = len(ids)
                continue
            for piece in _pieces(text):
                pieces.append(piece)
                owner.append(i)
                pending += len(piece)
                if pending >= _GROUP:
                    flush()
        flush()
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), sizes


def _runs(values: array, ends: array, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of some slots in a row, and where each ends."""
    v, e = np.frombuffer(values, f"u{values.itemsize}"), np.frombuffer(ends, np.uint32).astype(np.int64)
    size = e[slot + 1] - e[slot]
    reach = np.cumsum(size)
    return v[np.repeat(e[slot] - reach + size, size) + np.arange(int(size.sum()))], reach.astype(np.uint32)


def _pieces(text: str) -> Iterator[str]:
    """Cut a long text where blanks begin; no pre-token runs over such a place."""
    at = 0
    while len(text) - at > _PIECE:
        cut = re.compile(r"(?<=[^\s\x1c-\x1f])[ \t\n]").search(text, at + _PIECE)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


_ENCODERS: dict[str, Encoder] = WORKER_CACHES.setdefault("token_files", {})


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _small(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        reach = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = done = 0
        while at < batch.num_rows:
            to = min(at + _ROWS, max(at + 1, int(np.searchsorted(reach, done + _BYTES, side="right"))))
            yield batch.slice(at, to - at)
            at, done = to, int(reach[to - 1])


def encode_once(docs: DataFrame, path: str) -> tuple[DataFrame, np.ndarray]:
    """Ids of every row's whole text with a closing id 0, and all ids by falling count, ties by id, unused ones at the end.

    A task writes its documents (doc_id, bytes of the text, n, ids as little-endian integers) and, after them, rows with the
    count of every id it met. What goes to the driver is bounded by the vocabulary.
    """
    size = max(Tokenizer.from_file(path).get_vocab_size(), END_ID + 1)
    kind = id_kind(size)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker("token_files")
        encoder = _encoder(path)
        met = np.zeros(size, np.int64)
        for batch in _small(batches, "text"):
            ids, sizes = encoder.encode(batch["text"].to_pylist())
            ids, sizes = np.insert(ids, np.cumsum(sizes), END_ID), sizes + 1
            met += np.bincount(ids, minlength=size)
            at = np.concatenate([[0], np.cumsum(sizes)]) * kind.itemsize
            held = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(ids.astype(kind))])
            yield pa.record_batch({"doc_id": batch["doc_id"], "bytes": pc.binary_length(batch["text"]).cast("int64"), "n": pa.array(sizes), "ids": held, "id": pa.nulls(len(sizes), pa.int32()), "times": pa.nulls(len(sizes), pa.int64())})
        at = np.flatnonzero(met)
        none = pa.nulls(len(at), pa.int64())
        yield pa.record_batch({"doc_id": none, "bytes": none, "n": none, "ids": pa.nulls(len(at), pa.binary()), "id": pa.array(at.astype(np.int32)), "times": pa.array(met[at])})

    coded = materialize(docs.mapInArrow(code, "doc_id long, bytes long, n long, ids binary, id int, times long"), "token-ids", "zstd")
    sums = coded.where("id is not null").groupBy("id").agg(F.sum("times").alias("n")).toPandas()
    n = np.zeros(size, np.int64)
    n[sums["id"]] = sums["n"]
    return coded.where("id is null").select("doc_id", "bytes", "n", "ids"), np.lexsort([np.arange(size), -n]).astype(np.uint32)


def id_kind(size: int) -> np.dtype:
    """How an id of so many is kept between the passes."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def pack(ranks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and data bytes of runs of ranks, and the two byte counts of every run."""
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    reach = np.concatenate([[0], np.cumsum(code + np.uint8(1), dtype=np.int64)])
    data = np.empty(int(reach[-1]), np.uint8)
    data[reach[:-1]] = ranks.astype(np.uint8)
    for byte in range(1, 4):
        use = np.flatnonzero(code >= byte)
        if not len(use):
            break
        data[reach[use] + byte] = (ranks[use] >> np.uint32(8 * byte)).astype(np.uint8)
    control_bytes = -(-sizes // 4)
    slot = np.repeat(4 * (np.cumsum(control_bytes) - control_bytes) - np.cumsum(sizes) + sizes, sizes) + np.arange(len(ranks))
    slots = np.zeros(4 * int(control_bytes.sum()), np.uint8)
    slots[slot] = code
    four = slots.view("<u4")
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return (four | four >> 6 | four >> 12 | four >> 18).astype(np.uint8), data, control_bytes, reach[ends[1:]] - reach[ends[:-1]]


# Widths of the four ranks a control byte stands for.
WIDTHS = np.stack([(np.arange(256) >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.int64)


def unpack(control: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ranks of runs packed one after the other; ``sizes`` are their lengths."""
    control_bytes = -(-sizes // 4)
    slot = np.repeat(4 * (np.cumsum(control_bytes) - control_bytes) - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    width = WIDTHS[control].reshape(-1)[slot]
    offset = np.cumsum(width) - width
    ranks = data[offset].astype(np.uint32)
    for byte in range(1, 4):
        use = np.flatnonzero(width > byte)
        if not len(use):
            break
        ranks[use] |= data[offset[use] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def write_tokens(docs: DataFrame, path: str, tokenizer: str, shard_bytes: int = 24 << 20) -> dict:
    """Write the ids of every row's whole text and a closing id 0, in ascending doc_id order; returns the manifest.

    NULL and empty texts have the closing id only. Rows without doc_id come first; rows of one doc_id are written one after
    the other, by text. Other columns are ignored. An empty table gives a manifest without files.
    """
    with job(docs.sparkSession):
        return _write_tokens(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), path, tokenizer, shard_bytes)


def _write_tokens(docs: DataFrame, path: str, tokenizer: str, shard_bytes: int) -> dict:
    coded, order = encode_once(docs, tokenizer)
    put_file(path, ".ranks.tmp", "ranks.bin", [order.astype("<u4").tobytes()])
    rank_of = np.empty(len(order), np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    bounds = range_bounds(coded, "doc_id", F.col("bytes"), shard_bytes)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker()
        edges = np.array(bounds, dtype=np.int64)
        kind = id_kind(len(rank_of))
        for batch in _small(batches, "ids"):
            sizes = batch["n"].to_numpy()
            control, data, cb, db = pack(rank_of[np.frombuffer(b"".join(batch["ids"].to_pylist()), kind)], sizes)
            at = [np.concatenate([[0], np.cumsum(b)]).astype(np.int32) for b in (cb, db)]
            columns = [pa.Array.from_buffers(pa.binary(), len(cb), [None, pa.py_buffer(o), pa.py_buffer(v)]) for o, v in zip(at, (control, data))]
            yield pa.record_batch({"shard": pa.array(ranges_of(batch["doc_id"], edges)), "doc_id": batch["doc_id"], "n": batch["n"], "control": columns[0], "data": columns[1]})

    ranked = coded.mapInArrow(rank, "shard int, doc_id long, n long, control binary, data binary")
    dealt = ranked.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "n", "data")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, number = TaskContext.get().taskAttemptId(), 0
        ids, sizes, control, data, held = [], [], [], [], 0

        def roll(shard: int) -> pa.RecordBatch:
            name = f"tokens-{shard:06d}-{number:05d}.frvb"
            head = np.array([len(ids), sum(sizes), sum(map(len, data))], "<u8").tobytes()
            known = np.array([i is None for i in ids], np.uint8).tobytes()
            index = known + np.array([i or 0 for i in ids], "<i8").tobytes() + np.array(sizes, "<u4").tobytes()
            put_file(path, f".{name}.{attempt}.tmp", name, [MAGIC + head + index, *control, *data])
            return pa.record_batch({"name": [name], "documents": [len(ids)], "tokens": [sum(sizes)]})

        shard = 0
        for batch in batches:
            shard = batch["shard"][0].as_py()
            ids += batch["doc_id"].to_pylist()
            sizes += batch["n"].to_pylist()
            control.append(b"".join(batch["control"].to_pylist()))
            data.append(b"".join(batch["data"].to_pylist()))
            held += len(control[-1]) + len(data[-1])
            if held >= shard_bytes:  # a range may hold more than a file does
                yield roll(shard)
                ids, sizes, control, data, held, number = [], [], [], [], 0, number + 1
        if ids:
            yield roll(shard)

    files = dealt.mapInArrow(write, "name string, documents long, tokens long").toPandas().sort_values("name")
    files["start"] = files["tokens"].cumsum() - files["tokens"]
    manifest = {"end_id": END_ID, "bounds": bounds, "files": files.to_dict("records")}
    put_file(path, f".{MANIFEST}.tmp", MANIFEST, [json.dumps(manifest, indent=1).encode()])
    return manifest


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files the manifest names: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids."""
    fs, folder = filesystem(path)
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
        named = json.loads(f.read())["files"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    if not named:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(pd.DataFrame(named)).repartitionByRange(len(named), "name")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(path)
        with fs.open_input_stream(f"{folder}/ranks.bin") as f:
            order = np.frombuffer(f.read(), "<u4")
        for batch in batches:
            for name, start in zip(batch["name"].to_pylist(), batch["start"].to_pylist()):
                with fs.open_input_stream(f"{folder}/{name}", compression=None) as f:
                    raw = f.read()
                if raw[:8] != MAGIC:
                    raise ValueError(f"{name} is not a token file")
                docs, _, nbytes = (int(v) for v in np.frombuffer(raw, "<u8", 3, 8))
                at = 32
                missing = np.frombuffer(raw, np.uint8, docs, at).astype(bool)
                ids = np.frombuffer(raw, "<i8", docs, at + docs)
                sizes = np.frombuffer(raw, "<u4", docs, at + 9 * docs).astype(np.int64)
                control = np.frombuffer(raw, np.uint8, len(raw) - nbytes - at - 13 * docs, at + 13 * docs)
                data = np.frombuffer(raw, np.uint8, nbytes, len(raw) - nbytes)
                lo = 0
                reach = np.cumsum(sizes)
                while lo < docs:
                    hi = max(lo + 1, int(np.searchsorted(reach, (reach[lo - 1] if lo else 0) + _IDS)))
                    n = sizes[lo:hi]
                    cut = int((-(-n // 4)).sum())
                    ranks = unpack(control[:cut], data, n)
                    used = int(((ranks > 0xFF).astype(np.int64) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF) + 1).sum())
                    control, data = control[cut:], data[used:]
                    tokens = order[ranks]
                    ends = np.cumsum(n)
                    crc = [zlib.crc32(tokens[e - k : e]) for e, k in zip(ends.tolist(), n.tolist())]
                    out = {"doc_id": pa.array(ids[lo:hi], mask=missing[lo:hi]), "start": pa.array(start + ends - n), "n_tokens": pa.array(n), "ids_crc32": pa.array(crc, pa.int64())}
                    if with_ids:
                        out["ids"] = pa.array([tokens[e - k : e].astype(np.int32) for e, k in zip(ends, n)], pa.list_(pa.int32()))
                    yield pa.record_batch(out)
                    start, lo = start + int(ends[-1]), hi

    return files.mapInArrow(read, schema)


@query()
def op3_token_files(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path)
