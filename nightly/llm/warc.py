"""Deterministic sharded WARC writer and its reader.

Records are dealt to shards by ranges of page_id and sorted inside them. The range bounds come from ids whose hash falls
under a threshold, so the same table gives the same shards on every run and retry. A shard rolls to a new file when its
compressed size passes a limit. Every record is its own gzip member with regenerated headers: record id, digests of
block and payload, lengths. Files are written under temporary names and renamed; a manifest of names, sizes, counts and
digests is written last and is what readers go by, so files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from nightly.llm.common import filesystem, put_file, query, range_bounds, range_of, table
from nightly.session import materialize, scratch_path

MANIFEST = "MANIFEST.json"
_ID_SPACE = 0x9D2C_5680_0000_8000_8000_0000_0000_0000  # a version 8 (custom) UUID with room for 62 + 2 bits of id


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    """A record id that holds the page id in both directions; the nil UUID for NULL."""
    if page_id is None:
        return f"<urn:uuid:{uuid.UUID(int=0)}>"
    n = page_id & (1 << 64) - 1
    return f"<urn:uuid:{uuid.UUID(int=_ID_SPACE | (n >> 62) << 66 | (n & (1 << 62) - 1))}>"


def page_of(record: str) -> int | None:
    value = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    if value == 0:
        return None
    n = (value >> 66 & 3) << 62 | value & (1 << 62) - 1
    return n - (1 << 64) if n >> 63 else n


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head only and names the response it repeats."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    target = "".join(c for c in url or "" if c > " ") or f"page:{page_id}"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}"]
    lines += [f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http;msgtype=response"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        lines += [f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += [f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def mark_revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``pages`` with ``first_id``: the smallest page_id with the same payload, NULL where the page is its own.

    Copies are found on (digest, id) pairs: an aggregate that is combined before its shuffle finds the payloads that occur
    twice, and only those are joined back; the join has two plain exchanges, so a hot payload is split by AQE.
    """
    payload = F.coalesce(F.encode("html", "utf-8"), F.lit(b""))
    keyed = pages.withColumn("_digest", F.sha1(payload))
    big = keyed.where(F.octet_length(payload) >= least_bytes).groupBy("_digest")
    twice = big.agg(F.min("page_id").alias("first_id"), F.count("*").alias("_n")).where("_n > 1")
    twice = materialize(twice.select("_digest", "first_id"), "warc-payloads")
    return keyed.join(twice, "_digest", "left").drop("_digest")


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, shard_bytes: int = 16 << 20, roll_bytes: int = 8 << 20) -> dict:
    """Write a record per row of ``pages`` (page_id, url, html) under ``path`` and return the manifest.

    NULL html is an empty payload. Of rows with equal payloads of at least ``least_bytes`` bytes the one with the smallest
    page_id is the response (of repeated ids the first written), the others revisit it. NULL page_ids come first in the
    first shard; they are responses unless the payload also belongs to an id. Other columns are ignored. An empty table
    gives a manifest without files.
    """
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    bounds = range_bounds(pages, "page_id", F.octet_length("html"), shard_bytes)
    marked = mark_revisits(pages, least_bytes).withColumn("shard", range_of("page_id", bounds))
    dealt = marked.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "url", "html")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        parts, size, count, rolled, before = [], 0, 0, 0, (None, None)
        shard = None

        def close():
            name = f"shard-{shard:06d}-{rolled:04d}.warc.gz"
            put_file(path, f".{name}.{attempt}.tmp", name, parts)
            digest = hashlib.sha256()
            for p in parts:
                digest.update(p)
            return pa.record_batch({"name": [name], "bytes": [size], "records": [count], "sha256": [digest.hexdigest()]})

        for batch in batches:
            for page, url, html, first, shard in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "first_id", "shard"))):
                payload = (html or "").encode()
                digest = base32_sha1(payload)
                own = first is None or (page == first and before != (page, digest))
                before = (page, digest)
                parts.append(_member(record(page, url, payload, digest, first, not own)))
                size, count = size + len(parts[-1]), count + 1
                if size >= roll_bytes:
                    yield close()
                    parts, size, count, rolled = [], 0, 0, rolled + 1
        if parts:
            yield close()

    files = dealt.mapInArrow(write, "name string, bytes long, records long, sha256 string").toPandas().sort_values("name")
    manifest = {"format": "WARC/1.1", "bounds": bounds, "files": files.to_dict("records")}
    put_file(path, f".{MANIFEST}.tmp", MANIFEST, [json.dumps(manifest, indent=1).encode()])
    return manifest


_SLICE = 1 << 16  # bytes of a file unpacked at once


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a file of gzip members."""
    view, at = memoryview(data), 0
    while at < len(view):
        d, parts = zlib.decompressobj(31), []
        while not d.eof and at < len(view):
            part = view[at : at + _SLICE]
            parts.append(d.decompress(part))
            at += len(part) - len(d.unused_data)
        if not d.eof:
            raise ValueError("the file ends inside a record")
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        yield headers, rest[: int(headers["Content-Length"])]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files the manifest names; file, block and payload digests are checked."""
    fs, folder = filesystem(path)
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
        named = json.loads(f.read())["files"]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
    if not named:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(pd.DataFrame(named)).repartitionByRange(len(named), "name")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = filesystem(path)
        for batch in batches:
            for name, want in zip(batch["name"], batch["sha256"]):
                with fs.open_input_stream(f"{folder}/{name}", compression=None) as f:
                    data = f.read()
                if hashlib.sha256(data).hexdigest() != want:
                    raise ValueError(f"{name} differs from the manifest")
                rows = []
                for h, block in parse(data):
                    if h["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                        raise ValueError(f"{h['WARC-Record-ID']}: damaged block")
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = h["WARC-Type"] == "revisit"
                    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
                        raise ValueError(f"{h['WARC-Record-ID']}: damaged payload")
                    origin = page_of(h["WARC-Refers-To"]) if revisit else None
                    rows.append((page_of(h["WARC-Record-ID"]), h["WARC-Target-URI"], size, digest, h["WARC-Type"], origin, None if revisit else payload.decode()))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return files.mapInPandas(read, schema)


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(x, 1 + 5 * (i // 4)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


@query(ORACLE)
def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf, "pages"), path)
    back = read_warc(spark, path)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
