"""Deterministic sharded WARC writer, and a reader of what it committed.

Records are dealt to shards by ranges of their id, sorted and written by one
task per shard, which starts a new file when the compressed size passes a
limit. Headers, digests and record ids are formed anew from the content. A file
is written under a temporary name and renamed when it is whole; the manifest,
a table with a row per file, is the commit: readers open only what it lists, so
an attempt that was lost leaves nothing they see.

Copies of a large payload become revisit records. Which copy is the response is
known from digests alone; the decisions travel as notes that sort just before
their records, so contents are shuffled once.

Edge cases: a null html is an empty payload, a null url leaves the URI out; a
null id sorts first and is no larger id; of rows that repeat the largest id
with the same payload the first is the response; an empty table gives an empty
manifest; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.llm.common import discard, load, store
from pixelframe.llm.registry import query
from pixelframe.storage import scratch_path

#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Bytes a shard should hold, those of a record besides its payload, and most shards, whose bounds tasks carry.
SHARD_BYTES, RECORD_BYTES, MAX_SHARDS = 8 << 20, 1 << 10, 4096
#: Ids sampled per shard bound, those of the smallest hash.
SAMPLED = 20
#: A file is closed when its compressed size passes this.
ROLL_BYTES = 64 << 20
#: Rows of contents per batch between Spark and a task.
READ_BYTES = 1 << 20
DATE = "2026-01-01T00:00:00Z"
MANIFEST = "shard int, file string, records long, bytes long, sha256 string"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long, payload binary"
)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder as executors reach it, and the path in it."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", uri)))


def payload_facts(pages: DataFrame) -> DataFrame:
    content = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select("page_id", F.length(content).cast("long").alias("size"), F.unhex(F.sha2(content, 256)).alias("content"))


def revisit_notes(facts: DataFrame) -> DataFrame:
    """(page_id, content, response): members of groups of equal large payloads."""
    large = facts.where(F.col("size") >= REVISIT_BYTES)
    groups = large.groupBy("content").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = store(groups.drop("n"), "warc-groups")
    return large.join(groups, "content").select("page_id", "content", "response").distinct()


def shard_bounds(facts: DataFrame) -> list[int]:
    """Ids that part the shards: quantiles of a bounded sample, the same in every run."""
    total = facts.agg(F.sum(F.col("size") + RECORD_BYTES)).first()[0] or 0
    shards = min(MAX_SHARDS, total // SHARD_BYTES + 1)
    ids = facts.select("page_id").where("page_id is not null")
    drawn = ids.orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLED * shards)
    sample = sorted(r[0] for r in drawn.collect())
    return [sample[len(sample) * k // shards] for k in range(1, shards)] if sample else []


def _record(kind: str, page_id: int | None, url: str | None, payload: bytes, nth: int, response: int | None) -> bytes:
    sha1 = hashlib.sha1(payload)
    digest = "sha1:" + base64.b32encode(sha1.digest()).decode()

    def name(of: int | None, n: int) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{of}/{sha1.hexdigest()}/{n}')}>"

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", name(page_id, nth)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        escaped = "".join(f"%{ord(c):02X}" if ord(c) <= 0x20 or ord(c) == 0x7F else c for c in url)
        headers.append(("WARC-Target-URI", escaped))
    if page_id is not None:
        headers.append(("Page-ID", str(page_id)))
    if kind == "revisit":
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("WARC-Refers-To", name(response, 0)))
        if response is not None:
            headers.append(("Refers-To-Page-ID", str(response)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class ShardWriter:
    """The files of one shard, each under a temporary name until it is whole."""

    def __init__(self, folder: str, shard: int, roll_bytes: int) -> None:
        self.client, self.inner = open_folder(folder)
        self.shard, self.roll_bytes, self.number, self.stream = shard, roll_bytes, 0, None
        self.done: list[tuple] = []

    def add(self, record: bytes) -> None:
        if self.stream is None:
            self.temporary = f"{self.inner}/.part-{uuid.uuid4().hex}"
            self.stream = self.client.open_output_stream(self.temporary)
            self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.stream.write(member)
        self.digest.update(member)
        self.records += 1
        self.bytes += len(member)
        if self.bytes >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            file = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.client.move(self.temporary, f"{self.inner}/{file}")
            self.done.append((self.shard, file, self.records, self.bytes, self.digest.hexdigest()))
            self.number, self.stream = self.number + 1, None


def write_archives(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write every page below ``folder`` and return the manifest, as stored in it."""
    spark = pages.sparkSession
    client, inner = open_folder(folder)
    client.create_dir(inner, recursive=True)
    facts = store(payload_facts(pages), "warc-facts")
    bounds = np.array(shard_bounds(facts), np.int64)

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series) -> pd.Series:
        found = np.searchsorted(bounds, page_id.fillna(0).to_numpy(np.int64), "right")
        return pd.Series(np.where(page_id.isna(), 0, found).astype(np.int32))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer: ShardWriter | None = None
        page, notes, seen = object(), {}, {}
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "page_id", "url", "html", "content", "response")]
            for k in range(len(batch)):
                shard, page_id, url, html, content, response = (c[k].as_py() for c in columns)
                if writer is None or writer.shard != shard:
                    if writer is not None:
                        writer.close()
                        yield _manifest(writer)
                    writer = ShardWriter(folder, shard, roll_bytes)
                if page_id != page:
                    page, notes, seen = page_id, {}, {}
                if content is not None:
                    notes[content] = response
                    continue
                payload = (html or "").encode("utf-8")
                key = hashlib.sha256(payload).digest()
                nth = seen[key] = seen.get(key, -1) + 1
                again = key in notes and (nth > 0 or notes[key] != page_id)
                writer.add(_record("revisit" if again else "response", page_id, url, payload, nth, notes.get(key)))
        if writer is not None:
            writer.close()
            yield _manifest(writer)

    contents = pages.select("page_id", "url", "html", F.lit(None).cast("binary").alias("content"), F.lit(None).cast("long").alias("response"))
    notes = store(revisit_notes(facts), "warc-notes")
    empty = F.lit(None).cast("string")
    noted = notes.select("page_id", empty.alias("url"), empty.alias("html"), "content", "response")
    dealt = contents.unionByName(noted).withColumn("shard", shard_of("page_id"))
    ordered = dealt.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions(
        "shard", F.col("page_id").asc_nulls_first(), F.col("content").desc_nulls_last(), "url", "html"
    )
    manifest = f"{folder}/manifest"
    ordered.mapInArrow(rows, MANIFEST).write.parquet(manifest)
    discard(facts)
    discard(notes)
    return spark.read.schema(MANIFEST).parquet(manifest)


def _manifest(writer: ShardWriter) -> pa.RecordBatch:
    columns = list(zip(*writer.done, strict=True))
    names = ["shard", "file", "records", "bytes", "sha256"]
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def members(stream: pa.NativeFile) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    pending, unpacker, parts = b"", zlib.decompressobj(31), []
    while True:
        data = pending or stream.read(READ_BYTES)
        if not data:
            break
        parts.append(unpacker.decompress(data))
        pending = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the last record of the archive is cut off")


def parse_record(record: bytes) -> tuple:
    """A row of ``RECORDS``; a payload that contradicts its digest raises."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    number = {k: int(fields[k]) if k in fields else None for k in ("Page-ID", "Refers-To-Page-ID")}
    return (
        number["Page-ID"], fields.get("WARC-Target-URI"), size, digest.hex(), kind,
        number["Refers-To-Page-ID"], payload if kind == "response" else None,
    )


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all files that the manifest lists, a task per few files."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, inner = open_folder(folder)
        names = [f.split()[0] for f in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for file in batch.column("file").to_pylist():
                held, size = [], 0
                with client.open_input_stream(f"{inner}/{file}", compression=None) as stream:
                    for record in members(stream):
                        row = parse_record(record)
                        held.append(row if payloads else (*row[:-1], None))
                        size += len(record)
                        if size >= 4 * READ_BYTES:
                            yield _rows(held, names, kinds)
                            held, size = [], 0
                if held:
                    yield _rows(held, names, kinds)

    files = max(1, manifest.count())
    return manifest.select("file").repartition(files, "file").mapInArrow(rows, RECORDS)


def _rows(held: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


OP4_SQL = f"""
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
  CASE WHEN size >= {REVISIT_BYTES} AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= {REVISIT_BYTES} AND nth > 1 THEN latest END AS refers_to
FROM (
  SELECT page_id, octet_length(encode(body))::BIGINT AS size, sha1(body) AS digest,
    row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) AS nth,
    max(page_id) OVER (PARTITION BY body) AS latest
  FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))
"""


@query("op4_warc_archives", OP4_SQL)
def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "archives")
    manifest = write_archives(load(spark, sf_dir, "pages"), folder)
    return read_archives(manifest, folder, payloads=False).drop("url", "payload")
