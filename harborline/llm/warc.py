"""WARC archives: a deterministic sharded writer with temporary names and a manifest, and a reader.

``write`` decides each page's record, deals pages out to shards by ranges of ``page_id``, sorts every shard and
writes it as gzip members, one record each, rolling to a new file when the compressed size passes
``roll_bytes``. Headers and digests are made anew from the payload. A task writes under a temporary name that
holds its attempt; names of whole files come back as rows of the job, so that only files of attempts that
Spark took count. They go to the manifest, are renamed in a second job that can be repeated, and leftovers of
lost attempts are deleted. Equal input gives equal files: shard bounds come from byte counts of at most
``BINS`` ranges of ids, not from a sample, ties are ordered by url and digest, and members carry no time.
A range that alone exceeds ``shard_bytes`` is split by a hash of url and digest.

Of records with equal payloads of at least ``least`` bytes that with the largest page id is a response and the
others revisit it. Null html is an empty payload, null urls give no target header. Null ids go to the first
shard, revisit a response that has an id, and are a response where no equal payload has one; rows that
share the largest id are all responses. Empty tables give an empty manifest. Long payloads are held one
record at a time by writer and reader. Extra columns aren't read.

``read`` streams the files of a manifest, one task per file, and checks block digests and payload lengths.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.common import cut

BINS = 4096  # ranges of ids whose bytes are counted
BITS = 1 << 20  # of the table of repeated digests
CRLF = b"\r\n"


def _bits(rows: DataFrame, key: Column) -> tuple[Column, Column, Column]:
    bit = F.pmod(F.xxhash64(key), F.lit(BITS)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)))
    table = [0] * (BITS // 64)
    for k, v in rows.groupBy((bit / 64).cast("int")).agg(F.bit_or(mask)).collect():  # at most BITS / 64 rows
        table[k] = v
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>"), (bit / 64).cast("int"), mask


def decide(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 1000) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest`` (SHA-1), ``n_bytes``, ``refers_to`` (null: a response).

    Only pages whose payload may repeat, by a bit table of fixed size, meet the table of repeated payloads.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("n_bytes", F.octet_length("html").cast("long"))
    repeated = cut(
        rows.where(F.col("n_bytes") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("_digest"), "keep")
    )
    table, slot, mask = _bits(repeated.withColumnRenamed("_digest", "digest"), F.col("digest"))
    rows = rows.withColumn("may", (F.get(table, slot).bitwiseAND(mask) != 0) & (F.col("n_bytes") >= least))
    alone = rows.where("not may").drop("may").withColumn("refers_to", F.lit(None).cast(rows.schema["page_id"].dataType))
    met = rows.where("may").join(repeated, rows["digest"] == repeated["_digest"], "left")
    other = F.when(F.col("page_id").eqNullSafe(F.col("keep")), F.lit(None)).otherwise(F.col("keep"))
    met = met.select("page_id", "url", "html", "digest", "n_bytes", other.alias("refers_to"))
    # a revisit has no payload to write
    met = met.withColumn("html", F.when(F.col("refers_to").isNull(), F.col("html")))
    return alone.unionByName(met)


def _shard(rows: DataFrame, shard_bytes: int) -> Column:
    """Shard number of a row, by ranges of page ids with about equal bytes."""
    ends = rows.agg(F.min("page_id").alias("low"), F.max("page_id").alias("high")).first()
    low, high = ends.low or 0, ends.high or 0
    width = (high - low) // BINS + 1
    slot = F.coalesce(F.floor((F.col("page_id") - low) / width).cast("int"), F.lit(0))
    first, pieces = [0] * BINS, [1] * BINS
    filled, shard = 0, 0
    for k, n in sorted(rows.groupBy(slot.alias("k")).agg(F.sum("n_bytes").alias("n")).collect()):  # at most BINS rows
        if filled and filled + n > shard_bytes:
            shard, filled = shard + 1, 0
        first[k], pieces[k] = shard, max(1, -(-n // shard_bytes))
        shard, filled = shard + pieces[k] - 1, filled + n
    array = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")
    return F.get(array(first), slot) + F.pmod(F.xxhash64("url", "digest"), F.get(array(pieces), slot)).cast("int")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, n_bytes: int, refers_to: int | None) -> bytes:
    """One WARC record without compression."""
    sha1 = lambda raw: "sha1:" + base64.b32encode(raw).decode()
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest}")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: text/html;charset=utf-8",
        f"WARC-Block-Digest: {sha1(hashlib.sha1(payload).digest())}",
        f"WARC-Payload-Digest: {sha1(bytes.fromhex(digest))}",
        f"X-Payload-Length: {n_bytes}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + CRLF * 2 + payload + CRLF * 2


def _member(raw: bytes, level: int) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


class _File:
    """One archive being written under a temporary name."""

    def __init__(self, fs, root: str, name: str, attempt: str):
        self.name, self.temporary = name, f"{name}.{attempt}.tmp"
        self.stream = fs.open_output_stream(f"{root}/{self.temporary}", compression=None)
        self.size = self.records = 0
        self.sum = hashlib.sha256()

    def add(self, raw: bytes) -> None:
        self.stream.write(raw)
        self.sum.update(raw)
        self.size += len(raw)
        self.records += 1

    def close(self) -> tuple[str, str, int, int, str]:
        self.stream.close()
        return self.name, self.temporary, self.size, self.records, self.sum.hexdigest()


def write(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 1000,
    shard_bytes: int = 64 << 20,
    roll_bytes: int = 32 << 20,
    level: int = 4,
) -> DataFrame:
    """Write ``pages`` to ``folder`` (a URI that all executors reach) and return the manifest:
    ``name``, ``temporary``, ``bytes``, ``records``, ``sha256``."""
    from pyarrow import fs as pafs

    rows = decide(pages, page_id, url, html, least)
    narrow = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.octet_length(F.coalesce(F.col(html), F.lit(""))).cast("long").alias("n_bytes")
    )
    dealt = rows.withColumn("shard", _shard(narrow, shard_bytes)).repartition("shard")
    dealt = dealt.sortWithinPartitions("shard", "page_id", "url", "digest")
    fields = ("shard", "page_id", "url", "html", "digest", "n_bytes", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        fs.create_dir(root, recursive=True)
        done = []
        for shard, group in groupby((r for b in batches for r in _rows(b, fields)), key=lambda r: r[0]):
            file, number = None, 0
            for _, page, url, html, digest, n_bytes, refers in group:
                if file is None:
                    file = _File(fs, root, f"{shard:07d}-{number:05d}.warc.gz", attempt)
                payload = (html or "").encode("utf-8", "surrogatepass")
                file.add(_member(record(page, url, payload, digest, n_bytes, refers), level))
                if file.size >= roll_bytes:
                    done.append(file.close())
                    file, number = None, number + 1
            if file is not None:
                done.append(file.close())
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], ["name", "temporary", "bytes", "records", "sha256"])

    manifest = cut(dealt.mapInArrow(run, "name string, temporary string, bytes long, records long, sha256 string"))

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary, size in _rows(batch, ("name", "temporary", "bytes")):
                if fs.get_file_info(f"{root}/{temporary}").type != pafs.FileType.NotFound:
                    fs.move(f"{root}/{temporary}", f"{root}/{name}")
                if fs.get_file_info(f"{root}/{name}").size != size:
                    raise OSError(f"{name} isn't as written")
            yield batch

    committed = manifest.mapInArrow(commit, manifest.schema)
    committed.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/manifest")
    fs, root = pafs.FileSystem.from_uri(folder)
    for info in fs.get_file_info(pafs.FileSelector(root)):
        if info.base_name.endswith(".tmp"):
            fs.delete_file(info.path)
    return pages.sparkSession.read.schema(manifest.schema).parquet(f"{folder.rstrip('/')}/manifest")


def _rows(batch: pa.RecordBatch, fields: tuple[str, ...]) -> Iterator[tuple]:
    return zip(*(batch.column(f).to_pylist() for f in fields))


def _members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Contents of the gzip members of a stream, one at a time."""
    rest, open_member, parts = b"", None, []
    while True:
        raw = rest or stream.read(chunk)
        rest = b""
        if not raw:
            if open_member is not None:
                raise ValueError("the archive ends inside a record")
            return
        open_member = open_member or zlib.decompressobj(31)
        parts.append(open_member.decompress(raw))
        if open_member.eof:
            yield b"".join(parts)
            rest, open_member, parts = open_member.unused_data, None, []


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, with its block digest checked."""
    head, _, body = raw.partition(CRLF * 2)
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = body[: int(headers["Content-Length"])]
    if base64.b32encode(hashlib.sha1(block).digest()).decode() != headers["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"block digest of {headers['WARC-Record-ID']} differs")
    return headers, block


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives in the manifest: ``page_id``, ``url``, ``record_type``, ``payload_bytes``,
    ``payload_digest`` (hex), ``refers_to`` and, if wanted, ``payload``."""
    from pyarrow import fs as pafs

    manifest = spark.read.parquet(f"{folder.rstrip('/')}/manifest").select("name")
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", *(["payload"] if payloads else [])]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), *([pa.binary()] if payloads else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for (name,) in _rows(batch, ("name",)):
                held, size = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for raw in _members(stream):
                        h, block = parse(raw)
                        kind, digest, n = h["WARC-Type"], base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex(), int(h["X-Payload-Length"])
                        if kind == "response":  # a response proves its payload, a revisit quotes it
                            n, digest = len(block), hashlib.sha1(block).hexdigest()
                        row = (number(h.get("X-Page-ID")), h.get("WARC-Target-URI"), kind, n, digest, number(h.get("X-Refers-To-Page-ID")), block)
                        held.append(row[: len(names)])
                        size += len(block) if payloads else 0
                        if len(held) >= 5_000 or size >= 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * payloads
    return manifest.repartition(max(1, manifest.count()), "name").mapInArrow(run, schema)
