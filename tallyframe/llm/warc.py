"""WARC archives of captured pages, read back through an externally merged index.

`write` makes gzipped WARC 1.1 files, one member per record, in a folder of any file system
that pyarrow opens (local, NFS, hdfs, s3, gs). A task writes to names of its own; only files
named in the stored manifest count, so a repeated task or a lost executor leaves no half file
behind that is read. A payload of `min_bytes` or more that was captured before is written as a
revisit record, which has headers only; payloads of revisits are never moved.

`read` parses archives (gzipped by record, gzipped as a whole, or plain), one file per task.

`index` makes the capture index by an external merge. The records of each archive are sorted
in their task: a run, cut into blocks of lines `urlkey timestamp {json}`. Every T-th of all
first lines of blocks, in order, is a splitter, so a range between splitters has at most the
lines of T blocks and one block per run, even if one url has most of all captures. A range is
merged from its runs by a tree of losers; the order is that of whole lines. `histories` types
the lines and numbers them: `position` over all, `capture` within a url key.

Defined cases. Null html is empty. A null url has the empty url key and no Target-URI header.
Control characters and blanks in a url are percent-encoded. A null page_id is smaller than any
other. Of repeated rows with a payload of `min_bytes`, one is the response and the others
revisit it. An empty table gives no archive and an empty index. Records without payload digest
get the digest of what was read; one whose payload differs from its digest raises. Columns
other than page_id, url, html and the capture time are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.llm import exact_dedup
from tallyframe.llm.common import bounded_batches, bring_back, save
from tallyframe.operators.ordering import running_sum
from tallyframe.session import scratch_path

#: Shortest payload that can be a revisit, and compressed bytes after which a file is closed.
MIN_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
#: Lines of a block; blocks of a range at least; ranges at most.
BLOCK_LINES = 256
RANGE_BLOCKS = 256
MOST_RANGES = 10_000
READ_BYTES = 1 << 20
FIRST_CAPTURE = 1_577_836_800  # 2020-01-01, for tables without a capture time


def opened(uri: str) -> tuple[files.FileSystem, str]:
    return files.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def default_time() -> Column:
    """A capture time for tables that have none: a second per page_id."""
    return F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(10**9))


# ---------------------------------------------------------------- records

def header(kind: str, fields: Sequence[tuple[str, str | int | None]], length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{k}: {v}" for k, v in fields if v is not None]
    return "\r\n".join([*lines, f"Content-Length: {length}", "", ""]).encode()


def clean_url(url: str | None) -> str | None:
    return None if url is None else re.sub(
        "[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: `com,example,www)/a?b`, in lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    if not host:
        return url.split("#")[0].lower()
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    place = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}{place}){parts.path or '/'}{query}".lower()


def http_head(payload_bytes: int) -> bytes:
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {payload_bytes}\r\n\r\n").encode()


def record_urn(*identity: object) -> str:
    raw = hashlib.sha256("\0".join(map(str, identity)).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=raw[:16], version=5)}>"


def sha1_field(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def sha1_hex(field: str) -> str:
    """The hex digits of a `sha1:` field in base 32 or 16."""
    value = field.removeprefix("sha1:")
    return value.lower() if len(value) == 40 else base64.b32decode(value).hex()


def warc_time(seconds: int) -> str:
    from datetime import datetime, timezone

    return datetime.fromtimestamp(seconds, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def member(record: bytes) -> bytes:
    engine = zlib.compressobj(6, zlib.DEFLATED, 31)
    return engine.compress(record) + engine.flush()


def decide(pages: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(responses with html, revisits without): which record each page becomes."""
    identity = F.to_json(F.struct("page_id", "url", "captured"), {"ignoreNullFields": "false"})
    docs = pages.withColumn("doc_id", identity).withColumnRenamed("html", "text")
    keyed = docs.select("page_id", "url", "captured", exact_dedup.row_identity().alias("row_key"),
                        F.sha2("text", 256).alias("sha"), F.sha1("text").alias("sha1"),
                        F.octet_length("text").cast("bigint").alias("bytes"))
    rows = save(keyed.withColumn("rid", F.monotonically_increasing_id()), "captures")
    long_rows = rows.where(F.col("bytes") >= min_bytes)
    groups = save(long_rows.groupBy("sha").agg(
        F.max(F.struct("page_id", "rid", "row_key", "url", "captured")).alias("top"),
        F.count("*").alias("n")).where("n > 1"), "copies")
    judged = save(bring_back(long_rows, groups, "sha", "n", F.col("rid"), "inner")
                  .withColumn("kept", F.col("rid") == F.col("top.rid")), "capture-decisions")
    responses = exact_dedup.without(docs, judged).withColumnRenamed("text", "html")
    return responses, judged.where("NOT kept")


def write(
    pages: DataFrame, folder: str | None = None, captured: Column | None = None,
    min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write an archive of `pages` (page_id, url, html); the manifest: path, records, bytes.

    `captured` gives the capture time in whole seconds since 1970.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = (folder or scratch_path(spark, "warc")).rstrip("/")
    given = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"),
        F.coalesce("html", F.lit("")).alias("html"),
        (captured if captured is not None else default_time()).cast("bigint").alias("captured"))
    responses, revisits = decide(given, min_bytes)
    none = F.lit(None)
    rows = responses.select(
        "page_id", "url", "captured", F.col("html"), exact_dedup.row_identity(text="html").alias("row_key"),
        none.cast("bigint").alias("rid"), none.cast("string").alias("sha1"),
        none.cast("bigint").alias("bytes"), none.cast("binary").alias("top_key"),
        none.cast("bigint").alias("top_id"), none.cast("string").alias("top_url"),
        none.cast("bigint").alias("top_captured"),
    ).unionByName(revisits.select(
        "page_id", "url", "captured", none.cast("string").alias("html"), "row_key", "rid", "sha1", "bytes",
        F.col("top.row_key").alias("top_key"), F.col("top.page_id").alias("top_id"),
        F.col("top.url").alias("top_url"), F.col("top.captured").alias("top_captured")))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(folder)
        part, name, out, records = TaskContext.get().partitionId(), None, None, 0

        def entry():
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64()),
                 pa.array([size], pa.int64())], names=["path", "records", "bytes"])

        for batch in batches:
            for row in rows_of(batch):
                if out is not None and out.tell() >= archive_bytes:
                    yield entry()
                    out = None
                if out is None:
                    system.create_dir(path, recursive=True)
                    name, records = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(member(info_record(name)))
                out.write(member(page_record(row, min_bytes, f"{name}:{records}")))
                records += 1
        if out is not None:
            yield entry()

    return save(rows.mapInArrow(archive, "path string, records bigint, bytes bigint"), "manifest")


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def info_record(name: str) -> bytes:
    block = b"software: page archiver\r\nformat: WARC File Format 1.1\r\n"
    return header("warcinfo", [
        ("WARC-Record-ID", record_urn(name)), ("WARC-Date", warc_time(FIRST_CAPTURE)),
        ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
    ], len(block)) + block + b"\r\n\r\n"


def page_record(row: dict, min_bytes: int, place: str) -> bytes:
    common = [("WARC-Date", warc_time(row["captured"])), ("WARC-Target-URI", clean_url(row["url"])),
              ("WARC-X-Page-ID", row["page_id"]), ("Content-Type", "application/http;msgtype=response")]
    if row["top_key"] is None:
        payload = row["html"].encode()
        # payloads that can be referred to are unique by identity, others need their place
        own = row["row_key"].hex() if len(payload) >= min_bytes else f"{row['row_key'].hex()}:{place}"
        head = http_head(len(payload))
        digest = sha1_field(hashlib.sha1(payload).digest())
        return b"".join([header("response", [
            ("WARC-Record-ID", record_urn(own)), *common, ("WARC-Payload-Digest", digest),
        ], len(head) + len(payload)), head, payload, b"\r\n\r\n"])
    head = http_head(row["bytes"])
    return header("revisit", [
        ("WARC-Record-ID", record_urn(row["row_key"].hex(), row["rid"])), *common,
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Payload-Digest", sha1_field(bytes.fromhex(row["sha1"]))),
        ("WARC-Refers-To", record_urn(row["top_key"].hex())),
        ("WARC-Refers-To-Target-URI", clean_url(row["top_url"])),
        ("WARC-Refers-To-Date", warc_time(row["top_captured"])),
        ("WARC-X-Refers-To-Page-ID", row["top_id"]),
    ], len(head)) + head + b"\r\n\r\n"


# ---------------------------------------------------------------- reading

@dataclass(frozen=True)
class Record:
    """One record: its place in the file (length None within a shared gzip member), headers, block."""

    offset: int
    length: int | None
    fields: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.fields.get("warc-type", "")

    def http(self) -> tuple[dict[str, str], bytes]:
        """HTTP headers and payload; a block that is no HTTP message is all payload."""
        if not self.fields.get("content-type", "").startswith("application/http"):
            return {}, self.block
        head, _, payload = self.block.partition(b"\r\n\r\n")
        return fields_of(head), payload


def fields_of(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k.strip()}


def take_record(buffer: bytearray) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and length of a whole record at the start of the buffer, if it is all there."""
    lead = 0
    while buffer[lead:lead + 2] == b"\r\n":
        lead += 2
    end = buffer.find(b"\r\n\r\n", lead)
    if end < 0:
        return None
    fields = fields_of(bytes(buffer[lead:end]))
    if not buffer[lead:lead + 5] == b"WARC/" or "content-length" not in fields:
        raise ValueError("not a WARC record")
    begin = end + 4
    stop = begin + int(fields["content-length"])
    if len(buffer) < stop + 4:
        return None
    return fields, bytes(buffer[begin:stop]), stop + 4


def read_records(stream, path: str) -> Iterator[Record]:
    """The records of one archive, read in pieces; raises if the last one is cut off."""
    buffer, begin, taken, held = bytearray(), 0, 0, None
    engine, shared = None, False
    first = True
    while chunk := stream.read(READ_BYTES):
        if first:
            engine = zlib.decompressobj(31) if chunk[:2] == b"\x1f\x8b" else None
            packed, first = engine is not None, False
        while chunk:
            done = False
            if packed:
                buffer += engine.decompress(chunk)
                taken += len(chunk) - len(engine.unused_data)
                chunk, done = engine.unused_data, engine.eof
            else:
                buffer += chunk
                chunk = b""
            while found := take_record(buffer):
                fields, block, size = found
                del buffer[:size]
                if not packed:
                    yield Record(begin, size, fields, block)
                    begin += size
                    continue
                if held:
                    shared = True
                    yield held
                held = Record(begin, None, fields, block)
            if done:
                if held:
                    yield held if shared else Record(begin, taken - begin, held.fields, held.block)
                held, shared, begin = None, False, taken
                engine = zlib.decompressobj(31)
    if bytes(buffer).strip(b"\r\n") or held:
        raise ValueError(f"{path} ends within a record")


def from_archives(paths: DataFrame, column: str, per_file: Callable, schema: str) -> DataFrame:
    """Apply `per_file(path, records)` to the archives named in a column, one file at a time."""
    named = paths.select(F.col(column).alias("path"))
    count = max(1, named.count())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = opened(path)
                with system.open_input_stream(place, compression=None) as stream:
                    yield from per_file(path, read_records(stream, path))

    return named.repartition(count).mapInArrow(each, schema)


def capture(path: str, record: Record) -> dict | None:
    """What the index keeps of a response or revisit; None for other records."""
    if record.kind not in ("response", "revisit"):
        return None
    http, payload = record.http()
    stated = record.fields.get("warc-payload-digest", "")
    if record.kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if stated.startswith("sha1:") and sha1_hex(stated) != digest:
            raise ValueError(f"{path}: the payload at {record.offset} differs from its digest")
    else:
        size, digest = int(http.get("content-length", 0)), sha1_hex(stated)

    def number(name: str) -> int | None:
        return int(record.fields[name]) if name in record.fields else None

    return {
        "page_id": number("warc-x-page-id"), "url": record.fields.get("warc-target-uri"),
        "type": record.kind, "digest": digest, "bytes": size,
        "refers_to": number("warc-x-refers-to-page-id"), "path": path, "offset": record.offset,
        "length": record.length,
    }


def read(paths: DataFrame, column: str = "path") -> DataFrame:
    """The payloads of all responses: page_id, url, digest, payload (null where not UTF-8)."""
    def rows(path: str, records: Iterator[Record]) -> Iterator[pa.RecordBatch]:
        for record in records:
            found = capture(path, record)
            if found is not None and found["type"] == "response":
                try:
                    text = record.http()[1].decode()
                except UnicodeDecodeError:
                    text = None
                yield pa.RecordBatch.from_arrays([
                    pa.array([found["page_id"]], pa.int64()), pa.array([found["url"]], pa.string()),
                    pa.array([found["digest"]], pa.string()), pa.array([text], pa.string()),
                ], names=["page_id", "url", "digest", "payload"])

    return from_archives(paths, column, rows, "page_id bigint, url string, digest string, payload string")


# ---------------------------------------------------------------- the index

class LoserTree:
    """Merge sorted iterators: each inner node keeps the loser of the match played there."""

    def __init__(self, runs: Sequence[Iterator[str]]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        k = len(self.runs)
        self.nodes = [0] * max(k, 1)
        won = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = won[2 * node], won[2 * node + 1]
            won[node], self.nodes[node] = (a, b) if self.beats(a, b) else (b, a)
        self.winner = won[1] if k > 1 else 0

    def beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None
        return (x, a) < (y, b)

    def __iter__(self) -> Iterator[str]:
        k = len(self.runs)
        while k and self.heads[self.winner] is not None:
            now = self.winner
            yield self.heads[now]
            self.heads[now] = next(self.runs[now], None)
            node = (now + k) // 2
            while node:
                if self.beats(self.nodes[node], now):
                    self.nodes[node], now = now, self.nodes[node]
                node //= 2
            self.winner = now


def line_of(found: dict, record: Record) -> str:
    stamp = re.sub("[^0-9]", "", record.fields.get("warc-date", ""))[:14]
    return f"{url_key(found['url'])} {stamp} {json.dumps(found, ensure_ascii=False)}"


def runs(paths: DataFrame, column: str, block_lines: int) -> DataFrame:
    """The sorted run of each archive in blocks: run, block, first, n, lines."""
    def rows(path: str, records: Iterator[Record]) -> Iterator[pa.RecordBatch]:
        lines = sorted(line_of(found, r) for r in records if (found := capture(path, r)) is not None)
        for block, at in enumerate(range(0, len(lines), block_lines)):
            some = lines[at:at + block_lines]
            yield pa.RecordBatch.from_arrays([
                pa.array([path]), pa.array([block], pa.int32()), pa.array([some[0]]),
                pa.array([len(some)], pa.int64()), pa.array([some], pa.list_(pa.string())),
            ], names=["run", "block", "first", "n", "lines"])

    return save(from_archives(
        paths, column, rows, "run string, block int, first string, n bigint, lines array<string>"), "runs")


def splitters(blocks: DataFrame, range_blocks: int) -> list[str]:
    """Every T-th of the first lines of blocks; at most MOST_RANGES."""
    count = blocks.count()
    step = max(range_blocks, math.ceil(count / MOST_RANGES))
    if count <= step:
        return []
    order = [F.col(c) for c in ("first", "run", "block")]
    numbered = running_sum(blocks.select("first", "run", "block"), F.lit(1), order, "place")
    at = numbered.where((F.col("place") > 1) & (F.col("place") % step == 0)).select("first").distinct()
    return sorted(r[0] for r in at.collect())


def index(
    paths: DataFrame, column: str = "path", block_lines: int = BLOCK_LINES,
    range_blocks: int = RANGE_BLOCKS,
) -> DataFrame:
    """The merged index of archives: range, at (from 0 in the range), capture_here, line."""
    blocks = runs(paths, column, block_lines)
    cuts = splitters(blocks, range_blocks)
    held = paths.sparkSession.sparkContext.broadcast(cuts)  # at most MOST_RANGES lines
    bounded_batches(paths.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["range", "run", "block", "lines"]
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            for run, block, lines in zip(
                    *[batch.column(c).to_pylist() for c in ("run", "block", "lines")], strict=True):
                begin = 0
                while begin < len(lines):
                    place = bisect_right(held.value, lines[begin])
                    end = len(lines)
                    if place < len(held.value) and lines[-1] >= held.value[place]:
                        end = next(i for i in range(begin, len(lines)) if lines[i] >= held.value[place])
                    for name, v in zip(names, (place, run, block, lines[begin:end]), strict=True):
                        out[name].append(v)
                    begin = end
            yield pa.RecordBatch.from_arrays([
                pa.array(out["range"], pa.int32()), pa.array(out["run"], pa.string()),
                pa.array(out["block"], pa.int32()), pa.array(out["lines"], pa.list_(pa.string())),
            ], names=names)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        here: dict[str, list[list[str]]] = {}

        def merged() -> Iterator[pa.RecordBatch]:
            sources = [(line for block in here[run] for line in block) for run in sorted(here)]
            key, number, lines, numbers, start = None, 0, [], [], 0
            for line in LoserTree(sources):
                own = line.split(" ", 1)[0]
                number = number + 1 if own == key else 1
                key = own
                lines.append(line)
                numbers.append(number)
                if len(lines) == 4096:
                    yield batch_out(start, lines, numbers)
                    start, lines, numbers = start + len(lines), [], []
            if lines:
                yield batch_out(start, lines, numbers)

        def batch_out(start: int, lines: list[str], numbers: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([now] * len(lines), pa.int32()),
                pa.array(range(start, start + len(lines)), pa.int64()),
                pa.array(numbers, pa.int64()), pa.array(lines, pa.string()),
            ], names=["range", "at", "capture_here", "line"])

        for batch in batches:
            for place, run, lines in zip(
                    *[batch.column(c).to_pylist() for c in ("range", "run", "lines")], strict=True):
                if place != now:
                    yield from merged()
                    now, here = place, {}
                here.setdefault(run, []).append(lines)
        yield from merged()

    pieces = blocks.mapInArrow(deal, "range int, run string, block int, lines array<string>")
    return save(
        pieces.repartition(len(cuts) + 1, "range").sortWithinPartitions("range", "run", "block")
        .mapInArrow(merge, "range int, at bigint, capture_here bigint, line string"), "merged-index")


FIELDS = "page_id bigint, url string, type string, digest string, bytes bigint, refers_to bigint, " \
         "path string, offset bigint, length bigint"


def histories(merged: DataFrame) -> DataFrame:
    """Typed captures in order: position, url_key, capture (from 1 per url key), timestamp, FIELDS."""
    spark: SparkSession = merged.sparkSession
    key = F.substring_index("line", " ", 1)
    pieces = merged.groupBy("range").agg(
        F.count("*").alias("n"), F.min_by(key, "at").alias("first"),
        F.max_by(F.struct(key.alias("key"), "capture_here"), "at").alias("last")).collect()
    position, open_key, open_count, rows = 0, None, 0, []
    for piece in sorted(pieces, key=lambda r: r.range):  # at most MOST_RANGES
        carried = open_count if piece.first == open_key else 0
        rows.append((piece.range, position, piece.first, carried))
        position += piece.n
        open_count = piece.last.capture_here + (carried if piece.last.key == piece.first else 0)
        open_key = piece.last.key
    offsets = F.broadcast(spark.createDataFrame(
        rows, "range int, before bigint, first_key string, carried bigint"))
    body = F.from_json(F.regexp_extract("line", "^[^ ]* [0-9]* (.*)$", 1), FIELDS)
    return (
        merged.join(offsets, "range")
        .select((F.col("before") + F.col("at")).alias("position"), key.alias("url_key"),
                (F.col("capture_here") + F.when(key == F.col("first_key"), F.col("carried"))
                 .otherwise(0)).alias("capture"),
                F.regexp_extract("line", "^[^ ]* ([0-9]*) ", 1).alias("timestamp"), body.alias("b"))
        .select("position", "url_key", "capture", "timestamp", "b.*")
    )


def report(pages: DataFrame, **options) -> DataFrame:
    """Write `pages` to archives, read them back; per page what its record says, in index order."""
    manifest = write(pages, **options)
    return histories(index(manifest)).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to", "url_key", "timestamp", "capture", "position")
