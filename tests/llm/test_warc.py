import gzip
import hashlib
import io
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F, types as T

from tallyframe.llm import warc

SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
LONG = "<p>é</p>" * 300
EDGE = [
    (1, "http://www.Example.com/a b?q=1#top", LONG), (2, "http://example.com/b", LONG),
    (2, "http://example.com/b", LONG), (3, None, None), (4, "http://[bad", ""), (5, "no url", "x" * 1000),
    (6, "no url", "x" * 1000), (7, "http://example.com/b", "x" * 999), (8, "http://example.com/b", "x" * 999),
    (None, "http://a.b/\r\nWARC-Type: evil", "y" * 2000), (9, "http://a.b/", "\r\n\r\nWARC/1.1\r\n" * 200),
    (10, "http://a.b:8080/", "z" * 3_000_000), (8, "http://example.com/b", "x" * 999),
]


def plain(rows):
    groups = defaultdict(list)
    for i, (page, _, html) in enumerate(rows):
        groups[html or ""].append((page is not None, page or 0, i))
    out = []
    for i, (page, _, html) in enumerate(rows):
        raw = (html or "").encode()
        top = max(groups[html or ""], key=lambda m: m[:2])
        same = [m for m in groups[html or ""] if m[:2] == top[:2]]
        revisit = len(raw) >= 1000 and i != same[0][2]
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                    top[1] if revisit else None))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("path", F.lit("clash")).withColumn(
        "row_key", F.lit(1)).withColumn("given", F.lit(2)).withColumn("doc_id", F.lit("a"))


def answer(spark, rows, **options):
    out = warc.report(frame(spark, rows), **options)
    return sorted((tuple(r[:5]) for r in out.collect()), key=str)


def test_records_match_brute_force(spark):
    assert answer(spark, EDGE) == plain(EDGE)
    assert answer(spark, EDGE, archive_bytes=1) == plain(EDGE)  # an archive per record


def test_nothing_is_archived(spark):
    assert answer(spark, []) == []


def test_many_copies_of_a_page(spark):
    rng = random.Random(2)
    rows = [(i, f"http://h/{i % 3}", rng.choice([LONG, "short", None, str(i) * 400])) for i in range(300)]
    assert answer(spark, rows) == plain(rows)


def test_payloads_come_back(spark):
    manifest = warc.write(frame(spark, EDGE))
    back = {(r.page_id, r.digest): r.payload for r in warc.read(manifest).collect()}
    kept = {(p, hashlib.sha1((h or "").encode()).hexdigest()): h or "" for p, _, h in EDGE
            if (p, h) not in ((1, LONG), (5, "x" * 1000))}
    assert back == kept


def test_archives_are_gzip_members_with_random_access(spark):
    manifest = warc.write(frame(spark, EDGE))
    captures = warc.histories(warc.index(manifest)).collect()
    for row in captures:
        system, path = warc.opened(row.path)
        with system.open_input_file(path) as file:
            file.seek(row.offset)
            record = gzip.decompress(file.read(row.length))
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + row.type.encode())
        assert b"\r\nWARC-Type: evil" not in record.split(b"\r\n\r\n")[0]
    urns = [r for p in {c.path for c in captures} for r in urns_of(p)]
    assert len(urns) == len(set(urns))


def urns_of(uri):
    system, path = warc.opened(uri)
    with system.open_input_stream(path, compression=None) as stream:
        return [r.fields["warc-record-id"] for r in warc.read_records(stream, path)]


@pytest.mark.parametrize("range_blocks", [1, 3, 1000])
def test_index_is_the_sorted_order_of_all_captures(spark, range_blocks):
    rng = random.Random(range_blocks)
    rows = [(i, f"http://h{rng.choice('aaaab')}.org/{rng.choice('xy')}", "t") for i in range(400)]
    pages = frame(spark, rows).repartition(9)
    merged = warc.index(warc.write(pages, captured=F.col("page_id") % 50), block_lines=8,
                        range_blocks=range_blocks)
    got = warc.histories(merged).orderBy("position").collect()
    lines = [r.line for r in merged.orderBy("range", "at").collect()]
    assert lines == sorted(lines) and [r.position for r in got] == list(range(400))
    seen = defaultdict(int)
    for row in got:
        seen[row.url_key] += 1
        assert row.capture == seen[row.url_key]
    assert [(r.url_key, r.timestamp) for r in got] == sorted((r.url_key, r.timestamp) for r in got)
    if range_blocks == 1:  # one url has most captures, yet no range has most of the lines
        counts = [r["count"] for r in merged.groupBy("range").count().collect()]
        assert max(counts) < 200 and len(counts) > 10


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(1)
    for k in range(9):
        runs = [sorted(rng.choice("abcdefgh") for _ in range(rng.randrange(6))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_other_archives_are_read():
    block = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nhello"
    one = warc.header("response", [("Content-Type", "application/http; msgtype=response"),
                                   ("WARC-Target-URI", "http://a/")], len(block)) + block + b"\r\n\r\n"
    for data in (one * 3, gzip.compress(one * 3), gzip.compress(one) * 3):
        records = list(warc.read_records(io.BytesIO(data), "x"))
        assert [r.http() for r in records] == [({"x": "y"}, b"hello")] * 3
    spots = [(r.offset, r.length) for r in warc.read_records(io.BytesIO(one * 2), "x")]
    assert spots == [(0, len(one)), (len(one), len(one))]
    for broken in (one[:-9], gzip.compress(one)[:-20], b"not an archive\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(broken), "x"))


def test_a_damaged_payload_raises():
    fields = {"warc-type": "response", "warc-payload-digest": warc.sha1_field(hashlib.sha1(b"a").digest())}
    with pytest.raises(ValueError):
        warc.capture("x", warc.Record(0, 1, fields, b"b"))


def test_url_keys():
    assert warc.url_key("http://www.Example.com/A?b=1#c") == "com,example)/a?b=1"
    assert warc.url_key("https://a.b:443/") == "b,a)/" and warc.url_key("http://a.b:81") == "b,a:81)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"
