"""Bloom filters over digests, built by Spark tasks and merged by segments.

Keys beyond one filter's bound are cut into ranges with a filter each, see `flag_repeats`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.common import bounded_batches
from tallyframe.session import scratch_path

#: Bits per key, and the most bits of one filter (32 MiB). A fuller filter lets more
#: rows through to the exact step; no result depends on it.
BITS_PER_KEY = 16
MAX_BITS = 1 << 28
MIN_BITS = 1 << 16
HASHES = 4
SEGMENT_BYTES = 2048
#: Parts in which the tasks' copies of one segment are merged first.
PARTS = 32
#: Ranges whose filters are built at the same time.
AT_ONCE = 4


def filter_bits(keys: int) -> int:
    """A power of two with about `BITS_PER_KEY` bits for each key, within the bounds."""
    bits = MIN_BITS
    while bits < min(MAX_BITS, BITS_PER_KEY * keys):
        bits *= 2
    return bits


def range_count(keys: int) -> int:
    """Ranges, a power of two, of which each has room for its share of the keys in one filter."""
    ranges = 1
    while BITS_PER_KEY * keys > MAX_BITS * ranges:
        ranges *= 2
    return ranges


def positions(digests: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions (rows, HASHES) of 32-byte digests given as (rows, 4) uint64."""
    first, step = digests[:, 0], digests[:, 1] | np.uint64(1)
    with np.errstate(over="ignore"):
        spots = first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (spots & np.uint64(bits - 1)).astype(np.int64)


def digest_rows(column: pa.Array) -> np.ndarray:
    joined = b"".join(v.as_py() for v in column)
    return np.frombuffer(joined, np.uint64).reshape(-1, 4)


@dataclass(frozen=True)
class Bloom:
    """A filter of `bits` bits; `held` is the broadcast array of its bytes."""

    bits: int
    held: Any

    def may_have(self, digests: np.ndarray) -> np.ndarray:
        spots = positions(digests, self.bits)
        return ((self.held.value[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1).all(axis=1)

    def release(self) -> None:
        """Drop the broadcast, when nothing that uses it is left to compute."""
        self.held.destroy()


def merge_two(once_a, twice_a, once_b, twice_b):
    """Saturating sum of two counters with the states never, once, twice or more."""
    return once_a | once_b, twice_a | twice_b | (once_a & once_b)


def build(keys: DataFrame, column: str, count: int, repeated: bool) -> Bloom:
    """A filter of the 32-byte digests in `column`, of those that may repeat if `repeated`.

    Each task counts its own digests per bit (never, once, more often); segments of
    the counters are summed by key, in two rounds, so that no task sees more than a
    part of one segment's copies. The driver gets the finished filter, whose size
    has the fixed bound MAX_BITS / 8.
    """
    spark, bits = keys.sparkSession, filter_bits(count)
    bounded_batches(spark)
    schema = pa.schema([("segment", pa.int32()), ("part", pa.int32()),
                        ("once", pa.binary()), ("twice", pa.binary())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        part = None
        for batch in batches:
            if not batch.num_rows:
                continue
            digests = digest_rows(batch.column(0))
            part = int(digests[0, 2] % PARTS) if part is None else part
            spots, n = np.unique(positions(digests, bits), return_counts=True)
            byte, bit = spots >> 3, (1 << (spots & 7)).astype(np.uint8)
            again = (n > 1) | ((once[byte] & bit) > 0)
            np.bitwise_or.at(twice, byte[again], bit[again])
            np.bitwise_or.at(once, byte, bit)
        rows = once.reshape(-1, SEGMENT_BYTES)
        live = np.flatnonzero(rows.any(axis=1))
        for at in range(0, len(live), 256):
            some = live[at:at + 256]
            yield pa.RecordBatch.from_arrays([
                pa.array(some.astype(np.int32)), pa.array([part] * len(some), pa.int32()),
                pa.array([rows[i].tobytes() for i in some], pa.binary()),
                pa.array([twice[i * SEGMENT_BYTES:(i + 1) * SEGMENT_BYTES].tobytes()
                          for i in some], pa.binary()),
            ], schema=schema)

    def merge(part: pa.Table) -> pa.Table:
        once, twice = np.zeros(SEGMENT_BYTES, np.uint8), np.zeros(SEGMENT_BYTES, np.uint8)
        for a, b in zip(part["once"], part["twice"], strict=True):
            once, twice = merge_two(once, twice, np.frombuffer(a.as_py(), np.uint8),
                                    np.frombuffer(b.as_py(), np.uint8))
        return pa.table({"segment": part["segment"][:1], "part": part["part"][:1],
                         "once": pa.array([once.tobytes()], pa.binary()),
                         "twice": pa.array([twice.tobytes()], pa.binary())})

    form = "segment int, part int, once binary, twice binary"
    merged = (
        keys.select(F.col(column).alias("k")).mapInArrow(local, form)
        .groupBy("segment", "part").applyInArrow(merge, form)
        .groupBy("segment").applyInArrow(merge, form)
    )
    held = np.zeros(bits // 8, np.uint8)
    for row in merged.select("segment", "twice" if repeated else "once").collect():
        at = row[0] * SEGMENT_BYTES
        held[at:at + SEGMENT_BYTES] = np.frombuffer(row[1], np.uint8)
    return Bloom(bits, spark.sparkContext.broadcast(held))


def with_flag(df: DataFrame, column: str, bloom: Bloom, out: str) -> DataFrame:
    """Add the boolean `out`: whether the filter may have the digest in `column`."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BooleanType())])
    at = df.columns.index(column)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = bloom.may_have(digest_rows(batch.column(at))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(flags, pa.bool_())], names=[*batch.schema.names, out])

    return df.mapInArrow(test, schema)


def flag_repeats(rows: DataFrame, column: str, count: int, out: str) -> DataFrame:
    """Add the boolean `out`: whether the 32-byte digest in `column` may repeat in the `count` rows.

    While one filter has BITS_PER_KEY bits for every row, it does. Beyond, the rows are
    written once more, each task dealing its own into files of digest ranges, which shuffles
    nothing; a range is then read alone, gets a filter of its own, is flagged and stored.
    So the bits per key stay the same at any size, a task merges copies of its range only,
    and AT_ONCE filters are alive at a time. `rows` must be stored.
    """
    ranges = range_count(count)
    if ranges == 1:
        return with_flag(rows, column, build(rows, column, count, repeated=True), out)
    spark = rows.sparkSession
    dealt = rows.withColumn("_range", F.pmod(F.xxhash64(column), F.lit(ranges)).cast("int"))
    sizes = {r["_range"]: r["n"] for r in dealt.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    split, flagged = scratch_path(spark, "digest-ranges"), scratch_path(spark, "flagged")
    # files are tasks times ranges at most, so the tasks are kept as few as the ranges
    dealt.coalesce(max(spark.sparkContext.defaultParallelism, ranges)).write.partitionBy("_range").parquet(split)

    def flag(number: int) -> str:
        part = spark.read.schema(rows.schema).parquet(f"{split}/_range={number}")
        found = build(part, column, sizes[number], repeated=True)
        path = f"{flagged}/{number}"
        with_flag(part, column, found, out).write.parquet(path)
        found.release()
        return path

    with ThreadPool(AT_ONCE) as pool:
        paths = pool.map(flag, sorted(sizes), chunksize=1)
    return spark.read.parquet(*paths)
