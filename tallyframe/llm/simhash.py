"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints: A-Z lower-cased, words between ASCII white space, shingles of
`shingle` words (a shorter text is one shingle, an empty or null one has
fingerprint zero), XXH64 with seed 42; a bit is 1 if set in over half the shingles.

Search: bit i of a fingerprint has the vector phi(i), cycling through the non-zero
vectors of GF(2)^(radius+1). For every non-zero v of that space there is one table,
masked to the bits with <phi(i), v> = 1. Up to `radius` differing bits span less
than the whole space, so some v is orthogonal to all of them and the pair collides
in v's table: no pair within the radius is missed. Fingerprints alone in a bucket leave
its table. In each table the others are linked through hubs: each is written under itself
and its changes in one bit (for radius 2) that the table's mask leaves open; such a change
stays in the bucket. Two fingerprints under one hub of a table differ in at most two bits,
and the two bits of a pair that collides there lead both to one hub. The distance is
verified there, and a link names its table. A hub holds at most 1 + 28 or so fingerprints
whatever the size of a bucket, so no bucket is gathered and no pairs of it are listed.

Equal fingerprints are one node. Null doc_ids never name a component unless it has
no other. Repeated rows are linked like any others; an empty table gives no rows. Other
columns are ignored by `group` and kept by `apply`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm import exact_dedup
from tallyframe.llm.common import (
    batch_of, bounded_batches, bring_back, only_columns, row_key, save, texts,
)
from tallyframe.llm.graph import connected_components

BITS = 64
SEED = 42
#: Shingles whose bits are counted at once (64 bytes each).
CHUNK = 1 << 15


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()  # bytes: A-Z alone, and ASCII white space alone
    if not words:
        return []
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-shingle]]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=True)]


def fingerprint(hashes: list[int]) -> int:
    """The bits set in over half of the hashes; zero for none."""
    values = np.array(hashes, dtype=">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(values), CHUNK):
        part = np.unpackbits(values[at:at + CHUNK].view(np.uint8)).reshape(-1, BITS)
        ones += part.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(values)).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """Per row: doc_id, rid, row_key, fp (the fingerprint as a signed long)."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.binary()), ("fp", pa.int64())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = list(texts(batch))
            yield batch_of(schema, {
                "doc_id": batch.column(0),
                "row_key": [row_key(i.as_py(), t) for i, t in zip(batch.column(0), raw, strict=True)],
                "fp": [signed(fingerprint(shingle_hashes(t, shingle))) for t in raw],
            })

    made = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        make, "doc_id bigint, row_key binary, fp bigint")
    return save(made.withColumn("rid", F.monotonically_increasing_id()), "fingerprints")


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks of which any `radius` bits miss at least one entirely."""
    size = 1 << (radius + 1)
    return [
        sum(1 << i for i in range(BITS) if ((i % (size - 1) + 1) & v).bit_count() % 2)
        for v in range(1, size)
    ]


def near_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (u, v, t) between distinct fingerprints `fp` of at most `radius` bits' distance.

    `t` is the covering table in which the link was found. Links join exactly the pairs'
    components: fingerprints of one hub are linked to its least. `radius` is 1 or 2, so
    that hubs lie one bit away.
    """
    if radius not in (1, 2):
        raise ValueError("the radius must be 1 or 2 bits")
    masks = covering_masks(radius)
    bits = [F.lit(signed(m)) for m in masks]
    placed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(m).alias("key"))
        for k, m in enumerate(bits)])).alias("b")).select("fp", "b.t", "b.key")
    placed = save(placed, "buckets")
    shared = save(
        placed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
        .select(F.struct("t", "key").alias("bucket"), "n"), "shared-buckets")
    alive = bring_back(
        placed.select("fp", "t", F.struct("t", "key").alias("bucket")), shared, "bucket", "n",
        F.col("fp"), "inner")
    open_bits = F.element_at(F.array(*[F.bitwise_not(m) for m in bits]), F.col("t") + 1)
    flips = F.filter(
        F.array(*[F.lit(signed(1 << i)) for i in range(BITS)]),
        lambda bit: open_bits.bitwiseAND(bit) != 0)
    changed = F.transform(flips, lambda bit: F.col("fp").bitwiseXOR(bit))
    if radius == 1:  # a hub would link pairs two bits apart, so one side stays unchanged
        near = alive.select("t", F.col("fp").alias("u"), F.explode(changed).alias("v"))
        links = near.join(alive.select("t", F.col("fp").alias("v")), ["t", "v"], "left_semi")
    else:
        under = alive.select("t", "fp", F.explode(F.concat(F.array("fp"), changed)).alias("hub"))
        met = under.groupBy("t", "hub").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        links = met.select("t", F.explode("fps").alias("u"), F.array_min("fps").alias("v")).where("u <> v")
    return links.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius).select("u", "v", "t")


def group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Per row: doc_id, rid, row_key, fp, component_id, kept (one row of each component)."""
    rows = fingerprints(docs, shingle)
    prints = save(
        rows.groupBy("fp").agg(
            F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first")),
        "distinct-fingerprints")
    roots = save(connected_components(near_links(prints, radius)), "components")
    linked = roots.join(prints.select(F.col("fp").alias("node"), "first"), "node")
    least = save(
        linked.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("size")),
        "component-firsts")
    named = bring_back(roots, least, "root", "size", F.col("node"), "inner").select(
        F.col("node").alias("fp"), "least")
    complete = save(
        prints.join(named, "fp", "left").withColumn("least", F.coalesce("least", "first"))
        .select("fp", "n", F.col("least.doc_id").alias("component_id"),
                F.col("least.rid").alias("least_rid")),
        "fingerprint-components")
    return bring_back(rows, complete, "fp", "n", F.col("rid"), "inner").select(
        "doc_id", "rid", "row_key", "fp", "component_id",
        (F.col("rid") == F.col("least_rid")).alias("kept"))


def apply(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each component, the one of smallest doc_id, with all its columns."""
    return exact_dedup.without(docs, group(only_columns(docs, "doc_id", "text"), shingle, radius))
