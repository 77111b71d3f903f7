"""Exact dedup by two-pass Bloom filtering.

The first pass hashes every text and counts the hashes in a Bloom filter with the
states never, once, more often. The second pass tests every hash: rows whose hash
cannot repeat pass straight through, and only the others shuffle, to be grouped
exactly. Hashes beyond the bound of one filter are cut into ranges with a filter each.

Texts are equal when identical after lower-casing A-Z; a null text is an empty one.
Of equal texts the row with the largest doc_id stays (a null doc_id is smaller than
any other); of rows that also share the doc_id, one. Empty tables give empty
results; other columns are ignored by `decide` and kept by `apply`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm import bloom
from tallyframe.llm.common import (
    batch_of, bounded_batches, bring_back, only_columns, row_key, save, texts,
)


def hashes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, rid (a row number), sha (of the normalised text), row_key."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.binary()), ("row_key", pa.binary())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            raw = list(texts(batch))
            yield batch_of(schema, {
                "doc_id": ids,
                # lower() of bytes changes A-Z alone
                "sha": [hashlib.sha256(t.lower()).digest() for t in raw],
                "row_key": [row_key(i.as_py(), t) for i, t in zip(ids, raw, strict=True)],
            })

    made = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        digest, "doc_id bigint, sha binary, row_key binary")
    return save(made.withColumn("rid", F.monotonically_increasing_id()), "text-hashes")


def decide(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, rid, sha, row_key, keep_id, group_size, kept."""
    rows = hashes(docs)
    flagged = bloom.flag_repeats(rows, "sha", rows.count(), "maybe")
    straight = flagged.where(~F.col("maybe")).select(
        *rows.columns, F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    # `max` over structs puts null first, as the contract of ties asks.
    candidates = flagged.where("maybe").drop("maybe")
    groups = save(
        candidates.groupBy("sha").agg(
            F.max(F.struct("doc_id", "rid")).alias("top"), F.count("*").alias("group_size"))
        .select("sha", F.col("top.doc_id").alias("keep_id"), F.col("top.rid").alias("keep_rid"),
                "group_size"),
        "copy-groups",
    )
    grouped = bring_back(candidates, groups, "sha", "group_size", F.col("rid"), "inner").select(
        *rows.columns, "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
    )
    return straight.unionByName(grouped)


def row_identity(text: str = "text") -> Column:
    """`row_key` computed by Spark's own functions from the columns doc_id and `text`."""
    return F.unhex(F.sha2(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("None")).cast("binary"), F.lit(b"\0"),
        F.coalesce(F.col(text), F.lit("")).cast("binary")), 256))


def without(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of `docs` whose decision is `kept`, in all their columns.

    `decisions` has row_key, rid and kept for each row; rows without a decision stay. Texts
    of kept rows do not shuffle: a Bloom filter of the dropped row keys lets them pass, and
    the few rows it holds meet the exact list. Of rows that repeat in doc_id and text, as
    many stay as were kept: the first one by the JSON of the whole row. The given columns
    travel in one struct, so none can clash.
    """
    judged = save(
        decisions.groupBy("row_key").agg(
            F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("stay"))
        .where("stay < n"),
        "dropped-rows",
    )
    held = bloom.build(judged, "row_key", judged.count(), repeated=False)
    packed = docs.select(
        row_identity().alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given"))
    flagged = bloom.with_flag(packed, "row_key", held, "maybe")
    held_rows = flagged.where("maybe")
    result = flagged.where("NOT maybe").select("given").unionByName(
        held_rows.join(judged, "row_key", "left_anti").select("given"))
    partly = judged.where("stay > 0").select("row_key")
    if not partly.isEmpty():  # repeated rows: equal in doc_id and text
        result = result.unionByName(
            held_rows.join(partly, "row_key").groupBy("row_key")
            .agg(F.min_by("given", F.to_json("given")).alias("given")).select("given"))
    return result.select("given.*")


def apply(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    return without(docs, decide(only_columns(docs, "doc_id", "text")))
