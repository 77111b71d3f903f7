"""What the operators of this subpackage share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.session import scratch_path

#: Rows of an Arrow batch; whole texts of this many documents are in memory at once.
BATCH_ROWS = 500
#: A key with more than this share of the rows is hot. There are at most 1/share of them.
HOT_SHARE = 0.001
#: Parts into which a hot key is split.
SALTS = 256

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, whatever the length of the texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def save(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of a text column, one value at a time; null is empty."""
    values = batch.column(batch.schema.get_field_index(column))
    for value in values.cast(pa.binary()):
        yield value.as_py() or b""


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, schema.field(k).type)
         for k, v in columns.items()],
        schema=schema,
    )


def row_key(doc_id, text: bytes) -> bytes:
    """Identity of a row: its doc_id and its text. Rows equal in both are repeated rows."""
    return hashlib.sha256(b"%s\0" % str(doc_id).encode() + text).digest()


def bring_back(
    rows: DataFrame, groups: DataFrame, key: str, size: str, salt_by: Column, how: str = "left",
) -> DataFrame:
    """Join `rows` with `groups` (one row per `key`, of `size` rows) without a hot task.

    Keys above `HOT_SHARE` of all rows are split: their group is repeated per salt
    and their rows are dealt by `salt_by`. The list of hot keys is broadcast; it
    has at most 1/HOT_SHARE entries. `groups` must be stored, as it is read twice.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.where(F.col(size) > max(1, int(total * HOT_SHARE))).select(
        F.col(key).alias("_hot_key"))
    is_hot = F.col("_hot_key").isNotNull()
    dealt = (
        rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(salt_by), F.lit(SALTS)))
                    .otherwise(0).cast("int"))
        .drop("_hot_key")
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = (
        groups.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_salt", F.explode(copies)).drop("_hot_key")
    )
    return dealt.join(spread, [key, "_salt"], how).drop("_salt")


def only_columns(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns alone, so that no other column can clash."""
    return docs.select(*[F.col(f"`{c}`") for c in needed])


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until `df` has no such column, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])
