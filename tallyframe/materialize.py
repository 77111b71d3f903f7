"""Compute a reduced table once, and know how big it is.

Operators here never shuffle raw rows to learn something about their group:
they aggregate, store the aggregate, look at its measured size and only then
choose how to bring it back to the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tallyframe.session import limit, scratch_path


@dataclass(frozen=True)
class Sized:
    """A table and a proven upper bound of its rows and bytes."""

    df: DataFrame
    rows: int
    bytes: int
    stats: dict = field(default_factory=dict)

    @property
    def broadcastable(self) -> bool:
        return self.bytes <= limit(self.df.sparkSession, "broadcastBytes")

    @property
    def single_task(self) -> bool:
        return self.rows <= limit(self.df.sparkSession, "singleTaskRows")

    def replace(self, df: DataFrame) -> Sized:
        """The same bound for a filter of this table, or a projection that widens no row."""
        return Sized(df, self.rows, self.bytes)

    def reduced(self, df: DataFrame) -> Sized:
        """A table of at most as many rows, such as an aggregate of this one.

        While this table is small its bound holds for `df` as well, whose few
        added columns double the bytes at most, and nothing is computed.
        Otherwise `df` is stored and measured.
        """
        bound = Sized(df, self.rows, 2 * self.bytes)
        return bound if bound.broadcastable and bound.single_task else store(df)


def _variable_width(column: T.StructField) -> bool:
    return isinstance(
        column.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    )


def row_bytes(schema: T.StructType) -> Column:
    """Bytes that a row of these columns is counted with."""
    found = F.lit(16 * max(1, len(schema.fields)))
    for column in schema.fields:
        if _variable_width(column):
            length = F.octet_length(F.col(f"`{column.name}`").cast("string"))
            found = found + F.coalesce(length, F.lit(0))
    return found


def store(df: DataFrame | Sized, **stats: Column) -> Sized:
    """Write `df` as Parquet to the shared folder and measure it on the way, in one job.

    `stats` are further aggregates, read off the written table.
    """
    if isinstance(df, Sized):
        return df
    measures = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("b")]
    watch, path = Observation(), scratch_path(df.sparkSession, "stored")
    df.observe(watch, *measures).write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    size = watch.get or kept.agg(*measures).first().asDict()  # a plan without rows observes nothing
    found = kept.agg(*[v.alias(k) for k, v in stats.items()]).first().asDict() if stats else {}
    return Sized(kept, int(size["n"]), int(size["b"]), found)
