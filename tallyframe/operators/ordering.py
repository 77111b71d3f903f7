"""Running totals and ranks that do not funnel a group through one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.materialize import Sized, store
from tallyframe.session import limit


def running_sum(
    table: DataFrame | Sized, value: str | Column, order_by: Sequence[Column],
    out: str, partition_by: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running total of `value` in `order_by` order, per `partition_by`.

    `order_by` must be a total order within a partition and partition keys must
    not be null. A table under the single-task bound uses one window. A larger
    one is range-partitioned on the whole order, each slice is totalled, and the
    slice offsets (at most one row per slice and key) are added back.
    """
    table = store(table)
    if table.single_task:
        window = Window.partitionBy(*partition_by).orderBy(*order_by)
        return table.df.withColumn(
            out, F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, 0))
        )

    slices = math.ceil(table.rows / limit(table.df.sparkSession, "singleTaskRows")) + 1
    by = list(partition_by)
    sliced = store(
        table.df.withColumn("_value", F.col(value) if isinstance(value, str) else value)
        .repartitionByRange(slices, *[F.col(c) for c in by], *order_by)
        .withColumn("_slice", F.spark_partition_id())
    ).df
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*by, "_slice").agg(F.sum("_value").alias("_total"))
        .withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    inside = (
        Window.partitionBy(*by, "_slice").orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        sliced.join(offsets, [*by, "_slice"])
        .withColumn(out, F.col("_offset") + F.sum("_value").over(inside))
        .select(*table.df.columns, out)
    )


def rank_rows(
    table: DataFrame | Sized, order_by: Sequence[Column], out: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Row number from 1 in `order_by` order, per `partition_by`."""
    return running_sum(table, F.lit(1), order_by, out, partition_by)


def first_rows(df: DataFrame, n: int, order_by: Sequence[Column | str]) -> DataFrame:
    """The first `n` rows in an explicit order (a distributed top-n)."""
    return df.orderBy(*order_by).limit(n)
