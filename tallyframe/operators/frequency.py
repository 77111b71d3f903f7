"""Counting operators: group sizes, frequency tables, totals, Pareto tables.

Every operator drops null keys and takes an optional `weight` column, so that it
can run on a table that is already grouped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.materialize import Sized, store
from tallyframe.operators.lookup import all_present, attach
from tallyframe.operators.ordering import running_sum


def group_size(
    df: DataFrame, keys: Sequence[str], out: str = "n", weight: str | None = None
) -> DataFrame:
    """Rows per key tuple; tuples with a null are left out."""
    size = F.sum(weight) if weight else F.count("*")
    return df.where(all_present(keys)).groupBy(*keys).agg(size.cast("bigint").alias(out))


def counted(
    df: DataFrame | Sized, keys: Sequence[str], out: str = "n", weight: str | None = None
) -> Sized:
    """`group_size` with a size bound: stored, or bounded by an already sized input."""
    if isinstance(df, Sized):
        return df.reduced(group_size(df.df, keys, out, weight))
    return store(group_size(df, keys, out, weight))


def value_counts(
    df: DataFrame, column: str, out: str = "counts", weight: str | None = None
) -> DataFrame:
    """Frequency table, most frequent first and ties by value."""
    return group_size(df, [column], out, weight).orderBy(F.desc(out), F.asc(column))


def grand_total(df: DataFrame, value: str, out: str = "total") -> DataFrame:
    """One row holding the sum of `value`."""
    return df.agg(F.sum(value).alias(out))


def pareto_table(
    df: DataFrame | Sized, column: str, weight: str | None = None,
    counts: str = "counts", running: str = "cumsum", share: str = "perce",
) -> DataFrame:
    """Frequency table with running total and running share, in falling order."""
    table = counted(df, [column], counts, weight)
    ordered = running_sum(table, counts, [F.desc(counts), F.asc(column)], running)
    if table.single_task:
        total = F.sum(counts).over(Window.partitionBy())
    else:
        total = F.lit(table.df.agg(F.sum(counts)).first()[0])
    return ordered.withColumn(share, F.col(running) / total.cast("double"))


def with_group_count(
    df: DataFrame, keys: Sequence[str], out: str, weight: str | None = None
) -> DataFrame:
    """Attach the size of each row's group; null where a key is null."""
    return attach(df, group_size(df, keys, out, weight), keys)


def distinct_per_group(
    df: DataFrame, group: str, column: str, out: str
) -> DataFrame:
    """Distinct non-null values of `column` per non-null `group`.

    Duplicates are removed on both columns first, so a group of any size is
    spread over the shuffle by its values.
    """
    pairs = df.where(F.col(group).isNotNull()).select(group, column).distinct()
    return pairs.groupBy(group).agg(F.count(column).alias(out))


def top_of_group(
    pairs: DataFrame | Sized, group: str, count: str = "n", out: str = "top_n"
) -> DataFrame:
    """Rows of a counted pair table that reach their group's maximum, ties kept."""
    pairs = store(pairs)
    best = pairs.reduced(pairs.df.groupBy(group).agg(F.max(count).alias(out)))
    return attach(pairs.df, best, [group]).where(F.col(count) == F.col(out))


def group_means(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Mean of each measure per key tuple; tuples with a null are left out."""
    return (
        df.where(all_present(keys)).groupBy(*keys)
        .agg(*[F.avg(m).alias(m) for m in measures])
    )


def top_values(
    frequencies: DataFrame, k: int, by: str = "column", value: str = "value", count: str = "n"
) -> DataFrame:
    """The `k` most frequent values per `by`; Spark trims groups before shuffling."""
    window = Window.partitionBy(by).orderBy(F.desc(count), F.asc(value))
    return frequencies.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def rounded(column: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)
