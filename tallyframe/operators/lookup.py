"""Bring a keyed table back to rows without moving the rows when possible."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.materialize import Sized, store


def all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def attach(df: DataFrame, lookup: DataFrame | Sized, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a lookup that has one row per key to `df`.

    A lookup whose measured size is under the broadcast bound is broadcast and
    the rows stay where they are. A larger one is joined by shuffle, in one scan
    of the rows: partitions that a hot key makes large are split by adaptive
    execution, which repeats their part of the lookup, as it has one row per key.
    Streams take the same two ways.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(keys)
    lookup = store(lookup)
    if lookup.broadcastable:
        return df.join(F.broadcast(lookup.df), keys, how)
    return df.join(lookup.df.hint("shuffle_merge"), keys, how)


def flag_members(
    df: DataFrame, members: DataFrame | Sized, column: str, out: str = "is_member"
) -> DataFrame:
    """Add a boolean: is `column` among the distinct values of `members`?"""
    kept = store(members)
    marked = kept.replace(kept.df.select(column).withColumn(out, F.lit(True)))
    return attach(df, marked, [column]).withColumn(out, F.coalesce(out, F.lit(False)))


def map_or_self(
    df: DataFrame, mapping: DataFrame | Sized, column: str,
    source: str = "source", target: str = "target", within: Sequence[str] = (),
) -> DataFrame:
    """Replace `column` by its mapped value, or keep it when it has none."""
    order = df.columns
    kept = store(mapping)
    renamed = kept.df.select(
        *within, F.col(source).alias(column), F.col(target).alias("_mapped")
    )
    joined = attach(df, kept.replace(renamed), [*within, column])
    return joined.withColumn(column, F.coalesce("_mapped", column)).select(*order)


def last_wins(df: DataFrame, key: str, value: str, order_by: Sequence[str]) -> DataFrame:
    """One row per `key` with the value of the greatest `order_by` tuple."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order_by)).alias(value))
