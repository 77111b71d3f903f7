"""Exact interpolated quantiles of many columns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.session import limit

BUCKETS = 1024


def as_number(column: str) -> Column:
    """The column as a double; NaN counts as missing, and -0.0 is 0.0."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value + 0.0)


def quantile_names(probabilities: Sequence[float]) -> list[str]:
    """`p25` for 0.25, `p0_1` for 0.001: one name for each probability."""
    names = [f"p{100 * p:.10g}".replace(".", "_") for p in probabilities]
    if len(set(names)) < len(names):
        raise ValueError(f"a probability is given twice: {list(probabilities)}")
    return names


@dataclass
class _Interval:
    """Values in [low, high], of which `before` are smaller than all, with the ranks sought."""

    low: float
    high: float
    before: int
    ranks: list[int]


def quantile_columns(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[Column]]:
    """Per column, one expression per probability for use inside `df.agg`.

    A table of few cells uses the exact `percentile` aggregate. That aggregate
    keeps every distinct value in one task, so a larger table is narrowed down
    by histograms instead and the expressions are literals. Both find the same order
    statistics, infinities among them, and weigh them by the same formula.
    """
    cells = df.count() * max(1, len(columns))
    if cells <= limit(df.sparkSession, "percentileCells"):
        # One aggregate per column; its results are picked by position.
        shares = F.array(*[F.lit(float(p)) for p in probabilities])
        return {
            c: [F.percentile(as_number(c), shares)[i] for i in range(len(probabilities))]
            for c in columns
        }
    found = _narrow(df, list(columns), list(probabilities))
    return {c: [F.lit(v).cast("double") for v in found[c]] for c in columns}


def _narrow(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list]:
    """Find order statistics by repeated histograms.

    Each pass splits every open interval into equal buckets, counts them (the
    counts combine before the shuffle, and only counts reach the driver) and
    keeps the buckets that hold a rank. An interval closes when all its values
    are equal, however many copies there are.
    """
    bounds = df.agg(*[
        expression for i, c in enumerate(columns) for expression in (
            F.count(as_number(c)).alias(f"n{i}"),
            F.min(_finite(c)).alias(f"a{i}"), F.max(_finite(c)).alias(f"b{i}"),
            F.count_if(as_number(c) == -math.inf).alias(f"i{i}"),
            F.count_if(as_number(c) == math.inf).alias(f"j{i}"))
    ]).first()
    values: dict[tuple[int, int], float] = {}
    open_at: dict[int, list[_Interval]] = {}
    for i in range(len(columns)):
        n, below, above = bounds[f"n{i}"], bounds[f"i{i}"], bounds[f"j{i}"]
        ranks = {r for p in probabilities for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
        values.update({(i, r): -math.inf for r in ranks if r < below})
        values.update({(i, r): math.inf for r in ranks if r >= n - above})
        finite = sorted(r for r in ranks if below <= r < n - above)
        if finite:
            _settle(i, [_Interval(bounds[f"a{i}"], bounds[f"b{i}"], below, finite)], values, open_at)

    while open_at:
        counted = _histogram(df, columns, open_at).collect()
        buckets = {}
        for row in counted:
            buckets.setdefault((row["c"], row["b"] // BUCKETS), []).append(row)
        following: dict[int, list[_Interval]] = {}
        for i, intervals in open_at.items():
            narrowed = []
            for j, interval in enumerate(intervals):
                before = interval.before
                for row in sorted(buckets[i, j], key=lambda r: r["b"]):
                    ranks = [r for r in interval.ranks if before <= r < before + row["n"]]
                    if ranks:
                        narrowed.append(_Interval(row["low"], row["high"], before, ranks))
                    before += row["n"]
            _settle(i, narrowed, values, following)
        open_at = following

    result = {}
    for i, name in enumerate(columns):
        n = bounds[f"n{i}"]
        result[name] = [_interpolate(values, i, p * (n - 1)) if n else None for p in probabilities]
    return result


def _settle(i, intervals, values, open_at) -> None:
    for interval in intervals:
        if interval.low == interval.high:
            values.update({(i, r): interval.low for r in interval.ranks})
        else:
            open_at.setdefault(i, []).append(interval)


def _interpolate(values, i: int, position: float) -> float:
    """As the `percentile` aggregate does it, to the last digit."""
    below, above = math.floor(position), math.ceil(position)
    low, high = values[i, below], values[i, above]
    return low if low == high else (above - position) * low + (position - below) * high


def _finite(column: str) -> Column:
    value = as_number(column)
    return F.when(F.abs(value) < math.inf, value)


def _histogram(df: DataFrame, columns: list[str], open_at: dict[int, list[_Interval]]) -> DataFrame:
    entries = []
    for i, intervals in open_at.items():
        value = as_number(columns[i])
        bucket = F.lit(None).cast("int")
        for j, interval in enumerate(intervals):
            # Halves keep the width finite for any two finite bounds.
            position = (value / 2 - F.lit(interval.low / 2)) / F.lit(interval.high / 2 - interval.low / 2)
            inside = F.least(F.lit(BUCKETS - 1), F.floor(position * BUCKETS).cast("int"))
            bucket = F.when(
                value.between(F.lit(interval.low), F.lit(interval.high)), inside + j * BUCKETS
            ).otherwise(bucket)
        entries.append(F.struct(F.lit(i).alias("c"), bucket.alias("b"), value.alias("v")))
    return (
        df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
        .where(F.col("b").isNotNull()).groupBy("c", "b")
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
