"""Pool rare and tail categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.text import COMPONENT_RULES, Rule, apply_rules, normalize
from tallyframe.materialize import Sized
from tallyframe.operators.frequency import counted, pareto_table
from tallyframe.operators.lookup import flag_members


def canonical_names(
    df: DataFrame, column: str, rules: Sequence[Rule] = COMPONENT_RULES
) -> DataFrame:
    """Lower-case, strip and apply the rename rules to one column."""
    return df.withColumn(column, apply_rules(normalize(F.col(column)), rules))


def frequent_values(
    df: DataFrame | Sized, column: str, min_rows: int, weight: str | None = None
) -> Sized:
    """Values that occur in at least `min_rows` rows."""
    sizes = counted(df, [column], "n", weight)
    return sizes.replace(sizes.df.where(F.col("n") >= min_rows).select(column))


def head_values(
    df: DataFrame | Sized, column: str, share: float, weight: str | None = None
) -> Sized:
    """Values whose running share, own rows included, stays within `share`."""
    sizes = counted(df, [column], "counts", weight)
    table = pareto_table(sizes, column, "counts")
    return sizes.reduced(table.where(F.col("perce") <= F.lit(float(share))).select(column))


def pool_others(
    df: DataFrame, keep: DataFrame | Sized, column: str, other: str
) -> DataFrame:
    """Replace values (and nulls) that are not in `keep` by `other`."""
    order = df.columns
    flagged = flag_members(df, keep, column, "_keep")
    return flagged.withColumn(
        column, F.when(F.col("_keep"), F.col(column)).otherwise(F.lit(other))
    ).select(*order)


def pool_rare(
    df: DataFrame, column: str, min_rows: int = 3, other: str = "other"
) -> DataFrame:
    """Pool values with fewer than `min_rows` rows."""
    return pool_others(df, frequent_values(df, column, min_rows), column, other)


def canonical_components(
    df: DataFrame, column: str = "component_name", rules: Sequence[Rule] = COMPONENT_RULES,
    min_rows: int = 3, other: str = "other",
) -> DataFrame:
    """Canonical component names, rare ones pooled after the rules have acted."""
    return pool_rare(canonical_names(df, column, rules), column, min_rows, other)


def pool_tail(
    df: DataFrame, column: str = "product_name", share: float = 0.95,
    other: str = "product_other",
) -> DataFrame:
    """Keep the categories that make up `share` of the rows and pool the rest."""
    return pool_others(df, head_values(df, column, share), column, other)
