"""Check a table against expectations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

_KINDS = {
    "text": ("string",), "integer": ("bigint", "int", "smallint", "tinyint"),
    "number": ("bigint", "int", "smallint", "tinyint", "double", "float"),
}


@dataclass(frozen=True)
class Expect:
    """A column that must exist, with a kind, a least value and no nulls."""

    column: str
    kind: str
    minimum: float | None = None
    nullable: bool = False


# The cleaned report table.
CLEAN_TABLE = (
    Expect("component_name", "text"),
    Expect("product_name", "text"),
    Expect("resolution_code", "integer", 0),
    Expect("status_code", "integer", 0),
    Expect("quantity_of_votes", "integer", 0),
    Expect("quantity_of_comments", "integer", 0),
    Expect("bug_fix_time", "integer", 0),
    Expect("severity_code", "integer", 0),
    Expect("assignee_name", "text"),
)


def check(df: DataFrame, expectations: Sequence[Expect] = CLEAN_TABLE) -> DataFrame:
    """One row per check: column, check, violations, passed.

    The schema is compared on the driver and all values in a single pass.
    Columns without an expectation are allowed.
    """
    types = dict(df.dtypes)
    results = []
    for e in expectations:
        if e.kind not in _KINDS:
            raise ValueError(f"unknown kind {e.kind!r}")
        present = e.column in types
        results.append((e.column, "present", F.lit(0 if present else 1)))
        if not present:
            continue
        column = F.col(f"`{e.column}`")
        results.append((e.column, "type", F.lit(0 if types[e.column] in _KINDS[e.kind] else 1)))
        if not e.nullable:
            results.append((e.column, "not_null", F.count_if(column.isNull())))
        if e.minimum is not None:
            results.append((e.column, "minimum", F.count_if(column < F.lit(e.minimum))))
    row = df.agg(*[v.cast("bigint").alias(str(i)) for i, (_, _, v) in enumerate(results)])
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"), F.col(str(i)).alias("violations"))
        for i, (c, k, _) in enumerate(results)
    ]
    long = row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return long.withColumn("passed", F.col("violations") == 0)


def require(df: DataFrame, expectations: Sequence[Expect] = CLEAN_TABLE) -> DataFrame:
    """Return `df`, or raise with the list of failed checks."""
    failed = check(df, expectations).where(~F.col("passed")).collect()
    if failed:
        raise ValueError("; ".join(
            f"{r['column']}: {r['check']} ({r['violations']})" for r in failed))
    return df
