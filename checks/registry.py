"""Queries over the given tables, each next to its SQL."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


@contextmanager
def lowered(spark: SparkSession, **bounds: int):
    """Lower `spark.tallyframe.*` bounds while a query is built, so that it takes the way of large tables."""
    names = {f"spark.tallyframe.{k}": str(v) for k, v in bounds.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# The issue view of `tallyframe.plans.issues`, as a common table expression.
ISSUES = """
issues AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(round(l_extendedprice * 100) AS BIGINT)) AS row_key,
         p_name AS component_name, p_brand AS product_name, s_name AS assignee_name,
         CAST(l_linenumber AS BIGINT) AS resolution_code,
         CAST(round(l_tax * 100) AS BIGINT) AS status_code,
         CAST(round(l_discount * 100) AS BIGINT) AS quantity_of_votes,
         CAST(l_quantity AS BIGINT) AS quantity_of_comments,
         CAST(floor(l_extendedprice / 1000) AS BIGINT) AS bug_fix_time,
         CAST(p_size % 5 + 1 AS BIGINT) AS severity_code
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
)"""


def component_case(column: str) -> str:
    """The rename rules as a CASE over an already normalised column."""
    from tallyframe.functions.text import COMPONENT_RULES

    tests = {"prefix": "starts_with", "contains": "contains"}
    branches = " ".join(
        f"WHEN {tests[r.kind]}({column}, '{r.text}') THEN '{r.name}'" for r in COMPONENT_RULES
    )
    return f"CASE {branches} ELSE {column} END"


def lcs_sql(a: str, b: str) -> str:
    """LCS length by the dynamic-programming table, as nested list reductions."""
    chars_a, chars_b = f"string_split({a}, '')", f"string_split({b}, '')"
    steps = f"list_transform(range(1, length({b}) + 1), lambda j: [j])"
    inner = (
        f"list_reduce(list_concat([[0::BIGINT]], {steps}), lambda acc, e: list_append(acc, "
        "CASE WHEN hit[e[1]] = 1 THEN prev[e[1]] + 1 "
        "ELSE greatest(prev[e[1] + 1], acc[e[1]]) END))"
    )
    rows = (
        f"list_transform({chars_a}, lambda c: "
        f"list_transform({chars_b}, lambda d: CAST(c = d AS BIGINT)))"
    )
    zero = f"[list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT)]"
    return f"list_reduce(list_concat({zero}, {rows}), lambda prev, hit: {inner})[length({b}) + 1]"


def score_sql(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 0 WHEN {a} = {b} THEN 100 "
        f"WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 "
        f"ELSE CAST(round_even(100 * (2 * {lcs_sql(a, b)} / "
        f"CAST(length({a}) + length({b}) AS DOUBLE)), 0) AS INTEGER) END"
    )
