"""Profiles and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.features import gapped, _GAPPED
from checks.registry import ISSUES, lowered, query
from tallyframe.operators import profiling, quality
from tallyframe.plans.issues import FEATURE_INTS, NAMES, issues, table


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query("null_counts", f"""
WITH {_GAPPED} """ + _union([
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM gapped" for c in ["row_key", *NAMES]
]))
def null_counts(spark, sf_dir):
    return profiling.null_counts(gapped(spark, sf_dir).select("row_key", *NAMES))


_STATS = ["mean", "std", "min", "p25", "p50", "p75", "max"]


def _describe_text(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", (SELECT count({c}) FROM rep) AS count,
       {', '.join(f'CAST(NULL AS DOUBLE) AS {s}' for s in _STATS)},
       (SELECT count(DISTINCT {c}) FROM rep) AS "unique", {c} AS top, n AS freq
FROM (SELECT {c}, count(*) AS n FROM rep WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1)"""


def _describe_number(c: str) -> str:
    quartiles = ", ".join(f"round(quantile_cont({c}, {q}), 6)" for q in (0.25, 0.5, 0.75))
    return f"""
SELECT '{c}', count({c}), round(avg({c}), 6), round(stddev_samp({c}), 6), CAST(min({c}) AS DOUBLE),
       {quartiles}, CAST(max({c}) AS DOUBLE), NULL, NULL, NULL FROM rep"""


_REPORT = f"""{ISSUES}, rep AS (
  SELECT component_name, product_name,
         nullif(assignee_name, CASE WHEN bug_fix_time % 17 = 0 THEN assignee_name END) AS assignee_name,
         {', '.join(FEATURE_INTS)} FROM issues)"""


def _report(spark, sf_dir):
    gap = F.when(F.col("bug_fix_time") % 17 != 0, F.col("assignee_name"))
    return issues(spark, sf_dir).withColumn("assignee_name", gap).drop("row_key")


@query("describe_all", f"WITH {_REPORT} " + _union(
    [f"({_describe_text(c)})" for c in NAMES] + [f"({_describe_number(c)})" for c in FEATURE_INTS]))
def describe_all(spark, sf_dir):
    return profiling.describe_all(_report(spark, sf_dir)).withColumns(
        {s: F.round(s, 6) for s in _STATS})


@query("profile_overview", """
WITH a AS (SELECT p_name, p_brand, nullif(p_size, p_partkey % 50) AS p_size FROM part),
d AS (SELECT DISTINCT * FROM a)
SELECT CAST((SELECT count(*) FROM a) AS BIGINT) AS n_rows, 3 AS n_columns,
       CAST((SELECT count(*) FROM a WHERE p_size IS NULL) AS BIGINT) AS missing_cells,
       CAST((SELECT count(*) FROM a) - (SELECT count(*) FROM d) AS BIGINT) AS duplicate_rows""")
def profile_overview(spark, sf_dir):
    return profiling.table_overview(table(spark, sf_dir, "part").select(
        "p_name", "p_brand", F.expr("nullif(p_size, p_partkey % 50)").alias("p_size")))


_PROBS = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def _profile_number(c: str, kind: str) -> str:
    return f"""
SELECT '{c}' AS "column", '{kind}' AS type, count({c}) AS count, count(*) - count({c}) AS missing,
       CAST(count_if({c} = 0) AS BIGINT) AS zeros, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
       round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(skewness({c}), 4) AS skewness, round(kurtosis({c}), 4) AS kurtosis,
       {', '.join(f'round(quantile_cont({c}, {p}), 4) AS {n}' for n, p in _PROBS.items())},
       count(DISTINCT {c}) AS "distinct" FROM rep"""


def _profile_text(c: str) -> str:
    return f"""
SELECT '{c}', 'string', count({c}), count(*) - count({c}), NULL, {', '.join(['NULL'] * 11)},
       count(DISTINCT {c}) FROM rep"""


@query("profile_columns", f"WITH {_REPORT} " + _union(
    [_profile_number(c, "bigint") for c in FEATURE_INTS] + [_profile_text(c) for c in NAMES]))
def profile_columns(spark, sf_dir):
    digits = {s: F.round(s, 4) for s in ("mean", "std", "skewness", "kurtosis", *_PROBS)}
    return profiling.profile_columns(_report(spark, sf_dir)).withColumns(digits)


def _histogram_sql(c: str, bins: int = 10) -> str:
    return f"""
SELECT '{c}' AS "column", bin, round(lo + bin * w, 4) AS low, round(lo + (bin + 1) * w, 4) AS high, n FROM (
  SELECT CAST(least({bins - 1}, floor((v - lo) / w)) AS INTEGER) AS bin, lo, w, count(*) AS n FROM (
    SELECT CAST({c} AS DOUBLE) AS v, CAST(min({c}) OVER () AS DOUBLE) AS lo,
           (CAST(max({c}) OVER () AS DOUBLE) - CAST(min({c}) OVER () AS DOUBLE)) / {bins} AS w
    FROM lineitem) GROUP BY ALL)"""


_HISTOGRAM = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query("histogram", _union([f"({_histogram_sql(c)})" for c in _HISTOGRAM]))
def histogram(spark, sf_dir):
    return profiling.histogram(table(spark, sf_dir, "lineitem"), _HISTOGRAM).withColumns(
        {"low": F.round("low", 4), "high": F.round("high", 4)})


_FREQUENT = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query("frequent_values", _union([f"""
(SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS "value", count(*) AS n,
        CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS INTEGER) AS "rank"
 FROM orders GROUP BY {c} QUALIFY "rank" <= 10)""" for c in _FREQUENT]))
def frequent_values(spark, sf_dir):
    return profiling.frequent_values(table(spark, sf_dir, "orders"), _FREQUENT, 10)


@query("frequent_values_large", _union([f"""
(SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS "value", count(*) AS n
 FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 10)"""
    for c in ("l_partkey", "l_orderkey", "l_returnflag")]))
def frequent_values_large(spark, sf_dir):
    """Frequent values named by sketches: whole ones, recounted ones, and a column of keys, counted in full."""
    columns = ["l_partkey", "l_orderkey", "l_returnflag"]
    with lowered(spark, countedRows=0):
        return profiling.frequent_values(table(spark, sf_dir, "lineitem"), columns, 10).drop("rank")


def _mixed(spark, sf_dir):
    """Orders with a boolean, a date text, a timestamp and a number with gaps, NaN and both zeros."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 3 == 0).alias("flag"), F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(float("nan"))).when(F.col("o_orderkey") % 11 == 0, None)
        .when(F.col("o_orderkey") % 5 == 0, F.lit(-0.0)).when(F.col("o_orderkey") % 5 == 1, F.lit(0.0))
        .otherwise(F.col("o_totalprice")).cast("double").alias("price"))


_MIXED = """
mixed AS (SELECT o_orderkey, o_orderkey % 3 = 0 AS flag, CAST(o_orderdate AS DATE) AS day,
  CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 5 < 2 THEN 0.0
       ELSE CAST(o_totalprice AS DOUBLE) END AS price FROM orders)"""


def _mode(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", (SELECT count({c}) FROM mixed) AS count, (SELECT count(DISTINCT {c}) FROM mixed) AS "unique",
       CAST({c} AS VARCHAR) AS top, count(*) AS freq FROM mixed WHERE {c} IS NOT NULL
GROUP BY {c} ORDER BY freq DESC, top LIMIT 1"""


@query("describe_all_types", f"WITH {_MIXED} " + _union(
    [f"({_mode(c)})" for c in ("flag", "day")]
    + [f"SELECT '{c}', count({c}), NULL, NULL, NULL FROM mixed" for c in ("o_orderkey", "price")]))
def describe_all_types(spark, sf_dir):
    return profiling.describe_all(_mixed(spark, sf_dir)).select("column", "count", "unique", "top", "freq")


@query("profile_nan", f"WITH {_MIXED} " + _union([
    f"SELECT '{c}' AS \"column\", count({c}) AS count, count(*) - count({c}) AS missing, "
    f"count(DISTINCT {c}) AS \"distinct\" FROM mixed" for c in ("o_orderkey", "flag", "day", "price")]))
def profile_nan(spark, sf_dir):
    return profiling.profile_columns(_mixed(spark, sf_dir)).select("column", "count", "missing", "distinct")


_LARGE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("quantiles_large", _union([
    f"SELECT '{c}' AS \"column\", " + ", ".join(
        f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS {n}" for n, p in
        {"p0_1": 0.001, "p50": 0.5, "p99_9": 0.999}.items()) + " FROM lineitem" for c in _LARGE]))
def quantiles_large(spark, sf_dir):
    """Quantiles narrowed down by histograms, as for tables of many cells."""
    rows = table(spark, sf_dir, "lineitem").select(*_LARGE)
    with lowered(spark, percentileCells=0):
        found = profiling.describe_all(rows, (0.001, 0.5, 0.999))
    return found.select("column", *[F.round(c, 6).alias(c) for c in ("p0_1", "p50", "p99_9")])


_CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_RANKS = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS r_{c}"
    for c in _CORRELATED)


@query("correlations", f"WITH ranked AS (SELECT *, {_RANKS} FROM lineitem) " + _union([
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS pearson, "
    f"round(corr(r_{a}, r_{b}), 6) AS spearman FROM ranked"
    for i, a in enumerate(_CORRELATED) for b in _CORRELATED[i + 1:]]))
def correlations(spark, sf_dir):
    return profiling.correlations(table(spark, sf_dir, "lineitem"), _CORRELATED).withColumns(
        {"pearson": F.round("pearson", 6), "spearman": F.round("spearman", 6)})


@query("correlations_large", f"WITH ranked AS (SELECT *, {_RANKS} FROM lineitem) " + _union([
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS pearson, "
    f"round(corr(r_{a}, r_{b}), 6) AS spearman FROM ranked"
    for i, a in enumerate(_CORRELATED) for b in _CORRELATED[i + 1:]]))
def correlations_large(spark, sf_dir):
    """Correlations with every rank joined by shuffle and ranked in slices."""
    with lowered(spark, broadcastBytes=0, singleTaskRows=1000):
        found = profiling.correlations(table(spark, sf_dir, "lineitem"), _CORRELATED)
    return found.withColumns({"pearson": F.round("pearson", 6), "spearman": F.round("spearman", 6)})


_GAPS = {"a": "CASE WHEN l_orderkey % 4 > 0 THEN l_quantity END", "b": "CASE WHEN l_orderkey % 5 > 0 THEN l_extendedprice END",
         "c": "l_discount", "d": "l_tax"}


def _pair_sql(a: str, b: str) -> str:
    ranks = ", ".join(f"rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0::DOUBLE AS r_{x}" for x in (a, b))
    return (f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS pearson, round(corr(r_{a}, r_{b}), 6) AS spearman "
            f"FROM (SELECT {a}, {b}, {ranks} FROM gaps WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")


@query("correlations_nulls", f"WITH gaps AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _GAPS.items())} FROM lineitem) " + _union(
    [f"({_pair_sql(a, b)})" for i, a in enumerate("abcd") for b in "abcd"[i + 1:]]))
def correlations_nulls(spark, sf_dir):
    """Each pair over the rows that have both values."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in _GAPS.items()])
    return profiling.correlations(rows, list(_GAPS)).withColumns(
        {"pearson": F.round("pearson", 6), "spearman": F.round("spearman", 6)})


@query("text_lengths", _union([
    f"SELECT '{c}' AS \"column\", CAST(min(length({c})) AS INTEGER) AS min_length, "
    f"round(avg(length({c})), 6) AS mean_length, CAST(max(length({c})) AS INTEGER) AS max_length FROM documents"
    for c in ("text", "lang", "source")]))
def text_lengths(spark, sf_dir):
    lengths = profiling.text_lengths(table(spark, sf_dir, "documents"), ["text", "lang", "source"])
    return lengths.withColumn("mean_length", F.round("mean_length", 6))


def _check_sql(e: quality.Expect) -> str:
    def row(kind, violations):
        return (f"SELECT '{e.column}' AS \"column\", '{kind}' AS \"check\", "
                f"CAST({violations} AS BIGINT) AS violations, {violations} = 0 AS passed")

    rows = [row("present", 0), row("type", 0),
            row("not_null", f"count_if({e.column} IS NULL)") + " FROM shifted"]
    if e.minimum is not None:
        rows.append(row("minimum", f"count_if({e.column} < {e.minimum})") + " FROM shifted")
    return _union(rows)


@query("quality_check", f"""
WITH {_REPORT}, shifted AS (SELECT * REPLACE (bug_fix_time - 5 AS bug_fix_time) FROM rep) """
       + _union([_check_sql(e) for e in quality.CLEAN_TABLE]))
def quality_check(spark, sf_dir):
    return quality.check(_report(spark, sf_dir).withColumn("bug_fix_time", F.col("bug_fix_time") - 5))
