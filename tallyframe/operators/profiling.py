"""Table and column profiles; every result is a small table in long form."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.materialize import store
from tallyframe.operators.frequency import top_values
from tallyframe.operators.heavyhitters import top_counts
from tallyframe.operators.lookup import attach
from tallyframe.operators.ordering import running_sum
from tallyframe.operators.projection import numeric_columns
from tallyframe.operators.quantiles import as_number, quantile_columns, quantile_names
from tallyframe.session import limit


def present(df: DataFrame, column: str) -> Column:
    """The column with NaN as null, which is what missing means in all profiles, and -0.0 as 0.0."""
    return as_number(column) if dict(df.dtypes)[column] in ("float", "double") else F.col(f"`{column}`")


def _unpivot(one_row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Turn a one-row table of aggregates into one row per entry."""
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column."""
    counted = df.agg(*[
        F.count_if(present(df, c).isNull()).alias(str(i)) for i, c in enumerate(df.columns)
    ])
    return _unpivot(counted, [
        F.struct(F.lit(c).alias("column"), F.col(str(i)).alias("nulls"))
        for i, c in enumerate(df.columns)
    ])


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per (column, value) of all rows, values as text, without missing ones."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), present(df, c).cast("string").alias("value"))
        for c in columns
    ]))
    return df.select(cells.alias("e")).select("e.*").where(F.col("value").isNotNull())


def frequencies(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per (column, value), values as text; one pass for all columns."""
    return _cells(df, list(columns or df.columns)).groupBy("column", "value").agg(F.count("*").alias("n"))


def _with_digest(cells: DataFrame) -> DataFrame:
    """Add 128 bits that stand for the value, so that no long text is shuffled."""
    return cells.withColumn("digest", F.unhex(F.md5("value")))


def digest_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, digest of the value); one pass for all columns."""
    cells = _with_digest(_cells(df, columns)).select("column", "digest")
    return cells.groupBy("column", "digest").agg(F.count("*").alias("n"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: unique values, the most frequent one (the smallest among equals) and its rows.

    Values are counted by their digests. Only rows that hold a most frequent value are looked
    at again; where no value repeats, that value is the smallest text.
    """
    counts = store(digest_counts(df, columns))
    sizes = counts.reduced(counts.df.groupBy("column").agg(
        F.count("*").alias("unique"), F.max("n").alias("freq")))
    repeated = store(attach(counts.df, sizes, ["column"], "inner").where(
        (F.col("n") == F.col("freq")) & (F.col("freq") > 1)).select("column", "digest"))
    found = attach(_with_digest(_cells(df, columns)), repeated, ["column", "digest"], "inner").groupBy(
        "column").agg(F.min("value").alias("top"))
    single = [r["column"] for r in sizes.df.where("freq = 1").collect()]  # columns of the table
    if single:
        found = found.unionByName(_cells(df, single).groupBy("column").agg(F.min("value").alias("top")))
    return sizes.df.join(F.broadcast(found), "column").select("column", "unique", "top", "freq")


def describe_all(df: DataFrame, quartiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Descriptive statistics of all columns, one row per column.

    Numeric columns have count, mean, std, min, interpolated quantiles and max; all
    others, whatever their type, count, unique, top and freq, with values as text.
    """
    numbers = numeric_columns(df)
    text = [c for c in df.columns if c not in numbers]
    names = quantile_names(quartiles)
    quantiles = quantile_columns(df, numbers, quartiles)
    nothing = F.lit(None).cast("double")

    aggregates, entries = [], []
    for i, c in enumerate(text + numbers):
        column = F.col(f"`{c}`") if c in text else as_number(c)
        aggregates.append(F.count(column).alias(f"{i}_count"))
        fields = [F.lit(c).alias("column"), F.col(f"{i}_count").alias("count")]
        stats = {"mean": F.avg, "std": F.stddev, "min": F.min}
        values = {k: fn(column) for k, fn in stats.items()} if c in numbers else {}
        if c in numbers:
            values |= dict(zip(names, quantiles[c])) | {"max": F.max(column)}
        aggregates += [v.alias(f"{i}_{k}") for k, v in values.items()]
        fields += [
            (F.col(f"{i}_{k}") if values else nothing).alias(k)
            for k in ["mean", "std", "min", *names, "max"]
        ]
        entries.append(F.struct(*fields))
    stats = _unpivot(df.agg(*aggregates), entries)
    if not text:
        return stats.withColumns({
            "unique": F.lit(None).cast("bigint"), "top": F.lit(None).cast("string"),
            "freq": F.lit(None).cast("bigint")})
    return stats.join(F.broadcast(modes(df, text)), "column", "left")


def table_overview(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells, duplicate rows.

    Copies are combined before the shuffle, whatever their number.
    """
    missing = sum((F.col(f"`{c}`").isNull().cast("int") for c in df.columns), F.lit(0))
    return (
        df.select(*[present(df, c).alias(c) for c in df.columns])
        .groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_copies"))
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
            F.coalesce(F.sum(missing * F.col("_copies")), F.lit(0)).alias("missing_cells"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        )
    )


def profile_columns(
    df: DataFrame, probabilities: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95)
) -> DataFrame:
    """Type, counts and moments per column; skewness and kurtosis bias-corrected."""
    numbers = set(numeric_columns(df))
    types = dict(df.dtypes)
    quantiles = quantile_columns(df, [c for c in df.columns if c in numbers], probabilities)
    names = quantile_names(probabilities)
    nothing = F.lit(None).cast("double")

    aggregates, entries = [], []
    for i, c in enumerate(df.columns):
        column = as_number(c) if c in numbers else F.col(f"`{c}`")
        aggregates += [F.count(column).alias(f"{i}_count"),
                       F.count_if(column.isNull()).alias(f"{i}_missing")]
        fields = [F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
                  F.col(f"{i}_count").alias("count"), F.col(f"{i}_missing").alias("missing")]
        if c in numbers:
            stats = {
                "zeros": F.count_if(column == 0), "min": F.min(column), "max": F.max(column),
                "mean": F.avg(column), "std": F.stddev(column),
                "g1": F.skewness(column), "g2": F.kurtosis(column),
            } | dict(zip(names, quantiles[c]))
            aggregates += [v.alias(f"{i}_{k}") for k, v in stats.items()]
            n = F.col(f"{i}_count").cast("double")
            skew = F.when(n > 2, F.col(f"{i}_g1") * F.sqrt(n * (n - 1)) / (n - 2))
            kurt = F.when(n > 3, ((n + 1) * F.col(f"{i}_g2") + 6) * (n - 1) / ((n - 2) * (n - 3)))
            fields += [F.col(f"{i}_{k}").alias(k) for k in ("zeros", "min", "max", "mean", "std")]
            fields += [skew.alias("skewness"), kurt.alias("kurtosis")]
            fields += [F.col(f"{i}_{k}").alias(k) for k in names]
        else:
            fields += [F.lit(None).cast("bigint").alias("zeros")]
            fields += [nothing.alias(k) for k in
                       ("min", "max", "mean", "std", "skewness", "kurtosis", *names)]
        entries.append(F.struct(*fields))
    stats = _unpivot(df.agg(*aggregates), entries)
    distinct = digest_counts(df, df.columns).groupBy("column").agg(F.count("*").alias("distinct"))
    return stats.join(F.broadcast(distinct), "column", "left").withColumn(
        "distinct", F.coalesce("distinct", F.lit(0)))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width bins per numeric column: column, bin, low, high, n.

    Empty bins have no row; the greatest value falls in the last bin.
    """
    bounds = df.agg(*[
        e for i, c in enumerate(columns)
        for e in (F.min(as_number(c)).alias(f"a{i}"), F.max(as_number(c)).alias(f"b{i}"))
    ]).first()
    entries = []
    for i, c in enumerate(columns):
        low, high = bounds[f"a{i}"], bounds[f"b{i}"]
        if low is None:
            continue
        width = (high - low) / bins
        at = F.lit(0) if width == 0 else F.least(
            F.lit(bins - 1), F.floor((as_number(c) - F.lit(low)) / F.lit(width)).cast("int"))
        entries.append(F.struct(
            F.lit(c).alias("column"), F.when(as_number(c).isNotNull(), at).alias("bin"),
            F.lit(low).alias("_low"), F.lit(width).alias("_width")))
    if not entries:
        raise ValueError("no column holds a value")
    return (
        df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin", "_low", "_width").agg(F.count("*").alias("n"))
        .select("column", "bin", (F.col("_low") + F.col("bin") * F.col("_width")).alias("low"),
                (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("high"), "n")
    )


def frequent_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The `k` most frequent values of each column, ties by value: column, value, n, rank.

    Of tables above `spark.tallyframe.countedRows` rows, sketches name the few values that
    are counted, so no table of all values is shuffled; columns for which they prove
    nothing are counted in full.
    """
    columns = list(columns)
    if df.count() <= limit(df.sparkSession, "countedRows"):
        return top_values(frequencies(df, columns), k)
    cells = df.select(*[present(df, c).cast("string").alias(str(i)) for i, c in enumerate(columns)])
    counts, unproven = top_counts(cells, columns, k)
    if unproven:
        counts = counts.unionByName(frequencies(df, [columns[i] for i in unproven]))
    return top_values(counts, k)


def gram(df: DataFrame, columns: Sequence[str], centre: Sequence[float], weight: str) -> tuple[np.ndarray, ...]:
    """Counts, sums, squares and products of all column pairs, over the rows that have both.

    A row counts as often as its `weight` says.

    One scan: a task multiplies the matrix of its rows, without `centre`, with that of their
    presence. (n, s, q, p) are square; s[a, b] and q[a, b] sum a and its square where b is present.
    """
    size, middle = len(columns), np.asarray(centre, float)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, size, size))
        for batch in batches:
            *values, counts = batch.columns
            n = np.asarray(counts, float)[:, None]
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in values]).astype(float)
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in values])
            x = np.where(there > 0, x - middle, 0.0)
            total += np.stack([(n * there).T @ there, (n * x).T @ there, (n * x * x).T @ there, (n * x).T @ x])
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["sums"])

    parts = df.select(
        *[as_number(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(f"`{weight}`").alias("n")
    ).mapInArrow(local, "sums array<double>")
    added = parts.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    whole = np.zeros(4 * size * size)
    for row in added.collect():  # four numbers per pair of columns
        whole[row["at"]] = row["v"]
    return tuple(whole.reshape(4, size, size))


def _pairwise(df: DataFrame, columns: Sequence[str], out: str, weight: str) -> DataFrame:
    """Correlation of each column pair, null without variance: two scans for any number of columns."""
    columns = list(columns)
    times = F.col(f"`{weight}`")
    means = df.agg(*[
        (F.sum(as_number(c) * times) / F.nullif(F.sum(F.when(as_number(c).isNotNull(), times)), F.lit(0))).alias(str(i))
        for i, c in enumerate(columns)]).first()
    n, s, q, p = gram(df, columns, [m or 0.0 for m in means], weight)
    rows = []
    with np.errstate(divide="ignore", invalid="ignore"):
        for i, j in combinations(range(len(columns)), 2):
            count = n[i, j]
            across = p[i, j] - s[i, j] * s[j, i] / count
            spread = (q[i, j] - s[i, j] ** 2 / count) * (q[j, i] - s[j, i] ** 2 / count)
            flat = count < 2 or spread <= 1e-24 * max(q[i, j] * q[j, i], 1e-300)
            rows.append((columns[i], columns[j], None if flat else float(across / math.sqrt(spread))))
    return df.sparkSession.createDataFrame(rows, f"column_a string, column_b string, `{out}` double")


def average_ranks(df: DataFrame, column: str, out: str, weight: str) -> DataFrame:
    """Distinct values of `column` with their rank, ties sharing the mean rank; `weight` counts a row's copies."""
    sizes = store(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum(weight).alias("_n")))
    ordered = running_sum(sizes, "_n", [F.asc(column)], "_upto")
    return ordered.select(column, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(out))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson and Spearman correlation of each column pair, over the rows that have both.

    Equal rows are counted first, and all else is done on the distinct ones. Ranks are computed
    on distinct values and attached to these rows: once per column for the pairs of columns without
    missing values, per pair for the others.
    """
    columns = list(columns)
    weight = "_copies"
    while weight in columns:
        weight = f"_{weight}"
    table = store(df.select(*[as_number(c).alias(c) for c in columns]).groupBy(
        *[f"`{c}`" for c in columns]).agg(F.count("*").alias(weight))).df
    missing = table.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns]).first()
    full = [c for c in columns if not missing[c]]
    ranked = table.select(*full, weight)
    for c in full:
        ranked = attach(ranked, average_ranks(table, c, f"_{c}", weight), [c])
    ranks = ranked.select(*[F.col(f"_{c}").alias(c) for c in full], weight)
    spearman = [_pairwise(ranks, full, "spearman", weight)] if len(full) > 1 else []
    gapped = [p for p in combinations(columns, 2) if missing[p[0]] or missing[p[1]]]
    if gapped:
        spearman.append(_spearman_of_pairs(table, gapped, weight))
    pearson = _pairwise(table, columns, "pearson", weight)
    return pearson.join(
        F.broadcast(reduce(DataFrame.unionByName, spearman)), ["column_a", "column_b"])


def _spearman_of_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], weight: str) -> DataFrame:
    """Spearman correlation of pairs with missing values, ranked among the rows that have both."""
    names = ["column_a", "column_b"]
    rows = df.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"`{a}`").alias("a"),
                 F.col(f"`{b}`").alias("b"), F.col(f"`{weight}`").alias("n")) for a, b in pairs
    ])).alias("e")).select("e.*").where("a IS NOT NULL AND b IS NOT NULL")
    # each pair of values once
    rows = store(rows.groupBy(*names, "a", "b").agg(F.sum("n").alias("n"))).df
    # the mean rank of n rows is (n + 1) / 2
    centre = rows.groupBy(*names).agg(((F.sum("n") + 1) / 2).alias("centre"))
    for side in ("a", "b"):
        sizes = store(rows.groupBy(*names, side).agg(F.sum("n").alias("_n")))
        ordered = running_sum(sizes, "_n", [F.asc(side)], "_upto", names)
        rank = ordered.select(*names, side, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(f"rank_{side}"))
        rows = attach(rows, rank, [*names, side])
    # a pair without a common row still has its line
    wanted = df.sparkSession.createDataFrame(list(pairs), names)
    x, y = (F.col(f"rank_{side}") - F.col("centre") for side in ("a", "b"))
    spread = F.sum(F.col("n") * x * x) * F.sum(F.col("n") * y * y)
    found = rows.join(F.broadcast(centre), names).groupBy(*names).agg(
        (F.sum(F.col("n") * x * y) / F.sqrt(F.nullif(spread, F.lit(0.0)))).alias("spearman"))
    return wanted.join(F.broadcast(found), names, "left")


def text_lengths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shortest, mean and longest length of each text column."""
    stats = {"min_length": F.min, "mean_length": F.avg, "max_length": F.max}
    row = df.agg(*[
        fn(F.length(f"`{c}`")).alias(f"{i}_{k}")
        for i, c in enumerate(columns) for k, fn in stats.items()
    ])
    return _unpivot(row, [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{k}").alias(k) for k in stats])
        for i, c in enumerate(columns)
    ])
