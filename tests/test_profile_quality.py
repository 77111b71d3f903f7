import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import profiling, quality
from tallyframe.operators.groupfeatures import (
    MEASURES, feature_lookup, group_features, learn_group_counts, lookup_means, score_lookup,
)
from tallyframe.operators.quantiles import quantile_columns


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(3)
    return pd.DataFrame({
        "id": np.arange(4000),
        "a": rng.normal(size=4000) * 10.0 ** rng.integers(-8, 8, 4000),
        "b": np.where(rng.random(4000) < 0.4, 5, rng.integers(0, 50, 4000)),
        "c": np.full(4000, 2.5),
    })


def test_narrowed_quantiles_are_exact(spark, bounds, numbers):
    df = spark.createDataFrame(numbers).withColumn("a", F.when(F.col("id") % 7 != 0, F.col("a")))
    pdf = df.toPandas()
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]
    bounds(percentileCells=0)
    found = quantile_columns(df, ["a", "b", "c"], probabilities)
    values = df.agg(*[v.alias(f"{c}{i}") for c in found for i, v in enumerate(found[c])]).first()
    for c in found:
        expected = pdf[c].quantile(probabilities).to_numpy()
        assert np.allclose([values[f"{c}{i}"] for i in range(len(probabilities))], expected, rtol=1e-12, atol=0)


@pytest.mark.parametrize("special", [[], [float("inf")], [float("-inf"), float("inf"), float("nan")], [None, float("-inf")]])
def test_both_ways_to_quantiles_agree_to_the_last_digit(spark, bounds, special):
    rng = np.random.default_rng(7)
    values = [*(rng.normal(size=501) * 1e5).tolist(), 0.0, -0.0, 1e-300, *special * 3]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    probabilities = [0.0, 0.001, 0.004, 0.1, 1 / 3, 0.5, 0.77, 0.995, 1.0]

    def found():
        row = df.agg(*[v.alias(f"q{i}") for i, v in enumerate(quantile_columns(df, ["a"], probabilities)["a"])]).first()
        return [repr(v) for v in row]

    exact = found()
    bounds(percentileCells=0)
    assert found() == exact


def test_one_meaning_of_missing(spark):
    df = spark.createDataFrame([(float("nan"), True), (None, None), (0.0, True), (-0.0, False)], "x double, b boolean")
    assert {r["column"]: r["nulls"] for r in profiling.null_counts(df).collect()} == {"x": 2, "b": 1}
    assert profiling.table_overview(df).first()["missing_cells"] == 3
    profile = {r["column"]: r for r in profiling.profile_columns(df).collect()}
    assert (profile["x"]["count"], profile["x"]["missing"], profile["x"]["distinct"]) == (2, 2, 1)
    described = {r["column"]: r for r in profiling.describe_all(df, [0.001, 0.004]).collect()}
    assert described["b"]["top"] == "true" and described["b"]["freq"] == 2
    assert {"p0_1", "p0_4"} <= set(profiling.describe_all(df, [0.001, 0.004]).columns)
    assert set(described) == {"x", "b"}


@pytest.mark.parametrize("limit", [10**8, 0])
def test_pairwise_correlations_match_pandas(spark, bounds, limit):
    bounds(broadcastBytes=limit)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.integers(0, 40, (400, 4)).astype(float), columns=list("abcd"))
    pdf["b"] += pdf["a"]
    pdf.loc[rng.random(400) < 0.3, "b"] = np.nan
    pdf.loc[rng.random(400) < 0.3, "c"] = np.nan
    pdf["e"] = np.nan
    found = profiling.correlations(spark.createDataFrame(pdf), list("abcde")).toPandas()
    assert len(found) == 10
    for r in found.itertuples():
        for ours, method in ((r.pearson, "pearson"), (r.spearman, "spearman")):
            assert np.isclose(ours, pdf.corr(method).loc[r.column_a, r.column_b], atol=1e-9, equal_nan=True)


def test_quantiles_of_nothing(spark, bounds):
    bounds(percentileCells=0)
    df = spark.createDataFrame([(None,)], "a double")
    assert df.agg(quantile_columns(df, ["a"], [0.5])["a"][0].alias("q")).first()["q"] is None


def test_describe_matches_pandas(spark, numbers):
    pdf = numbers.assign(t=np.where(numbers.b > 30, "x", np.where(numbers.b > 5, "y", None)))
    found = profiling.describe_all(spark.createDataFrame(pdf)).toPandas().set_index("column")
    expected = pdf.describe(include="all")
    for c in ("a", "b", "c"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert np.isclose(float(found.loc[c, ours]), float(expected.loc[theirs, c]), rtol=1e-9), (c, ours)
    for stat in ("count", "unique", "top", "freq"):
        assert found.loc["t", stat] == expected.loc[stat, "t"]


def test_profile_moments_match_pandas(spark, numbers):
    found = profiling.profile_columns(spark.createDataFrame(numbers)).toPandas().set_index("column")
    for c in ("a", "b"):
        assert np.isclose(found.loc[c, "skewness"], numbers[c].skew(), rtol=1e-6)
        assert np.isclose(found.loc[c, "kurtosis"], numbers[c].kurt(), rtol=1e-6)
        assert found.loc[c, "distinct"] == numbers[c].nunique()
    assert found.loc["b", "zeros"] == (numbers.b == 0).sum()


@pytest.mark.parametrize("limit", [10**8, 0])
def test_correlations_match_pandas(spark, bounds, numbers, limit):
    bounds(broadcastBytes=limit)
    pdf = numbers.assign(d=numbers.b + numbers.id % 11)[["id", "b", "d"]]
    found = profiling.correlations(spark.createDataFrame(pdf), ["id", "b", "d"]).toPandas()
    for row in found.itertuples():
        assert np.isclose(row.pearson, pdf.corr().loc[row.column_a, row.column_b], atol=1e-9)
        ranks = pdf.rank().corr().loc[row.column_a, row.column_b]
        assert np.isclose(row.spearman, ranks, atol=1e-9)


def test_overview_histogram_and_lengths(spark):
    df = spark.createDataFrame([("aa", 1), ("aa", 1), ("b", None), (None, 3)], "t string, n int")
    assert tuple(profiling.table_overview(df).first()) == (4, 2, 2, 1)
    bins = {r["bin"]: r["n"] for r in profiling.histogram(df, ["n"], 2).collect()}
    assert bins == {0: 2, 1: 1}
    assert tuple(profiling.text_lengths(df, ["t"]).first())[1:] == (1, 5 / 3, 2)
    assert {r["column"]: r["nulls"] for r in profiling.null_counts(df).collect()} == {"t": 1, "n": 1}


def test_quality(spark, reports):
    from tallyframe.plans.cleaning import clean
    cleaned = clean(reports)
    assert quality.check(cleaned).where(~F.col("passed")).count() == 0
    assert quality.require(cleaned) is cleaned
    bad = cleaned.drop("status_code").withColumn("bug_fix_time", F.col("bug_fix_time") - 10).withColumn(
        "severity_code", F.col("severity_code").cast("string")).withColumn("assignee_name", F.lit(None).cast("string"))
    failed = {(r["column"], r["check"]): r["violations"] for r in quality.check(bad).where(~F.col("passed")).collect()}
    assert failed == {("status_code", "present"): 1, ("severity_code", "type"): 1,
                      ("bug_fix_time", "minimum"): 1, ("assignee_name", "not_null"): 4}
    with pytest.raises(ValueError, match="status_code: present"):
        quality.require(bad)


NAMES = "component_name string, product_name string, assignee_name string, id int"


@pytest.mark.parametrize("limit", [10**8, 0])
def test_group_features_with_gaps(spark, bounds, limit):
    bounds(broadcastBytes=limit)
    df = spark.createDataFrame([
        ("ui", "p", "ann", 1), ("ui", "p", "bob", 2), ("core", "p", None, 3), (None, "p", "ann", 4),
        ("ui", None, "ann", 5), (None, "q", "bob", 6)], NAMES)
    found = {r["id"]: tuple(r[m] for m in MEASURES) for r in group_features(df).collect()}
    assert found == {
        1: (2, 2, 2, 4), 2: (2, 1, 2, 4), 3: (1, None, 2, 4), 4: (None, 2, 2, 4),
        5: (None, None, None, None), 6: (None, 1, 0, 1)}


def test_lookup_and_missing_pairs(spark):
    df = spark.createDataFrame([("ui", "p", "ann", 1), ("ui", "q", "ann", 2), ("ui", "q", "ann", 3)], NAMES)
    means = lookup_means(feature_lookup(df))
    row = means.first()
    assert tuple(row[m] for m in MEASURES) == (1.5, 1.5, 1.0, 1.5)
    asked = spark.createDataFrame([("ui", "ann"), ("ui", "eve"), (None, "ann")], "component_name string, assignee_name string")
    hits = {(r[0], r[1]): (r["lookup_hit"], r["n_components"]) for r in score_lookup(asked, means).collect()}
    assert hits == {("ui", "ann"): (True, 1.5), ("ui", "eve"): (False, 0.0), (None, "ann"): (False, 0.0)}
    filled = score_lookup(asked, means, "mean").where("NOT lookup_hit").first()
    assert filled["n_components"] == 1.5
    assert score_lookup(asked, means, "keep").where("n_components IS NULL").count() == 2
    with pytest.raises(Exception, match="no counts for"):
        score_lookup(asked, means, "error").collect()


def test_correlations_count_equal_rows(spark):
    rows = [(float(i % 7), float(i * i % 11), None if i % 5 == 0 else float(i % 3)) for i in range(40)]
    rows += [(1.0, 9.0, 2.0)] * 60
    df = spark.createDataFrame(rows, "a double, b double, _copies double")
    found = {(r["column_a"], r["column_b"]): (r["pearson"], r["spearman"]) for r in profiling.correlations(df, df.columns).collect()}
    frame = pd.DataFrame(rows, columns=df.columns)
    for (a, b), (pearson, spearman) in found.items():
        both = frame[[a, b]].dropna()
        assert abs(pearson - both[a].corr(both[b])) < 1e-9
        assert abs(spearman - both[a].rank().corr(both[b].rank())) < 1e-9
    wide = spark.createDataFrame([(1.0, None), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert profiling.correlations(wide, ["a", "b"]).first()["spearman"] is None


def test_many_members_do_not_keep_few_components_from_being_broadcast(spark, bounds):
    """And joins that move the rows come before those that do not."""
    df = spark.range(2000).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias("component_name"), F.concat(F.lit("p"), F.col("id") % 1).alias("product_name"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("member "), F.col("id") % 500)).alias("assignee_name"), "id")
    counts = learn_group_counts(df)
    assert counts.by_component.rows == 3 and counts.by_member.rows <= 501
    assert counts.by_component.bytes <= 3 * 60 and counts.by_member.bytes > 400 * 48
    bounds(broadcastBytes=10_000)
    assert counts.by_component.broadcastable and counts.by_group.broadcastable and not counts.by_member.broadcastable
    applied = counts.apply(df)
    plan = applied._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
    assert plan.index("BroadcastHashJoin") < plan.index("SortMergeJoin")
    assert applied.columns == [*df.columns, *MEASURES]
    found = {r["id"]: tuple(r[m] for m in MEASURES) for r in applied.collect()}
    assert found[1] == (667, 4, 3, 2000) and found[5] == (666, None, 3, 2000)
