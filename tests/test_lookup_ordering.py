import pytest
from pyspark.sql import Window, functions as F

from tallyframe.operators.frequency import counted, pareto_table, top_of_group, with_group_count
from tallyframe.operators.lookup import attach, flag_members, map_or_self
from tallyframe.operators.ordering import rank_rows, running_sum


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, a tenth have none."""
    key = F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)
    return spark.range(3000).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_shuffled_join_equals_broadcast_join(spark, bounds, skewed, how):
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    expected = rows(skewed.join(lookup, "k", how).select("id", "k", "v"))
    assert rows(attach(skewed, lookup, ["k"], how).select("id", "k", "v")) == expected
    bounds(broadcastBytes=0)
    assert rows(attach(skewed, lookup, ["k"], how).select("id", "k", "v")) == expected


def test_large_lookup_is_not_broadcast_whole(spark, bounds, skewed):
    lookup = spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert "SortMergeJoin" not in attach(skewed, lookup, ["k"])._jdf.queryExecution().toString()
    bounds(broadcastBytes=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in attach(skewed, lookup, ["k"])._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_chain_of_large_lookups_scans_its_input_once(spark, bounds, tmp_path):
    spark.range(500).select("id", (F.col("id") % 9).alias("k"), (F.col("id") % 4).alias("j")).write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    bounds(broadcastBytes=0)
    for key in ("k", "j", "k", "j"):
        df = attach(df, spark.range(9).select(F.col("id").alias(key), F.lit(1).alias(f"v{len(df.columns)}")), [key])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [id") == 1 and df.count() == 500


@pytest.mark.parametrize("limit", [10**6, 0])
def test_members_and_mapping(spark, bounds, limit):
    bounds(broadcastBytes=limit)
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "name string, id int")
    members = spark.createDataFrame([("a",), ("z",)], "name string")
    flagged = {r["id"]: r["is_member"] for r in flag_members(df, members, "name").collect()}
    assert flagged == {1: True, 2: False, 3: False}
    mapping = spark.createDataFrame([("a", "A")], "source string, target string")
    mapped = {r["id"]: r["name"] for r in map_or_self(df, mapping, "name").collect()}
    assert mapped == {1: "A", 2: "b", 3: None}


def test_running_sum_in_slices(spark, bounds):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v"))
    window = Window.partitionBy("g").orderBy(F.desc("id")).rowsBetween(Window.unboundedPreceding, 0)
    expected = rows(df.withColumn("s", F.sum("v").over(window)))
    bounds(singleTaskRows=40)
    assert rows(running_sum(df, "v", [F.desc("id")], "s", ["g"])) == expected
    total = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    expected = rows(df.withColumn("s", F.sum("v").over(total)))
    assert rows(running_sum(df, "v", [F.asc("id")], "s")) == expected
    ranks = rank_rows(df, [F.asc("id")], "r").collect()
    assert all(r["r"] == r["id"] + 1 for r in ranks)


def test_pareto_in_slices(spark, bounds):
    df = spark.range(2000).select(F.concat(F.lit("n"), F.floor(F.sqrt("id"))).alias("name"))
    whole = rows(pareto_table(df, "name"))
    bounds(singleTaskRows=10)
    assert rows(pareto_table(df, "name")) == whole


def test_group_count_ignores_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "name string, id int")
    assert {r["id"]: r["n"] for r in with_group_count(df, ["name"], "n").collect()} == {1: 2, 2: 2, 3: None}
    assert counted(df, ["name"]).df.collect()[0]["n"] == 2


def test_top_of_group_keeps_ties(spark):
    pairs = spark.createDataFrame([("p", "a", 2), ("p", "b", 2), ("p", "c", 1)], "p string, a string, n long")
    assert {r["a"] for r in top_of_group(pairs, "p").collect()} == {"a", "b"}
