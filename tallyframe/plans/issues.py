"""The star-schema tables seen as a table of issue reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.plans.features import NUMBERS as FEATURE_INTS
from tallyframe.sources.tables import spread

NAMES = ["component_name", "product_name", "assignee_name"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_issues(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """One issue per line item; works on a batch and on a stream of line items.

    The dimension joins carry no hint: Spark broadcasts them while they are under
    its own size threshold and otherwise splits skewed join partitions.
    """
    joined = lineitem.join(
        part, F.col("l_partkey") == F.col("p_partkey")
    ).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return joined.select(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents
        ).alias("row_key"),
        F.col("p_name").alias("component_name"),
        F.col("p_brand").alias("product_name"),
        F.col("s_name").alias("assignee_name"),
        F.col("l_linenumber").cast("bigint").alias("resolution_code"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("status_code"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("quantity_of_votes"),
        F.col("l_quantity").cast("bigint").alias("quantity_of_comments"),
        F.floor(F.col("l_extendedprice") / 1000).cast("bigint").alias("bug_fix_time"),
        (F.col("p_size") % 5 + 1).cast("bigint").alias("severity_code"),
    )


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_issues(spread(table(spark, sf_dir, "lineitem")), table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier"))
