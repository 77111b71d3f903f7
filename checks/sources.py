"""File round trips, null tokens and typed records."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ISSUES, query
from tallyframe.materialize import store
from tallyframe.plans.issues import issues, table
from tallyframe.session import scratch_path
from tallyframe.sources import records, tables


@query("csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf_dir):
    """Whole documents, with their quotes and line breaks, through a CSV file."""
    docs = table(spark, sf_dir, "documents")
    path = tables.write_table(docs, scratch_path(spark, "csv"), "documents", "csv")
    return tables.read_csv(spark, path, docs.schema)


@query("csv_split", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_split(spark, sf_dir):
    """Whole documents in one CSV file that is read in slices of 64 KiB."""
    docs = table(spark, sf_dir, "documents")
    path = tables.write_table(docs.coalesce(1), scratch_path(spark, "csv"), "documents", "csv")
    key = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(1 << 16))
    try:
        return store(tables.read_csv(spark, path, docs.schema)).df
    finally:
        spark.conf.set(key, usual)


@query("parquet_roundtrip", f"WITH {ISSUES} SELECT * FROM issues")
def parquet_roundtrip(spark, sf_dir):
    path = tables.write_table(issues(spark, sf_dir), scratch_path(spark, "parquet"), "issues")
    return tables.read_table(spark, path)


_DEFAULTED = [
    "creation_date", "short_description", "long_description", "reporter_name", "status_category",
    "update_date", "resolution_date", "severity_category",
]
_TOKEN = """CASE p_partkey % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN 'n/a'
 WHEN 4 THEN 'none' ELSE p_name END"""


@query("null_tokens", f"""
SELECT p_partkey, nullif(nullif(nullif(nullif({_TOKEN}, 'NA'), ''), 'null'), 'n/a') AS name, p_brand FROM part""")
def null_tokens(spark, sf_dir):
    named = table(spark, sf_dir, "part").select("p_partkey", F.expr(_TOKEN).alias("name"), "p_brand")
    return tables.nulls_from_tokens(named)


_TEXTS = """CASE WHEN l_orderkey % 9 = 0 THEN 'NaN' WHEN l_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(l_linenumber AS VARCHAR) END"""


@query("csv_inferred", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) AS price,
       CASE WHEN l_orderkey % 9 > 0 AND l_orderkey % 10 > 0 THEN CAST(l_linenumber AS BIGINT) END AS line,
       l_orderkey % 2 = 0 AS even, 'x' || l_linenumber AS name FROM lineitem""")
def csv_inferred(spark, sf_dir):
    """Types found after the null tokens are taken out: `n/a` and `NaN` leave a column whole numbers."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_extendedprice").cast("double").alias("price"),
        F.expr(_TEXTS.replace("VARCHAR", "STRING")).alias("line"), (F.col("l_orderkey") % 2 == 0).alias("even"),
        F.concat(F.lit("x"), F.col("l_linenumber").cast("string")).alias("name"))
    return tables.read_csv(spark, tables.write_table(rows, scratch_path(spark, "csv"), "lines", "csv"))


@query("json_invalid", f"""
WITH {ISSUES}
SELECT row_key, CASE WHEN resolution_code > 2 THEN component_name END AS component_name,
       CASE WHEN resolution_code > 2 THEN status_code END AS status_code,
       CASE WHEN resolution_code > 2 THEN 'normal' END AS severity_category,
       CASE WHEN resolution_code = 1 THEN 'no json' WHEN resolution_code = 2 THEN 'null' END AS rejected FROM issues""")
def json_invalid(spark, sf_dir):
    """Texts that are no JSON object, or null, are rejected and never filled with defaults."""
    text = F.when(F.col("resolution_code") == 1, "no json").when(
        F.col("resolution_code") > 2, F.to_json(F.struct("component_name", "status_code")))
    parsed = records.parse_records(
        issues(spark, sf_dir).select("row_key", text.alias("value")), keep=("row_key",), invalid="null")
    return parsed.select("row_key", "component_name", "status_code", "severity_category", "rejected")


@query("json_defaults", f"""
WITH {ISSUES}
SELECT row_key, CASE WHEN resolution_code = 3 THEN 'engine' ELSE component_name END AS component_name,
       assignee_name, 'fixed' AS resolution_category,
       CASE WHEN status_code = 5 THEN 4 ELSE status_code END AS status_code,
       quantity_of_votes, CASE WHEN quantity_of_comments > 40 THEN 8 ELSE quantity_of_comments END AS quantity_of_comments,
       bug_fix_time, severity_code, {', '.join(f"'{records.RECORD_DEFAULTS[c]}' AS {c}" for c in _DEFAULTED)},
       CASE WHEN resolution_code = 3 THEN 1 ELSE resolution_code END AS resolution_code FROM issues""")
def json_defaults(spark, sf_dir):
    """Records as JSON text: some fields missing or null, numbers partly as texts."""
    text = F.to_json(F.struct(
        F.when(F.col("resolution_code") != 3, F.col("component_name")).alias("component_name"),
        "assignee_name",
        F.when(F.col("status_code") != 5, F.col("status_code").cast("string")).alias("status_code"),
        F.col("quantity_of_votes").cast("string").alias("quantity_of_votes"),
        F.when(F.col("quantity_of_comments") <= 40, F.col("quantity_of_comments")).alias("quantity_of_comments"),
        "bug_fix_time", F.col("severity_code").cast("string").alias("severity_code"),
        F.when(F.col("resolution_code") != 3, F.col("resolution_code")).alias("resolution_code")))
    parsed = records.parse_records(issues(spark, sf_dir).select("row_key", text.alias("value")), keep=("row_key",))
    return parsed.select("row_key", *records.RECORD_DEFAULTS)
