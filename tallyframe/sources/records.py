"""Typed scoring records from JSON, with defaults and numeric texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Fields of a scoring record with their defaults.
RECORD_DEFAULTS = {
    "creation_date": "2015-05-22",
    "component_name": "engine",
    "short_description": "LogTraceException in ProposalUtils.toMethodNam",
    "long_description": "The following incident was reported via the au",
    "assignee_name": "serg.boyko2011",
    "reporter_name": "error-reports-inbox",
    "resolution_category": "fixed",
    "resolution_code": 1,
    "status_category": "closed",
    "status_code": 4,
    "update_date": "2015-05-27",
    "quantity_of_votes": 0,
    "quantity_of_comments": 8,
    "resolution_date": "2015-05-27",
    "bug_fix_time": 2,
    "severity_category": "normal",
    "severity_code": 2,
}

# Numbers may arrive as texts, so every field is read as a text first.
TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RECORD_DEFAULTS])
# A text that is no JSON object is kept in this column.
REJECTED = "rejected"
PARSED_SCHEMA = T.StructType([*TEXT_SCHEMA.fields, T.StructField(REJECTED, T.StringType())])


def with_defaults(df: DataFrame, keep: tuple[str, ...] = (), invalid: str = "error") -> DataFrame:
    """Fill missing fields and give integers their type.

    A text that is no integer raises, or becomes null with `invalid="null"`. So does a
    record whose text, in the column `rejected`, was no JSON object: with "null" all its
    fields are null and the text stays in `rejected`.
    """
    if invalid not in ("error", "null"):
        raise ValueError(f"unknown invalid {invalid!r}")
    columns, rejects = [], REJECTED in df.columns
    for name, default in RECORD_DEFAULTS.items():
        value = F.col(name) if name in df.columns else F.lit(None).cast("string")
        if isinstance(default, int):
            text = F.trim(value.cast("string"))
            number = text.try_cast("bigint")
            if invalid == "error":
                bad = F.concat(F.lit(f"{name} is not an integer: "), text)
                number = F.when(text.isNotNull() & number.isNull(), F.raise_error(bad).cast("bigint")).otherwise(number)
            value = F.when(text.isNull(), F.lit(default).cast("bigint")).otherwise(number)
        else:
            value = F.coalesce(value, F.lit(default))
        if rejects and invalid == "error":
            wrong = F.concat(F.lit("not a JSON object: "), F.col(REJECTED))
            kind = "bigint" if isinstance(default, int) else "string"
            value = F.when(F.col(REJECTED).isNotNull(), F.raise_error(wrong).cast(kind)).otherwise(value)
        elif rejects:
            value = F.when(F.col(REJECTED).isNull(), value)
        columns.append(value.alias(name))
    return df.select(*keep, *columns, *([REJECTED] if rejects and invalid == "null" else []))


def parse_records(df: DataFrame, column: str = "value", keep: tuple[str, ...] = (), **options) -> DataFrame:
    """Records from a column of JSON objects; works on streams too."""
    # `inline` keeps the optimizer from parsing the text once per field.
    text = F.coalesce(F.col(column), F.lit("null"))
    read = F.from_json(text, PARSED_SCHEMA, {"columnNameOfCorruptRecord": REJECTED})
    parsed = df.select(*keep, text.alias("_text"), F.inline(F.array(read)))
    # a text that holds something else than an object has no fields at all
    other = F.when(~F.col("_text").rlike(r"^\s*\{"), F.col("_text"))
    parsed = parsed.withColumn(REJECTED, F.coalesce(REJECTED, other)).drop("_text")
    return with_defaults(parsed, keep, **options)


def read_records(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records from files with one JSON object per line."""
    reader = spark.read.schema(PARSED_SCHEMA).option("columnNameOfCorruptRecord", REJECTED)
    return with_defaults(reader.json(path), **options)
