"""Read and write tables as CSV or Parquet."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyframe.materialize import store
from tallyframe.sources.csvsplit import records

# Texts that stand for a missing value in a CSV file.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# The raw report table, in file order.
REPORT_SCHEMA = T.StructType([
    T.StructField("creation_date", T.StringType()),
    T.StructField("component_name", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("short_description", T.StringType()),
    T.StructField("long_description", T.StringType()),
    T.StructField("assignee_name", T.StringType()),
    T.StructField("reporter_name", T.StringType()),
    T.StructField("resolution_category", T.StringType()),
    T.StructField("resolution_code", T.LongType()),
    T.StructField("status_category", T.StringType()),
    T.StructField("status_code", T.LongType()),
    T.StructField("update_date", T.StringType()),
    T.StructField("quantity_of_votes", T.LongType()),
    T.StructField("quantity_of_comments", T.LongType()),
    T.StructField("resolution_date", T.StringType()),
    T.StructField("bug_fix_time", T.LongType()),
    T.StructField("severity_category", T.StringType()),
    T.StructField("severity_code", T.LongType()),
])


def nulls_from_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn null tokens into nulls in all text columns."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({
        c: F.when(~F.col(f"`{c}`").isin(list(tokens)), F.col(f"`{c}`")) for c in text
    })


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
    tokens: Sequence[str] = NULL_TOKENS, multiline: bool | str = "split", invalid: str = "error",
) -> DataFrame:
    """Scan CSV with a header, which must agree with the schema.

    All columns are read as text, null tokens become nulls, and then types are given:
    those of the schema, or inferred in one scan. A text that does not fit the schema's
    type raises, or becomes null with `invalid="null"`. Quoted line breaks are kept and files
    are split among tasks (`sources.csvsplit`), which takes quotes as RFC 4180 has them. With
    `multiline=True` a file is one task, read by Spark alone; `multiline=False` is for files
    without quoted line breaks.
    """
    if multiline not in (True, False, "split"):
        raise ValueError(f"unknown multiline {multiline!r}")
    if invalid not in ("error", "null"):
        raise ValueError(f"unknown invalid {invalid!r}")
    split = multiline == "split"
    reader = spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=bool(multiline))
    if schema is None:
        # Parsed once, for finding the types and for giving them.
        frame = store(nulls_from_tokens(_split_csv(spark, path, sep, None) if split else reader.csv(path), tokens)).df
        return frame.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in infer_types(frame).items()])
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    frame = nulls_from_tokens(
        _split_csv(spark, path, sep, texts) if split
        else reader.options(enforceSchema=False).schema(texts).csv(path), tokens)
    columns = []
    for field in schema.fields:
        text = F.col(f"`{field.name}`")
        value = text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)
        if invalid == "error" and not isinstance(field.dataType, T.StringType):
            wrong = F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), text)
            value = F.when(
                text.isNotNull() & value.isNull(), F.raise_error(wrong).cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return frame.select(*columns)


def _split_csv(spark: SparkSession, path: str, sep: str, texts: T.StructType | None) -> DataFrame:
    """All columns as text; every file has the same header, which is checked."""
    rows, first = records(spark, path)
    header = first.select("text").distinct().limit(2).collect()
    if not header:
        if texts is None:
            raise ValueError(f"{path} has no header")
        return spark.createDataFrame([], texts)
    if len(header) > 1:
        raise ValueError(f"the files of {path} have different headers")
    [names] = csv.reader([header[0].text], delimiter=sep)
    if texts is None:
        texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif names != texts.names:
        raise ValueError(f"the header {names} differs from the columns {texts.names}")
    # numbered, so that no two columns of a header clash
    form = ", ".join(f"_c{i} string" for i in range(len(names)))
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"}
    parsed = rows.where("NOT first").select(F.from_csv("text", F.lit(form), options).alias("r"))
    return parsed.select(*[F.col(f"r._c{i}").alias(n) for i, n in enumerate(texts.names)])


# What every text of the type matches; blanks, control characters and signs are left open.
LOOKS_LIKE = {
    "bigint": r"^[^0-9A-Za-z.]*[0-9]+[^0-9A-Za-z.]*$",
    "double": r"^[^0-9A-Za-z.]*[0-9.iInN]",
    "boolean": r"^[^0-9A-Za-z]*(?i:t|true|y|yes|1|f|false|n|no|0)[^0-9A-Za-z]*$",
}


def infer_types(texts: DataFrame) -> dict[str, str]:
    """The narrowest of bigint, double and boolean that every text of a column has, else string."""
    kinds = ("bigint", "double", "boolean")

    def cast(column: str, kind: str):
        # Every failing cast costs an exception within Spark, so clear failures are left out.
        text = F.col(f"`{column}`")
        return F.when(text.rlike(LOOKS_LIKE[kind]), text.try_cast(kind))

    misses = texts.agg(*[
        F.count_if(F.col(f"`{c}`").isNotNull() & cast(c, k).isNull()).alias(f"{i}_{k}")
        for i, c in enumerate(texts.columns) for k in kinds
    ], *[F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(texts.columns)]).first()
    return {
        c: next((k for k in kinds if misses[f"{i}_n"] and not misses[f"{i}_{k}"]), "string")
        for i, c in enumerate(texts.columns)
    }


#: Scan partitions up to which a table is spread: 1 GiB at most, by Spark's default of
#: `spark.sql.files.maxPartitionBytes`.
SMALL_PARTITIONS = 8


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a small table of few scan partitions, such as a file of one row group.

    A table of more than SMALL_PARTITIONS partitions is never shuffled for it, however
    many cores there are.
    """
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(cores) if parts < cores and parts <= SMALL_PARTITIONS else df


def read_table(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    if format == "csv":
        return read_csv(spark, path, **options)
    if format == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown format {format!r}")


def write_table(
    df: DataFrame, folder: str, name: str, format: str = "parquet", mode: str = "overwrite"
) -> str:
    """Write `df` below `folder` under the name of the step that made it."""
    path = f"{folder.rstrip('/')}/{name}"
    writer = df.write.mode(mode)
    if format == "csv":
        writer.options(header=True, escape='"').csv(path)
    elif format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {format!r}")
    return path
