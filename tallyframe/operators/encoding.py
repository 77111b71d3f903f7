"""Label and one-hot encoding, variance filter, feature vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IndexToString, OneHotEncoder, StringIndexer, StringIndexerModel, VarianceThresholdSelector,
    VectorAssembler,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from tallyframe.materialize import Sized, store
from tallyframe.operators.lookup import attach
from tallyframe.operators.ordering import rank_rows
from tallyframe.operators.profiling import _unpivot, frequencies
from tallyframe.operators.quantiles import as_number

# Category lists live on the driver and in every task.
MAX_CATEGORIES = 100_000


def fit_labels(df: DataFrame, column: str, out: str = "label") -> StringIndexerModel:
    """Number the classes in alphabetical order; an unknown class is an error."""
    return StringIndexer(
        inputCol=column, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(df)


def label_decoder(model: StringIndexerModel, column: str = "prediction", out: str = "decoded") -> IndexToString:
    return IndexToString(inputCol=column, outputCol=out, labels=list(model.labelsArray[0]))


def column_variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population variance per numeric column: column, variance."""
    row = df.agg(*[F.var_pop(as_number(c)).alias(str(i)) for i, c in enumerate(columns)])
    return _unpivot(row, [
        F.struct(F.lit(c).alias("column"), F.col(str(i)).alias("variance"))
        for i, c in enumerate(columns)
    ])


def category_variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population variance of every one-hot column, without building any.

    A 0/1 column that is 1 in a share p of the rows has variance p (1 - p).
    """
    total = df.count()
    share = F.col("n") / F.lit(float(max(1, total)))
    return frequencies(df, columns).select(
        "column", "value", "n", (share * (1 - share)).alias("variance"))


def one_hot_long(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The ones of the one-hot code as rows: key, feature (`column_category`), value."""
    cells = F.array(*[
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}_"), F.col(c))) for c in columns])
    return df.select(*key, F.explode(F.array_compact(cells)).alias("feature")).withColumn("value", F.lit(1))


@dataclass(frozen=True)
class CategorySlots:
    """A one-hot code of any width, as a stored table: column, value, slot (from 0 in its column), n."""

    columns: list[str]
    table: Sized

    def names(self) -> DataFrame:
        """Names `column_category` of the slots."""
        return self.table.df.select(
            F.concat_ws("_", "column", "value").alias("name"), "column", "slot")

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `<column>_slot`; a null or unseen category has none."""
        for c in self.columns:
            own = self.table.df.where(F.col("column") == c).select(
                F.col("value").alias(c), F.col("slot").alias(f"{c}_slot"))
            df = attach(df, self.table.replace(own), [c])
        return df

    def widths(self) -> list[int]:
        """Categories of each column."""
        found = {r["column"]: r["n"] for r in self.table.df.groupBy("column").agg(F.count("*").alias("n")).collect()}
        return [found.get(c, 0) for c in self.columns]

    def vectors(self, df: DataFrame, out: str = "code") -> DataFrame:
        """Add the one-hot code of all columns, one after the other, as a sparse vector.

        The slots come by join and become the vector in Arrow batches, so its width
        is bounded by the vector type alone; a null or unseen category adds no one.
        """
        if out in df.columns:
            raise ValueError(f"there is a column {out!r} already")
        widths = self.widths()
        total = sum(widths)
        if total >= 1 << 31:
            raise ValueError(f"{total} categories do not fit one vector")
        firsts = np.cumsum([0, *widths[:-1]]).tolist()
        slots = F.array_compact(F.array(*[
            (F.col(f"{c}_slot") + first).cast("int") for c, first in zip(self.columns, firsts, strict=True)]))
        placed = self.transform(df).withColumn(out, slots).select(*[F.col(f"`{c}`") for c in df.columns], out)
        form = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())),
                          ("values", pa.list_(pa.float64()))])

        def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                given = batch.columns[-1]
                ends = np.cumsum([0, *given.value_lengths().to_pylist()]).astype(np.int32)
                flat = given.flatten().cast(pa.int32())
                vector = pa.StructArray.from_arrays([
                    pa.array(np.zeros(len(given), np.int8)), pa.array(np.full(len(given), total, np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends), flat),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ones(len(flat))))], fields=list(form))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], vector], names=batch.schema.names)

        return placed.mapInArrow(assemble, T.StructType([*df.schema.fields, T.StructField(out, VectorUDT())]))

    def passed(self, rows: int, threshold: float) -> DataFrame:
        """The names of slots whose population variance exceeds `threshold`."""
        share = F.col("n") / F.lit(float(max(1, rows)))
        kept = self.table.df.where(share * (1 - share) > F.lit(threshold))
        return kept.select(F.concat_ws("_", "column", "value").alias("name"))


def fit_slots(df: DataFrame, columns: Sequence[str]) -> CategorySlots:
    """Number the categories of each column in alphabetical order; no list reaches the driver."""
    ranked = rank_rows(store(frequencies(df, columns)), [F.asc("value")], "_rank", ["column"])
    return CategorySlots(list(columns), store(ranked.select(
        "column", "value", (F.col("_rank") - 1).cast("bigint").alias("slot"), "n")))


def _fit_codes(indexers: list, df: DataFrame, columns: list[str]):
    """Fit the encoder from the indexers' metadata; no rows are read."""
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_code" for c in columns],
        dropLast=True)
    return encoder.fit(PipelineModel(indexers).transform(df.limit(0)))


def fit_one_hot(df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES) -> PipelineModel:
    """One-hot vectors of all categories in alphabetical order, for pipelines of ML stages.

    Such stages keep their categories on the driver, so there is a bound to them;
    `fit_slots` gives the same code without one, as a table and as vectors.

    Null and unseen categories become all zeros: they are indexed into an extra
    last slot, which the encoder leaves out.
    """
    columns = list(columns)
    most = frequencies(df, columns).groupBy("column").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    if most and most > max_categories:
        raise ValueError(
            f"{most} categories in one column; use fit_slots, or fit_features, which keeps "
            "only those whose variance passes the threshold")
    indexer = StringIndexer(
        inputCols=columns, outputCols=[f"{c}_index" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    ).fit(df)
    return PipelineModel([indexer, _fit_codes([indexer], df, columns)])


def one_hot_names(model: PipelineModel) -> list[str]:
    """Names `column_category` of the coded columns."""
    indexer = model.stages[0]
    return [
        f"{c}_{label}" for c, labels in zip(indexer.getInputCols(), indexer.labelsArray) for label in labels
    ]


def fit_variance_filter(df: DataFrame, features: str, threshold: float, out: str = "selected"):
    """Keep vector slots whose population variance exceeds `threshold`.

    Spark's selector compares the sample variance, hence the correction.
    """
    n = df.count()
    if n < 2:
        raise ValueError("a variance needs at least two rows")
    return VarianceThresholdSelector(
        featuresCol=features, outputCol=out, varianceThreshold=threshold * n / (n - 1)).fit(df)


@dataclass(frozen=True)
class FeatureCode:
    """Fitted feature columns: which numbers and categories carry variance."""

    numeric: list[str]
    categories: dict[str, list[str]]
    model: PipelineModel

    @property
    def names(self) -> list[str]:
        return self.numeric + [f"{c}_{v}" for c, kept in self.categories.items() for v in kept]

    def prune(self, df: DataFrame) -> DataFrame:
        """Null out the categories that have no column of their own."""
        return df.withColumns({
            c: F.when(F.col(c).isin(kept), F.col(c)) for c, kept in self.categories.items()})


def fit_features(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
    threshold: float = 0.0005, out: str = "features",
) -> FeatureCode:
    """One-hot code and variance filter in one: numbers first, then categories.

    A category only passes when p (1 - p) > threshold for its share p, so at most
    about 1 / threshold categories of a column do. Only those reach the driver,
    however many there are, and the wide code is never built.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be positive")
    variances = {r["column"]: r["variance"] for r in column_variances(df, numeric).collect()}
    kept_numbers = [c for c in numeric if variances[c] is not None and variances[c] > threshold]
    passed = category_variances(df, categorical).where(F.col("variance") > F.lit(threshold))
    kept: dict[str, list[str]] = {}
    for row in passed.select("column", "value").collect():
        kept.setdefault(row["column"], []).append(row["value"])
    kept = {c: sorted(kept[c]) for c in categorical if c in kept}
    columns = list(kept)
    stages, codes = [], [f"{c}_code" for c in columns]
    if columns:
        indexers = [
            StringIndexerModel.from_labels(
                kept[c], inputCol=c, outputCol=f"{c}_index", handleInvalid="keep")
            for c in columns
        ]
        stages += [*indexers, _fit_codes(indexers, df, columns)]
    stages.append(VectorAssembler(inputCols=kept_numbers + codes, outputCol=out))
    return FeatureCode(kept_numbers, kept, PipelineModel(stages))
