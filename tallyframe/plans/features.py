"""The feature job: group counts, codes, oversampling, components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.hashing import row_digest
from tallyframe.materialize import store
from tallyframe.operators.components import component_columns, fit_code_components
from tallyframe.operators.encoding import FeatureCode, fit_features
from tallyframe.operators.groupfeatures import (
    MEASURES, feature_lookup, learn_group_counts, lookup_means,
)
from tallyframe.operators.oversampling import oversample
from tallyframe.operators.sampling import replicate, stratified_split
from tallyframe.plans.cleaning import clean
from tallyframe.sources.models import save_model
from tallyframe.sources.tables import read_table, write_table

LABEL = "product_name"
# Fixed values.
NUMBERS = [
    "resolution_code", "status_code", "quantity_of_votes",
    "quantity_of_comments", "bug_fix_time", "severity_code",
]
CATEGORIES = ["component_name", "assignee_name"]
VARIANCE_THRESHOLD = 0.0005
COMPONENTS = 8


@dataclass(frozen=True)
class Features:
    """The feature table and everything fitted on the way to it."""

    table: DataFrame
    lookup: DataFrame
    code: FeatureCode
    components: PipelineModel

    @property
    def pipeline(self) -> PipelineModel:
        """From a row with group counts to its components."""
        return PipelineModel([*self.code.model.stages, *self.components.stages])


def with_row_key(df: DataFrame, out: str = "row_key") -> DataFrame:
    """Give each row a key made of its content and, for copies, a number."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n")).withColumn(
        "_digest", row_digest(0, df.columns))
    numbered = replicate(store(copies).df, "_n", "_i")
    return numbered.withColumn(out, F.concat_ws("-", "_digest", "_i")).select(*df.columns, out)


def features(
    cleaned: DataFrame, key: str | None = None, label: str = LABEL,
    numbers: Sequence[str] = NUMBERS, categories: Sequence[str] = CATEGORIES,
    variance_threshold: float = VARIANCE_THRESHOLD, k: int = COMPONENTS,
    resample: str = "before_split", seed: int = 0, small_classes: str = "error",
) -> Features:
    """Build the feature table from a cleaned table.

    The table has `pca0`.., the label, the row key and `replica`. Classes are
    grown to equal size before the components are fitted: all rows with
    `resample="before_split"`, only the training rows of an exact split, which
    the table then carries as `is_test`, with "train_only", and none with "none".
    """
    if resample not in ("before_split", "train_only", "none"):
        raise ValueError(f"unknown resample {resample!r}")
    keyed = cleaned if key else with_row_key(cleaned)
    key = key or "row_key"
    counts = learn_group_counts(keyed)
    lookup = feature_lookup(keyed, counts)
    counted = counts.apply(keyed).withColumns({m: F.coalesce(m, F.lit(0)) for m in MEASURES})
    # Read by the fits, the oversampling and the projection.
    counted = store(counted.select(key, label, *numbers, *MEASURES, *categories)).df
    code = fit_features(counted, [*numbers, *MEASURES], categories, variance_threshold)
    pruned = code.prune(counted)
    rows, extra = pruned, []
    if resample == "train_only":
        rows, extra = store(stratified_split(pruned, label, [key], seed=seed)).df, ["is_test"]
    original = F.lit(0).cast("bigint").alias("replica")
    if resample == "none":
        rows = rows.select("*", original)
    else:
        learn = rows.where(~F.col("is_test")) if extra else rows
        grown = oversample(
            learn, label, key, code.numeric, list(code.categories),
            seed=seed, small_classes=small_classes)
        if extra:
            held_out = rows.where("is_test").select(*grown.drop("replica").columns, original)
            grown = grown.withColumn("is_test", F.lit(False)).unionByName(
                held_out.withColumn("is_test", F.lit(True)))
        rows = grown
    # Given rows are a projection of a stored table already.
    rows = rows if resample == "none" else store(rows).df
    encoded = code.model.transform(rows)
    fitted_on = rows.where(~F.col("is_test")) if extra else rows
    components = fit_code_components(fitted_on, code.numeric, code.categories, "features", k)
    table = component_columns(components.transform(encoded), [label, key, "replica", *extra], k=k)
    return Features(table, lookup, code, components)


def run(raw: DataFrame, folder: str, format: str = "parquet", key: str | None = None, **options) -> Features:
    """Clean, build features, and save both tables and all fitted parts below `folder`."""
    carried = [key] if key else []
    path = write_table(clean(raw, keep=carried), folder, "final_selection", format)
    cleaned = read_table(raw.sparkSession, path, format)
    made = features(cleaned, key, **options)
    save(made, folder, format)
    return made


def save(made: Features, folder: str, format: str = "parquet") -> None:
    write_table(made.table, folder, "model_input", format)
    write_table(made.lookup, folder, "feature_lookup")
    write_table(lookup_means(made.lookup), folder, "lookup_means")
    save_model(made.pipeline, folder, "feature_pipeline")
