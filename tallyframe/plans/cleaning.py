"""The cleaning job: select, canonicalise, merge names, pool, select."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.functions.text import COMPONENT_RULES, Rule
from tallyframe.materialize import Sized, store
from tallyframe.operators.lookup import map_or_self
from tallyframe.operators.namemerge import rename_map
from tallyframe.operators.pooling import (
    canonical_names, frequent_values, head_values, pool_others,
)
from tallyframe.operators.projection import select_existing

# Columns kept from the raw table and after cleaning, in order.
REPORT_COLUMNS = [
    "creation_date", "component_name", "product_name", "resolution_category",
    "resolution_code", "status_code", "update_date", "quantity_of_votes",
    "quantity_of_comments", "bug_fix_time", "severity_code", "assignee_name",
]
FINAL_COLUMNS = [
    "component_name", "product_name", "resolution_code", "status_code",
    "quantity_of_votes", "quantity_of_comments", "bug_fix_time",
    "severity_code", "assignee_name",
]


@dataclass(frozen=True)
class CleaningRules:
    """What a cleaning run learned from its table; applies to any other table."""

    components: Sized
    assignees: Sized
    products: Sized
    rules: tuple[Rule, ...]
    rare_name: str
    tail_name: str

    def apply(self, df: DataFrame) -> DataFrame:
        """Clean rows without shuffling them, as far as the learned tables broadcast."""
        out = canonical_names(df, "component_name", self.rules)
        out = pool_others(out, self.components, "component_name", self.rare_name)
        out = map_or_self(out, self.assignees, "assignee_name")
        if "product_name" in df.columns:
            out = pool_others(out, self.products, "product_name", self.tail_name)
        return out

    def save(self, folder: str) -> None:
        """Write the learned tables and names below `folder`."""
        for name in ("components", "assignees", "products"):
            getattr(self, name).df.write.mode("overwrite").parquet(f"{folder}/{name}")
        names = {"rules": [asdict(r) for r in self.rules], "rare_name": self.rare_name, "tail_name": self.tail_name}
        spark = self.components.df.sparkSession
        spark.createDataFrame([(json.dumps(names),)], "names string").write.mode("overwrite").parquet(f"{folder}/names")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> CleaningRules:
        tables = {
            name: store(spark.read.parquet(f"{folder}/{name}")) for name in ("components", "assignees", "products")}
        names = json.loads(spark.read.parquet(f"{folder}/names").first()["names"])
        rules = tuple(Rule(**r) for r in names.pop("rules"))
        return CleaningRules(**tables, rules=rules, **names)


def learn(
    df: DataFrame, rules: Sequence[Rule] = COMPONENT_RULES, min_rows: int = 3,
    share: float = 0.95, threshold: int = 60, min_count: int = 2,
    rare_name: str = "other", tail_name: str = "product_other",
) -> CleaningRules:
    """Learn all cleaning tables from one scan of the rows.

    The steps depend on the counts of components and of (product, assignee)
    pairs only. Grouping sets count both in one pass and combine before the
    shuffle; every step then works on the counts.
    """
    names = ["component_name", "product_name", "assignee_name"]
    counts = store(
        canonical_names(df.select(*names), "component_name", rules)
        .groupingSets([["component_name"], ["product_name", "assignee_name"]], *names)
        .agg(F.count("*").alias("_n"), F.grouping("component_name").alias("_pair"))
    )
    components = counts.replace(counts.df.where("_pair = 0"))
    pairs = counts.replace(counts.df.where("_pair = 1"))
    return CleaningRules(
        components=frequent_values(components, "component_name", min_rows, "_n"),
        # Stored, since every use of the cleaned rows would compare the names again.
        assignees=store(rename_map(
            pairs, "product_name", "assignee_name", threshold, min_count, "_n")),
        products=head_values(pairs, "product_name", share, "_n"),
        rules=tuple(rules), rare_name=rare_name, tail_name=tail_name,
    )


def clean(df: DataFrame, keep: Sequence[str] = (), **options) -> DataFrame:
    """The whole cleaning job; `keep` names key columns to carry along."""
    selected = select_existing(df, [*keep, *REPORT_COLUMNS])
    learned = learn(selected, **options)
    return select_existing(learned.apply(selected), [*keep, *FINAL_COLUMNS])
