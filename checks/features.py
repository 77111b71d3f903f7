"""Group-count features, lookup and scoring joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ISSUES, lowered, query
from tallyframe.operators import frequency, groupfeatures
from tallyframe.plans.issues import issues

NAMES = ["component_name", "product_name", "assignee_name"]

# Names with gaps, so that null keys are exercised.
_GAPS = {
    "component_name": "nullif(component_name, CASE WHEN bug_fix_time % 11 = 0 THEN component_name END)",
    "product_name": "nullif(product_name, CASE WHEN bug_fix_time % 13 = 0 THEN product_name END)",
    "assignee_name": "nullif(assignee_name, CASE WHEN bug_fix_time % 17 = 0 THEN assignee_name END)",
}
_GAPPED = f"""{ISSUES},
gapped AS (SELECT row_key, {', '.join(f'{e} AS {c}' for c, e in _GAPS.items())} FROM issues)"""


def _features_sql(source: str) -> str:
    def count(column, keys):
        present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        return f"CASE WHEN {present} THEN count({column}) OVER (PARTITION BY {', '.join(keys)}) END"
    return f"""
distincts AS (SELECT product_name, count(DISTINCT component_name) AS n_un_components
              FROM {source} WHERE product_name IS NOT NULL GROUP BY product_name),
features AS (SELECT {source}.*,
  {count('component_name', ['product_name', 'component_name'])} AS n_components,
  {count('assignee_name', ['product_name', 'assignee_name'])} AS n_assignees,
  n_un_components,
  {count('product_name', ['product_name'])} AS n_product_rows
  FROM {source} LEFT JOIN distincts USING (product_name))"""


_ALL = f"{_GAPPED}, {_features_sql('gapped')}"
_MEASURES = "n_components, n_assignees, n_un_components, n_product_rows"


def gapped(spark, sf_dir):
    return issues(spark, sf_dir).select("row_key", *[F.expr(e).alias(c) for c, e in _GAPS.items()])


@query("group_features", f"""
WITH {_ALL} SELECT row_key, component_name, product_name, assignee_name, {_MEASURES} FROM features""")
def group_features(spark, sf_dir):
    return groupfeatures.group_features(gapped(spark, sf_dir))


@query("group_features_large", f"""
WITH {_ALL} SELECT row_key, component_name, product_name, assignee_name, {_MEASURES} FROM features""")
def group_features_large(spark, sf_dir):
    """Group features with every lookup joined by shuffle."""
    with lowered(spark, broadcastBytes=0):
        return groupfeatures.group_features(gapped(spark, sf_dir))


@query("distinct_per_group", f"""
WITH {_GAPPED}
SELECT product_name, count(DISTINCT component_name) AS n FROM gapped
WHERE product_name IS NOT NULL GROUP BY product_name""")
def distinct_per_group(spark, sf_dir):
    return frequency.distinct_per_group(gapped(spark, sf_dir), "product_name", "component_name", "n")


_LOOKUP = f"""{_ALL},
lookup AS (SELECT DISTINCT component_name, product_name, assignee_name, {_MEASURES} FROM features)"""


@query("feature_lookup", f"WITH {_LOOKUP} SELECT * FROM lookup")
def feature_lookup(spark, sf_dir):
    return groupfeatures.feature_lookup(gapped(spark, sf_dir))


_MEANS = f"""{_LOOKUP},
combos AS (SELECT DISTINCT component_name, assignee_name, {_MEASURES} FROM lookup),
means AS (SELECT component_name, assignee_name, avg(n_components) AS n_components,
                 avg(n_assignees) AS n_assignees, avg(n_un_components) AS n_un_components,
                 avg(n_product_rows) AS n_product_rows
          FROM combos WHERE component_name IS NOT NULL AND assignee_name IS NOT NULL GROUP BY ALL)"""
_ROUNDED = ", ".join(f"round({m}, 4) AS {m}" for m in _MEASURES.split(", "))


@query("lookup_mean", f"WITH {_MEANS} SELECT component_name, assignee_name, {_ROUNDED} FROM means")
def lookup_mean(spark, sf_dir):
    means = groupfeatures.lookup_means(groupfeatures.feature_lookup(gapped(spark, sf_dir)))
    return means.withColumns({m: F.round(m, 4) for m in groupfeatures.MEASURES})


@query("score_lookup", f"""
WITH {_MEANS}, asked AS (
  SELECT row_key, CASE WHEN bug_fix_time % 5 = 0 THEN component_name || ' x' ELSE component_name END AS component_name,
         assignee_name FROM issues),
joined AS (
  SELECT row_key, asked.component_name, asked.assignee_name,
         coalesce(n_components, 0) AS n_components, coalesce(n_assignees, 0) AS n_assignees,
         coalesce(n_un_components, 0) AS n_un_components, coalesce(n_product_rows, 0) AS n_product_rows,
         means.component_name IS NOT NULL AS lookup_hit
  FROM asked LEFT JOIN means USING (component_name, assignee_name))
SELECT row_key, component_name, assignee_name, {_ROUNDED}, lookup_hit FROM joined""")
def score_lookup(spark, sf_dir):
    name = F.expr("CASE WHEN bug_fix_time % 5 = 0 THEN component_name || ' x' ELSE component_name END")
    asked = issues(spark, sf_dir).select("row_key", name.alias("component_name"), "assignee_name")
    means = groupfeatures.lookup_means(groupfeatures.feature_lookup(gapped(spark, sf_dir)))
    scored = groupfeatures.score_lookup(asked, means)
    return scored.withColumns({m: F.round(m, 4) for m in groupfeatures.MEASURES})
