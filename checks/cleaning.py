"""Selections, text rules, pooling, name merging and the cleaning job."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ISSUES, component_case, lowered, query, score_sql
from tallyframe.functions.similarity import match_masks, score
from tallyframe.functions.text import apply_rules, normalize, COMPONENT_RULES
from tallyframe.operators import frequency, namemerge, pooling, projection
from tallyframe.operators.lookup import flag_members, last_wins, map_or_self
from tallyframe.plans import cleaning
from tallyframe.plans.issues import issues, table

@query("select_tolerant", f"""
WITH {ISSUES}
SELECT component_name, product_name, resolution_code, status_code, quantity_of_votes,
       quantity_of_comments, bug_fix_time, severity_code, assignee_name FROM issues""")
def select_tolerant(spark, sf_dir):
    return projection.select_existing(issues(spark, sf_dir), cleaning.REPORT_COLUMNS)


@query("drop_rename_cast", f"""
WITH {ISSUES}
SELECT row_key, CAST(resolution_code AS INTEGER) AS resolution, CAST(status_code AS INTEGER) AS status
FROM issues""")
def drop_rename_cast(spark, sf_dir):
    kept = projection.drop_columns(
        issues(spark, sf_dir), "component_name", "product_name", "assignee_name",
        "quantity_of_votes", "quantity_of_comments", "bug_fix_time", "severity_code",
    )
    named = projection.rename(kept, {"resolution_code": "resolution", "status_code": "status"})
    return projection.cast_columns(named, ["resolution", "status"], "int")


@query("normalize_text", """
SELECT p_partkey, regexp_replace(lower(concat(chr(9), ' ', upper(p_name), ' ', p_type, ' ', chr(10))),
                                 '^\\s+|\\s+$', '', 'g') AS name FROM part""")
def normalize_text(spark, sf_dir):
    padded = F.concat(F.lit("\t "), F.upper("p_name"), F.lit(" "), F.col("p_type"), F.lit(" \n"))
    return table(spark, sf_dir, "part").select("p_partkey", normalize(padded).alias("name"))


_RAW_NAME_SQL = """CASE p_partkey % 7 WHEN 0 THEN 'GIT ' || p_name WHEN 1 THEN p_name || ' Connector'
 WHEN 2 THEN 'git ' || p_name || ' package' WHEN 3 THEN 'Report connector ' || p_name
 WHEN 4 THEN '  CI-' || p_name || ' ' WHEN 5 THEN upper(p_name) ELSE p_name || ' ' || p_size END"""


def _raw_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.expr(_RAW_NAME_SQL).alias("component_name"))


_NORMAL_SQL = "regexp_replace(lower(component_name), '^\\s+|\\s+$', '', 'g')"
_NAMED_SQL = f"""
raw AS (SELECT p_partkey, {_RAW_NAME_SQL} AS component_name FROM part),
normal AS (SELECT p_partkey, {_NORMAL_SQL} AS name FROM raw),
named AS (SELECT p_partkey, {component_case('name')} AS component_name FROM normal)"""


@query("component_rules", f"WITH {_NAMED_SQL} SELECT p_partkey, component_name FROM named")
def component_rules(spark, sf_dir):
    named = apply_rules(normalize(F.col("component_name")), COMPONENT_RULES)
    return _raw_names(spark, sf_dir).withColumn("component_name", named)


@query("rare_pool", f"""
WITH {_NAMED_SQL}, sized AS (
  SELECT *, count(component_name) OVER (PARTITION BY component_name) AS n FROM named)
SELECT p_partkey, CASE WHEN n >= 3 THEN component_name ELSE 'other' END AS component_name FROM sized""")
def rare_pool(spark, sf_dir):
    return pooling.canonical_components(_raw_names(spark, sf_dir))


_PAIR_NAME = "p_brand || '|' || p_name"


@query("rare_pool_pairs", f"""
WITH sized AS (SELECT p_partkey, {_PAIR_NAME} AS name,
                      count(*) OVER (PARTITION BY {_PAIR_NAME}) AS n FROM part)
SELECT p_partkey, CASE WHEN n >= 3 THEN name ELSE 'other' END AS name FROM sized""")
def rare_pool_pairs(spark, sf_dir):
    named = table(spark, sf_dir, "part").select("p_partkey", F.expr(_PAIR_NAME).alias("name"))
    return pooling.pool_rare(named, "name")


@query("group_count", f"""
WITH {ISSUES}
SELECT row_key, component_name, count(component_name) OVER (PARTITION BY component_name) AS n FROM issues""")
def group_count(spark, sf_dir):
    rows = issues(spark, sf_dir).select("row_key", "component_name")
    return frequency.with_group_count(rows, ["component_name"], "n")


@query("value_counts", f"""
WITH {ISSUES}
SELECT product_name, count(*) AS counts FROM issues GROUP BY product_name ORDER BY 2 DESC, 1""")
def value_counts(spark, sf_dir):
    return frequency.value_counts(issues(spark, sf_dir), "product_name")


@query("first_rows", f"""
WITH {ISSUES}, c AS (SELECT component_name, count(*) AS counts FROM issues GROUP BY component_name)
SELECT component_name, counts FROM c ORDER BY counts DESC, component_name LIMIT 5""")
def first_rows(spark, sf_dir):
    counted = frequency.group_size(issues(spark, sf_dir), ["component_name"], "counts")
    from tallyframe.operators.ordering import first_rows as first
    return first(counted, 5, [F.desc("counts"), F.asc("component_name")])


def _pareto_sql(source: str, column: str) -> str:
    return f"""
counted AS (SELECT {column}, count(*) AS counts FROM {source} WHERE {column} IS NOT NULL GROUP BY 1),
pareto AS (SELECT {column}, counts,
       CAST(sum(counts) OVER (ORDER BY counts DESC, {column} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumsum,
       CAST(sum(counts) OVER (ORDER BY counts DESC, {column} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
         / CAST(sum(counts) OVER () AS DOUBLE) AS perce FROM counted)"""


@query("pareto_table", f"""
WITH {_pareto_sql('part', 'p_name')}
SELECT p_name, counts, cumsum, round(perce, 6) AS perce FROM pareto""")
def pareto_table(spark, sf_dir):
    ordered = frequency.pareto_table(table(spark, sf_dir, "part"), "p_name")
    return ordered.withColumn("perce", F.round("perce", 6))


@query("pareto_pool", f"""
WITH {ISSUES}, {_pareto_sql('issues', 'product_name')}
SELECT row_key, CASE WHEN product_name IN (SELECT product_name FROM pareto WHERE perce <= CAST(0.95 AS DOUBLE))
       THEN product_name ELSE 'product_other' END AS product_name FROM issues""")
def pareto_pool(spark, sf_dir):
    return pooling.pool_tail(issues(spark, sf_dir).select("row_key", "product_name"))


_NULLED = "nullif(p_name, CASE WHEN p_partkey % 9 = 0 THEN p_name END)"


@query("pareto_pool_nulls", f"""
WITH named AS (SELECT p_partkey, {_NULLED} AS name FROM part), {_pareto_sql('named', 'name')}
SELECT p_partkey, CASE WHEN name IN (SELECT name FROM pareto WHERE perce <= CAST(0.95 AS DOUBLE))
       THEN name ELSE 'name_other' END AS name FROM named""")
def pareto_pool_nulls(spark, sf_dir):
    named = table(spark, sf_dir, "part").select("p_partkey", F.expr(_NULLED).alias("name"))
    return pooling.pool_tail(named, "name", 0.95, "name_other")


@query("grand_total", f"""
WITH {ISSUES}, c AS (SELECT product_name, count(*) AS counts FROM issues GROUP BY 1)
SELECT CAST(sum(counts) AS BIGINT) AS total FROM c""")
def grand_total(spark, sf_dir):
    sizes = frequency.group_size(issues(spark, sf_dir), ["product_name"], "counts")
    return frequency.grand_total(sizes, "counts")


@query("pair_counts", f"""
WITH {ISSUES}
SELECT product_name, assignee_name, count(*) AS n FROM issues GROUP BY ALL""")
def pair_counts(spark, sf_dir):
    return frequency.group_size(issues(spark, sf_dir), ["product_name", "assignee_name"])


_TOP_SQL = f"""{ISSUES},
pairs AS (SELECT product_name, assignee_name, count(*) AS n FROM issues GROUP BY ALL),
best AS (SELECT *, max(n) OVER (PARTITION BY product_name) AS top_n FROM pairs)"""


@query("top_per_product", f"""
WITH {_TOP_SQL} SELECT product_name, assignee_name, n, top_n FROM best WHERE n = top_n""")
def top_per_product(spark, sf_dir):
    pairs = frequency.group_size(issues(spark, sf_dir), ["product_name", "assignee_name"])
    return frequency.top_of_group(pairs, "product_name")


_LONG = tuple(f"lower(concat({', '.join(['p_' + c for c in order] * 3)}))" for order in (
    ("name", "type", "brand"), ("type", "brand", "name")))


@query("similarity_long", f"""
WITH names AS (SELECT DISTINCT {_LONG[0]} AS a, {_LONG[1]} AS b FROM part)
SELECT a, b, {score_sql('a', 'b')} AS score FROM names""")
def similarity_long(spark, sf_dir):
    """Texts of several words of bits on both sides."""
    names = table(spark, sf_dir, "part").select(F.expr(_LONG[0]).alias("a"), F.expr(_LONG[1]).alias("b")).distinct()
    return names.select("a", "b", score(F.col("a"), F.col("b"), match_masks(F.col("b"))).alias("score"))


@query("similarity_pairs", f"""
WITH names AS (SELECT DISTINCT p_name, p_type FROM part)
SELECT p_name, p_type, {score_sql('p_name', 'lower(p_type)')} AS score FROM names""")
def similarity_pairs(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_name", "p_type").distinct()
    kind = F.lower("p_type")
    return names.select("p_name", "p_type", score(F.col("p_name"), kind, match_masks(kind)).alias("score"))


_FUZZY_SQL = f"""{_TOP_SQL},
leaders AS (SELECT product_name, assignee_name AS leader, top_n FROM best WHERE n = top_n AND top_n > 1),
met AS (SELECT product_name, leader, top_n, assignee_name FROM leaders JOIN pairs USING (product_name)),
names AS (SELECT DISTINCT leader, assignee_name FROM met),
scored AS (SELECT leader, assignee_name, {score_sql('assignee_name', 'leader')} AS score FROM names),
fuzzy AS (SELECT product_name, leader, top_n, assignee_name, score
          FROM met JOIN scored USING (leader, assignee_name) WHERE score > 60 AND score <> 100),
mapping AS (SELECT assignee_name AS source, arg_max(leader, (product_name, leader)) AS target
            FROM fuzzy GROUP BY assignee_name)"""


@query("fuzzy_join", f"WITH {_FUZZY_SQL} SELECT product_name, leader, top_n, assignee_name, score FROM fuzzy")
def fuzzy_join(spark, sf_dir):
    return namemerge.similar_pairs(issues(spark, sf_dir), "product_name", "assignee_name")


@query("rename_map", f"WITH {_FUZZY_SQL} SELECT source, target FROM mapping")
def rename_map(spark, sf_dir):
    return namemerge.rename_map(issues(spark, sf_dir), "product_name", "assignee_name")


@query("assignee_merge", f"""
WITH {_FUZZY_SQL}
SELECT row_key, product_name, coalesce(target, assignee_name) AS assignee_name
FROM issues LEFT JOIN mapping ON assignee_name = source""")
def assignee_merge(spark, sf_dir):
    rows = issues(spark, sf_dir).select("row_key", "product_name", "assignee_name")
    return namemerge.merge_names(rows)


@query("assignee_merge_by_product", f"""
WITH {_FUZZY_SQL}, local AS (
  SELECT product_name, assignee_name, max(leader) AS target FROM fuzzy GROUP BY ALL)
SELECT row_key, product_name, coalesce(target, assignee_name) AS assignee_name
FROM issues LEFT JOIN local USING (product_name, assignee_name)""")
def assignee_merge_by_product(spark, sf_dir):
    rows = issues(spark, sf_dir).select("row_key", "product_name", "assignee_name")
    return namemerge.merge_names(rows, scope="block")


@query("last_wins_map", f"""
WITH {ISSUES}
SELECT assignee_name, max((product_name, component_name))[2] AS component_name
FROM issues GROUP BY assignee_name""")
def last_wins_map(spark, sf_dir):
    return last_wins(issues(spark, sf_dir), "assignee_name", "component_name",
                     ["product_name", "component_name"])


@query("map_or_self", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       coalesce('nation ' || s_nationkey, CAST(l_suppkey AS VARCHAR)) AS owner
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey""")
def map_or_self_query(spark, sf_dir):
    mapping = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").cast("string").alias("source"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("target"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_suppkey").cast("string").alias("owner"))
    return map_or_self(rows, mapping, "owner")


@query("in_set_flag", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25) AS large FROM lineitem""")
def in_set_flag(spark, sf_dir):
    large = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return flag_members(rows, large, "l_partkey", "large")


CLEAN_SQL = f"""{_FUZZY_SQL},
component AS (SELECT *, {component_case("lower(component_name)")} AS c FROM issues),
pooled AS (SELECT *, CASE WHEN count(c) OVER (PARTITION BY c) >= 3 THEN c ELSE 'other' END AS pooled_name
           FROM component),
{_pareto_sql('issues', 'product_name')},
clean AS (
SELECT row_key, pooled_name AS component_name,
       CASE WHEN product_name IN (SELECT product_name FROM pareto WHERE perce <= CAST(0.95 AS DOUBLE))
            THEN product_name ELSE 'product_other' END AS product_name,
       resolution_code, status_code, quantity_of_votes, quantity_of_comments, bug_fix_time, severity_code,
       coalesce(target, assignee_name) AS assignee_name
FROM pooled LEFT JOIN mapping ON assignee_name = source)"""


@query("clean_job", f"WITH {CLEAN_SQL} SELECT * FROM clean")
def clean_job(spark, sf_dir):
    return cleaning.clean(issues(spark, sf_dir), keep=["row_key"])


@query("clean_job_large", f"WITH {CLEAN_SQL} SELECT * FROM clean")
def clean_job_large(spark, sf_dir):
    """The cleaning job with every lookup joined by shuffle and every order cut into slices."""
    with lowered(spark, broadcastBytes=0, singleTaskRows=50):
        return cleaning.clean(issues(spark, sf_dir), keep=["row_key"])


@query("clean_summary", f"""
WITH {CLEAN_SQL} SELECT product_name, component_name, count(*) AS n FROM clean GROUP BY ALL""")
def clean_summary(spark, sf_dir):
    """Flagship: the cleaned table, counted by product and component."""
    cleaned = cleaning.clean(issues(spark, sf_dir))
    return cleaned.groupBy("product_name", "component_name").agg(F.count("*").alias("n"))
