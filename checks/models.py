"""Encoding, splitting, oversampling, projection, training and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.cleaning import CLEAN_SQL
from checks.registry import ISSUES, query
from tallyframe.functions.text import normalize
from tallyframe.materialize import store
from tallyframe.operators import (
    components, encoding, groupfeatures, metrics, neighbors, oversampling, sampling, stages,
    training as trees,
)
from tallyframe.operators.boosting import PATIENCE
from tallyframe.plans import cleaning, features, scoring, training
from tallyframe.plans.issues import FEATURE_INTS, as_issues, issues, table
from tallyframe.session import scratch_path
from tallyframe.sources import records
from tallyframe.sources.models import load_model, save_model
from tallyframe.sources.tables import read_table, write_table
from tallyframe.streaming.scoring import run_available, start_with_rejects

_QUOTAS = """
sizes AS (SELECT product_name, count(*) AS n FROM issues GROUP BY 1),
total AS (SELECT CAST(sum(n) AS BIGINT) AS total,
                 CAST(sum(n) - ceil(0.2::DOUBLE * sum(n)) AS BIGINT) AS train FROM sizes),
shared AS (SELECT product_name, n, CAST(n AS HUGEINT) * train // total AS share,
                  CAST(n AS HUGEINT) * train % total AS rest, train FROM sizes, total),
quotas AS (SELECT product_name, n, CAST(n - share - CASE WHEN row_number() OVER (ORDER BY rest DESC, product_name)
                  <= train - sum(share) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM shared)"""


@query("test_quotas", f"WITH {ISSUES}, {_QUOTAS} SELECT product_name, n, quota FROM quotas")
def test_quotas(spark, sf_dir):
    return sampling.test_quotas(issues(spark, sf_dir), "product_name").df


@query("stratified_split", f"""
WITH {ISSUES}, {_QUOTAS}
SELECT row_key, product_name,
       row_number() OVER (PARTITION BY product_name ORDER BY md5('0|' || row_key)) <= quota AS is_test
FROM issues JOIN quotas USING (product_name)""")
def stratified_split(spark, sf_dir):
    rows = issues(spark, sf_dir).select("row_key", "product_name")
    return sampling.stratified_split(rows, "product_name", ["row_key"])


_NEAR = """
pairs AS (
  SELECT a.label, a.vec_id, b.vec_id AS neighbor,
         list_sum(list_transform(list_zip(a.embedding, b.embedding),
                  lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS d
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
near AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbor) AS INTEGER) AS "rank"
         FROM pairs QUALIFY "rank" <= 5)"""


@query("knn_in_class", f"""
WITH {_NEAR} SELECT label, vec_id, neighbor, "rank", round(sqrt(d), 6) AS distance FROM near""")
def knn_in_class(spark, sf_dir):
    found = neighbors.nearest_in_class(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding")
    return found.withColumn("distance", F.round("distance", 6))


_UNIT = "('0x' || substr(draw, {start}, 8))::BIGINT / 4294967296.0::DOUBLE"


@query("oversample", f"""
WITH sizes AS (SELECT label, count(*) AS n, max(count(*)) OVER () - count(*) AS missing FROM embeddings GROUP BY label),
ranked AS (SELECT label, vec_id, embedding, n, missing,
                  row_number() OVER (PARTITION BY label ORDER BY md5('0|' || vec_id)) AS r
           FROM embeddings JOIN sizes USING (label)),
bases AS (SELECT *, missing // n + CASE WHEN r <= missing % n THEN 1 ELSE 0 END AS replicas FROM ranked),
drawn AS (SELECT label, vec_id, embedding, replica, md5('0|' || vec_id || '|' || replica) AS draw
          FROM (SELECT *, unnest(range(1, replicas + 1)) AS replica FROM bases)),
picked AS (SELECT *, CAST(floor({_UNIT.format(start=1)} * 5) AS INTEGER) + 1 AS "rank",
                  {_UNIT.format(start=9)} AS u FROM drawn),
{_NEAR},
made AS (SELECT p.label, p.vec_id, p.replica, p.u, near.neighbor, p.embedding AS x, e.embedding AS y
         FROM picked p JOIN near ON near.vec_id = p.vec_id AND near."rank" = p."rank"
         JOIN embeddings e ON e.vec_id = near.neighbor)
SELECT label, vec_id, replica, neighbor, i - 1 AS dim,
       round(x[i]::DOUBLE + u * (y[i]::DOUBLE - x[i]::DOUBLE), 6) AS value
FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM made)""")
def oversample(spark, sf_dir):
    made = oversampling.synthetic_points(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding")
    return made.select("label", "vec_id", "replica", "neighbor", F.posexplode("x").alias("dim", "value")
                       ).withColumns({"dim": F.col("dim").cast("bigint"), "value": F.round("value", 6)})


@query("oversample_mixed", f"""
WITH rows AS (
  SELECT c_custkey AS key, c_mktsegment AS label, CAST(floor(c_acctbal) AS BIGINT) AS p,
         CAST(c_custkey % 40 AS BIGINT) AS q, CASE WHEN c_nationkey < 20 THEN c_nationkey::VARCHAR END AS c
  FROM customer),
sizes AS (SELECT label, count(*) AS n, max(count(*)) OVER () - count(*) AS missing FROM rows GROUP BY label),
ranked AS (SELECT rows.*, n, missing, row_number() OVER (PARTITION BY label ORDER BY md5('0|' || key)) AS r
           FROM rows JOIN sizes USING (label)),
bases AS (SELECT *, missing // n + CASE WHEN r <= missing % n THEN 1 ELSE 0 END AS replicas FROM ranked),
drawn AS (SELECT *, md5('0|' || key || '|' || replica) AS draw
          FROM (SELECT *, unnest(range(1, replicas + 1)) AS replica FROM bases)),
picked AS (SELECT *, CAST(floor({_UNIT.format(start=1)} * 5) AS INTEGER) + 1 AS place,
                  {_UNIT.format(start=9)} AS u FROM drawn),
near AS (
  SELECT a.key, b.p AS yp, b.q AS yq, b.c AS yc, row_number() OVER (PARTITION BY a.key ORDER BY
           ((a.p - b.p) * (a.p - b.p) + (a.q - b.q) * (a.q - b.q)
            + CASE WHEN a.c = b.c OR coalesce(a.c, b.c) IS NULL THEN 0
                   WHEN a.c IS NULL OR b.c IS NULL THEN 1 ELSE 2 END), b.key) AS place
  FROM rows a JOIN rows b ON a.label = b.label AND a.key <> b.key)
SELECT key, label, p, q, c, CAST(0 AS BIGINT) AS replica FROM rows
UNION ALL
SELECT key, label, CAST(trunc(p::DOUBLE + u * (yp::DOUBLE - p::DOUBLE)) AS BIGINT),
       CAST(trunc(q::DOUBLE + u * (yq::DOUBLE - q::DOUBLE)) AS BIGINT),
       CASE WHEN c = yc THEN c END, replica
FROM picked JOIN near USING (key, place)""")
def oversample_mixed(spark, sf_dir):
    """Whole numbers and a category grown together, the mode of the feature job."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("label"),
        F.floor("c_acctbal").cast("bigint").alias("p"), (F.col("c_custkey") % 40).cast("bigint").alias("q"),
        F.when(F.col("c_nationkey") < 20, F.col("c_nationkey").cast("string")).alias("c"))
    return oversampling.oversample(rows, "label", "key", ["p", "q"], ["c"])


@query("class_growth", f"""
WITH {ISSUES} SELECT product_name AS label, count(*) AS n, max(count(*)) OVER () - count(*) AS missing
FROM issues GROUP BY product_name""")
def class_growth(spark, sf_dir):
    return oversampling.growth(issues(spark, sf_dir), "product_name").df


@query("one_hot_long", f"""
WITH {ISSUES}
SELECT row_key, 'component_name_' || component_name AS feature, 1 AS value FROM issues
UNION ALL SELECT row_key, 'assignee_name_' || assignee_name, 1 FROM issues""")
def one_hot_long(spark, sf_dir):
    return encoding.one_hot_long(issues(spark, sf_dir), ["row_key"], ["component_name", "assignee_name"])


@query("one_hot_unseen", f"""
WITH {ISSUES}, known AS (
  SELECT component_name, CAST(row_number() OVER (ORDER BY component_name) - 1 AS BIGINT) AS slot
  FROM (SELECT DISTINCT component_name FROM issues WHERE component_name NOT LIKE 'red%'))
SELECT row_key, component_name, slot, slot IS NOT NULL AS seen
FROM issues LEFT JOIN known USING (component_name)""")
def one_hot_unseen(spark, sf_dir):
    rows = issues(spark, sf_dir).select("row_key", "component_name")
    code = encoding.fit_slots(rows.where("component_name NOT LIKE 'red%'"), ["component_name"])
    slot = F.col("component_name_slot")
    return code.transform(rows).select("row_key", "component_name", slot.alias("slot"), slot.isNotNull().alias("seen"))


@query("one_hot_vectors", f"""
WITH {ISSUES}, known AS (
  SELECT component_name, CAST(row_number() OVER (ORDER BY component_name) - 1 AS BIGINT) AS slot
  FROM (SELECT DISTINCT component_name FROM issues WHERE component_name NOT LIKE 'red%'))
SELECT row_key, component_name, slot FROM issues LEFT JOIN known USING (component_name)""")
def one_hot_vectors(spark, sf_dir):
    """The same code as vectors; an unseen category is all zeros."""
    rows = issues(spark, sf_dir).select("row_key", "component_name")
    model = encoding.fit_one_hot(rows.where("component_name NOT LIKE 'red%'"), ["component_name"])
    slot = F.nullif(F.array_position(vector_to_array("component_name_code"), F.lit(1.0)), F.lit(0)) - 1
    return model.transform(rows).select("row_key", "component_name", slot.cast("bigint").alias("slot"))


@query("one_hot_sparse", f"""
WITH {ISSUES},
a AS (SELECT product_name, row_number() OVER (ORDER BY product_name) AS at
      FROM (SELECT DISTINCT product_name FROM issues WHERE product_name <> 'Brand#11')),
b AS (SELECT assignee_name, row_number() OVER (ORDER BY assignee_name) + (SELECT count(*) FROM a) AS at
      FROM (SELECT DISTINCT assignee_name FROM issues WHERE product_name <> 'Brand#11')),
w AS (SELECT (SELECT count(*) FROM a) + (SELECT count(*) FROM b) AS width)
SELECT row_key, width, concat_ws(',', a.at, b.at) AS slots
FROM issues LEFT JOIN a USING (product_name) LEFT JOIN b USING (assignee_name), w""")
def one_hot_sparse(spark, sf_dir):
    """Vectors of two columns, assembled from joined slots; slots from 1."""
    rows = issues(spark, sf_dir).select("row_key", "product_name", "assignee_name")
    code = encoding.fit_slots(rows.where("product_name <> 'Brand#11'"), ["product_name", "assignee_name"])
    made = code.vectors(rows).withColumn("code", F.unwrap_udt("code"))
    return made.select(
        "row_key", F.col("code")["size"].cast("bigint").alias("width"),
        F.array_join(F.transform(F.col("code")["indices"], lambda i: i + 1), ",").alias("slots"))


@query("one_hot_names", f"""
WITH {ISSUES}
SELECT DISTINCT 'component_name_' || component_name AS name FROM issues
UNION SELECT DISTINCT 'product_name_' || product_name FROM issues""")
def one_hot_names(spark, sf_dir):
    return encoding.fit_slots(issues(spark, sf_dir), ["component_name", "product_name"]).names().select("name")


@query("column_variance", f"WITH {ISSUES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(var_pop({c}), 6) AS variance FROM issues" for c in FEATURE_INTS))
def column_variance(spark, sf_dir):
    variances = encoding.column_variances(issues(spark, sf_dir), FEATURE_INTS)
    return variances.withColumn("variance", F.round("variance", 6))


_THRESHOLD = 0.0099
_PASSED = f"""{ISSUES},
numbers AS ({' UNION ALL '.join(f"SELECT '{c}' AS name, var_pop({c}) AS v FROM issues" for c in FEATURE_INTS)}),
codes AS (SELECT 'assignee_name_' || a.assignee_name AS name,
                 (count(*) / (SELECT count(*)::DOUBLE FROM issues))
                 * (1 - count(*) / (SELECT count(*)::DOUBLE FROM issues)) AS v FROM issues a GROUP BY 1),
passed AS (SELECT name FROM numbers WHERE v > {_THRESHOLD}::DOUBLE
           UNION ALL SELECT name FROM codes WHERE v > {_THRESHOLD}::DOUBLE)"""


@query("variance_filter", f"WITH {_PASSED} SELECT name FROM passed")
def variance_filter(spark, sf_dir):
    rows = issues(spark, sf_dir).select(*FEATURE_INTS, "assignee_name")
    numbers = encoding.column_variances(rows, FEATURE_INTS).where(F.col("variance") > _THRESHOLD)
    codes = encoding.fit_slots(rows, ["assignee_name"]).passed(rows.count(), _THRESHOLD)
    return numbers.select(F.col("column").alias("name")).unionByName(codes)


@query("feature_code", f"WITH {_PASSED} SELECT name FROM passed")
def feature_code(spark, sf_dir):
    code = encoding.fit_features(issues(spark, sf_dir), FEATURE_INTS, ["assignee_name"], _THRESHOLD)
    return spark.createDataFrame([(n,) for n in code.names], "name string")


@query("saved_parts", f"""
WITH {_PASSED}
SELECT row_key, (SELECT count(*) FROM passed) AS width,
       CAST(('assignee_name_' || assignee_name) IN (SELECT name FROM passed) AS INTEGER) AS ones,
       CAST({' + '.join(f"{c} * (SELECT count(*) FROM passed WHERE name = '{c}')" for c in FEATURE_INTS)} AS BIGINT) AS numbers
FROM issues""")
def saved_parts(spark, sf_dir):
    """Column selection and fitted code, saved, loaded and applied to rows with padded names and a column too few."""
    rows = issues(spark, sf_dir)
    fitted = rows.withColumn("assignee_name", normalize(F.col("assignee_name")))
    code = encoding.fit_features(fitted, FEATURE_INTS, ["assignee_name"], _THRESHOLD)
    chosen = stages.ColumnSelector(inputCols=["row_key", "absent", *FEATURE_INTS, "assignee_name"], textCols=["assignee_name"])
    folder = scratch_path(spark, "parts")
    save_model(PipelineModel([chosen, *code.model.stages]), folder, "code")
    padded = rows.withColumn("assignee_name", F.concat(F.lit("\t "), F.upper("assignee_name"), F.lit(" ")))
    made = load_model(folder, "code").transform(padded)
    cells, numeric = vector_to_array("features"), len(code.numeric)
    total = lambda part: F.aggregate(part, F.lit(0.0), lambda a, x: a + x)
    return made.select(
        "row_key", F.size(cells).cast("bigint").alias("width"),
        total(F.slice(cells, numeric + 1, max(1, len(code.names) - numeric))).cast("int").alias("ones"),
        total(F.slice(cells, 1, numeric)).cast("bigint").alias("numbers"))


@query("category_variance", f"""
WITH {ISSUES}, t AS (SELECT count(*)::DOUBLE AS total FROM issues),
c AS (SELECT 'component_name' AS "column", component_name AS "value", count(*) AS n FROM issues GROUP BY 2)
SELECT "column", "value", n, round(n / total * (1 - n / total), 9) AS variance FROM c, t""")
def category_variance(spark, sf_dir):
    found = encoding.category_variances(issues(spark, sf_dir), ["component_name"])
    return found.withColumn("variance", F.round("variance", 9))


_INDEXED = f"""{ISSUES}, classes AS (
  SELECT product_name, CAST(row_number() OVER (ORDER BY product_name) - 1 AS DOUBLE) AS label
  FROM (SELECT DISTINCT product_name FROM issues))"""


@query("label_index", f"""
WITH {_INDEXED} SELECT row_key, product_name, label FROM issues JOIN classes USING (product_name)""")
def label_index(spark, sf_dir):
    rows = issues(spark, sf_dir).select("row_key", "product_name")
    return encoding.fit_labels(rows, "product_name").transform(rows)


@query("label_decode", f"""
WITH {_INDEXED} SELECT row_key, c.product_name AS decoded
FROM issues JOIN classes c ON c.label = (resolution_code + status_code) % (SELECT count(*) FROM classes)""")
def label_decode(spark, sf_dir):
    rows = issues(spark, sf_dir)
    model = encoding.fit_labels(rows, "product_name")
    index = (F.col("resolution_code") + F.col("status_code")) % len(model.labelsArray[0])
    return encoding.label_decoder(model).transform(
        rows.select("row_key", index.cast("double").alias("prediction"))).drop("prediction")


_PREDICTED = f"""{ISSUES}, predicted AS (
  SELECT product_name AS label, CASE WHEN (bug_fix_time + resolution_code) % 3 = 0 THEN component_name
         ELSE product_name END AS prediction FROM issues WHERE status_code <> 4 OR product_name < 'Brand#2')"""


def _predicted(spark, sf_dir):
    rows = issues(spark, sf_dir).where("status_code <> 4 OR product_name < 'Brand#2'")
    wrong = (F.col("bug_fix_time") + F.col("resolution_code")) % 3 == 0
    return rows.select(F.col("product_name").alias("label"),
                       F.when(wrong, F.col("component_name")).otherwise(F.col("product_name")).alias("prediction"))


@query("confusion", f"WITH {_PREDICTED} SELECT label, prediction, count(*) AS n FROM predicted GROUP BY ALL")
def confusion(spark, sf_dir):
    return metrics.confusion(_predicted(spark, sf_dir), "label", "prediction")


@query("micro_f1", f"""
WITH {_PREDICTED}, classes AS (SELECT DISTINCT unnest([label, prediction]) AS c FROM predicted),
tally AS (SELECT c, count_if(label = c AND prediction = c) AS tp, count_if(label <> c AND prediction = c) AS fp,
                 count_if(label = c AND prediction <> c) AS fn FROM predicted, classes GROUP BY c)
SELECT round(sum(tp) / (sum(tp) + 0.5::DOUBLE * (sum(fp) + sum(fn))), 9) AS f1 FROM tally""")
def micro_f1(spark, sf_dir):
    return metrics.micro_f1(_predicted(spark, sf_dir), "label", "prediction").select(F.round("f1", 9).alias("f1"))


@query("balanced_accuracy", f"""
WITH {_PREDICTED}, recalls AS (SELECT avg((label = prediction)::INTEGER) AS recall FROM predicted GROUP BY label)
SELECT round(avg(recall), 9) AS balanced_accuracy FROM recalls""")
def balanced_accuracy(spark, sf_dir):
    score = metrics.balanced_accuracy(_predicted(spark, sf_dir), "label", "prediction")
    return score.select(F.round("balanced_accuracy", 9).alias("balanced_accuracy"))


@query("covariance", f"WITH {ISSUES} " + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(covar_samp({a}, {b}), 5) AS covariance FROM issues"
    for i, a in enumerate(FEATURE_INTS) for b in FEATURE_INTS[i:]))
def covariance(spark, sf_dir):
    found = components.covariances(issues(spark, sf_dir), FEATURE_INTS)
    return found.withColumn("covariance", F.round("covariance", 5))


def _vectors(spark, sf_dir):
    return VectorAssembler(inputCols=FEATURE_INTS, outputCol="features").transform(issues(spark, sf_dir))


@query("pca_project")
def pca_project(spark, sf_dir):
    rows = _vectors(spark, sf_dir).select("row_key", "features")
    model = components.fit_components(rows, "features", 3)
    return components.component_columns(model.transform(rows), ["row_key"], k=3)


@query("pca_invariants", f"""
WITH {ISSUES} SELECT round({' + '.join(f'var_samp({c})' for c in FEATURE_INTS)}, 4) AS variance,
       0.0::DOUBLE AS mean, 0.0::DOUBLE AS covariance, true AS falling FROM issues""")
def pca_invariants(spark, sf_dir):
    """All components together keep the variance, have mean 0 and do not correlate."""
    rows = _vectors(spark, sf_dir).select("features")
    k = len(FEATURE_INTS)
    projected = components.component_columns(components.fit_components(rows, "features", k).transform(rows), [], k=k)
    names = projected.columns
    return projected.agg(
        F.round(sum(F.var_samp(c) for c in names), 4).alias("variance"),
        F.round(F.greatest(*[F.abs(F.avg(c)) for c in names]), 4).alias("mean"),
        F.round(F.greatest(*[F.abs(F.covar_samp(a, b)) for a in names for b in names if a < b]), 4).alias("covariance"),
        F.array_sort(F.array(*[-F.var_samp(c) for c in names])).eqNullSafe(
            F.array(*[-F.var_samp(c) for c in names])).alias("falling"))


def _model_input(spark, sf_dir):
    return features.features(cleaning.clean(issues(spark, sf_dir), keep=["row_key"]), "row_key").table


@query("model_input", f"""
WITH {CLEAN_SQL}, sizes AS (SELECT product_name, count(*) AS n FROM clean GROUP BY 1)
SELECT row_key, product_name, CAST(0 AS BIGINT) AS replica, true AS complete FROM clean
UNION ALL
SELECT 'new rows', product_name, max(n) OVER () - n, true FROM sizes""")
def model_input(spark, sf_dir):
    """Every given row once, and per class as many new ones as the largest class has more."""
    table = store(_model_input(spark, sf_dir)).df
    complete = reduce(lambda a, b: a & b, [F.col(f"pca{i}").isNotNull() for i in range(features.COMPONENTS)])
    given = table.where("replica = 0").select("row_key", "product_name", "replica", complete.alias("complete"))
    new = table.groupBy("product_name").agg(
        F.lit("new rows").alias("row_key"), F.count_if(F.col("replica") > 0).alias("replica"),
        F.bool_and(complete).alias("complete"))
    return given.unionByName(new)


@query("model_input_sizes", f"""
WITH {CLEAN_SQL}, sizes AS (SELECT product_name, count(*) AS n FROM clean GROUP BY 1)
SELECT product_name, max(n) OVER () AS n FROM sizes""")
def model_input_sizes(spark, sf_dir):
    return _model_input(spark, sf_dir).groupBy("product_name").agg(F.count("*").alias("n"))


@query("feature_lookup_clean", f"""
WITH {CLEAN_SQL}, f AS (SELECT component_name, product_name, assignee_name,
  count(*) OVER (PARTITION BY product_name, component_name) AS n_components,
  count(*) OVER (PARTITION BY product_name, assignee_name) AS n_assignees,
  count(*) OVER (PARTITION BY product_name) AS n_product_rows FROM clean),
u AS (SELECT product_name, count(DISTINCT component_name) AS n_un_components FROM clean GROUP BY 1)
SELECT DISTINCT component_name, product_name, assignee_name, n_components, n_assignees, n_un_components, n_product_rows
FROM f JOIN u USING (product_name)""")
def feature_lookup_clean(spark, sf_dir):
    return groupfeatures.feature_lookup(cleaning.clean(issues(spark, sf_dir)))


def _whole_features(spark, sf_dir):
    """With the defaults of the job, so with grown classes."""
    return features.features(cleaning.clean(issues(spark, sf_dir), keep=["row_key"]), "row_key")


def _feature_table(spark, sf_dir):
    cleaned = cleaning.clean(issues(spark, sf_dir), keep=["row_key"])
    return features.features(cleaned, "row_key", resample="none")


_SPLIT_SQL = f"""
sizes AS (SELECT product_name, count(*) AS n FROM clean GROUP BY 1),
total AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) - ceil(0.2::DOUBLE * sum(n)) AS BIGINT) AS train FROM sizes),
shared AS (SELECT product_name, n, CAST(n AS HUGEINT) * train // total AS share,
                  CAST(n AS HUGEINT) * train % total AS rest, train FROM sizes, total),
quotas AS (SELECT product_name, n, CAST(n - share - CASE WHEN row_number() OVER (ORDER BY rest DESC, product_name)
                  <= train - sum(share) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM shared)"""


@query("train_predict", f"""
WITH {CLEAN_SQL}, {_SPLIT_SQL}
SELECT row_key, product_name, true AS known,
       row_number() OVER (PARTITION BY product_name ORDER BY md5('0|' || row_key || '|0')) <= quota AS is_test
FROM clean JOIN quotas USING (product_name)""")
def train_predict(spark, sf_dir):
    """The exact split of the given rows, not grown; a prediction is one of the classes."""
    trained = training.train(_feature_table(spark, sf_dir).table)
    known = F.col("predicted_name").isin(list(trained.labels.labelsArray[0]))
    return trained.predictions.select("row_key", "product_name", "is_test", known.alias("known"))


@query("train_boosted", """
WITH rows AS (SELECT doc_id, 2 * quality::DOUBLE + toxic::DOUBLE AS label FROM documents JOIN labels USING (doc_id)),
sizes AS (SELECT label, count(*) AS n FROM rows GROUP BY 1),
total AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) - ceil(0.2::DOUBLE * sum(n)) AS BIGINT) AS train FROM sizes),
shared AS (SELECT label, n, CAST(n AS HUGEINT) * train // total AS share,
                  CAST(n AS HUGEINT) * train % total AS rest, train FROM sizes, total),
quotas AS (SELECT label, n, CAST(n - share - CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
                  <= train - sum(share) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM shared)
SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('0|' || doc_id)) <= quota AS is_test,
       true AS known, true AS stopped
FROM rows JOIN quotas USING (label)""")
def train_boosted(spark, sf_dir):
    """Quality and toxicity from document columns: four classes boosted together.

    The split is exact, a prediction is one of the classes, and boosting ended at the best of
    at most 180 rounds, no more than the patience before the last one.
    """
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    words = F.size(F.split("text", r"\s+")).cast("double")
    rows = docs.select("doc_id", (
        2 * F.col("quality").cast("double") + F.col("toxic").cast("double")).alias("label"), F.array(
        F.col("n_chars").cast("double"), words, F.col("n_chars") / words).alias("features"))
    split = store(sampling.stratified_split(rows, "label", ["doc_id"])).df
    model, done = trees.fit_boosted(split, 4, validation="is_test")
    stopped = done.losses.index(min(done.losses)) == done.best_round <= done.rounds <= min(
        180, done.best_round + PATIENCE)
    return model.transform(split).select(
        "doc_id", "label", "is_test", F.col("prediction").isin(0.0, 1.0, 2.0, 3.0).alias("known"),
        F.lit(stopped).alias("stopped"))


@query("hyper_search")
def hyper_search(spark, sf_dir):
    return training.train(_whole_features(spark, sf_dir).table).trials


@query("train_metrics")
def train_metrics(spark, sf_dir):
    return training.train(_whole_features(spark, sf_dir).table).metrics


def _scorer(spark, sf_dir):
    made = _whole_features(spark, sf_dir)
    return scoring.build_scorer(made, training.train(made.table))


@query("score_batch", f"""
WITH {CLEAN_SQL}, combos AS (SELECT DISTINCT component_name, assignee_name FROM clean)
SELECT row_key, c.component_name IS NOT NULL AS lookup_hit, true AS known FROM issues i LEFT JOIN combos c
  ON lower(trim(i.component_name)) = c.component_name AND lower(trim(i.assignee_name)) = c.assignee_name""")
def score_batch(spark, sf_dir):
    """Exact hits of the lookup; a prediction is one of the classes."""
    scorer = _scorer(spark, sf_dir)
    known = F.col("product").isin(list(scorer.pipeline.stages[-1].getLabels()))
    return scorer.score(issues(spark, sf_dir), "row_key").select("row_key", "lookup_hit", known.alias("known"))


@query("score_saved", f"WITH {ISSUES} SELECT row_key, true AS lookup_hit, true AS same FROM issues")
def score_saved(spark, sf_dir):
    """Scores of the saved pipeline, loaded again, next to those of the scorer in memory."""
    raw, folder = issues(spark, sf_dir), scratch_path(spark, "scorer")
    made = _whole_features(spark, sf_dir)
    trained = training.train(made.table)
    scorer = scoring.build_scorer(made, trained, cleaning.learn(raw))
    scoring.save_scorer(scorer, folder)
    again = PipelineModel.load(f"{folder}/record_pipeline").transform(raw).select(
        "row_key", "lookup_hit", F.col("product").alias("again"))
    here = scorer.score(raw, "row_key").select("row_key", "product")
    return again.join(here, "row_key").select("row_key", "lookup_hit", (F.col("product") == F.col("again")).alias("same"))


@query("feature_job", f"""
WITH {CLEAN_SQL}, sizes AS (SELECT count(*) AS n FROM clean),
t AS (SELECT DISTINCT component_name, product_name, assignee_name FROM clean)
SELECT n AS final_selection, n AS model_input, (SELECT count(*) FROM t) AS feature_lookup,
       (SELECT count(DISTINCT (component_name, assignee_name)) FROM clean) AS lookup_means FROM sizes""")
def feature_job(spark, sf_dir):
    """The job from raw reports to saved tables, whose files are read again; of the model input, given rows count."""
    folder = scratch_path(spark, "features")
    features.run(issues(spark, sf_dir), folder, key="row_key")
    counts = [
        spark.read.parquet(f"{folder}/{name}").agg(
            (F.count_if(F.col("replica") == 0) if name == "model_input" else F.count("*")).alias(name))
        for name in ("final_selection", "model_input", "feature_lookup", "lookup_means")]
    return reduce(lambda a, b: a.join(F.broadcast(b)), counts)


@query("lookup_roundtrip", f"""
WITH {CLEAN_SQL}, f AS (SELECT component_name, product_name, assignee_name,
  count(*) OVER (PARTITION BY product_name, component_name) AS n_components,
  count(*) OVER (PARTITION BY product_name, assignee_name) AS n_assignees,
  count(*) OVER (PARTITION BY product_name) AS n_product_rows FROM clean),
u AS (SELECT product_name, count(DISTINCT component_name) AS n_un_components FROM clean GROUP BY 1)
SELECT DISTINCT component_name, product_name, assignee_name, n_components, n_assignees, n_un_components, n_product_rows
FROM f JOIN u USING (product_name)""")
def lookup_roundtrip(spark, sf_dir):
    """The lookup table through its files."""
    lookup = groupfeatures.feature_lookup(cleaning.clean(issues(spark, sf_dir)))
    return read_table(spark, write_table(lookup, scratch_path(spark, "lookup"), "feature_lookup"))


@query("feature_table_roundtrip", f"""
WITH {CLEAN_SQL} SELECT row_key, product_name, CAST(0 AS BIGINT) AS replica, true AS same FROM clean""")
def feature_table_roundtrip(spark, sf_dir):
    """The feature table through its files, every component equal to the last digit.

    A row carries a hash of its components as they were when they were written.
    """
    made = _feature_table(spark, sf_dir).table
    names = [c for c in made.columns if c.startswith("pca")]
    written = made.withColumn("_hash", _component_hash(names))
    again = read_table(spark, write_table(written, scratch_path(spark, "input"), "model_input"))
    there = again.select("row_key", "product_name", "replica", _component_hash(names).alias("there"))
    here = again.select("row_key", F.col("_hash").alias("here"))
    return there.join(here, "row_key").select("row_key", "product_name", "replica", (F.col("here") == F.col("there")).alias("same"))


def _component_hash(names):
    """Of the bits of all numbers, and of which are missing."""
    return F.xxhash64(*names, *[F.col(c).isNull() for c in names])


def _stream(spark, sf_dir):
    lines = spark.readStream.schema(table(spark, sf_dir, "lineitem").schema).option(
        "pathGlobFilter", "lineitem.parquet").option("maxFilesPerTrigger", 1000).parquet(sf_dir)
    return as_issues(lines, table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier"))


@query("score_stream", f"WITH {ISSUES} SELECT row_key, true AS same FROM issues")
def score_stream(spark, sf_dir):
    """Scores of the records as they arrive, next to those of the whole table."""
    scorer = _scorer(spark, sf_dir)
    streamed = run_available(_stream(spark, sf_dir), lambda rows: scorer.score(rows, "row_key"))
    batch = scorer.score(issues(spark, sf_dir), "row_key").select(
        "row_key", F.struct("lookup_hit", "product").alias("batch"))
    same = F.struct("lookup_hit", "product") == F.col("batch")
    return streamed.join(batch, "row_key").select("row_key", same.alias("same"))


@query("stream_rejects", f"""
WITH {ISSUES}
SELECT row_key, resolution_code > 2 AS scored, CASE WHEN resolution_code > 2 THEN component_name END AS component_name,
       CASE WHEN resolution_code > 2 THEN status_code + 1 END AS next_code,
       CASE WHEN resolution_code = 1 THEN 'no json' WHEN resolution_code = 2 THEN 'null' END AS rejected FROM issues""")
def stream_rejects(spark, sf_dir):
    """A stream of texts in two sinks: records, and texts that are none."""
    text = F.when(F.col("resolution_code") == 1, "no json").when(
        F.col("resolution_code") > 2, F.to_json(F.struct("component_name", "status_code")))
    parsed = records.parse_records(
        _stream(spark, sf_dir).select("row_key", text.alias("value")), keep=("row_key",), invalid="null")
    output, rejected = scratch_path(spark, "scored"), scratch_path(spark, "rejected")
    start_with_rejects(
        parsed, lambda rows: rows.select("row_key", "component_name", (F.col("status_code") + 1).alias("next_code")),
        output, rejected, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(output).select(
        "row_key", F.lit(True).alias("scored"), "component_name", "next_code",
        F.lit(None).cast("string").alias("rejected"),
    ).unionByName(spark.read.parquet(rejected).select(
        "row_key", F.lit(False).alias("scored"), F.lit(None).cast("string").alias("component_name"),
        F.lit(None).cast("bigint").alias("next_code"), "rejected"))


_MEANS_SQL = """
, f AS (SELECT component_name, assignee_name,
  count(*) OVER (PARTITION BY product_name, component_name) AS n_components,
  count(*) OVER (PARTITION BY product_name, assignee_name) AS n_assignees,
  count(*) OVER (PARTITION BY product_name) AS n_product_rows, product_name FROM issues),
u AS (SELECT product_name, count(DISTINCT component_name) AS n_un_components FROM issues GROUP BY 1),
d AS (SELECT DISTINCT component_name, assignee_name, n_components, n_assignees, n_un_components, n_product_rows
      FROM f JOIN u USING (product_name)),
means AS (SELECT component_name, assignee_name, avg(n_components) AS a, avg(n_assignees) AS b,
                 avg(n_un_components) AS c, avg(n_product_rows) AS e FROM d GROUP BY ALL)"""


@query("stream_lookup", f"""
WITH {ISSUES} {_MEANS_SQL}
SELECT row_key, round(coalesce(a, 0), 4) AS n_components, round(coalesce(b, 0), 4) AS n_assignees,
       round(coalesce(c, 0), 4) AS n_un_components, round(coalesce(e, 0), 4) AS n_product_rows,
       a IS NOT NULL AS lookup_hit
FROM issues LEFT JOIN means USING (component_name, assignee_name)""")
def stream_lookup(spark, sf_dir):
    """Records arrive as a stream and meet the saved mean counts."""
    means = store(groupfeatures.lookup_means(groupfeatures.feature_lookup(issues(spark, sf_dir))))
    scored = run_available(_stream(spark, sf_dir), lambda rows: groupfeatures.score_lookup(
        rows.select("row_key", "component_name", "assignee_name"), means), "lookup")
    measures = {m: F.round(m, 4) for m in groupfeatures.MEASURES}
    return scored.drop("component_name", "assignee_name").withColumns(measures)
