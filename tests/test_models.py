import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyframe.operators import components, encoding, metrics, stages, training as trees
from tallyframe.operators.groupfeatures import lookup_means
from tallyframe.operators.stages import CleanNames, GroupLookup, NormalizedNames
from tallyframe.plans import cleaning, features, scoring, training
from tallyframe.plans.issues import FEATURE_INTS, as_issues, issues, table
from tallyframe.sources.models import load_model, save_model
from tallyframe.streaming.scoring import run_available

SF = "/root/testdata/sf0.001"


def test_slots_of_more_categories_than_a_driver_list(spark, bounds):
    df = spark.range(240_000).select("id", F.format_string("c%06d", F.col("id") % 120_000).alias("c"))
    bounds(broadcastBytes=0, singleTaskRows=50_000)
    code = encoding.fit_slots(df.where("id % 120000 <> 7"), ["c"])
    assert code.table.rows == 119_999
    found = code.transform(df)
    assert found.where("c_slot IS NULL").count() == 2
    wrong = F.col("c_slot") != F.col("id") % 120_000 - F.when(F.col("id") % 120_000 > 7, 1).otherwise(0)
    assert found.where(wrong).count() == 0 and found.count() == 240_000
    assert code.passed(240_000, 0.0).count() == 119_999


def test_vectors_of_any_width(spark, bounds):
    df = spark.range(120_000).select(
        "id", F.format_string("c%06d", F.col("id")).alias("c"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("d"), F.col("id") % 5)).alias("d"))
    bounds(broadcastBytes=0, singleTaskRows=50_000)
    code = encoding.fit_slots(df.where("id <> 7"), ["c", "d"])
    assert code.widths() == [119_999, 5]
    found = code.vectors(df)
    assert found.columns == ["id", "c", "d", "code"]
    for r in found.where("id < 40 OR id > 119990").collect():
        wanted = [] if r.id == 7 else [r.id - (r.id > 7)]
        wanted += [119_999 + r.id % 5] if r.id % 3 else []
        assert r.code.size == 120_004 and list(r.code.indices) == wanted and list(r.code.values) == [1.0] * len(wanted)
    assert found.count() == 120_000
    assembled = VectorAssembler(inputCols=["id", "code"], outputCol="all").transform(found.where("id = 4"))
    assert assembled.first()["all"].size == 120_005
    none = encoding.fit_slots(df.limit(0), ["c"]).vectors(df.limit(2)).collect()
    assert [r.code.size for r in none] == [0, 0]


def test_vectors_equal_those_of_the_stages(spark):
    df = issues(spark, SF).select("row_key", "component_name", "product_name")
    known = df.where("component_name NOT LIKE 'red%'")
    columns = ["component_name", "product_name"]
    model = encoding.fit_one_hot(known, columns)
    wide = VectorAssembler(inputCols=[f"{c}_code" for c in columns], outputCol="v").transform(model.transform(df))
    mine = encoding.fit_slots(known, columns).vectors(df, "own")
    both = wide.select("row_key", "v").join(mine, "row_key").select("v", "own").collect()
    assert len(both) >= df.count() and all(r.v.toArray().tolist() == r.own.toArray().tolist() for r in both[:500])


def dense(df, column):
    return np.array([r[0] for r in df.select(vector_to_array(column)).collect()])


def test_one_hot_is_alphabetical_and_blind_to_the_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "c string")
    model = encoding.fit_one_hot(df, ["c"])
    assert encoding.one_hot_names(model) == ["c_a", "c_b", "c_c"]
    asked = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert dense(model.transform(asked), "c_code").tolist() == [[1, 0, 0], [0, 0, 0], [0, 0, 0]]
    with pytest.raises(ValueError, match="3 categories"):
        encoding.fit_one_hot(df, ["c"], max_categories=2)


def test_variance_filter_uses_population_variance(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 0.0), (4.0, 0.0)], "a double, b double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    kept = lambda t: list(encoding.fit_variance_filter(vectors, "v", t).selectedFeatures)
    population = np.var([1, 3, 4])
    assert kept(population - 0.01) == [0] and kept(population + 0.01) == []


def test_feature_code_equals_code_then_filter(spark):
    df = issues(spark, SF).select(*FEATURE_INTS, "component_name", "assignee_name")
    threshold = 0.012
    code = encoding.fit_features(df, FEATURE_INTS, ["component_name", "assignee_name"], threshold)
    model = encoding.fit_one_hot(df, ["component_name", "assignee_name"])
    assembled = VectorAssembler(
        inputCols=[*FEATURE_INTS, "component_name_code", "assignee_name_code"], outputCol="v")
    wide = assembled.transform(model.transform(df))
    chosen = encoding.fit_variance_filter(wide, "v", threshold)
    names = FEATURE_INTS + encoding.one_hot_names(model)
    assert code.names == [names[i] for i in chosen.selectedFeatures]
    assert 0 < len(code.names) < len(names)
    both = code.model.transform(chosen.transform(wide).drop(
        *[f"{c}{end}" for c in code.categories for end in ("_index", "_code")]))
    assert both.where(F.col("features") != F.col("selected")).count() == 0
    again = code.model.transform(code.prune(df))
    assert np.allclose(sorted(map(tuple, dense(again, "features"))), sorted(map(tuple, dense(both, "selected"))))


def test_components_match_svd(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) + 50
    df = VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(
        spark.createDataFrame(data.tolist(), list("abcde")))
    found = dense(components.fit_components(df, "features", 3).transform(df), "pca")
    centred = data - data.mean(axis=0)
    axes = np.linalg.svd(centred, full_matrices=False)[2][:3]
    axes *= np.sign(axes[np.arange(3), np.abs(axes).argmax(axis=1)])[:, None]
    assert np.allclose(sorted(found.tolist()), sorted((centred @ axes.T).tolist()), atol=1e-6)


def test_components_of_a_code_are_those_of_its_vectors(spark, tmp_path, monkeypatch):
    rows = [(i % 7 * 1.0, 1e6 + i * i % 11, ["a", "b", "c", None][i * i % 4], ["u", "v", "w"][i % 3], i % 2 == 0)
            for i in range(90)]
    df = spark.createDataFrame(rows, "p double, q double, c string, d string, held boolean")
    code = encoding.fit_features(df, ["p", "q"], ["c", "d"], 0.01)
    learn = code.prune(df).where("held")
    encoded = code.model.transform(code.prune(df))
    wanted = components.fit_components(code.model.transform(learn), "features", 4)
    monkeypatch.setattr(PCA, "fit", lambda *a: pytest.fail("vectors were made"))
    found = components.fit_code_components(learn, code.numeric, code.categories, "features", 4)
    assert np.allclose(found.stages[0].explainedVariance.toArray(), wanted.stages[0].explainedVariance.toArray())
    for part in ("mean", "std"):
        assert np.allclose(*[getattr(m.stages[2], part).toArray() for m in (found, wanted)], atol=1e-6)
    save_model(found, str(tmp_path), "found")
    left, right = (dense(m.transform(encoded), "pca") for m in (load_model(str(tmp_path), "found"), wanted))
    assert np.allclose(left, right, atol=1e-6) and abs(left[::2].mean(axis=0)).max() < 1e-6
    with pytest.raises(ValueError, match="20 components"):
        components.fit_code_components(learn, code.numeric, code.categories, "features", 20)


def test_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "c"), ("b", "b"), ("d", None)], "y string, p string")
    assert metrics.micro_f1(df, "y", "p").first()[0] == 0.5
    assert metrics.balanced_accuracy(df, "y", "p").first()[0] == pytest.approx((0.5 + 2 / 3 + 0) / 3)
    counted = df.groupBy("y", "p").agg(F.count("*").alias("k"))
    assert metrics.micro_f1(counted, "y", "p", "k").first()[0] == 0.5


def test_search_space_is_seeded_and_in_range():
    drawn = trees.draw_trials(trials=50)
    assert drawn == trees.draw_trials(trials=50) != trees.draw_trials(trials=50, seed=1)
    for name, span in trees.SEARCH_SPACE.items():
        values = [d[name] for d in drawn]
        assert all(span.low <= v <= span.high for v in values)
        if span.step:
            assert all(v == int(v) for v in values)


def test_boosted_three_classes_and_reload(spark, tmp_path):
    df = spark.range(240).select(
        (F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 5 == 0).alias("held"),
        ((F.col("id") % 3) * 10 + F.col("id") % 4).cast("double").alias("x"), F.lit(1.0).alias("z"))
    df = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df)
    model, _ = trees.fit_boosted(df, 3, n_estimators=5, params={"max_depth": 2}, validation="held")
    predicted = model.transform(df)
    assert set(predicted.columns) == {"label", "held", "x", "z", "features", "prediction"}
    assert metrics.micro_f1(predicted, "label", "prediction").first()[0] == 1.0
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(df)
    assert metrics.micro_f1(again, "label", "prediction").first()[0] == 1.0


def test_custom_stages_reload(spark, tmp_path, reports):
    means = lookup_means(spark.createDataFrame(
        [("ui", "p", "jdt-ui-inbox", 4, 3, 2, 1)],
        "component_name string, product_name string, assignee_name string, "
        "n_components long, n_assignees long, n_un_components long, n_product_rows long"))
    means.write.parquet(str(tmp_path / "means"))
    pipeline = PipelineModel([stages.ColumnSelector(), stages.GroupLookup(path=str(tmp_path / "means"))])
    pipeline.write().save(str(tmp_path / "stages"))
    scored = PipelineModel.load(str(tmp_path / "stages")).transform(reports)
    assert scored.columns[:8] == stages.SCORING_COLUMNS
    assert scored.where("lookup_hit").count() == 2 and scored.where("n_components = 4").count() == 2


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    """The whole chain on the smallest tables."""
    folder = str(tmp_path_factory.mktemp("job"))
    raw = issues(spark, SF)
    made = features.run(raw, folder, key="row_key")
    trained = training.train(made.table, trials=[
        {"max_depth": 4, "gamma": 1.0, "colsample_bytree": 0.7, "min_child_weight": 1},
        {"max_depth": 2, "gamma": 1.0, "colsample_bytree": 0.7, "min_child_weight": 1},
    ], n_estimators=5, folder=folder)
    return raw, made, trained, folder


def test_feature_job(spark, job):
    raw, made, _, folder = job
    stored = spark.read.parquet(f"{folder}/model_input")
    assert stored.columns[:8] == [f"pca{i}" for i in range(8)]
    sizes = [r["count"] for r in stored.groupBy("product_name").count().collect()]
    assert len(set(sizes)) == 1
    means = stored.agg(*[F.avg(f"pca{i}") for i in range(8)]).first()
    assert np.allclose(means, 0, atol=1e-6)
    assert spark.read.parquet(f"{folder}/feature_lookup").count() == made.lookup.count()
    assert spark.read.parquet(f"{folder}/final_selection").count() == raw.count()


def test_training_job(spark, job):
    _, _, trained, folder = job
    scores = {(r["side"], r["metric"]): r["value"] for r in trained.metrics.collect()}
    assert set(scores) == {(s, m) for s in ("test", "train") for m in ("f1", "balanced_accuracy")}
    assert all(0 < v <= 1 for v in scores.values())
    trials = spark.read.parquet(f"{folder}/trials").collect()
    assert len(trials) == 2 and max(t["f1"] for t in trials) == pytest.approx(scores["test", "f1"])
    names = trained.predictions.select("prediction", "predicted_name").distinct().collect()
    assert len({r[0] for r in names}) == len({r[1] for r in names})


def test_stream_scores_like_batch(spark, job):
    raw, made, trained, folder = job
    for rules in (None, cleaning.learn(raw)):
        whole = scoring.save_scorer(scoring.build_scorer(made, trained, rules), folder)
        scorer = scoring.load_scorer(spark, folder)
        assert (scorer.rules is None) == (rules is None)
        batch = scorer.score(raw, "row_key")
        stream = as_issues(
            spark.readStream.schema(table(spark, SF, "lineitem").schema)
            .option("pathGlobFilter", "lineitem.parquet").parquet(SF),
            table(spark, SF, "part"), table(spark, SF, "supplier"))
        scored = run_available(stream, lambda rows: scorer.score(rows, "row_key"))
        assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, batch.collect()))
        assert batch.count() == raw.count()
        one = PipelineModel.load(f"{folder}/record_pipeline").transform(raw).select("row_key", "lookup_hit", "product")
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, batch.collect()))
        assert [type(s) for s in whole.stages[:2]] == [
            CleanNames if rules else NormalizedNames, GroupLookup]
    with pytest.raises(ValueError, match="not a stream"):
        run_available(raw, lambda rows: rows)


def test_growing_the_training_side_only(spark):
    cleaned = cleaning.clean(issues(spark, SF), keep=["row_key"])
    made = features.features(cleaned, "row_key", resample="train_only")
    table = made.table.select("product_name", "replica", "is_test", "pca0").toPandas()
    assert (table[table.is_test].replica == 0).all()
    assert table[~table.is_test].groupby("product_name").size().nunique() == 1
    assert (table.replica == 0).sum() == cleaned.count()
    assert table[table.is_test].groupby("product_name").size().nunique() > 1
    assert abs(table[~table.is_test].pca0.mean()) < 1e-6
    split = training.split_table(made.table, ["row_key"])
    assert split.where("is_test").count() == table.is_test.sum()
    with pytest.raises(ValueError, match="unknown resample"):
        features.features(cleaned, "row_key", resample="later")


def test_rows_without_a_key_get_one(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("b", 2)], "c string, n int")
    keyed = features.with_row_key(df)
    assert keyed.select("row_key").distinct().count() == 6
    assert sorted(map(tuple, keyed.select("c", "n").collect())) == [("a", 1)] * 5 + [("b", 2)]


def test_sparse_code_is_read_without_its_width(spark, tmp_path):
    from checks.models import one_hot_sparse

    spark.createDataFrame(
        [(i, 1, i % 3, i, 1.0, 0.0, 0.0, 10.0) for i in range(6)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_tax double, "
        "l_discount double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(i, "p", f"Brand#1{i}", 1) for i in range(3)], "p_partkey long, p_name string, p_brand string, p_size int",
    ).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(i, f"s{i}") for i in range(6)], "s_suppkey long, s_name string").write.parquet(
        f"{tmp_path}/supplier.parquet")
    found = one_hot_sparse(spark, str(tmp_path))
    assert "udf(code" not in found._jdf.queryExecution().toString().lower()
    assert {r["row_key"][0]: (r["width"], r["slots"]) for r in found.collect()} == {
        "0": (6, "1,3"), "1": (6, ""), "2": (6, "2,4"), "3": (6, "1,5"), "4": (6, ""), "5": (6, "2,6")}
