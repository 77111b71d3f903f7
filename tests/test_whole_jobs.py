"""The training queries leave the defaults of the library as they are."""

import pytest

from checks import models


class Called(Exception):
    pass


@pytest.fixture
def stopped(monkeypatch):
    """Record what the jobs are called with, and stop there."""
    def stop(name, result=None):
        def call(*args, **options):
            calls[name] = options
            if result is None:
                raise Called
            return result
        return call

    calls = {}
    made = type("Made", (), {"table": None})
    monkeypatch.setattr(models.features, "features", stop("features", made))
    monkeypatch.setattr(models.features, "run", stop("run"))
    monkeypatch.setattr(models.training, "train", stop("train"))
    return calls


@pytest.mark.parametrize("name", ["hyper_search", "train_metrics", "score_batch", "score_saved", "score_stream"])
def test_training_queries_use_the_defaults(spark, stopped, name):
    with pytest.raises(Called):
        getattr(models, name)(spark, "/root/testdata/sf0.001")
    assert stopped == {"features": {}, "train": {}}


def test_the_split_is_searched_in_full(spark, stopped):
    with pytest.raises(Called):
        models.train_predict(spark, "/root/testdata/sf0.001")
    assert stopped["train"] == {}


def test_the_feature_job_grows_classes(spark, stopped):
    with pytest.raises(Called):
        models.feature_job(spark, "/root/testdata/sf0.001")
    assert stopped["run"] == {"key": "row_key"}


def test_the_feature_table_is_written_once_and_compared_by_narrow_hashes(spark, monkeypatch):
    rows = [("a", "p", 0, 1.0, 2.0), ("b", "q", 0, float("nan"), None), ("b", "q", 0, 3.0, -0.0), (None, "p", 0, 1.0, 1.0)]
    made = type("Made", (), {"table": spark.createDataFrame(
        rows, "row_key string, product_name string, replica bigint, pca0 double, pca1 double")})
    monkeypatch.setattr(models, "_feature_table", lambda *a: made)
    found = models.feature_table_roundtrip(spark, "")
    assert sorted((r.row_key, r.product_name, r.same) for r in found.collect()) == [
        ("a", "p", True), *[("b", "q", False)] * 2, *[("b", "q", True)] * 2]
    plan = found._jdf.queryExecution().optimizedPlan()
    sides = plan.toString().split("Join")[1]
    assert "stored" not in sides and "pca" not in plan.output().mkString()
    joined = plan.children().head()
    widths = [[a.dataType().simpleString() for a in _all(side.output())] for side in _all(joined.children())]
    assert widths == [["string", "string", "bigint", "bigint"], ["string", "bigint"]]


def _all(scala):
    return [scala.apply(i) for i in range(scala.size())]
