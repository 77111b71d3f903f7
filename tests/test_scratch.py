import os

import pytest

from tallyframe.materialize import store
from tallyframe.session import scratch_path, scratch_scope


def test_a_scope_deletes_its_own_tables_alone(spark):
    outer = store(spark.range(5).toDF("a"))
    with scratch_scope(spark):
        path = scratch_path(spark, "inner")
        with scratch_scope(spark):
            inmost = scratch_path(spark, "inmost")
            spark.range(3).write.parquet(inmost)
            assert os.path.isdir(inmost)
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path) and not os.path.exists(inmost)
        never_written = scratch_path(spark, "none")
    assert not os.path.exists(path) and not os.path.exists(never_written)
    assert outer.df.count() == 5


def test_a_scope_ends_with_its_job_whatever_happens(spark):
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        path = scratch_path(spark, "failed")
        spark.range(3).write.parquet(path)
        1 // 0
    assert not os.path.exists(path)
    later = scratch_path(spark, "later")
    spark.range(2).write.parquet(later)
    with scratch_scope(spark):
        pass
    assert spark.read.parquet(later).count() == 2
