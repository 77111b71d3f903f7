import pytest

import __spark_entry__ as contract
from checks import registry
from checks.compare import canonical, oracle_rows

SF = "/root/testdata/sf0.001"

# Covered end to end by other tests, and slow.
SLOW = {"model_input", "model_input_sizes", "train_metrics"}


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema and first.count() > 0


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in SLOW])
def test_query_matches_sql(spark, name):
    df = contract.queries()[name](spark, SF)
    got = df.collect()
    if name not in contract.oracle_sql():
        assert got
        return
    columns, want = oracle_rows(contract.oracle_sql()[name], SF)
    assert sorted(columns) == sorted(df.columns)
    assert canonical(got, df.columns) == canonical(want, columns)
