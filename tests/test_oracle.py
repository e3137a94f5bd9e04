"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import differences, oracle

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
SQL = entry_module.oracle_sql()
FITTED = sorted(set(entry_module.queries()) - set(SQL) - {"credit_evaluation"})


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    df = entry_module.queries()[name](spark, SF)
    assert differences(df, df.collect(), oracle(SF), SQL[name]) is None


@pytest.mark.parametrize("name", FITTED)
def test_fitted_query_gives_rows(spark, name):
    assert entry_module.queries()[name](spark, SF).count() > 0


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_module.queries())
