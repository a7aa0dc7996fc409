"""Every registered query against DuckDB, or at least for rows, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import connect, differences

SLOW = {"cv_grid", "cv_selected", "compare_recipes"}  # exercised in test_tuning.py


@pytest.fixture(scope="module")
def duck(tables):
    return connect(tables)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_agrees_with_sql(spark, tables, duck, name):
    assert differences(queries()[name](spark, tables), duck, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_model_queries_beat_the_mean(spark, tables, name):
    found = queries()[name](spark, tables)
    if "prediction" not in found.columns:
        assert found.count() > 0
        return
    row = found.selectExpr(
        "sqrt(avg(pow(net - prediction, 2))) AS error", "stddev_pop(net) AS spread", "count(*) AS n"
    ).first()
    assert row["n"] > 1000
    assert row["error"] < row["spread"]


def test_entry_has_rows(spark, tables):
    assert entry(spark).count() > 0
