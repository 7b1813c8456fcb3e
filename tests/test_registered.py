"""Every registered query runs, and equals its SQL where it has any."""

import pytest
from compare import first_difference, spark_rows, sql_rows, sql_tables
from pyspark.sql import functions as F

from offerlens.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(folder):
    return sql_tables(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, folder, connection, name):
    ours = spark_rows(QUERIES[name](spark, folder))
    assert first_difference(ours, sql_rows(connection, ORACLES[name])) is None
    assert ours[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).limit(1).collect()


def test_score_batch_obeys_probability_laws(spark, folder):
    rows = QUERIES["score_batch"](spark, folder)
    assert rows.where(~F.col("score").between(0, 1)).isEmpty()
    assert rows.where(F.col("prediction") != (F.col("score") >= 0.5).cast("int")).isEmpty()


def test_importances_sum_to_one_in_falling_order(spark, folder):
    values = [r["importance"] for r in QUERIES["feature_importance"](spark, folder).collect()]
    assert sum(values) == pytest.approx(1.0)
    assert values == sorted(values, reverse=True)


def test_panel_reads_only_needed_columns(spark, folder):
    plan = QUERIES["target_distribution"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<FLAG_VENTA:bigint>" in plan
