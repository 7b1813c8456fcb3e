import pytest
from pyspark.sql import functions as F

from offerlens.queries import QUERIES
from offerlens.session import stage_by_key


@pytest.fixture
def without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_stored_by_key_join_without_a_shuffle(spark, folder, without_broadcast):
    plan = _plan(QUERIES["keyed_join"](spark, folder))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_rows_stay_as_they_are(spark, without_broadcast):
    rows = [(1, "a", 1.0), (1, None, None), (None, None, 2.0), (2, "b", 3.0), (2, "b", 3.0)]
    df = spark.createDataFrame(rows, "`k 1` int, k2 string, v double")
    kept = stage_by_key(df, "keyed", ["k 1", "k2"], 4)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect()), key=str) == sorted(rows, key=str)
    per_key = kept.groupBy("k 1", "k2").agg(F.count("*").alias("n"))
    assert "Exchange" not in _plan(per_key) and sorted(r["n"] for r in per_key.collect()) == [1, 1, 1, 2]
    assert stage_by_key(df.limit(0), "keyed", ["k2"], 4).isEmpty()
