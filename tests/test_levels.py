from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from offerlens.operators.levels import level_index, one_hot_vector
from offerlens.plans.features import one_hot


def test_positions_and_values_are_those_of_the_dense_form(spark):
    rows = [(1, "b", 10), (2, None, 9), (3, "a", None), (4, "é", 10), (5, None, None), (6, "b", 10), (7, "a.b", 9)]
    df = spark.createDataFrame(rows, "id int, a string, `b c` int")
    index = level_index(df, ["b c", "a"])
    names = {r["column"]: [] for r in index.collect()}
    for r in index.orderBy("position").collect():
        assert r["index"] == len(names[r["column"]])
        names[r["column"]].append(r["value"])
    assert names == {"b c": ["10", "9"], "a": ["a", "a.b", "b", "é"]}
    dense = {r[0]: [float(x) for x in r[1:]] for r in one_hot(df, {c: names[c] for c in ("b c", "a")}).collect()}
    sparse = one_hot_vector(df, index, ["b c", "a"])
    assert sparse.columns == ["id", "a", "b c", "levels"]
    assert {r["id"]: r["v"] for r in sparse.select("id", vector_to_array("levels").alias("v")).collect()} == dense


def test_many_levels_make_no_columns(spark):
    df = spark.range(120_000).select("id", F.when(F.col("id") < 100_000, F.col("id")).otherwise(7).cast("string").alias("c"))
    index = level_index(df, ["c"])
    assert index.agg(F.count("*"), F.min("position"), F.max("position"), F.count_distinct("position")).first() == (100_000, 0, 99_999, 100_000)
    vectors = one_hot_vector(df, index, ["c"])
    assert vectors.columns == ["id", "c", "levels"]
    few = vectors.where("id % 9973 = 0").collect()
    order = {r["value"]: r["position"] for r in index.where(F.col("value").isin([r["c"] for r in few])).collect()}
    assert few and all(r["levels"].size == 100_000 and list(r["levels"].indices) == [order[r["c"]]] for r in few)


def test_unknown_levels_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, c string")
    index = level_index(df, ["c"])
    other = spark.createDataFrame([(3, "y")], "id int, c string")
    assert one_hot_vector(other, index, ["c"]).first()["levels"].toArray().tolist() == [0.0]
    nothing = df.where("id = 2")
    assert one_hot_vector(nothing, level_index(nothing, ["c"]), ["c"]).first()["levels"].size == 0
    assert level_index(df.limit(0), ["c"]).isEmpty()
