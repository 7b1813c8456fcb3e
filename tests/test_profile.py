import numpy as np
import pandas as pd
import pytest
from frames import six_rows
from pyspark.sql import functions as F

from offerlens.operators import profile as P
from offerlens.operators.columns import rename_columns
from offerlens.operators.summary import exact_quantiles


@pytest.fixture(scope="module")
def five(spark):
    return rename_columns(six_rows(spark, 5))


def test_target_and_month_counts(five):
    rows = P.target_distribution(five).collect()
    assert [(r["value"], r["count"], r["percent"]) for r in rows] == [("0", 3, 60.0), ("1", 2, 40.0)]
    months = {r["value"]: r["count"] for r in P.month_distribution(five).collect()}
    assert months == {"202401": 2, "202402": 1, "202403": 2}
    assert P.month_distribution(five.drop("MES")).isEmpty()
    with pytest.raises(ValueError):
        P.target_distribution(five.drop("FLAG_VENTA"))


def test_missing_is_a_value_of_its_own(spark):
    table = spark.createDataFrame([(1,), (None,), (None,)], "FLAG_VENTA int")
    assert [(r[0], r[1]) for r in P.value_counts(table, "FLAG_VENTA").collect()] == [(None, 2), ("1", 1)]


def test_null_report(five):
    nulls = {r["column"]: (r["nulls"], r["null_percent"]) for r in P.null_report(five).collect()}
    assert nulls["Uso_Linea"] == nulls["Uso_TrimLinea"] == nulls["REGION"] == (1, 20.0)
    assert nulls["MES"] == (0, 0.0)
    assert P.null_report(five.limit(0)).isEmpty()
    assert P.top_null_columns(five, 3).count() == 3


def test_published_percentages(spark):
    table = spark.createDataFrame([(19192, 21.92), (13856, 15.83), (5186, 5.92), (37, 0.04), (18, 0.02)], "n int, p double")
    assert table.where(P.percent(F.col("n"), F.lit(87556)) != F.col("p")).isEmpty()


def test_duplicates_treat_missing_as_equal(spark):
    nan = float("nan")
    rows = [(1, None, nan), (1, None, nan), (1, None, nan), (2, "a", 0.0), (2, "a", -0.0), (3, None, 1.0), (3, "a", 1.0)]
    table = spark.createDataFrame(rows, "a int, b string, c double")
    assert P.duplicate_rows(table).first()[0] == 3
    assert P.duplicate_rows(table.limit(0)).first()[0] == 0


def test_describe_equals_pandas(spark, five):
    ours = {r["column"]: r for r in P.describe_all(five).collect()}
    frame = five.toPandas().astype({"EDAD": float})
    for c in ("Uso_Linea", "EDAD", "Ahorro", "Deuda_Cubierta%"):
        theirs = frame[c].astype(float).describe()
        got = [ours[c][k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        assert got == pytest.approx(theirs.tolist())
    assert (ours["REGION"]["count"], ours["REGION"]["unique"], ours["REGION"]["top"], ours["REGION"]["freq"]) == (4, 2, "ESTE", 2)


def test_summary(five):
    row = P.validation_summary(five, "somewhere").first()
    assert (row["rows"], row["columns"], row["duplicated_rows"]) == (5, 22, 0)
    assert row["target_distribution"] == {"0": 3, "1": 2}
    assert row["total_null_values"] == int(five.toPandas().isna().sum().sum())


def test_patterns_cover_all_rows(five):
    rows = P.null_patterns(five).collect()
    assert sum(r["count"] for r in rows) == 5
    assert all(len(r["pattern"]) == 22 for r in rows)


@pytest.mark.parametrize("ranked", [10**6, 64])
def test_quantiles_are_exact_for_any_bracket_size(spark, ranked):
    """Heavy ties, a third of all rows on one value, gaps, negatives, one empty column."""
    rng = np.random.default_rng(1)
    n = 30_000
    smooth, skewed = rng.normal(size=n), np.where(rng.random(n) < 0.34, 7.0, rng.exponential(3.0, n) - 1)
    few, gaps = rng.integers(0, 5, n).astype(float), np.where(rng.random(n) < 0.2, np.nan, rng.random(n))
    frame = pd.DataFrame({"smooth": smooth, "skewed": skewed, "few": few, "gaps": gaps})
    table = spark.createDataFrame(frame).withColumn("gaps", F.when(~F.isnan("gaps"), F.col("gaps")))
    table = table.withColumn("none", F.lit(None).cast("double"))
    probabilities = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = exact_quantiles(table, table.columns, probabilities, ranked)
    for c in frame:
        assert got[c] == pytest.approx(frame[c].quantile(probabilities).tolist(), abs=1e-12)
    assert got["none"] == [None] * len(probabilities)


def test_describe_takes_every_type_and_no_column(spark):
    table = spark.range(5).selectExpr(
        "date_add(date'2024-02-27', cast(id as int)) as d", "timestamp_ntz'2024-01-01 10:00:00' as t", "id % 2 = 0 as b", "array(id % 2) as a",
        "named_struct('x', 1) as s", "cast('q' as binary) as y", "if(id = 0, double('nan'), id) as n", "cast(null as date) as e", "parse_json('{}') as v", "map(1, id % 2) as m")
    rows = {r["column"]: r for r in P.describe_all(table).collect()}
    assert list(sorted(rows)) == sorted(table.columns)
    assert (rows["d"]["earliest"], rows["d"]["latest"], rows["d"]["unique"]) == ("2024-02-27", "2024-03-02", 5)
    assert (rows["b"]["top"], rows["b"]["freq"], rows["b"]["earliest"]) == ("true", 3, None)
    assert (rows["a"]["top"], rows["m"]["unique"], rows["v"]["freq"], rows["y"]["top"]) == ("[0]", 2, 5, "q")
    assert (rows["n"]["count"], rows["n"]["mean"], rows["n"]["q50"], rows["e"]["count"], rows["e"]["earliest"]) == (4, 2.5, 2.5, 0, None)
    assert P.describe_all(table.select("d")).count() == 1
    assert P.describe_all(table.limit(0)).where("count = 0").count() == 10


def test_summary_scans_twice(spark, tmp_path):
    """Two reads of the table, by the plans that ran."""
    from offerlens.operators.summary import summarise

    spark.range(1000).selectExpr("id", "id * 1.5D as x", "cast(id % 7 as string) as c").write.parquet(str(tmp_path / "t"))
    calls = spark.sparkContext.accumulator(0)
    scans = spark.range(0).sparkSession.read.parquet(str(tmp_path / "t"))
    counted = scans.mapInPandas(lambda it: (calls.add(len(b)) or b for b in it), scans.schema)
    known = summarise(counted, ["x"], {"x": (0.1, 0.5), "id": (0.9,)}, ["c"])
    assert calls.value == 2000 and known.rows == 1000
    assert known.quantiles == {"x": [pytest.approx(149.85), 749.25], "id": [pytest.approx(899.1)]}
    assert {r["value"]: r["count"] for r in known.levels.collect()}["0"] == 143


def test_missed_brackets_are_widened(spark, monkeypatch):
    from offerlens.operators import summary

    monkeypatch.setattr(summary, "SKETCH_SIZE", 8)
    monkeypatch.setattr(summary, "MARGIN", 1e-6)
    table = spark.range(20_000).selectExpr("pmod(hash(id), 100003) as x")
    expected = table.toPandas()["x"].quantile([0.3, 0.5]).tolist()
    assert exact_quantiles(table, ["x"], (0.3, 0.5))["x"] == pytest.approx(expected)
