import math

import pytest
from frames import six_rows
from pyspark.sql import functions as F

from offerlens.contract import FeatureSpec
from offerlens.functions.scalars import whole
from offerlens.operators import columns as C
from offerlens.operators import gates as G
from offerlens.plans import features as B
from offerlens.sources.panel import _hundredths

SPEC = FeatureSpec()


@pytest.fixture(scope="module")
def raw(spark):
    return six_rows(spark)


@pytest.fixture(scope="module")
def model(raw):
    return B.FeatureBuilder().fit(raw)


def test_whole_rounds_as_round_does_and_makes_no_decimals(spark):
    halves = [0.5, 1.5, 2.5, 0.49999999999999994, 114.99999999999999, 4503599627370495.5, 9007199254740993.0, 1e17, 0.0, 0.07 * 100, 1.005 * 100]
    table = spark.createDataFrame([(x,) for v in halves for x in (v, -v)] + [(None,)], "a double")
    made = table.select(whole(F.col("a")).cast("long").alias("w"), F.round("a").cast("long").alias("r"))
    assert all(r["w"] == r["r"] for r in made.collect())
    for used in (_hundredths("a"), whole(F.col("a"))):
        assert "round(" not in table.select(used.alias("h"))._jdf.queryExecution().optimizedPlan().toString()


def test_floor_keeps_missing_missing(spark):
    table = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "a double")
    assert [r[0] for r in C.floor_columns(table, ["a", "absent"]).collect()] == [0.0, None, 2.0]


def test_log_floors_its_source(spark):
    table = spark.createDataFrame([("-3",), ("x",), ("7",)], "a string")
    rows = [tuple(r) for r in C.add_log_features(table, ["a", "absent"]).collect()]
    assert rows == [(0.0, 0.0), (None, None), (7.0, pytest.approx(math.log(8)))]


def test_uniform_draws_stay_in_their_range(raw):
    table = B.prepare(raw)
    fitted = B.fit_uniform(table, ["Meses_oferta"])
    f = fitted["Meses_oferta"]
    assert (f["nulls"], f["mean"]) == (2, 7.0)
    assert f["std"] == pytest.approx(2.581988897471611)
    filled = B.impute_uniform(table, fitted, SPEC.key, SPEC.seed)
    assert filled.where("Meses_oferta is null").isEmpty()
    drawn = [r["Meses_oferta"] for r in filled.where(F.col("CLIENTE").isin(72, 75)).collect()]
    assert len(set(drawn)) == 2
    assert all(f["lower"] <= v <= f["upper"] for v in drawn)


def test_published_bounds():
    """Mean and deviation of two columns give the published draw ranges."""
    for mean, std, lower, upper in ((0.07870700457758947, 0.1570558247635814, 0.0, 0.23576282934117088),
                                    (14.704464043419268, 5.929295170542251, 8.775168872877018, 20.63375921396152)):
        low = max(0.0, mean - std)
        assert (low, max(low, mean + std)) == pytest.approx((lower, upper))


def test_draws_do_not_depend_on_partitions(raw, model):
    one = model.keeping("CLIENTE").transform(raw.coalesce(1)).orderBy("CLIENTE").collect()
    many = model.keeping("CLIENTE").transform(raw.repartition(4)).orderBy("CLIENTE").collect()
    assert one == many


def test_empty_and_single_columns(spark):
    table = spark.createDataFrame([(None, 5.0, None), (None, None, None)], "a double, b double, c string")
    fitted = B.fit_uniform(table, ["a", "b"])
    assert (fitted["a"]["mean"], fitted["a"]["std"], fitted["b"]["std"]) == (0.0, 0.0, 0.0)
    assert B.fit_median(table, ["a"])["a"]["value"] == 0.0
    spec = FeatureSpec(categorical=("c",))
    mode = B.fit_categories(table, spec)["c"]
    assert (mode["value"], mode["levels"]) == ("DESCONOCIDO", ["DESCONOCIDO"])


def test_even_median(spark):
    table = spark.createDataFrame([(float(i),) for i in range(1, 5)], "a double")
    assert B.fit_median(table, ["a"])["a"]["value"] == 2.5


def test_mode_ties_take_the_smallest(raw):
    fitted = B.fit_categories(raw, SPEC)
    assert (fitted["REGION"]["value"], fitted["EST_CIVIL"]["value"], fitted["SEXO"]["value"]) == ("ESTE", "UNIDO", "F")


def test_too_many_levels_is_an_error(raw):
    with pytest.raises(ValueError, match="REGION"):
        B.fit_categories(raw, FeatureSpec(categorical=("REGION", "SEXO"), max_levels=2))


def test_one_hot_of_a_missing_value_is_zero(spark):
    table = spark.createDataFrame([("b",), (None,)], "c string")
    coded = B.one_hot(table, {"c": ["a", "b c", "b"]})
    assert coded.columns == ["c_a", "c_b c", "c_b"]
    assert [tuple(r) for r in coded.collect()] == [(0, 0, 1), (0, 0, 0)]


def test_feature_table(raw, model):
    table = model.transform(raw)
    G.enforce(G.final_gate(table))
    G.enforce(G.label_gate(table))
    assert table.columns[:8] == ["MES", "Plazo_Renovado", "FLAG_VENTA", "Nro_Entidades", "Dif_Entidades", "Meses_oferta",
                                 "EDAD", "Flag_LimProv"]
    assert table.columns[8:18] == [f"{c}_LOG" for c in SPEC.log]
    assert table.columns[18:] == ["REGION_ESTE", "REGION_NORTE", "REGION_SUR", "SEXO_F", "SEXO_M",
                                  "EST_CIVIL_LIBRE", "EST_CIVIL_UNIDO", "EST_CIVIL_VIUDO"]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_state_survives_saving(raw, model, tmp_path):
    model.write().overwrite().save(str(tmp_path / "m"))
    back = B.FeatureBuilderModel.load(str(tmp_path / "m"))
    assert back.transform(raw).collect() == model.transform(raw).collect()


def test_fitted_model_transforms_a_stream(spark, raw, model, tmp_path):
    raw.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    query = (model.transform(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
             .trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_final_gate_failures(spark):
    for rows, shape, match in (
        ([], "FLAG_VENTA int, a int", "not_empty"),
        ([(1, None)], "FLAG_VENTA int, a int", "no_nulls: a"),
        ([(1, "x")], "FLAG_VENTA int, a string", "no_text_columns: a"),
        ([(1, 2)], "b int, a int", "target_present"),
    ):
        with pytest.raises(G.GateError, match=match):
            G.enforce(G.final_gate(spark.createDataFrame(rows, shape)))


def test_label_gate_failures(spark):
    for rows, shape, match in (
        ([(None, 1)], "FLAG_VENTA int, a int", "label_complete"),
        ([(2, 1)], "FLAG_VENTA int, a int", "label_binary"),
        ([(1, "x")], "FLAG_VENTA int, a string", "features_numeric"),
        ([(1, None)], "FLAG_VENTA int, a int", "features_complete"),
    ):
        with pytest.raises(G.GateError, match=match):
            G.enforce(G.label_gate(spark.createDataFrame(rows, shape)))
    with pytest.raises(G.GateError, match="target_present"):
        G.label_gate(spark.createDataFrame([(1,)], "a int"))
