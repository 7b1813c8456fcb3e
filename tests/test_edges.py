"""Cases at the edge of what texts, nested values and classes may hold."""

import json

from pyspark.sql import functions as F

from offerlens.functions.scalars import to_numeric
from offerlens.operators.columns import json_rows
from offerlens.operators.evaluate import roc_curve


def test_only_decimal_texts_are_numbers(spark):
    texts = ["12D", "5f", "0x1p3", "1e", " 7 ", "-2.5e3", ".5", "inf", "nan", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(to_numeric(F.col("t"))).collect()
    assert [r[0] for r in rows] == [None, None, None, None, 7.0, -2500.0, 0.5, float("inf"), None, None, None]


def test_nested_missing_numbers_are_null(spark):
    df = spark.sql("SELECT array(double('NaN'), 1.5D) a, map('k', double('NaN')) m, named_struct('x', double('NaN'), 'y', array(float('NaN'))) s")
    assert json.loads(json_rows(df).first()[0]) == {"a": [None, 1.5], "m": {"k": None}, "s": {"x": None, "y": [None]}}


def test_curve_of_one_class(spark):
    rows = roc_curve(spark.createDataFrame([(1, 0.2), (1, 0.7)], "label int, score double")).collect()
    assert {r["tpr"] for r in rows} <= {0.0, 0.5, 1.0} and all(r["fpr"] in (None, 0.0) for r in rows)
