import pytest
from frames import twelve_rows
from pyspark.sql import functions as F

from offerlens.functions.hashing import key_digest, uniform
from offerlens.operators import split as S


def test_published_quotas():
    assert S.holdout_quotas({0: 84064, 1: 3492}) == {0: 25219, 1: 1048}
    with pytest.raises(ValueError):
        S.holdout_quotas({0: 5, 1: 1})


def test_fold_quotas_deal_rows_out_in_class_order():
    assert S.fold_quotas({0: 7, 1: 4}, 3) == {0: [3, 2, 2], 1: [1, 2, 1]}


@pytest.mark.parametrize("length", [None, 1, 3])
def test_split_is_exact_and_in_hash_order(spark, length):
    """A rare class, and prefixes of any length, give the same rows as a full ranking."""
    table = spark.range(5000).select("id", F.when(F.col("id") % 23 == 0, 1).otherwise(0).alias("FLAG_VENTA"))
    rows = S.stratified_split(table, ["id"], prefix_length=length).withColumn("d", key_digest(42, "split", ["id"])).collect()
    for cls in (0, 1):
        mine = sorted((r for r in rows if r["FLAG_VENTA"] == cls), key=lambda r: r["d"])
        quota = S.holdout_quotas({0: 4782, 1: 218})[cls]
        assert [r["split"] for r in mine] == ["test"] * quota + ["train"] * (len(mine) - quota)


def test_folds_have_even_class_shares(spark):
    table = twelve_rows(spark)
    rows = S.stratified_folds(table, ["CLIENTE"]).groupBy("fold", "FLAG_VENTA").count().collect()
    assert {(r["fold"], r["FLAG_VENTA"]): r["count"] for r in rows} == {(f, c): 2 for f in range(3) for c in (0, 1)}
    with pytest.raises(ValueError):
        S.stratified_folds(table.limit(3), ["CLIENTE"])


def test_split_needs_no_shuffle_once_cut(spark):
    plan = S.stratified_split(twelve_rows(spark), ["CLIENTE"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_weights(spark):
    table = spark.createDataFrame([(0,)] * 9 + [(1,)] * 3, "FLAG_VENTA int")
    assert S.balanced_weights(table) == {0: pytest.approx(12 / 18), 1: 2.0}


def test_total_distribution(spark):
    rows = S.split_distribution(S.stratified_split(twelve_rows(spark), ["CLIENTE"])).collect()
    counts = {(r["split"], r["class"]): r["count"] for r in rows}
    assert counts["total", 0] == counts["train", 0] + counts["test", 0] == 6
    assert sum(n for (split, _), n in counts.items() if split == "test") == 4


def test_uniform_draws(spark):
    draws = [r[0] for r in spark.range(4000).select(uniform(1, "a", ["id"])).collect()]
    assert 0 <= min(draws) < 0.01 and 0.99 < max(draws) < 1
    assert sum(draws) / 4000 == pytest.approx(0.5, abs=0.02)
