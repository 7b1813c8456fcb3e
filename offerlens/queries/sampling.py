"""Registered queries: split, folds, weights, neighbours and oversampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.contract import CUSTOMER, N_FOLDS, SEED, SMOTE_NEIGHBOURS, SMOTE_RATIO, TARGET, TEST_SIZE
from offerlens.functions.scalars import col, whole
from offerlens.operators import neighbours as N
from offerlens.operators import oversample as O
from offerlens.operators import split as S
from offerlens.queries.features import FEATURE_CTE, FEATURES
from offerlens.queries.inputs import KEY, KEY_SQL, builder, once, panel, raw, rounded
from offerlens.queries.panel_sql import digest_sql, over_panel, uniform_sql
from offerlens.session import new_path, stage, stage_by_key

# All features a model is fitted on, in whole hundredths, so that distances are equal in both engines to the last bit.
POINT_FEATURES = tuple(c for c in FEATURES if c not in (TARGET, "CLIENTE"))


def points(spark, folder) -> DataFrame:
    def make() -> DataFrame:
        table = builder(spark, folder).keeping(CUSTOMER).transform(raw(spark, folder))
        hundredths = F.array(*[whole(col(c).cast("double") * 100).cast("long").cast("double") for c in POINT_FEATURES])
        return stage(table.select(
            F.concat_ws(":", *[col(k).cast("string") for k in KEY]).alias("key"), col(TARGET).cast("int").alias("label"),
            hundredths.alias("features")), "points")

    return once(spark, folder, "points", make)


SPLIT_CTES = f"""
counts AS (SELECT "FLAG_VENTA" AS cls, count(*) AS n FROM panel GROUP BY 1),
total AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(n) - ceil(sum(n) * CAST({TEST_SIZE} AS DOUBLE)) AS BIGINT) AS n_train FROM counts),
floors AS (SELECT cls, c.n, c.n * n_train // t.n AS base, c.n * n_train % t.n AS rest, n_train FROM counts c, total t),
quotas AS (SELECT cls, n - base - CAST(row_number() OVER (ORDER BY rest DESC, cls)
           <= (n_train - (SELECT sum(base) FROM floors)) AS BIGINT) AS n_test FROM floors),
split AS (SELECT p.*, CASE WHEN row_number() OVER (PARTITION BY "FLAG_VENTA"
             ORDER BY {digest_sql(SEED, 'split', KEY_SQL)}) <= n_test THEN 'test' ELSE 'train' END AS split
          FROM panel p JOIN quotas ON cls = "FLAG_VENTA")"""


def stratified_split(spark, folder) -> DataFrame:
    return S.stratified_split(panel(spark, folder), KEY).select(*KEY, TARGET, "split")


def keyed_join(spark, folder) -> DataFrame:
    """Panel and split, each stored in buckets of the key, joined and counted per row without a shuffle."""
    table, buckets = panel(spark, folder), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stage_by_key(table.select(*KEY, TARGET), "keyed-rows", KEY, buckets)
    parts = stage_by_key(S.stratified_split(table, KEY).select(*KEY, "split"), "keyed-split", KEY, buckets)
    return rows.join(parts, list(KEY)).groupBy(*KEY, TARGET, "split").agg(F.count("*").alias("rows"))


def stratified_folds(spark, folder) -> DataFrame:
    return S.stratified_folds(panel(spark, folder), KEY).select(*KEY, TARGET, "fold")


_FOLDS_SQL = over_panel(f"""
SELECT "MES", "CLIENTE", "FLAG_VENTA",
  CAST(CASE WHEN place <= q0 THEN 0 WHEN place <= q0 + q1 THEN 1 ELSE 2 END AS INTEGER) AS fold
FROM (SELECT *, row_number() OVER (PARTITION BY "FLAG_VENTA" ORDER BY {digest_sql(SEED, 'fold', KEY_SQL)}) AS place FROM panel)
JOIN (SELECT cls, count(*) FILTER ((first + i) % {N_FOLDS} = 0) AS q0, count(*) FILTER ((first + i) % {N_FOLDS} = 1) AS q1
      FROM (SELECT cls, n, CAST(coalesce(sum(n) OVER (ORDER BY cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first
            FROM (SELECT "FLAG_VENTA" AS cls, count(*) AS n FROM panel GROUP BY 1)), LATERAL (SELECT unnest(range(n)) AS i)
      GROUP BY 1) ON cls = "FLAG_VENTA" """)


def split_roundtrip(spark, folder) -> DataFrame:
    """The split written partitioned, and its test part read back."""
    path = new_path(spark, "split-table")
    S.stratified_split(panel(spark, folder), KEY).write.partitionBy("split").parquet(path)
    back = spark.read.parquet(path).where(F.col("split") == "test")
    return back.groupBy(col("MES"), col(TARGET)).agg(F.count("*").alias("rows"), F.sum("CLIENTE").alias("keys"))


def class_weights(spark, folder) -> DataFrame:
    """Weights of the oversampled rows: what a model sees."""
    oversampled = once(spark, folder, "oversampled", lambda: stage(O.oversample(points(spark, folder)), "oversampled"))
    weights = S.balanced_weights(oversampled, "label")
    return rounded(spark.createDataFrame(list(weights.items()), "class bigint, weight double"))


def smote_neighbours(spark, folder) -> DataFrame:
    rare = points(spark, folder).where(F.col("label") == 1)
    lists = N.neighbour_lists(rare, SMOTE_NEIGHBOURS)
    rows = lists.select("key", F.posexplode("neighbours").alias("place", "n"))
    return rounded(rows.select("key", "place", F.col("n.key").alias("neighbour"), F.col("n.distance").alias("distance")))


_SQUARES = " + ".join(f"(a.f{i} - b.f{i}) * (a.f{i} - b.f{i})" for i in range(len(POINT_FEATURES)))
_NEIGHBOURS = FEATURE_CTE + f""",
rare AS (SELECT concat_ws(':', "MES", "CLIENTE") AS key, {", ".join(
    f'CAST(CAST(round(CAST("{c}" AS DOUBLE) * 100) AS BIGINT) AS DOUBLE) AS f{i}' for i, c in enumerate(POINT_FEATURES))}
  FROM features WHERE "FLAG_VENTA" = 1),
near AS (SELECT * FROM (
  SELECT a.key, b.key AS neighbour, sqrt({_SQUARES}) AS distance, {", ".join(f"b.f{i} AS g{i}" for i in range(len(POINT_FEATURES)))},
         row_number() OVER (PARTITION BY a.key ORDER BY sqrt({_SQUARES}), b.key) - 1 AS place
  FROM rare a JOIN rare b ON a.key <> b.key) WHERE place < {SMOTE_NEIGHBOURS})"""


def smote_rows(spark, folder) -> DataFrame:
    new = O.synthetic_rows(points(spark, folder))
    return rounded(new.select("key", "label", *[
        F.element_at("features", i + 1).alias(c) for i, c in enumerate(POINT_FEATURES)]))


_SMOTE_SQL = over_panel(f"""
SELECT s.key || '#' || copy AS key, 1 AS label, {", ".join(
    f'round(f{i} + {{step}} * (g{i} - f{i}), 6) AS "{c}"' for i, c in enumerate(POINT_FEATURES))}
FROM seeds s JOIN near n ON n.key = s.key AND n.place = CAST(floor({{which}} * {SMOTE_NEIGHBOURS}) AS BIGINT)
""".format(
    step=uniform_sql(SEED, "step", ["s.key", "copy"]), which=uniform_sql(SEED, "neighbour", ["s.key", "copy"])
), _NEIGHBOURS + f""",
sizes AS (SELECT count(*) FILTER ("FLAG_VENTA" = 1) AS minor, count(*) FILTER ("FLAG_VENTA" = 0) AS major FROM panel),
wanted AS (SELECT minor, CAST(floor(CAST({SMOTE_RATIO} AS DOUBLE) * major - minor) AS BIGINT) AS n FROM sizes),
ordered AS (SELECT *, row_number() OVER (ORDER BY {digest_sql(SEED, 'seed', ['key'])}) AS spot FROM rare),
seeds AS (SELECT o.*, unnest(range(1, 1 + n // minor + CAST(spot <= n % minor AS BIGINT))) AS copy FROM ordered o, wanted)""")


# Rows per class after oversampling: the rare class grows to a share of the other.
GROWN = f"""sizes AS (SELECT count(*) FILTER ("FLAG_VENTA" = 1) AS minor, count(*) FILTER ("FLAG_VENTA" = 0) AS major FROM panel),
grown AS (SELECT CAST(0 AS BIGINT) AS class, major AS n FROM sizes
  UNION ALL SELECT 1, minor + CAST(floor(CAST({SMOTE_RATIO} AS DOUBLE) * major - minor) AS BIGINT) FROM sizes)"""

QUERIES = {
    "stratified_split": stratified_split,
    "keyed_join": keyed_join,
    "split_distribution": lambda s, d: S.split_distribution(S.stratified_split(panel(s, d), KEY)),
    "stratified_folds": stratified_folds,
    "split_roundtrip": split_roundtrip,
    "class_weights": class_weights,
    "smote_neighbours": smote_neighbours,
    "smote_rows": smote_rows,
}

ORACLES = {
    "stratified_split": over_panel('SELECT "MES", "CLIENTE", "FLAG_VENTA", split FROM split', SPLIT_CTES),
    "keyed_join": over_panel('SELECT "MES", "CLIENTE", "FLAG_VENTA", split, CAST(1 AS BIGINT) AS "rows" FROM split', SPLIT_CTES),
    "split_distribution": over_panel("""
SELECT split, "FLAG_VENTA" AS class, count(*) AS count FROM split GROUP BY 1, 2
UNION ALL SELECT 'total', "FLAG_VENTA", count(*) FROM split GROUP BY 2""", SPLIT_CTES),
    "stratified_folds": _FOLDS_SQL,
    "split_roundtrip": over_panel("""SELECT "MES", "FLAG_VENTA", count(*) AS "rows", CAST(sum("CLIENTE") AS BIGINT) AS keys
FROM split WHERE split = 'test' GROUP BY 1, 2""", SPLIT_CTES),
    "class_weights": over_panel("""SELECT class, round(CAST((SELECT sum(n) FROM grown) AS DOUBLE) / (2 * n), 6) AS weight FROM grown""", GROWN),
    "smote_neighbours": over_panel("SELECT key, CAST(place AS INTEGER) AS place, neighbour, round(distance, 6) AS distance FROM near", _NEIGHBOURS),
    "smote_rows": _SMOTE_SQL,
}
