"""Registered queries: fits, imputations, encoding and the feature table."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.contract import RAW_COLUMNS, RENAMES, FeatureSpec
from offerlens.functions.scalars import col
from offerlens.operators.columns import rename_columns
from offerlens.operators.gates import Watch
from offerlens.operators.levels import level_index, one_hot_vector
from offerlens.plans import features as B
from offerlens.queries.inputs import KEY, KEY_SQL, builder, panel, prepared, raw, rounded
from offerlens.queries.panel_sql import over_panel, uniform_sql
from offerlens.session import new_path

SPEC = FeatureSpec()
PANEL = {RENAMES.get(c, c): kind for c, kind in RAW_COLUMNS.items()}
# Levels that occur in the given tables, for the SQL text only.
LEVELS = {
    "REGION": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "SEXO": ["F", "M"],
    "EST_CIVIL": ["A", "B", "F", "H", "M"],
}

_FLOORED = "floored AS (SELECT * REPLACE (" + ", ".join(
    f'CAST(CASE WHEN "{c}" < 0 THEN 0 ELSE "{c}" END AS DOUBLE) AS "{c}"' for c in SPEC.log
) + ") FROM panel)"
_LOGGED = "logged AS (SELECT *, " + ", ".join(f'ln(1 + "{c}") AS "{c}_LOG"' for c in SPEC.log) + " FROM floored)"
_MODE = "(SELECT \"{c}\" FROM logged WHERE \"{c}\" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
_FITTED = "fitted AS (SELECT " + ", ".join(
    [f'count(*) - count("{c}") AS "n:{c}"' for c in (*SPEC.impute_uniform, *SPEC.impute_median, *SPEC.categorical)]
    + [f'avg("{c}") AS "m:{c}", stddev_samp("{c}") AS "s:{c}", '
       f'greatest(CAST(0 AS DOUBLE), avg("{c}") - stddev_samp("{c}")) AS "lo:{c}"' for c in SPEC.impute_uniform]
    + [f'quantile_cont("{c}", 0.5) AS "v:{c}"' for c in SPEC.impute_median]
    + [f'{_MODE.format(c=c)} AS "v:{c}"' for c in SPEC.categorical]
) + " FROM logged)"


def _draw(c: str) -> str:
    high = f'greatest("lo:{c}", "m:{c}" + "s:{c}")'
    return f'coalesce("{c}", "lo:{c}" + ({high} - "lo:{c}") * {uniform_sql(SPEC.seed, c, KEY_SQL)})'


_FILL = {
    **{c: _draw(c) for c in SPEC.impute_uniform},
    **{c: f'coalesce("{c}", "v:{c}")' for c in (*SPEC.impute_median, *SPEC.categorical)},
}
ALL_LOGGED = {**PANEL, **{f"{c}_LOG": "double" for c in SPEC.log}}
_IMPUTED = "imputed AS (SELECT " + ", ".join(
    f'{_FILL[c]} AS "{c}"' if c in _FILL else f'"{c}"' for c in ALL_LOGGED
) + " FROM logged, fitted)"
CTES = ", ".join([_FLOORED, _LOGGED, _FITTED, _IMPUTED])

_DUMMIES = {f"{c}_{v}": f"""CAST(coalesce("{c}" = '{v}', false) AS INTEGER)""" for c, vs in LEVELS.items() for v in vs}
_KEPT = [c for c in ALL_LOGGED if c not in SPEC.drop and c not in SPEC.categorical]
FEATURES = [*_KEPT, *_DUMMIES]
# The feature table under its own names, unrounded, with the identifier.
FEATURE_CTE = CTES + ', features AS (SELECT "CLIENTE", ' + ", ".join(
    [f'"{c}"' for c in _KEPT] + [f'{x} AS "{n}"' for n, x in _DUMMIES.items()]
) + " FROM imputed)"


def _imputed_sql(names) -> str:
    cells = [f'round("{c}", 6) AS "{c}"' if ALL_LOGGED[c] == "double" else f'"{c}"' for c in names]
    return over_panel(f'SELECT "MES", "CLIENTE", {", ".join(cells)} FROM imputed', CTES)


def _keyed(df: DataFrame, names) -> DataFrame:
    return rounded(df.select(*KEY, *[col(c) for c in names]))


def impute_uniform(spark, folder) -> DataFrame:
    table = prepared(spark, folder)
    fitted = B.fit_uniform(table, SPEC.impute_uniform)
    return _keyed(B.impute_uniform(table, fitted, KEY, SPEC.seed), SPEC.impute_uniform)


def impute_median(spark, folder) -> DataFrame:
    table = prepared(spark, folder)
    return _keyed(B.impute_value(table, B.fit_median(table, SPEC.impute_median)), SPEC.impute_median)


def impute_mode(spark, folder) -> DataFrame:
    table = panel(spark, folder)
    return _keyed(B.impute_value(table, B.fit_categories(table, SPEC)), SPEC.categorical)


IMPUTED = (*SPEC.impute_uniform, *SPEC.impute_median, *SPEC.categorical)


def impute_all(spark, folder) -> DataFrame:
    return _keyed(builder(spark, folder).impute(prepared(spark, folder)), IMPUTED)


def _imputation_rows(table: DataFrame) -> DataFrame:
    value = F.coalesce(F.round(F.col("value").try_cast("double"), 6).cast("string"), F.col("value"))
    return rounded(table.withColumn("value", value))


def impute_stats(spark, folder) -> DataFrame:
    """The fit from a plain read of the panel, not the shared one."""
    return _imputation_rows(B.FeatureBuilder().fit(raw(spark, folder)).imputations(spark))


def preprocessor_state(spark, folder) -> DataFrame:
    """Fitted values written, read back and listed."""
    path = new_path(spark, "builder")
    builder(spark, folder).write().save(path)
    return _imputation_rows(B.FeatureBuilderModel.load(path).imputations(spark))


def _stats_sql() -> str:
    gap = "CAST(NULL AS DOUBLE)"
    parts = []
    for c in SPEC.impute_uniform:
        values = [f'"m:{c}"', f'"s:{c}"', f'"lo:{c}"', f'greatest("lo:{c}", "m:{c}" + "s:{c}")']
        shown = [f'CASE WHEN "n:{c}" > 0 THEN round({v}, 6) END' for v in values]
        parts.append((c, "random_uniform_mean_std", *shown, "CAST(NULL AS VARCHAR)"))
    for c in SPEC.impute_median:
        parts.append((c, "median", gap, gap, gap, gap, f'CASE WHEN "n:{c}" > 0 THEN CAST(round("v:{c}", 6) AS VARCHAR) END'))
    for c in SPEC.categorical:
        parts.append((c, "mode", gap, gap, gap, gap, f'CASE WHEN "n:{c}" > 0 THEN "v:{c}" END'))
    return over_panel(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{m}' AS method, "n:{c}" AS nulls_imputed, {a} AS mean, {b} AS std,
        {lo} AS lower_bound, {hi} AS upper_bound, {v} AS value FROM fitted""" for c, m, a, b, lo, hi, v in parts
    ), ", ".join([_FLOORED, _LOGGED, _FITTED]))


def one_hot(spark, folder) -> DataFrame:
    """Encoding of the categories as they are: a missing one gives zeros."""
    table = panel(spark, folder).select(*KEY, *SPEC.categorical)
    return B.one_hot(table, {c: f["levels"] for c, f in B.fit_categories(table, SPEC).items()})


def one_hot_sparse(spark, folder) -> DataFrame:
    """The levels that the sparse vectors of all rows hold, read back from their positions, and the vectors' size."""
    table = panel(spark, folder).select(*KEY, *SPEC.categorical)
    index = level_index(table, SPEC.categorical)
    vectors = one_hot_vector(table, index, SPEC.categorical).select(*KEY, vector_to_array("levels").alias("v"))
    held = vectors.select(*KEY, F.size("v").alias("size"), F.posexplode("v").alias("position", "hot")).where("hot = 1")
    return held.join(index, "position").select(*KEY, "column", "value", F.col("position").cast("long").alias("position"), "size")


def _sparse_sql() -> str:
    held = " UNION ALL ".join(
        f"""SELECT "MES", "CLIENTE", {i} AS place, '{c}' AS "column", CAST("{c}" AS VARCHAR) AS "value" FROM panel WHERE "{c}" IS NOT NULL"""
        for i, c in enumerate(SPEC.categorical))
    return over_panel("""SELECT "MES", "CLIENTE", "column", "value", position, CAST((SELECT count(*) FROM levels) AS INTEGER) AS size
FROM held JOIN levels USING (place, "value")""", f"""held AS ({held}), levels AS (
SELECT place, "value", row_number() OVER (ORDER BY place, "value") - 1 AS position FROM (SELECT DISTINCT place, "value" FROM held))""")


def feature_table(spark, folder) -> DataFrame:
    return rounded(builder(spark, folder).transform(raw(spark, folder)))


def gates_in_flight(spark, folder) -> DataFrame:
    """Verdicts and negative counts of two written tables, counted by the writes: the features, and the panel as it is."""
    parts = []
    staged = raw(spark, folder)
    source = spark.newSession().read.schema(staged.schema).parquet(*staged.inputFiles())  # see Watch
    for name, table, left_out in (
        ("features", builder(spark, folder).keeping("CLIENTE").transform(source), ["CLIENTE"]), ("panel", rename_columns(source), [])):
        watch = Watch(table, SPEC.target, left_out, [*SPEC.floor_at_zero, "Dif_Entidades"])
        watch.df.write.parquet(new_path(spark, "watched"))
        counts = watch.negative_counts().select(
            F.concat(F.lit("negative "), "column").alias("check"), (F.col("negatives") == 0).alias("passed"), F.col("negatives").cast("string").alias("detail"))
        verdicts = watch.final_gate().unionByName(watch.label_gate()).unionByName(counts)
        parts.append(verdicts.select(F.lit(name).alias("table"), "check", "passed", "detail"))
    return parts[0].unionByName(parts[1])


def _in_flight_sql() -> str:
    def rows(name: str, source: str, columns, texts, negatives) -> str:
        nulls = {c: f'(count(*) - count("{c}"))' for c in columns}
        holders = "concat_ws(', ', " + ", ".join(f"CASE WHEN {n} > 0 THEN '{c}' END" for c, n in nulls.items()) + ")"
        total = " + ".join(nulls.values())
        inner = " + ".join(n for c, n in nulls.items() if c != SPEC.target)
        odd = ", ".join(texts)
        checks = [("not_empty", "count(*) > 0", "count(*)"), ("target_present", "count(*) >= 0", f"max('{SPEC.target}')"), ("no_nulls", f"{total} = 0", holders),
                  ("no_text_columns", f"(count(*) >= 0) = {not texts}", f"max('{odd}')"), ("label_complete", f'count("{SPEC.target}") = count(*)', f"{nulls[SPEC.target]}"),
                  ("label_binary", f'count(*) FILTER ("{SPEC.target}" NOT IN (0, 1)) = 0', f'count(*) FILTER ("{SPEC.target}" NOT IN (0, 1))'),
                  ("features_numeric", f"(count(*) >= 0) = {not texts}", f"max('{odd}')"), ("features_complete", f"{inner} = 0", inner)]
        checks += [(f"negative {c}", f'count(*) FILTER ("{c}" < 0) = 0', f'count(*) FILTER ("{c}" < 0)') for c in negatives]
        return " UNION ALL ".join(
            f"""SELECT '{name}' AS "table", '{c}' AS "check", {ok} AS passed, CAST({detail} AS VARCHAR) AS detail FROM {source}""" for c, ok, detail in checks)

    return over_panel(rows("features", "features", FEATURES, [], ["Dif_Entidades"]) + " UNION ALL " + rows(
        "panel", "panel", PANEL, [c for c, kind in PANEL.items() if kind == "string"], [*SPEC.floor_at_zero, "Dif_Entidades"]), FEATURE_CTE)


def _feature_sql() -> str:
    cells = [f'round("{c}", 6) AS "{c}"' if ALL_LOGGED.get(c) == "double" else f'"{c}"' for c in FEATURES]
    return over_panel(f"SELECT {', '.join(cells)} FROM features", FEATURE_CTE)


QUERIES = {
    "impute_stats": impute_stats,
    "impute_uniform": impute_uniform,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "impute_all": impute_all,
    "one_hot": one_hot,
    "one_hot_sparse": one_hot_sparse,
    "preprocessor_state": preprocessor_state,
    "feature_table": feature_table,
    "gates_in_flight": gates_in_flight,
}

ORACLES = {
    "impute_stats": _stats_sql(),
    "impute_uniform": _imputed_sql(SPEC.impute_uniform),
    "impute_median": _imputed_sql(SPEC.impute_median),
    "impute_mode": _imputed_sql(SPEC.categorical),
    "impute_all": _imputed_sql(IMPUTED),
    "one_hot": over_panel('SELECT "MES", "CLIENTE", ' + ", ".join(f'{x} AS "{n}"' for n, x in _DUMMIES.items()) + " FROM panel"),
    "one_hot_sparse": _sparse_sql(),
    "preprocessor_state": _stats_sql(),
    "feature_table": _feature_sql(),
    "gates_in_flight": _in_flight_sql(),
}
