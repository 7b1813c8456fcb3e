"""Registered queries: scans, column operators, gates and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.contract import MONTH, NULL_TOKENS, RAW_COLUMNS, RENAMES, TARGET, FeatureSpec
from offerlens.functions.scalars import col, null_tokens, to_numeric
from offerlens.operators import columns as C
from offerlens.operators import gates as G
from offerlens.operators import profile as P
from offerlens.queries.inputs import once, panel, prepared, raw, rounded
from offerlens.queries.panel_sql import over_panel, over_raw
from offerlens.session import new_path
from offerlens.sources import files
from offerlens.sources.panel import read_table

SPEC = FeatureSpec()
PANEL_COLUMNS = {RENAMES.get(c, c): kind for c, kind in RAW_COLUMNS.items()}


def _csv(spark: SparkSession, folder: str) -> str:
    """The raw panel as a delimited file, written once."""
    def make() -> str:
        path = new_path(spark, "campaign-csv")
        files.write_delimited(raw(spark, folder), path)
        return path

    return once(spark, folder, "csv", make)


def csv_scan(spark, folder) -> DataFrame:
    return files.read_delimited(spark, _csv(spark, folder), RAW_COLUMNS)


def csv_inferred_types(spark, folder) -> DataFrame:
    kinds = files.infer_types(files.read_text_table(spark, _csv(spark, folder)))
    return spark.createDataFrame(list(kinds.items()), "`column` string, type string")


def null_token_scan(spark, folder) -> DataFrame:
    n = F.col("event_id")
    text = F.element_at(F.array(*[F.lit(t) for t in NULL_TOKENS], F.lit("na"), F.lit(" NA"), F.col("event_type")),
                        (n % (len(NULL_TOKENS) + 3)).cast("int") + 1)
    return read_table(spark, folder, "events").select("event_id", null_tokens(text).alias("cleaned"))


_TOKEN_LIST = ", ".join(f"'{t}'" for t in NULL_TOKENS)
NULL_TOKENS_SQL = f"""
SELECT event_id, CASE WHEN list_contains([{_TOKEN_LIST}], t) THEN NULL ELSE t END AS cleaned
FROM (SELECT event_id, list_extract([{_TOKEN_LIST}, 'na', ' NA', event_type],
      CAST(event_id % {len(NULL_TOKENS) + 3} AS INTEGER) + 1) AS t FROM events)"""


def to_numeric_coerce(spark, folder) -> DataFrame:
    n = F.col("event_id") % 5
    text = (
        F.when(n == 0, F.col("event_type")).when(n == 1, F.lit("")).when(n == 2, F.lit("NaN"))
        .when(n == 3, F.lit("-1.5e2")).otherwise(F.col("event_id").cast("string"))
    )
    return read_table(spark, folder, "events").select("event_id", to_numeric(text).alias("number"))


TO_NUMERIC_SQL = """
SELECT event_id, CASE WHEN isnan(d) THEN NULL ELSE d END AS number
FROM (SELECT event_id, TRY_CAST(CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN '' WHEN 2 THEN 'NaN'
      WHEN 3 THEN '-1.5e2' ELSE CAST(event_id AS VARCHAR) END AS DOUBLE) AS d FROM events)"""


def json_safe_rows(spark, folder) -> DataFrame:
    value = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return C.json_rows(read_table(spark, folder, "events").select("event_id", "event_type", value.alias("value")))


JSON_SAFE_SQL = """
SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","value":'
       || CASE WHEN event_id % 7 = 0 THEN 'null' ELSE CAST(value AS VARCHAR) END || '}' AS json
FROM events"""


def clean_column_names(spark, folder) -> DataFrame:
    messy = read_table(spark, folder, "events").select(
        F.col("event_id").alias("﻿event_id "), F.col("event_type").alias(" event_type"), F.col("value").alias("value"))
    clean = C.clean_column_names(messy)
    return clean.groupBy("event_type").agg(F.count("event_id").alias("events"), F.max("value").alias("largest"))


def content_fingerprint(spark, folder) -> DataFrame:
    """Doubles to six decimals, as engines write them differently."""
    return files.table_fingerprint(read_table(spark, folder, "lineitem"), 6)


def _fingerprint_sql() -> str:
    kinds = {
        "l_orderkey": "i", "l_partkey": "i", "l_suppkey": "i", "l_linenumber": "i", "l_quantity": "d",
        "l_extendedprice": "d", "l_discount": "d", "l_tax": "d", "l_returnflag": "i", "l_linestatus": "i",
        "l_shipdate": "i",
    }
    values = [f"CAST({f'CAST(round_even({c} * 1000000, 0) AS BIGINT)' if k == 'd' else c} AS VARCHAR)" for c, k in kinds.items()]
    texts = " || ".join(f"coalesce(length({v}) || ':' || {v}, '-')" for v in values)
    return f"""
SELECT count(*) AS "rows",
       CAST(coalesce(sum(CAST(CAST('0x' || substr(md5({texts}), 1, 15) AS BIGINT) AS HUGEINT)), 0)
            AS VARCHAR) AS fingerprint
FROM lineitem"""


def ingest_profile(spark, folder) -> DataFrame:
    path = _csv(spark, folder)
    table = files.read_delimited(spark, path, RAW_COLUMNS)
    record = P.ingest_record(table, path, files.content_md5(spark, path))
    return record.select("rows", "columns", F.array_join("column_names", ",").alias("column_names"), "target",
                         F.to_json("target_distribution").alias("target_distribution"),
                         F.col("file_hash_md5").rlike("^[0-9a-f]{32}$").alias("has_md5"))


def _counts_json(column: str, table: str) -> str:
    return f"""(SELECT '{{' || string_agg('"' || v || '":' || n, ',' ORDER BY v) || '}}'
  FROM (SELECT coalesce(CAST("{column}" AS VARCHAR), 'nan') AS v, count(*) AS n FROM {table} GROUP BY 1))"""


INGEST_SQL = over_raw(f"""
SELECT (SELECT count(*) FROM raw) AS "rows", {len(RAW_COLUMNS)} AS columns,
       '{",".join(RAW_COLUMNS)}' AS column_names, '{TARGET}' AS target,
       {_counts_json(TARGET, "raw")} AS target_distribution, true AS has_md5""")


def file_manifest(spark, folder) -> DataFrame:
    return files.file_manifest(spark, _csv(spark, folder)).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "length", "md5")


def value_counts(spark, folder) -> DataFrame:
    return P.value_counts(panel(spark, folder), "REGION")


def _value_counts_sql(column: str, percent: bool) -> str:
    share = ', round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM panel), 2) AS percent' if percent else ""
    return over_panel(f'SELECT CAST("{column}" AS VARCHAR) AS value, count(*) AS count{share} FROM panel GROUP BY 1')


def _null_rows_sql(order: str = "") -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS nulls,
        round((count(*) - count("{c}")) * CAST(100 AS DOUBLE) / count(*), 2) AS null_percent FROM panel"""
        for c in PANEL_COLUMNS
    )
    return over_panel(f'SELECT * FROM ({parts}) {order}')


def null_patterns_sql() -> str:
    digits = " || ".join(f"""CASE WHEN "{c}" IS NULL THEN '1' ELSE '0' END""" for c in PANEL_COLUMNS)
    return over_panel(f"SELECT {digits} AS pattern, count(*) AS count FROM panel GROUP BY 1")


def duplicate_rows(spark, folder) -> DataFrame:
    """All columns of all lines, returned lines planted a second time."""
    lines = read_table(spark, folder, "lineitem")
    return P.duplicate_rows(lines.unionByName(lines.where("l_returnflag = 'R'")))


DUPLICATE_SQL = """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT *, count(*) AS n FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R') GROUP BY ALL)"""


def describe_all(spark, folder) -> DataFrame:
    return rounded(P.describe_all(panel(spark, folder)), 4)


_NO_DATES = "CAST(NULL AS VARCHAR) AS earliest, CAST(NULL AS VARCHAR) AS latest"


def _describe_sql() -> str:
    parts = []
    for c, kind in PANEL_COLUMNS.items():
        if kind == "string":
            modes = f'(SELECT "{c}" AS v, count(*) AS n FROM panel WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)'
            gap = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", '"min"', "q25", "q50", "q75", '"max"'))
            gap += ", " + _NO_DATES
            parts.append(f"""SELECT '{c}' AS "column", count("{c}") AS count, count(DISTINCT "{c}") AS "unique",
              (SELECT v FROM {modes}) AS top, (SELECT n FROM {modes}) AS freq, {gap} FROM panel""")
        else:
            x = f'CAST("{c}" AS DOUBLE)'
            parts.append(f"""SELECT '{c}' AS "column", count({x}) AS count, CAST(NULL AS BIGINT) AS "unique",
              CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, round(avg({x}), 4) AS mean,
              round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS "min", round(quantile_cont({x}, 0.25), 4) AS q25,
              round(quantile_cont({x}, 0.5), 4) AS q50, round(quantile_cont({x}, 0.75), 4) AS q75,
              round(max({x}), 4) AS "max", {_NO_DATES} FROM panel""")
    return over_panel(" UNION ALL ".join(parts))


def describe_types(spark, folder) -> DataFrame:
    """Orders with their dates, a flag, and lists: a table of many column types."""
    orders = read_table(spark, folder, "orders")
    return rounded(P.describe_all(orders.select(
        F.col("o_orderdate").cast("date").alias("ordered"), "o_orderdate", (F.col("o_orderstatus") == "O").alias("is_open"), "o_orderpriority",
        F.array(F.substring("o_orderpriority", 1, 1)).alias("urgency"), F.col("o_totalprice").cast("decimal(12, 2)").alias("price"),
        F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).alias("customer"), F.lit(None).cast("date").alias("never"))), 4)


def _types_sql() -> str:
    texts = {"ordered": ("CAST(CAST(o_orderdate AS DATE) AS VARCHAR)", True), "o_orderdate": ("strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", True),
             "is_open": ("CAST(o_orderstatus = 'O' AS VARCHAR)", False), "o_orderpriority": ("o_orderpriority", False),
             "urgency": ("'[' || o_orderpriority[1] || ']'", False), "never": ("CAST(NULL AS VARCHAR)", True)}
    numbers = {"price": "CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE)", "customer": "CAST(CASE WHEN o_custkey % 3 = 0 THEN o_custkey END AS DOUBLE)"}
    gap = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", '"min"', "q25", "q50", "q75", '"max"'))
    parts = []
    for c, (x, dated) in texts.items():
        modes = f"(SELECT {x} AS v, count(*) AS n FROM orders WHERE {x} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"
        ends = f"min({x}) AS earliest, max({x}) AS latest" if dated else _NO_DATES
        parts.append(f"""SELECT '{c}' AS "column", count({x}) AS count, count(DISTINCT {x}) AS "unique",
          (SELECT v FROM {modes}) AS top, (SELECT n FROM {modes}) AS freq, {gap}, {ends} FROM orders""")
    for c, x in numbers.items():
        parts.append(f"""SELECT '{c}', count({x}), NULL, NULL, NULL, round(avg({x}), 4), round(stddev_samp({x}), 4), round(min({x}), 4),
          round(quantile_cont({x}, 0.25), 4), round(quantile_cont({x}, 0.5), 4), round(quantile_cont({x}, 0.75), 4), round(max({x}), 4),
          {_NO_DATES} FROM orders""")
    return " UNION ALL ".join(parts)


def validation_summary(spark, folder) -> DataFrame:
    summary = P.validation_summary(panel(spark, folder), folder)
    return summary.select(
        "rows", "columns", "duplicated_rows", "columns_with_nulls", "total_null_values", "target",
        F.to_json("target_distribution").alias("target_distribution"),
        F.to_json("mes_distribution").alias("mes_distribution"),
    )


def _validation_sql() -> str:
    nulls = [f'count(*) - count("{c}")' for c in PANEL_COLUMNS]
    return over_panel(f"""
SELECT count(*) AS "rows", {len(PANEL_COLUMNS)} AS columns,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM panel)) AS duplicated_rows,
       {" + ".join(f"CAST({n} > 0 AS BIGINT)" for n in nulls)} AS columns_with_nulls,
       {" + ".join(nulls)} AS total_null_values, '{TARGET}' AS target,
       {_counts_json(TARGET, "panel")} AS target_distribution,
       {_counts_json(MONTH, "panel")} AS mes_distribution
FROM panel""")


def negative_counts(spark, folder) -> DataFrame:
    return P.negative_counts(panel(spark, folder), [*SPEC.log, "Dif_Entidades"])


NEGATIVE_SQL = over_panel(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ("{c}" < 0) AS negatives FROM panel"""
    for c in [*SPEC.log, "Dif_Entidades"]
))

LEVELS_SQL = over_panel(" UNION ALL ".join(
    f"""SELECT DISTINCT '{c}' AS "column", "{c}" AS level FROM panel WHERE "{c}" IS NOT NULL""" for c in SPEC.categorical
))


def rename_tolerant(spark, folder) -> DataFrame:
    names = {**RENAMES, "ABSENT_COLUMN": "Absent"}
    return C.rename_columns(raw(spark, folder), names)


def cap_floor_zero(spark, folder) -> DataFrame:
    capped = C.floor_columns(panel(spark, folder), SPEC.floor_at_zero)
    return capped.select("MES", "CLIENTE", *[col(c).cast("double").alias(c) for c in SPEC.floor_at_zero])


CAP_SQL = over_panel('SELECT "MES", "CLIENTE", ' + ", ".join(
    f'CAST(CASE WHEN "{c}" < 0 THEN 0 ELSE "{c}" END AS DOUBLE) AS "{c}"' for c in SPEC.floor_at_zero
) + " FROM panel")


def log1p_features(spark, folder) -> DataFrame:
    logged = C.add_log_features(panel(spark, folder), [*SPEC.log, "Absent"])
    return rounded(logged.select("MES", "CLIENTE", *[col(c) for c in SPEC.log], *[col(f"{c}_LOG") for c in SPEC.log]))


def _log_sql() -> str:
    floor = {c: f'CAST(CASE WHEN "{c}" < 0 THEN 0 ELSE "{c}" END AS DOUBLE)' for c in SPEC.log}
    return over_panel('SELECT "MES", "CLIENTE", ' + ", ".join(
        [f'round({x}, 6) AS "{c}"' for c, x in floor.items()]
        + [f'round(ln(1 + {x}), 6) AS "{c}_LOG"' for c, x in floor.items()]
    ) + " FROM panel")


def drop_model_columns(spark, folder) -> DataFrame:
    return C.drop_columns(panel(spark, folder), [*SPEC.drop, "Absent"])


DROP_SQL = over_panel("SELECT " + ", ".join(f'"{c}"' for c in PANEL_COLUMNS if c not in SPEC.drop) + " FROM panel")


def dataset_gate(spark, folder) -> DataFrame:
    return G.dataset_gate(raw(spark, folder).drop("REGION"))


DATASET_GATE_SQL = over_raw(f"""
SELECT * FROM (VALUES ('several_columns', true, ''), ('required_columns', false, 'REGION'),
  ('mandatory_columns', true, ''), ('target_present', true, '{TARGET}')) AS t("check", passed, detail)
UNION ALL SELECT 'not_empty', count(*) > 0, '' FROM raw""")


def final_gate(spark, folder) -> DataFrame:
    return G.final_gate(prepared(spark, folder))


def _final_gate_sql() -> str:
    # Log columns are missing exactly where their sources are.
    order = [*PANEL_COLUMNS, *[f"{c}_LOG" for c in SPEC.log]]
    source = {c: c.removesuffix("_LOG") for c in order}
    nulls = {c: f'(count(*) - count("{source[c]}"))' for c in order}
    holders = ", ".join(f"CASE WHEN {n} > 0 THEN '{c}' END" for c, n in nulls.items())
    texts = ", ".join(c for c, kind in PANEL_COLUMNS.items() if kind == "string")
    return over_panel(f"""
SELECT 'not_empty' AS "check", count(*) > 0 AS passed, CAST(count(*) AS VARCHAR) AS detail FROM panel
UNION ALL SELECT 'target_present', true, '{TARGET}'
UNION ALL SELECT 'no_nulls', {" + ".join(nulls.values())} = 0, concat_ws(', ', {holders}) FROM panel
UNION ALL SELECT 'no_text_columns', false, '{texts}'""")


def label_contract(spark, folder) -> DataFrame:
    return G.label_gate(panel(spark, folder))


def _label_sql() -> str:
    features = [c for c in PANEL_COLUMNS if c != TARGET]
    nulls = " + ".join(f'count(*) - count("{c}")' for c in features)
    texts = ", ".join(c for c in features if PANEL_COLUMNS[c] == "string")
    return over_panel(f"""
SELECT 'label_complete' AS "check", count(*) = count("{TARGET}") AS passed,
       CAST(count(*) - count("{TARGET}") AS VARCHAR) AS detail FROM panel
UNION ALL SELECT 'label_binary', count(*) FILTER ("{TARGET}" NOT IN (0, 1)) = 0,
       CAST(count(*) FILTER ("{TARGET}" NOT IN (0, 1)) AS VARCHAR) FROM panel
UNION ALL SELECT 'features_numeric', false, '{texts}'
UNION ALL SELECT 'features_complete', {nulls} = 0, CAST({nulls} AS VARCHAR) FROM panel""")


QUERIES = {
    "csv_scan": csv_scan,
    "csv_inferred_types": csv_inferred_types,
    "null_tokens": null_token_scan,
    "to_numeric_coerce": to_numeric_coerce,
    "json_safe_rows": json_safe_rows,
    "clean_column_names": clean_column_names,
    "content_fingerprint": content_fingerprint,
    "file_manifest": file_manifest,
    "ingest_profile": ingest_profile,
    "value_counts": value_counts,
    "target_distribution": lambda s, d: P.target_distribution(panel(s, d)),
    "month_distribution": lambda s, d: P.month_distribution(panel(s, d)),
    "null_report": lambda s, d: P.null_report(panel(s, d)),
    "top_null_columns": lambda s, d: P.top_null_columns(panel(s, d)),
    "null_patterns": lambda s, d: P.null_patterns(panel(s, d)),
    "duplicate_rows": duplicate_rows,
    "describe_all": describe_all,
    "describe_types": describe_types,
    "validation_summary": validation_summary,
    "negative_counts": negative_counts,
    "category_levels": lambda s, d: P.category_levels(panel(s, d), SPEC.categorical),
    "rename_tolerant": rename_tolerant,
    "cap_floor_zero": cap_floor_zero,
    "log1p_features": log1p_features,
    "drop_model_columns": drop_model_columns,
    "dataset_gate": dataset_gate,
    "final_gate": final_gate,
    "label_contract": label_contract,
}

ORACLES = {
    "csv_scan": over_raw("SELECT * FROM raw"),
    "csv_inferred_types": "SELECT * FROM (VALUES " + ", ".join(
        f"('{c}', '{kind}')" for c, kind in RAW_COLUMNS.items()) + ') AS t("column", type)',
    "null_tokens": NULL_TOKENS_SQL,
    "to_numeric_coerce": TO_NUMERIC_SQL,
    "json_safe_rows": JSON_SAFE_SQL,
    "clean_column_names": "SELECT event_type, count(event_id) AS events, max(value) AS largest FROM events GROUP BY 1",
    "content_fingerprint": _fingerprint_sql(),
    "ingest_profile": INGEST_SQL,
    "value_counts": _value_counts_sql("REGION", False),
    "target_distribution": _value_counts_sql(TARGET, True),
    "month_distribution": _value_counts_sql(MONTH, True),
    "null_report": _null_rows_sql(),
    "top_null_columns": _null_rows_sql('ORDER BY nulls DESC, "column" LIMIT 10'),
    "null_patterns": null_patterns_sql(),
    "duplicate_rows": DUPLICATE_SQL,
    "describe_all": _describe_sql(),
    "describe_types": _types_sql(),
    "validation_summary": _validation_sql(),
    "negative_counts": NEGATIVE_SQL,
    "category_levels": LEVELS_SQL,
    "rename_tolerant": over_panel("SELECT * FROM panel"),
    "cap_floor_zero": CAP_SQL,
    "log1p_features": _log_sql(),
    "drop_model_columns": DROP_SQL,
    "dataset_gate": DATASET_GATE_SQL,
    "final_gate": _final_gate_sql(),
    "label_contract": _label_sql(),
}
