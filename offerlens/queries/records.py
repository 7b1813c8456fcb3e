"""Registered queries: documents whose fields differ by month, written and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.contract import MONTH, TARGET
from offerlens.functions.scalars import col
from offerlens.queries.features import PANEL
from offerlens.queries.inputs import panel
from offerlens.queries.panel_sql import over_panel
from offerlens.session import new_path
from offerlens.sources import files

NUMBERS = [c for c, kind in PANEL.items() if kind != "string" and c != MONTH]


def monthly_records(table: DataFrame) -> DataFrame:
    """One document per month: rows, counts per label, and the columns that have gaps or negatives in that month."""
    def listed(counts: dict) -> Column:
        filled = F.map_from_entries(F.array(*[F.struct(F.lit(c).alias("key"), n.alias("value")) for c, n in counts.items()]))
        return F.map_filter(filled, lambda _, n: n > 0)

    return table.groupBy(MONTH).agg(
        F.count("*").alias("rows"),
        listed({v: F.count_if(col(TARGET) == int(v)) for v in ("0", "1")}).alias("target"),
        F.struct(listed({c: F.count_if(col(c).isNull()) for c in PANEL if c != MONTH}).alias("nulls"),
                 listed({c: F.count_if(col(c) < 0) for c in NUMBERS}).alias("negatives")).alias("quality"))


def record_fields(spark, folder) -> DataFrame:
    """Every field of every month's document, from the written files; text is compared, so numbers keep their digits."""
    path = new_path(spark, "records")
    files.write_document(monthly_records(panel(spark, folder)), path)
    documents = files.read_variants(spark, path)
    keyed = documents.select(F.variant_get("document", f"$.{MONTH}", "long").alias(MONTH), "document")
    return files.variant_fields(keyed).where(F.col("value") != "{}")


def _record_sql() -> str:
    counts = {MONTH: f'"{MONTH}"', "rows": "count(*)"}
    counts |= {f"target.{v}": f"""count(*) FILTER ("{TARGET}" = {v})""" for v in (0, 1)}
    counts |= {f"quality.nulls.{c}": f'count(*) - count("{c}")' for c in PANEL if c != MONTH}
    counts |= {f"quality.negatives.{c}": f'count(*) FILTER ("{c}" < 0)' for c in NUMBERS}
    cells = ", ".join(f'CAST({n} AS BIGINT) AS "{field}"' for field, n in counts.items())
    return over_panel(f"""SELECT m AS "{MONTH}", field, CAST(value AS VARCHAR) AS value
FROM (SELECT CAST("{MONTH}" AS BIGINT) AS m, {cells} FROM panel GROUP BY "{MONTH}") UNPIVOT (value FOR field IN (COLUMNS(* EXCLUDE m)))
WHERE value > 0""")


QUERIES = {"record_fields": record_fields}

ORACLES = {"record_fields": _record_sql()}
