"""SQL text of the campaign panel, for checking query results in another engine."""

from __future__ import annotations

from offerlens.contract import RENAMES
from offerlens.sources.panel import END_DATE, FIRST, LAST

_PANEL = f"""
order_lines AS (
  SELECT l_orderkey, count(*) AS lines,
         sum(CAST(round(l_discount * 100) AS BIGINT)) AS discount,
         sum(CAST(round(l_tax * 100) AS BIGINT)) AS tax,
         sum(CAST(l_quantity AS BIGINT)) AS quantity
  FROM lineitem GROUP BY l_orderkey),
by_month AS (
  SELECT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) AS ordered,
         count(*) AS orders, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
         sum(lines) AS lines, sum(discount) AS discount, sum(tax) AS tax, sum(quantity) AS quantity
  FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey
  WHERE o_orderdate < TIMESTAMP '{END_DATE} 00:00:00'
  GROUP BY 1, 2),
months AS (SELECT range AS month FROM range({FIRST}, {LAST} + 1)),
history AS (
  SELECT o_custkey, month,
         sum(orders) FILTER (month = ordered) AS bought,
         CAST(sum(cents) FILTER (month > ordered) AS DOUBLE) AS cents,
         sum(orders) FILTER (month > ordered) AS orders,
         CAST(sum(cents) FILTER (month - ordered BETWEEN 1 AND 24) AS DOUBLE) AS cents_24,
         CAST(sum(cents) FILTER (month - ordered BETWEEN 1 AND 6) AS DOUBLE) AS cents_6,
         sum(orders) FILTER (month - ordered BETWEEN 1 AND 6) AS orders_6,
         sum(orders) FILTER (month - ordered BETWEEN 7 AND 12) AS orders_7_12,
         sum(lines) FILTER (month - ordered BETWEEN 1 AND 12) AS lines_12,
         CAST(sum(discount) FILTER (month - ordered BETWEEN 1 AND 12) AS DOUBLE) AS discount_12,
         CAST(sum(tax) FILTER (month - ordered BETWEEN 1 AND 12) AS DOUBLE) AS tax_12,
         CAST(sum(quantity) FILTER (month - ordered BETWEEN 1 AND 12) AS DOUBLE) AS quantity_12,
         min(month - ordered) FILTER (month > ordered) AS last_order_age,
         max(month - ordered) FILTER (month > ordered) AS first_order_age
  FROM by_month JOIN months ON ordered <= month
  GROUP BY 1, 2),
cells AS (
  SELECT c_custkey AS k, c_nationkey, c_acctbal, c_mktsegment, r_name, m.month, h.*,
         coalesce(h.cents, 0) / CAST(100 AS DOUBLE) AS money
  FROM customer CROSS JOIN months m
  LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey
  LEFT JOIN history h ON h.o_custkey = c_custkey AND h.month = m.month),
raw AS (
  SELECT CAST((month - 1) // 12 * 100 + (month - 1) % 12 + 1 AS BIGINT) AS "MES",
         CAST(k AS BIGINT) AS "CLIENTE",
         CAST(floor(money) AS BIGINT) AS "LINEA_RENOVADO",
         CAST((k % 5 + 1) * 12 AS BIGINT) AS "PLAZO_RENOVADO",
         CAST(CASE WHEN bought > 0 THEN 1 ELSE 0 END AS BIGINT) AS "FLAG_VENTA",
         discount_12 / CAST(100 AS DOUBLE) / CAST(lines_12 AS DOUBLE) AS "USO_LINEA_TOTAL_TC_T2",
         tax_12 / CAST(100 AS DOUBLE) / CAST(lines_12 AS DOUBLE) AS "USO_TRIM_LINEA_BBVA",
         CAST(coalesce(lines_12, 0) AS BIGINT) AS "NR_ENTIDADES_TOTAL_T2",
         CAST(coalesce(orders_6, 0) - coalesce(orders_7_12, 0) AS BIGINT) AS "DIFF_NRO_ENTIDA_TOTALES_T2_T12",
         cents_24 / CAST(100 AS DOUBLE) AS "SDO_CONSUMO_T2",
         CAST(CASE WHEN last_order_age <= 15 THEN last_order_age END AS DOUBLE) AS "RESENCIA_OFERTA_PLD_RENOVADO",
         CAST(floor(c_acctbal) AS BIGINT) AS "Ahorro_Sldo_Bco_T1",
         CAST(floor(c_acctbal - money / CAST(100 AS DOUBLE)) AS BIGINT) AS "PConsumo_Sldo_Bco_T1",
         coalesce(cents_6 / CAST(100 AS DOUBLE) / CAST(orders_6 AS DOUBLE), CAST(0 AS DOUBLE)) - c_acctbal
           AS "SDO_BCO_tot_sm_pasivo_Bco_6M",
         CAST(CASE WHEN k % 997 <> 0 THEN k % 52 + 21 END AS DOUBLE) AS "EDAD",
         CASE WHEN k % 991 <> 0 THEN CASE WHEN k % 10 < 7 THEN 'M' ELSE 'F' END END AS "SEXO",
         CASE WHEN k % 983 <> 0 THEN substr(c_mktsegment, 1, 1) END AS "EST_CIVIL",
         CAST(first_order_age AS DOUBLE) AS "ANTIGUEDAD_MES",
         CASE WHEN k % 89 <> 0 THEN r_name END AS "REGION",
         CAST(c_nationkey % 2 AS BIGINT) AS "FLAG_LIMA_PROVINCIA",
         cents / CAST(100 AS DOUBLE) / CAST(orders AS DOUBLE) / CAST(50 AS DOUBLE) AS "SUELDO_ESTIMADO",
         CAST(coalesce(quantity_12, 0) AS DOUBLE) / CAST(100 AS DOUBLE) AS "CUBRIR_DEUDA_CONSUMO_SF_RENOVA_PLD"
  FROM cells)"""

_RENAMED = "panel AS (SELECT * RENAME (" + ", ".join(
    f'"{old}" AS "{new}"' for old, new in RENAMES.items()
) + ") FROM raw)"


def over_raw(body: str, ctes: str = "") -> str:
    """``body`` may read ``raw``: the panel under its raw names."""
    return f"WITH {_PANEL}{', ' + ctes if ctes else ''}\n{body}"


def over_panel(body: str, ctes: str = "") -> str:
    """``body`` may read ``panel``: the panel under its analysis names."""
    return over_raw(body, _RENAMED + (", " + ctes if ctes else ""))


def uniform_sql(seed: int, purpose: str, key: list[str]) -> str:
    """The SQL form of ``functions.hashing.uniform``."""
    return f"CAST(CAST('0x' || substr({digest_sql(seed, purpose, key)}, 1, 13) AS BIGINT) AS DOUBLE) / CAST({2**52} AS DOUBLE)"


def digest_sql(seed: int, purpose: str, key: list[str]) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in key)
    return f"md5(concat_ws(':', '{seed}', '{purpose}', {parts}))"


SCORED = f"""
scored AS (
  SELECT "MES", "CLIENTE", CAST("FLAG_VENTA" AS INTEGER) AS label,
         round({uniform_sql(42, 'score', ['"MES"', '"CLIENTE"'])} * CAST(0.6 AS DOUBLE)
               + "FLAG_VENTA" * CAST(0.25 AS DOUBLE), 4) AS score
  FROM panel)"""


def over_scored(body: str, ctes: str = "") -> str:
    """``body`` may read ``scored``: label and score of every panel row."""
    return over_panel(body, SCORED + (", " + ctes if ctes else ""))


def rounded_sql(columns: dict[str, str], digits: int = 6) -> str:
    """Select list of name -> kind, with doubles rounded."""
    return ", ".join(
        f'round("{c}", {digits}) AS "{c}"' if kind == "double" else f'"{c}"' for c, kind in columns.items()
    )
