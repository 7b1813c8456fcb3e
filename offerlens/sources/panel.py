"""A campaign panel derived from the order tables.

One row per customer and month (1997-01 .. 1997-09) with the 22 raw columns of
the contract, including missing values, negatives and a rare 0/1 target. It
stands in for a campaign extract, so every stage can run on real volumes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.contract import RAW_COLUMNS
from offerlens.functions.scalars import whole
from offerlens.session import stage

FIRST = 1997 * 12 + 1
LAST = 1997 * 12 + 9
END_DATE = "1997-10-01"

_staged: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _hundredths(name: str) -> Column:
    """Money and rates as whole hundredths, so that sums are exact in any order."""
    return whole(F.col(name).cast("double") * 100).cast("long")


def orders_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and their lines, summed per customer and calendar month.

    Lines collapse to one row per order before the join, so neither money nor
    counts are multiplied, and a huge order reaches the shuffle pre-summed.
    """
    lines = (
        read_table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("lines"),
            F.sum(_hundredths("l_discount")).alias("discount"),
            F.sum(_hundredths("l_tax")).alias("tax"),
            F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
        )
    )
    orders = (
        read_table(spark, folder, "orders")
        .where(F.col("o_orderdate") < F.lit(END_DATE).cast("timestamp_ntz"))
        .select(
            "o_orderkey",
            F.col("o_custkey").alias("CLIENTE"),
            (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("ordered"),
            _hundredths("o_totalprice").alias("cents"),
        )
    )
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("CLIENTE", "ordered")
        .agg(
            F.count("*").alias("orders"),
            F.sum("cents").alias("cents"),
            *[F.sum(c).alias(c) for c in ("lines", "discount", "tax", "quantity")],
        )
    )


def customer_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Build the panel.

    At most 33 order months per customer reach the second shuffle, and the nine
    panel months unfold only after the join, so they are never shuffled.
    """
    age = F.col("month") - F.col("ordered")

    def total(name: str, first: int, last: int | None = None) -> Column:
        inside = age >= first if last is None else age.between(first, last)
        return F.sum(F.when(inside, F.col(name)))

    measures = {
        "bought": total("orders", 0, 0),
        "cents": total("cents", 1),
        "orders": total("orders", 1),
        "cents_24": total("cents", 1, 24),
        "cents_6": total("cents", 1, 6),
        "orders_6": total("orders", 1, 6),
        "orders_7_12": total("orders", 7, 12),
        "lines_12": total("lines", 1, 12),
        "discount_12": total("discount", 1, 12),
        "tax_12": total("tax", 1, 12),
        "quantity_12": total("quantity", 1, 12),
        "last_order_age": F.min(F.when(age >= 1, age)),
        "first_order_age": F.max(F.when(age >= 1, age)),
    }
    entry = F.struct(F.col("month"), F.struct(*measures).alias("measures"))
    history = (
        orders_by_month(spark, folder)
        .repartition("CLIENTE")
        .withColumn("month", F.explode(F.sequence(F.greatest(F.col("ordered"), F.lit(FIRST)), F.lit(LAST))))
        .groupBy("CLIENTE", "month").agg(*[value.alias(name) for name, value in measures.items()])
        .groupBy("CLIENTE").agg(F.map_from_entries(F.collect_list(entry)).alias("history"))
    )
    places = (
        read_table(spark, folder, "nation")
        .join(read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    months = (
        read_table(spark, folder, "customer")
        .select(F.col("c_custkey").alias("CLIENTE"), "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(history, "CLIENTE", "left")
        .withColumn("month", F.explode(F.sequence(F.lit(FIRST), F.lit(LAST))))
        .withColumn("measures", F.try_element_at("history", F.col("month")))
        .select("CLIENTE", "month", "c_nationkey", "c_acctbal", "c_mktsegment", "r_name", "measures.*")
    )
    key = F.col("CLIENTE")
    money = F.coalesce(F.col("cents"), F.lit(0)).cast("double") / 100
    mean_6 = F.coalesce(F.col("cents_6").cast("double") / 100 / F.col("orders_6"), F.lit(0.0))

    def unless(condition: Column, value: Column) -> Column:
        return F.when(~condition, value)

    columns = {
        "MES": F.floor((F.col("month") - 1) / 12) * 100 + (F.col("month") - 1) % 12 + 1,
        "CLIENTE": key,
        "LINEA_RENOVADO": F.floor(money),
        "PLAZO_RENOVADO": (key % 5 + 1) * 12,
        "FLAG_VENTA": F.when(F.col("bought") > 0, 1).otherwise(0),
        "USO_LINEA_TOTAL_TC_T2": F.col("discount_12").cast("double") / 100 / F.col("lines_12"),
        "USO_TRIM_LINEA_BBVA": F.col("tax_12").cast("double") / 100 / F.col("lines_12"),
        "NR_ENTIDADES_TOTAL_T2": F.coalesce(F.col("lines_12"), F.lit(0)),
        "DIFF_NRO_ENTIDA_TOTALES_T2_T12":
            F.coalesce(F.col("orders_6"), F.lit(0)) - F.coalesce(F.col("orders_7_12"), F.lit(0)),
        "SDO_CONSUMO_T2": F.col("cents_24").cast("double") / 100,
        "RESENCIA_OFERTA_PLD_RENOVADO": F.when(F.col("last_order_age") <= 15, F.col("last_order_age")),
        "Ahorro_Sldo_Bco_T1": F.floor("c_acctbal"),
        "PConsumo_Sldo_Bco_T1": F.floor(F.col("c_acctbal") - money / 100),
        "SDO_BCO_tot_sm_pasivo_Bco_6M": mean_6 - F.col("c_acctbal"),
        "EDAD": unless(key % 997 == 0, key % 52 + 21),
        "SEXO": unless(key % 991 == 0, F.when(key % 10 < 7, "M").otherwise("F")),
        "EST_CIVIL": unless(key % 983 == 0, F.substring("c_mktsegment", 1, 1)),
        "ANTIGUEDAD_MES": F.col("first_order_age"),
        "REGION": unless(key % 89 == 0, F.col("r_name")),
        "FLAG_LIMA_PROVINCIA": F.col("c_nationkey") % 2,
        "SUELDO_ESTIMADO": F.col("cents").cast("double") / 100 / F.col("orders") / 50,
        "CUBRIR_DEUDA_CONSUMO_SF_RENOVA_PLD":
            F.coalesce(F.col("quantity_12"), F.lit(0)).cast("double") / 100,
    }
    return months.select(
        *[columns[name].cast(kind).alias(name) for name, kind in RAW_COLUMNS.items()]
    )


def staged_panel(spark: SparkSession, folder: str) -> DataFrame:
    """The panel as a written table, built once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _staged:
        _staged[key] = stage(customer_panel(spark, folder), "panel")
    return _staged[key]
