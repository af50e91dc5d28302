"""Sales, features and stores tables derived from an order/line-item star schema.

A supplier is a store and a part type a department, so the panel grows with the
line items. Money is summed in whole cents (BIGINT): the sums are exact and do
not depend on the order in which partitions are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DATE, KEY, STORE
from .layout import dealt

#: Line items of a task: some 100 to 200 MB while they are joined or added up.
LINES = 250_000

# Department code of each part type (anything else is 6) and the
# ISO weeks that count as promotional holidays.
DEPT_CODES = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5}
OTHER_DEPT = 6
HOLIDAY_WEEKS = (6, 36, 47, 52)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _friday(ts: str) -> Column:
    return F.date_add(F.trunc(F.col(ts).cast("date"), "week"), 4)


def _cents(amount: Column) -> Column:
    return F.floor(amount * 100 + 0.5)


def _dept(code: Column) -> Column:
    dept = F
    for name, number in DEPT_CODES.items():
        dept = dept.when(code == name, number)
    return dept.otherwise(OTHER_DEPT).cast("long")


def sales_lines(spark: SparkSession, root: str) -> DataFrame:
    """One row per line item: store, department, week and amount in cents."""
    # Worked out before the join: weeks and cents are smaller to shuffle than times and prices.
    line = table(spark, root, "lineitem").select(
        "l_partkey", (F.col("l_suppkey") + 1).cast("long").alias("Store"), _friday("l_shipdate").alias("Date"),
        _cents(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("cents"))
    part = table(spark, root, "part").select("p_partkey", _dept(F.col("p_type")).alias("Dept"))
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select("Store", "Dept", "Date", "cents")


def sales(spark: SparkSession, root: str) -> DataFrame:
    # Dealt before they are added up: a part of the file can hold millions of lines, most of them groups of their own.
    lines = dealt(sales_lines(spark, root), table(spark, root, "lineitem").count(), KEY, LINES)
    weekly = lines.groupBy("Store", "Dept", "Date").agg(
        (F.sum("cents") / 100.0).alias("Weekly_Sales"))
    return weekly.withColumn("IsHoliday", F.weekofyear("Date").isin(*HOLIDAY_WEEKS))


def features(spark: SparkSession, root: str) -> DataFrame:
    line = table(spark, root, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", _cents(F.col("l_extendedprice")).alias("line_cents"))
    orders = table(spark, root, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).try_cast("tinyint").alias("prio"), _friday("o_orderdate").alias("Date"),
        _cents(F.col("o_totalprice")).alias("order_cents"))
    n = line.count()
    line, orders = dealt(line, n, ["l_orderkey"], LINES), dealt(orders, n, ["o_orderkey"], LINES)
    lines = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_suppkey") + 1).cast("long").alias("Store"), "Date", "order_cents",
        F.col("l_quantity").cast("long").alias("qty"), "line_cents", "prio")
    rows = F.count(F.lit(1))

    def hundredths(start: int, c: Column) -> Column:
        return (start + F.floor(c)) / 100.0

    weekly = dealt(lines, n, [STORE, DATE], LINES).groupBy("Store", "Date").agg(
        hundredths(4000, F.sum("order_cents") / rows / 10000.0).alias("Temperature"),
        hundredths(200, F.sum("qty") / rows * 4.0).alias("Fuel_Price"),
        *[hundredths(0, F.sum(F.when(F.col("prio") == k, F.col("line_cents"))) / 100.0).alias(f"MarkDown{k}")
          for k in range(1, 6)],
        hundredths(9500, F.sum("line_cents") / rows / 1000.0).alias("CPI"),
        hundredths(400, rows * 10.0).alias("Unemployment"),
    )
    return weekly.withColumn("IsHoliday", F.weekofyear("Date").isin(*HOLIDAY_WEEKS))


def stores(spark: SparkSession, root: str) -> DataFrame:
    kind = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")),
                        (F.col("s_nationkey") % 3 + 1).cast("int"))
    return table(spark, root, "supplier").select(
        (F.col("s_suppkey") + 1).cast("long").alias("Store"),
        F.when(F.col("s_acctbal") >= 0, kind).alias("Type"),
        (10000 + 20 * F.floor(F.abs("s_acctbal"))).cast("long").alias("Size"),
    )
