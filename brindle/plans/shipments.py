"""Shipment and revenue reports over a TPC-H style schema.

Each report is one function over DataFrames, so the caller chooses the storage format.  Filters and
projections come first and reach the scan.  No side carries a broadcast hint: the optimizer and
adaptive execution broadcast a side only when its measured size is below the session's limit.

Line items are summed or counted per order before the join where the report allows it.  That uses
the very shuffle the join needs, and one order holding a large share of all items then costs one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Money as decimals, as in the table definitions.
MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"
TOP_ORDER_KEYS = 20
TOP_REVENUES = 5


def on_day(column: str, day: str) -> Column:
    """Day equality, written as a range so that the filter reaches the Parquet scan."""
    start = F.lit(day).cast("date")
    return (F.col(column) >= start) & (F.col(column) < F.date_add(start, 1))


def shipped_count(lineitem: DataFrame, day: str) -> DataFrame:
    """Number of line items shipped on a day."""
    return lineitem.where(on_day("l_shipdate", day)).agg(F.count("*").alias("count"))


def clerk_orders(
    lineitem: DataFrame, orders: DataFrame, day: str, clerk: str = "o_clerk", limit: int = TOP_ORDER_KEYS
) -> DataFrame:
    """Clerk and order key of every item shipped on a day; the first ``limit`` by order key."""
    items = lineitem.where(on_day("l_shipdate", day)).select("l_orderkey")
    return (
        items.join(orders.select("o_orderkey", clerk), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(clerk, "o_orderkey")
        .orderBy("o_orderkey", clerk)
        .limit(limit)
    )


def part_supplier(
    lineitem: DataFrame, part: DataFrame, supplier: DataFrame, day: str, limit: int = TOP_ORDER_KEYS
) -> DataFrame:
    """Order key, part name and supplier name of items shipped on a day; the first ``limit``."""
    items = lineitem.where(on_day("l_shipdate", day)).select("l_orderkey", "l_partkey", "l_suppkey")
    return (
        items.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "p_name", "s_name")
        .orderBy("l_orderkey", "p_name", "s_name")
        .limit(limit)
    )


def _order_nations(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Order key with the nation of its customer."""
    homes = customer.select("c_custkey", "c_nationkey").join(
        nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        orders.select("o_orderkey", "o_custkey")
        .join(homes, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "n_nationkey", "n_name")
    )


def nation_shipments(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, day: str
) -> DataFrame:
    """Items shipped on a day, counted per nation of the customer."""
    items = lineitem.where(on_day("l_shipdate", day)).groupBy("l_orderkey").agg(F.count("*").alias("items"))
    # The day's orders are few, so they meet the orders first and the customers after that.
    buyers = items.join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("o_custkey", "items")
    return (
        buyers.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum("items").alias("count"))
        .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_nationkey", "n_name", "count")
        .orderBy("n_nationkey")
    )


def monthly_shipments(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, names: list[str]
) -> DataFrame:
    """Items per nation and month of shipment, over all days, for the named nations."""
    wanted = nation.select("n_nationkey", F.upper(F.trim("n_name")).alias("n_name")).where(
        F.col("n_name").isin([name.strip().upper() for name in names])
    )
    items = lineitem.select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    return (
        items.join(_order_nations(orders, customer, wanted), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("n_nationkey", "n_name", "month")
        .agg(F.count("*").alias("count"))
        .orderBy("n_nationkey", "month")
    )


def _pricing_columns() -> tuple[Column, Column]:
    price = F.col("l_extendedprice").cast(MONEY)
    discounted = price * (1 - F.col("l_discount").cast(RATE))
    return discounted, discounted * (1 + F.col("l_tax").cast(RATE))


def pricing_summary(lineitem: DataFrame, day: str) -> DataFrame:
    """Billing volume per return flag and line status for items shipped on a day.

    Sums are exact decimals and become doubles only at the end.
    """
    discounted, charge = _pricing_columns()
    quantity = F.col("l_quantity").cast(MONEY)
    price = F.col("l_extendedprice").cast(MONEY)
    rate = F.col("l_discount").cast(RATE)
    sums = (
        lineitem.where(on_day("l_shipdate", day))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum(quantity).alias("qty"),
            F.sum(price).alias("base"),
            F.sum(discounted).alias("disc"),
            F.sum(charge).alias("charge"),
            F.sum(rate).alias("rate"),
            F.count("*").alias("count_order"),
        )
    )
    double = {c: F.col(c).cast("double") for c in ("qty", "base", "disc", "charge", "rate")}
    return sums.select(
        "l_returnflag",
        "l_linestatus",
        double["qty"].alias("sum_qty"),
        double["base"].alias("sum_base_price"),
        F.round(double["disc"], 4).alias("sum_disc_price"),
        F.round(double["charge"], 6).alias("sum_charge"),
        F.round(double["qty"] / F.col("count_order"), 6).alias("avg_qty"),
        F.round(double["base"] / F.col("count_order"), 6).alias("avg_price"),
        F.round(double["rate"] / F.col("count_order"), 6).alias("avg_disc"),
        "count_order",
    )


def top_unshipped(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    day: str,
    priority: str = "o_shippriority",
    limit: int = TOP_REVENUES,
) -> DataFrame:
    """Orders placed before a day with items shipped after it, by revenue of those items."""
    after = F.col("l_shipdate") >= F.date_add(F.lit(day).cast("date"), 1)
    before = F.col("o_orderdate") < F.lit(day).cast("date")
    discounted, _ = _pricing_columns()
    revenue = lineitem.where(after).groupBy("l_orderkey").agg(F.sum(discounted).alias("revenue"))
    open_orders = orders.where(before).select("o_orderkey", "o_custkey", "o_orderdate", priority)
    return (
        revenue.join(open_orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "c_name",
            "l_orderkey",
            "revenue",
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
            priority,
        )
        .orderBy(F.desc("revenue"), "c_name", "l_orderkey", "o_orderdate", priority)
        .limit(limit)
        .withColumn("revenue", F.round(F.col("revenue").cast("double"), 4))
    )


PRICING_SQL = """
SELECT l_returnflag, l_linestatus,
       CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sum_base_price,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE), 4)
           AS sum_disc_price,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                      * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS DOUBLE), 6) AS sum_charge,
       round(CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / count(*), 6) AS avg_qty,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / count(*), 6) AS avg_price,
       round(CAST(sum(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / count(*), 6) AS avg_disc,
       count(*) AS count_order
FROM {lineitem}
WHERE l_shipdate >= CAST(:day AS DATE) AND l_shipdate < date_add(CAST(:day AS DATE), 1)
GROUP BY l_returnflag, l_linestatus
"""

CLERK_SQL = """
SELECT o_orderkey, {clerk}
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
WHERE l_shipdate >= CAST(:day AS DATE) AND l_shipdate < date_add(CAST(:day AS DATE), 1)
ORDER BY o_orderkey, {clerk} LIMIT 20
"""

NATION_SQL = """
SELECT n_nationkey, n_name, count(*) AS count
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
     JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
WHERE l_shipdate >= CAST(:day AS DATE) AND l_shipdate < date_add(CAST(:day AS DATE), 1)
GROUP BY n_nationkey, n_name ORDER BY n_nationkey
"""


def run_sql(spark: SparkSession, statement: str, tables: dict[str, DataFrame], **args: str) -> DataFrame:
    """Run SQL text over DataFrames passed by name, with bound parameters such as ``:day``."""
    return spark.sql(statement, args=args, **tables)
