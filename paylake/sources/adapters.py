"""Map the provided test tables onto the three domain tables.

=================  ==========================================================
transactions       ``events``: one event is one card payment
bulk transactions  ``orders`` joined with ``lineitem`` (midnight timestamps)
customers          ``customer`` with coordinates derived from the key
terminals          ``supplier`` with coordinates derived from the key
=================  ==========================================================

Every adapter is a projection over a parquet scan, so column pruning and
filters reach the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.functions.time import day_index, seconds_since

# Origin of the seconds/day offsets for each source table.
EVENTS_ORIGIN = "2024-01-01 00:00:00"
ORDERS_ORIGIN = "1995-01-01 00:00:00"

# Multipliers that place customers and terminals on the
# 100x100 grid, x = (key * a mod 10000) / 100.
CUSTOMER_GRID = (7919, 6101)
TERMINAL_GRID = (4733, 3571)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions_from_events(events: DataFrame, origin: str = EVENTS_ORIGIN) -> DataFrame:
    """events -> silver-shaped transactions (scenario 0; fraud = error event)."""
    secs = seconds_since("ts", origin)
    return events.select(
        F.col("event_id").cast("bigint").alias("TRANSACTION_ID"),
        F.col("ts").cast("timestamp_ntz").alias("TX_DATETIME"),
        F.col("user_id").cast("bigint").alias("CUSTOMER_ID"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("TERMINAL_ID"),
        F.col("value").cast("double").alias("TX_AMOUNT"),
        secs.cast("int").alias("TX_TIME_SECONDS"),
        day_index(secs).alias("TX_TIME_DAYS"),
        (F.col("event_type") == "error").cast("int").alias("TX_FRAUD"),
        F.lit(0).alias("TX_FRAUD_SCENARIO"),
    )


def transactions_from_orders(orders: DataFrame, lineitem: DataFrame,
                             origin: str = ORDERS_ORIGIN) -> DataFrame:
    """orders x lineitem -> transactions; id = orderkey * 8 + linenumber.

    Ids repeat where the source repeats an (order, line) pair.
    Shuffle join on the order key (both sides grow with the data).
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    secs = seconds_since("o_orderdate", origin)
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("TRANSACTION_ID"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("TX_DATETIME"),
        F.col("o_custkey").cast("bigint").alias("CUSTOMER_ID"),
        F.col("l_suppkey").cast("bigint").alias("TERMINAL_ID"),
        F.col("l_extendedprice").cast("double").alias("TX_AMOUNT"),
        secs.cast("int").alias("TX_TIME_SECONDS"),
        day_index(secs).alias("TX_TIME_DAYS"),
        (F.col("l_returnflag") == "R").cast("int").alias("TX_FRAUD"),
        F.lit(0).alias("TX_FRAUD_SCENARIO"),
    )


def _grid(key, mult: int):
    return (F.pmod(key * F.lit(mult), F.lit(10000)) / F.lit(100.0)).cast("double")


def customers_from_table(customer: DataFrame) -> DataFrame:
    """customer -> (CUSTOMER_ID, x_customer_id, y_customer_id)."""
    k = F.col("c_custkey").cast("bigint")
    return customer.select(k.alias("CUSTOMER_ID"),
                           _grid(k, CUSTOMER_GRID[0]).alias("x_customer_id"),
                           _grid(k, CUSTOMER_GRID[1]).alias("y_customer_id"))


def terminals_from_table(supplier: DataFrame) -> DataFrame:
    """supplier -> (TERMINAL_ID, x_terminal_id, y_terminal_id)."""
    k = F.col("s_suppkey").cast("bigint")
    return supplier.select(k.alias("TERMINAL_ID"),
                           _grid(k, TERMINAL_GRID[0]).alias("x_terminal_id"),
                           _grid(k, TERMINAL_GRID[1]).alias("y_terminal_id"))


def events_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(table(spark, sf_dir, "events"))


def orders_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_orders(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_from_table(table(spark, sf_dir, "customer"))


def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terminals_from_table(table(spark, sf_dir, "supplier"))
