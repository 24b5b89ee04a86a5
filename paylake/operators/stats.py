"""Daily fraud statistics and customer spending profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions.time import is_whole_cents, to_minor_units


def daily_stats(tx: DataFrame, day: str = "TX_TIME_DAYS") -> DataFrame:
    """Per day: transactions (non-null customer), frauds, distinct fraudulent cards.

    One grouped pass; a day without fraud reports 0 cards.
    """
    return tx.groupBy(day).agg(
        F.count("CUSTOMER_ID").alias("nb_tx"),
        F.coalesce(F.sum("TX_FRAUD"), F.lit(0)).cast("bigint").alias("nb_fraud"),
        F.count_distinct(F.when(F.col("TX_FRAUD") > 0, F.col("CUSTOMER_ID"))).alias("nb_fraud_cards"),
    )


def daily_stats_long(daily: DataFrame, day: str = "TX_TIME_DAYS", tx_scale: float = 50.0) -> DataFrame:
    """Long format (day, stat_type, value); transactions per day divided by ``tx_scale``."""
    prepared = daily.select(
        day,
        (F.col("nb_tx") / F.lit(float(tx_scale))).alias("nb_tx_per_day"),
        F.col("nb_fraud").cast("double").alias("nb_fraud_per_day"),
        F.col("nb_fraud_cards").cast("double").alias("nb_fraudcard_per_day"),
    )
    return prepared.unpivot([day], ["nb_tx_per_day", "nb_fraud_per_day", "nb_fraudcard_per_day"],
                            "stat_type", "value")


def fraud_rate(tx: DataFrame) -> DataFrame:
    """Overall share and count of fraudulent transactions."""
    return tx.agg(F.count(F.lit(1)).alias("nb_tx"),
                  F.coalesce(F.sum("TX_FRAUD"), F.lit(0)).cast("bigint").alias("nb_fraud"),
                  F.avg("TX_FRAUD").alias("fraud_rate"))


def customer_profile_estimate(tx: DataFrame) -> DataFrame:
    """Per customer: mean and sample std of amounts, mean transactions per day.

    Customers whose amounts are all whole cents get both from exact integer
    sums with one final division; the others (sub-cent, very large, NaN or
    infinite amounts) what ``avg`` and ``stddev_samp`` give.  Days observed =
    the day span of the whole table (scalar subquery, evaluated once).
    """
    a = F.col("TX_AMOUNT").cast("double")
    u = F.when(is_whole_cents(a), to_minor_units(a)).cast("decimal(38,0)")
    span = tx.select((F.max("TX_TIME_DAYS") - F.min("TX_TIME_DAYS") + 1).alias("d")).scalar()
    g = tx.groupBy("CUSTOMER_ID").agg(
        F.count(F.lit(1)).alias("n_tx"),
        F.count(a).alias("_n"),
        F.count(u).alias("_nu"),
        F.sum(u).alias("_s"),
        F.sum(u * u).alias("_ss"),
        F.avg(a).alias("_avg"),
        F.stddev_samp(a).alias("_std"),
    )
    n = F.col("_n")
    exact = n == F.col("_nu")
    var_num = (n * F.col("_ss") - F.col("_s") * F.col("_s")).cast("double")
    mean = F.when(exact, F.col("_s").cast("double") / (F.lit(100.0) * n.cast("double"))).otherwise(F.col("_avg"))
    std = (F.when(exact, F.sqrt(var_num / (n * (n - 1)).cast("double")) / F.lit(100.0))
           .otherwise(F.col("_std")))
    return g.select(
        "CUSTOMER_ID",
        F.when(n > 0, mean).alias("mean_amount"),
        F.when(n > 1, std).alias("std_amount"),
        (F.col("n_tx").cast("double") / span.cast("double")).alias("mean_nb_tx_per_day"),
    )
