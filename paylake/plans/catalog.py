"""Named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the provided test tables through the adapters, applies the
library operators, and returns a DataFrame whose column names match the SQL
in :mod:`paylake.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.operators import audit, conform, labels, ordering, proximity, stats, windows
from paylake.plans import jobs
from paylake.sources import adapters, tables
from paylake.sources.schemas import TRANSACTION_TYPES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------------ gold (L3)

@query
def gold_customer_spending(spark, sf_dir):
    tx = adapters.events_transactions(spark, sf_dir)
    out = windows.with_customer_spending(tx)
    feats = [f"CUSTOMER_ID_{m}_{n}DAY_WINDOW" for n in (1, 7, 30) for m in ("NB_TX", "AVG_AMOUNT")]
    return out.select("TRANSACTION_ID", "CUSTOMER_ID", "TX_TS", *feats)


@query
def gold_terminal_risk(spark, sf_dir):
    tx = adapters.events_transactions(spark, sf_dir)
    out = windows.with_terminal_risk(tx)
    feats = [f"TERMINAL_ID_{m}_{n}DAY_WINDOW" for n in (1, 7, 30) for m in ("NB_TX", "RISK")]
    return out.select("TRANSACTION_ID", "TERMINAL_ID", "TX_TS", *feats)


@query
def tx_calendar_flags(spark, sf_dir):
    tx = adapters.events_transactions(spark, sf_dir)
    return windows.add_calendar_flags(tx).select("TRANSACTION_ID", "TX_DATETIME", "TX_DURING_WEEKEND",
                                                 "TX_DURING_NIGHT")


@query
def gold_features(spark, sf_dir):
    return windows.gold_features(adapters.events_transactions(spark, sf_dir))


@query
def gold_features_bulk(spark, sf_dir):
    """Gold features over orders x lineitem: midnight timestamps, many peers."""
    return windows.gold_features(adapters.orders_transactions(spark, sf_dir))


@query
def gold_edge_amounts(spark, sf_dir):
    """Customer means over sub-cent, NaN and infinite amounts (changed by key)."""
    tx = adapters.events_transactions(spark, sf_dir)
    i = F.col("TRANSACTION_ID")
    amount = (F.when(i % 101 == 0, F.lit(float("nan"))).when(i % 103 == 0, F.lit(float("inf")))
              .when(i % 107 == 0, F.lit(float("-inf"))).otherwise(F.floor(F.col("TX_AMOUNT") * 8) / F.lit(8.0)))
    out = windows.with_customer_spending(tx.withColumn("TX_AMOUNT", amount))
    cols = []
    for n in windows.DEFAULT_WINDOWS:
        avg = F.col(f"CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW")
        kind = (F.when(F.isnan(avg), "nan").when(avg == float("inf"), "inf")
                .when(avg == float("-inf"), "-inf").otherwise("finite"))
        cols += [kind.alias(f"kind_{n}"), F.when(kind == "finite", avg).alias(f"avg_{n}")]
    return out.select("TRANSACTION_ID", *cols)


@query
def gold_exact_amounts(spark, sf_dir):
    """Customer means of amounts up to 2^73 and down to 1/1024, of both signs (changed by key):
    where the large ones of a frame cancel, the small ones are left whole."""
    tx = adapters.events_transactions(spark, sf_dir)
    i, a = F.col("TRANSACTION_ID"), F.col("TX_AMOUNT")
    large = F.floor(a * 8) * F.lit(2.0 ** 60)
    amount = F.when(i % 3 == 0, large).when(i % 3 == 1, -large).otherwise(F.floor(a * 1000) / F.lit(1024.0))
    out = windows.with_customer_spending(tx.withColumn("TX_AMOUNT", amount))
    return out.select("TRANSACTION_ID", *[F.col(f"CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW").alias(f"avg_{n}")
                                          for n in windows.DEFAULT_WINDOWS])


LOOKUP_ID = 777


@query
def point_lookup(spark, sf_dir):
    """Terminal features of one transaction, computed only over its terminal's
    rows inside the widest frame (the id filter cannot pass the window).  Terminal
    and times of the id are one scalar subquery, so rows are cut above the scan."""
    tx = windows.add_epoch(adapters.events_transactions(spark, sf_dir))
    term, second = F.col("TERMINAL_ID"), F.col("TX_TS")
    # one struct, so one subquery and one scan with the id pushed down
    found = (tx.where(F.col("TRANSACTION_ID") == LOOKUP_ID).select(F.struct(
        F.min(term).alias("t0"), F.max(term).alias("t1"), F.count_if(term.isNull()).alias("tn"),
        F.min(second).alias("s0"), F.max(second).alias("s1"), F.count_if(second.isNull()).alias("sn")).alias("f")).scalar())
    reach = (windows.DEFAULT_DELAY + max(windows.DEFAULT_WINDOWS)) * windows.SECONDS_PER_DAY
    near = term.between(found["t0"], found["t1"]) | (term.isNull() & (found["tn"] > 0))
    reached = second.between(found["s0"] - reach, found["s1"]) | (second.isNull() & (found["sn"] > 0))
    feats = windows.with_terminal_risk(tx.where(near & reached))
    return feats.where(F.col("TRANSACTION_ID") == LOOKUP_ID).select(
        "TRANSACTION_ID", "TX_DATETIME", "TX_FRAUD",
        *[f"TERMINAL_ID_{m}_{n}DAY_WINDOW" for n in (1, 7, 30) for m in ("NB_TX", "RISK")])


# ----------------------------------------------------------- bronze (L1)

@query
def bronze_csv_scan(spark, sf_dir):
    return jobs.bronze_transactions(spark, sf_dir)


@query
def bronze_topk_string_order(spark, sf_dir):
    """Top 3 by TRANSACTION_ID as text (lexicographic: 0, 1, 10), of a text view: nothing is landed."""
    view = jobs.raw_transactions_text(adapters.events_transactions(spark, sf_dir))
    return ordering.top_k(view, 3, F.col("TRANSACTION_ID").asc())


@query
def bronze_table_roundtrip(spark, sf_dir):
    bronze = jobs.bronze_transactions(spark, sf_dir)
    db = tables.ensure_database(spark)
    name = tables.save_table(bronze, tables.table_name("transaction", db, "bronze"))
    return tables.read_table(spark, name)


@query
def medallion_gold(spark, sf_dir):
    """The gold table after raw -> bronze -> silver -> gold, each layer through its tables."""
    return tables.read_table(spark, jobs.medallion(spark, sf_dir, jobs.LayerNames("fraud_medallion")))


LATE_DAYS = (3, 4)


@query
def gold_late_labels(spark, sf_dir):
    """The gold table after the labels of two days came in late (here: turned round) and only the
    buckets that they reach were rewritten."""
    names = jobs.LayerNames("fraud_late")
    gold = jobs.medallion(spark, sf_dir, names, gold=jobs.gold_buckets_job)
    silver = names.name("transactions", "silver")
    late = F.col("TX_TIME_DAYS").between(*LATE_DAYS)
    labelled = tables.read_table(spark, silver).withColumn("TX_FRAUD", F.when(late, 1 - F.col("TX_FRAUD")).otherwise(F.col("TX_FRAUD")))
    tables.save_table(labelled, silver)
    jobs.refresh_gold_buckets(spark, *LATE_DAYS, names)
    return tables.read_table(spark, gold).drop("TX_BUCKET")


@query
def gold_lookup(spark, sf_dir):
    """One transaction of the gold table, which is clustered by id: row groups without it are skipped."""
    gold = tables.read_table(spark, jobs.medallion(spark, sf_dir, jobs.LayerNames("fraud_lookup")))
    return gold.where(F.col("TRANSACTION_ID") == LOOKUP_ID)


@query
def raw_csv_roundtrip(spark, sf_dir):
    """Typed -> raw text CSV -> bronze -> silver equals the (second-truncated) source."""
    return conform.conform(jobs.bronze_transactions(spark, sf_dir), "transactions")


# ----------------------------------------------------------- silver (L2)

@query
def silver_transactions(spark, sf_dir):
    """Typing of the corrupted fixture: bad cells become NULL."""
    return conform.conform(jobs.bronze_transactions(spark, sf_dir, corrupt=True), "transactions")


@query
def silver_terminals(spark, sf_dir):
    return conform.conform(jobs.bronze_terminals(spark, sf_dir), "terminals")


@query
def silver_customers(spark, sf_dir):
    silver = conform.conform(jobs.bronze_customers(spark, sf_dir), "customers")
    return silver.withColumn("available_terminals", F.size("available_terminals"))


@query
def silver_customer_terminals(spark, sf_dir):
    """List text (plain and numpy-style) parsed back to ids, one row per pair."""
    silver = conform.conform(jobs.bronze_customers(spark, sf_dir), "customers")
    # the outer form keeps Spark from parsing each list twice more to filter out empty ones first
    pairs = silver.select("CUSTOMER_ID", F.posexplode_outer("available_terminals").alias("_place", "TERMINAL_ID"))
    return pairs.where(F.col("_place").isNotNull()).drop("_place")


@query
def preview_topk(spark, sf_dir):
    """Three rows of the typed text view: each task keeps three, nothing is landed."""
    view = jobs.raw_transactions_text(adapters.events_transactions(spark, sf_dir))
    return ordering.top_k(conform.conform(view, "transactions"), 3, F.col("TRANSACTION_ID").asc())


@query
def null_audit_transactions(spark, sf_dir):
    """Audit of the bronze table, as the reference runs it (only the
    empty amount cells are NULL before typing)."""
    return audit.null_audit(jobs.bronze_transactions(spark, sf_dir, corrupt=True))


@query
def null_audit_transactions_silver(spark, sf_dir):
    return audit.null_audit(conform.conform(jobs.bronze_transactions(spark, sf_dir, corrupt=True),
                                            "transactions"))


@query
def null_audit_customers(spark, sf_dir):
    return audit.null_audit(jobs.bronze_customers(spark, sf_dir))


@query
def null_audit_terminals(spark, sf_dir):
    return audit.null_audit(jobs.bronze_terminals(spark, sf_dir))


@query
def cast_loss_audit(spark, sf_dir):
    return audit.cast_loss_audit(jobs.bronze_transactions(spark, sf_dir, corrupt=True), TRANSACTION_TYPES)


@query
def schema_report(spark, sf_dir):
    return audit.schema_report(jobs.bronze_transactions(spark, sf_dir, corrupt=True), TRANSACTION_TYPES)


# -------------------------------------------------------------- proximity

@query
def customers_within_radius(spark, sf_dir):
    return proximity.terminals_within_radius(adapters.customers(spark, sf_dir), adapters.terminals(spark, sf_dir),
                                             jobs.DEFAULT_RADIUS)


@query
def customer_terminal_counts(spark, sf_dir):
    cust = adapters.customers(spark, sf_dir)
    return proximity.terminal_counts(cust, adapters.terminals(spark, sf_dir), jobs.DEFAULT_RADIUS)


# ----------------------------------------------------------------- labels

def _label_inputs(spark, sf_dir):
    """Transactions and the profile tables from which entities are drawn."""
    return (adapters.events_transactions(spark, sf_dir), adapters.terminals(spark, sf_dir),
            adapters.customers(spark, sf_dir))


@query
def label_threshold(spark, sf_dir):
    tx = adapters.events_transactions(spark, sf_dir)
    hit = labels.threshold_hits(tx)
    return tx.select("TRANSACTION_ID", "TX_AMOUNT", hit.cast("int").alias("TX_FRAUD"),
                     F.when(hit, 1).otherwise(0).alias("TX_FRAUD_SCENARIO"))


@query
def sample_k_per_day(spark, sf_dir):
    tx, terms, custs = _label_inputs(spark, sf_dir)
    n = labels.n_start_days(tx)
    t = labels.compromised_terminals(terms, n).select(
        "start_day", F.lit("terminal").alias("entity_kind"), F.col("TERMINAL_ID").alias("entity_id"))
    c = labels.compromised_customers(custs, n).select(
        "start_day", F.lit("customer").alias("entity_kind"), F.col("CUSTOMER_ID").alias("entity_id"))
    return t.unionByName(c)


@query
def label_compromised_terminals(spark, sf_dir):
    tx, terms, _ = _label_inputs(spark, sf_dir)
    n = labels.n_start_days(tx)
    comp = labels.compromised_terminals(terms, n)
    return labels.terminal_hits(tx, comp, max_rows=labels.TERMINALS_PER_DAY * n).select("TRANSACTION_ID", "TERMINAL_ID", "TX_TIME_DAYS")


@query
def label_compromised_customers(spark, sf_dir):
    tx, _, custs = _label_inputs(spark, sf_dir)
    n = labels.n_start_days(tx)
    return labels.customer_hits(tx, labels.compromised_customers(custs, n), max_rows=labels.CUSTOMERS_PER_DAY * n)


@query
def label_fraud_scenarios(spark, sf_dir):
    return labels.labelled(*_label_inputs(spark, sf_dir))


@query
def label_fraud_scenarios_bulk(spark, sf_dir):
    """Labels over orders x lineitem: repeated ids, many rows at one second."""
    return labels.labelled(adapters.orders_transactions(spark, sf_dir), adapters.terminals(spark, sf_dir),
                           adapters.customers(spark, sf_dir))


@query
def scenario_increment_counts(spark, sf_dir):
    return labels.scenario_increment_counts(labels.label_frauds(*_label_inputs(spark, sf_dir)))


# ------------------------------------------------------------------ stats

@query
def daily_fraud_stats(spark, sf_dir):
    return stats.daily_stats(labels.labelled(*_label_inputs(spark, sf_dir)))


@query
def daily_stats_long(spark, sf_dir):
    return stats.daily_stats_long(stats.daily_stats(labels.labelled(*_label_inputs(spark, sf_dir))))


@query
def fraud_rate(spark, sf_dir):
    return stats.fraud_rate(labels.labelled(*_label_inputs(spark, sf_dir)))


@query
def customer_profile_estimate(spark, sf_dir):
    return stats.customer_profile_estimate(adapters.events_transactions(spark, sf_dir))


# --------------------------------------------------------------- ordering

@query
def chronological_ids(spark, sf_dir):
    tx = adapters.events_transactions(spark, sf_dir)
    return ordering.chronological_ids(tx, out="CHRONO_ID").select("TRANSACTION_ID", "CHRONO_ID")


@query
def chronological_ids_bulk(spark, sf_dir):
    """Date-only times: many customers share an instant."""
    tx = adapters.orders_transactions(spark, sf_dir)
    return ordering.chronological_ids(tx, out="CHRONO_ID").select("TRANSACTION_ID", "CHRONO_ID")


@query
def tx_time_offsets(spark, sf_dir):
    tx = adapters.events_transactions(spark, sf_dir)
    return ordering.within_day(ordering.time_offsets(tx, adapters.EVENTS_ORIGIN))
