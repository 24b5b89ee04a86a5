"""End-to-end jobs of the medallion flow (L0-L3) and the fixtures they read.

raw (CSV text) -> bronze (string tables) -> silver (typed, audited)
-> gold (features); labelling turns unlabelled transactions into labelled
ones.  Each layer is written as a table before the next reads it, which
also cuts the lineage between layers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paylake.operators import audit, conform, proximity, stats, windows
from paylake.sources import adapters, files, tables
from paylake.sources.schemas import CUSTOMER_TYPES, LAYOUTS, TERMINAL_TYPES, TRANSACTION_TYPES

DEFAULT_RADIUS = 5.0
GOLD_BUCKET_DAYS = 10


def customer_profiles(customers: DataFrame, terminals: DataFrame, tx: DataFrame,
                      radius: float = DEFAULT_RADIUS) -> DataFrame:
    """Customer profile table: location, spending estimate, terminals in range."""
    est = stats.customer_profile_estimate(tx)
    # estimates first, so that no list is shuffled for them
    profiles = customers.join(est, "CUSTOMER_ID", "left")
    return proximity.with_terminal_lists(profiles, terminals, radius).select(*[c for c, _ in CUSTOMER_TYPES])


def terminal_profiles(terminals: DataFrame) -> DataFrame:
    return terminals.select(*[c for c, _ in TERMINAL_TYPES])


# ------------------------------------------------------------ raw fixtures

def raw_transactions_text(tx: DataFrame, corrupt: bool = False) -> DataFrame:
    text = files.to_text(tx.select(*[c for c, _ in TRANSACTION_TYPES]))
    return files.inject_bad_transaction_cells(text) if corrupt else text


def raw_customers_text(profiles: DataFrame) -> DataFrame:
    """Profiles as raw text; even ids print their terminal list numpy-style."""
    lists = files.list_text(F.col("available_terminals"), (F.col("CUSTOMER_ID") % 2) == 0)
    return files.to_text(profiles.select(*[c for c, _ in CUSTOMER_TYPES]), {"available_terminals": lists})


def land_customers(spark: SparkSession, profiles: DataFrame) -> str:
    """Raw customers, compressed: lists are most of the bytes and those of rows next to each other are much alike."""
    return files.land(spark, raw_customers_text(profiles), "customers", files.ZSTD, files.LIST_ROWS)


def bronze_transactions(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> DataFrame:
    path = files.land(spark, raw_transactions_text(adapters.events_transactions(spark, sf_dir), corrupt),
                      "transactions")
    return files.read_bronze_csv(spark, path, "transactions")


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = customer_profiles(adapters.customers(spark, sf_dir), adapters.terminals(spark, sf_dir),
                                 adapters.events_transactions(spark, sf_dir))
    return files.read_bronze_csv(spark, land_customers(spark, profiles), "customers")


def bronze_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = files.to_text(terminal_profiles(adapters.terminals(spark, sf_dir)))
    return files.read_bronze_csv(spark, files.land(spark, text, "terminals"), "terminals")


# ----------------------------------------------------------------- layers

@dataclass
class LayerNames:
    database: str = tables.DEFAULT_DATABASE
    catalog: str | None = None

    def name(self, table: str, layer: str) -> str:
        return tables.table_name(table, self.database, layer, self.catalog)


def bronze_job(spark: SparkSession, raw_paths: dict[str, str], names: LayerNames = LayerNames(),
               fmt: str = "parquet") -> dict[str, str]:
    """L1: raw CSV folders -> bronze string tables (full overwrite).

    Malformed rows stay in the bronze table as far as they could be read.  They are counted
    while it is written; where there are any, their lines go to a ``quarantine`` table.
    """
    tables.ensure_database(spark, names.database, catalog=names.catalog)
    out = {}
    for layout, path in raw_paths.items():
        df = files.read_bronze_csv(spark, path, layout, corrupt=True)
        seen = Observation()
        counted = df.observe(seen, F.count_if(F.col(files.CORRUPT).isNotNull()).alias("corrupt")).drop(files.CORRUPT)
        lists = any(t.startswith("array<") for _, t in LAYOUTS[layout])
        out[layout] = tables.save_table(counted, names.name(layout, "bronze"), fmt, rows_per_file=files.LIST_ROWS if lists else 0)
        held = names.name(layout, "quarantine")
        if seen.get["corrupt"]:
            tables.save_table(files.quarantine(df), held, fmt)
        elif tables.location(spark, held):
            tables.drop_table(spark, held)
    return out


def silver_job(spark: SparkSession, names: LayerNames = LayerNames(), fmt: str = "parquet",
               strict: bool = False) -> dict[str, DataFrame]:
    """L2: bronze -> typed silver tables; returns the audits of the silver tables, which are
    taken while they are written."""
    audits = {}
    for layout in ("customers", "terminals", "transactions"):
        bronze = tables.read_table(spark, names.name(layout, "bronze"))
        observed, audited = audit.observed_null_audit(conform.conform(bronze, layout, strict))
        tables.save_table(observed, names.name(layout, "silver"), fmt)
        audits[layout] = audited()
    return audits


def gold_job(spark: SparkSession, names: LayerNames = LayerNames(), fmt: str = "parquet") -> str:
    """L3: silver transactions -> gold feature table (24 columns), clustered by transaction id."""
    silver = tables.read_table(spark, names.name("transactions", "silver"))
    return tables.save_table(windows.gold_features(silver), names.name("transactions", "gold"), fmt,
                             cluster_by="TRANSACTION_ID", ranges_from=silver)


def _with_bucket(gold: DataFrame) -> DataFrame:
    return gold.withColumn("TX_BUCKET", F.floor(F.col("TX_TIME_DAYS") / F.lit(GOLD_BUCKET_DAYS)).cast("int"))


def gold_buckets_job(spark: SparkSession, names: LayerNames = LayerNames(), fmt: str = "parquet") -> str:
    """L3, partitioned by buckets of days (column TX_BUCKET), so that late labels can be worked in."""
    silver = tables.read_table(spark, names.name("transactions", "silver"))
    return tables.save_table(_with_bucket(windows.gold_features(silver)), names.name("transactions", "gold_buckets"), fmt,
                             partition_by=["TX_BUCKET"])


def refresh_gold_buckets(spark: SparkSession, first_day: int, last_day: int, names: LayerNames = LayerNames(),
                         fmt: str = "parquet") -> list[int]:
    """Rewrite the gold buckets that silver rows of days [first_day, last_day] reach, after their
    labels or amounts have changed; returns those buckets.

    A row bears on its own features and on those of up to 37 days later, so silver is read
    from 37 days before the first bucket on.  Buckets are replaced by dynamic partition
    overwrite, in place: the others' files stay, and readers see the buckets change one by
    one.  Days are those of the rows' old and new times; rows without a time are left alone.
    """
    reach = windows.DEFAULT_DELAY + max(windows.DEFAULT_WINDOWS)
    low, high = first_day // GOLD_BUCKET_DAYS, (last_day + reach) // GOLD_BUCKET_DAYS
    days = F.col("TX_TIME_DAYS").between(low * GOLD_BUCKET_DAYS - reach - 1, (high + 1) * GOLD_BUCKET_DAYS - 1)
    silver = tables.read_table(spark, names.name("transactions", "silver")).where(days)
    gold = _with_bucket(windows.gold_features(silver)).where(F.col("TX_BUCKET").between(low, high))
    name = names.name("transactions", "gold_buckets")
    (gold.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("TX_BUCKET")
     .save(tables.location(spark, name)))
    spark.catalog.refreshTable(name)
    return list(range(low, high + 1))


def medallion(spark: SparkSession, sf_dir: str, names: LayerNames, gold=gold_job) -> str:
    """Raw CSV -> bronze -> silver -> gold, each through its tables; returns the gold table."""
    tx = adapters.events_transactions(spark, sf_dir)
    terminals = adapters.terminals(spark, sf_dir)
    profiles = customer_profiles(adapters.customers(spark, sf_dir), terminals, tx)
    raw = {"transactions": files.land(spark, raw_transactions_text(tx), "transactions"),
           "customers": land_customers(spark, profiles),
           "terminals": files.land(spark, files.to_text(terminal_profiles(terminals)), "terminals")}
    bronze_job(spark, raw, names)
    silver_job(spark, names)
    return gold(spark, names)
