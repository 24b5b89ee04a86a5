from paylake.plans import jobs
from paylake.sources import adapters, files, tables

SF = "/root/testdata/sf0.001"


def test_medallion_layers_end_to_end(spark):
    tx = adapters.events_transactions(spark, SF)
    profiles = jobs.customer_profiles(adapters.customers(spark, SF), adapters.terminals(spark, SF), tx)
    raw = {
        "transactions": files.land(spark, jobs.raw_transactions_text(tx), "transactions"),
        "customers": files.land(spark, jobs.raw_customers_text(profiles), "customers"),
        "terminals": files.land(spark, files.to_text(jobs.terminal_profiles(adapters.terminals(spark, SF))),
                                "terminals"),
    }
    names = jobs.LayerNames("paylake_e2e")
    jobs.bronze_job(spark, raw, names)
    audits = jobs.silver_job(spark, names)
    assert audits["transactions"].first().total_rows == tx.count()
    assert audits["transactions"].first().nulls_TX_AMOUNT == 0
    gold = tables.read_table(spark, jobs.gold_job(spark, names))
    assert gold.count() == tx.count() and len(gold.columns) == 24
    silver_c = tables.read_table(spark, names.name("customers", "silver"))
    assert dict(silver_c.dtypes)["available_terminals"] == "array<bigint>"
    assert silver_c.where("size(available_terminals) != nb_terminals").count() == 0


def test_refresh_rewrites_only_reached_buckets(spark):
    """A late label day: equal to a full run, and the other buckets' files stay."""
    from pyspark.sql import functions as F
    from tests.helpers import tx_df

    day = 86400
    spec = [(i, (i * 7919) % (200 * day), i % 7, i % 5, 10.0 + i % 90, int(i % 11 == 0)) for i in range(900)]
    names = jobs.LayerNames("paylake_late")
    tables.ensure_database(spark, names.database)
    silver = names.name("transactions", "silver")
    tables.save_table(tx_df(spark, spec), silver)
    gold = jobs.gold_buckets_job(spark, names)

    def files_of(buckets):
        seen = spark.table(gold).where(~F.col("TX_BUCKET").isin(buckets)).select("_metadata.file_path").distinct()
        return sorted(r.file_path for r in seen.collect())

    changed = spark.table(silver).withColumn("TX_FRAUD", F.when(F.col("TX_TIME_DAYS") == 61, 1).otherwise(F.col("TX_FRAUD")))
    tables.save_table(changed, silver)
    want = list(range(61 // jobs.GOLD_BUCKET_DAYS, (61 + 37) // jobs.GOLD_BUCKET_DAYS + 1))
    before, old = files_of(want), sorted(map(str, spark.table(gold).collect()))
    assert jobs.refresh_gold_buckets(spark, 61, 61, names) == want
    assert files_of(want) == before and len(before) > 5
    now = spark.table(gold)
    assert sorted(map(str, now.collect())) != old
    full = jobs._with_bucket(jobs.windows.gold_features(spark.table(silver)))
    assert sorted(map(str, now.select(*full.columns).collect())) == sorted(map(str, full.collect()))
