from pyspark.sql import functions as F

from paylake.operators import labels, sampling, stats
from tests.helpers import tx_df

DAY = 86400


def test_threshold_is_strict(spark):
    df = tx_df(spark, [(1, 0, 1, 1, 220.0, 0), (2, 0, 1, 1, 220.01, 0), (3, 0, 1, 1, None, 0)])
    got = {r.TRANSACTION_ID: r.h for r in df.select("TRANSACTION_ID", labels.threshold_hits(df).alias("h")).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_terminal_window_days(spark):
    tx = tx_df(spark, [(1, 3 * DAY, 1, 7, 1.0, 0), (2, 30 * DAY, 1, 7, 1.0, 0), (3, 31 * DAY, 1, 7, 1.0, 0),
                       (4, 3 * DAY, 1, 8, 1.0, 0)])
    comp = spark.createDataFrame([(3, 7)], "start_day int, TERMINAL_ID bigint")
    hit = {r.TRANSACTION_ID for r in labels.terminal_hits(tx, comp).collect()}
    assert hit == {1, 2}  # day 3 and day 30 = 3 + 27 in; day 31 = 3 + 28 out


def test_customer_pool_share_and_overlap(spark):
    spec = [(i, (i % 10) * DAY, 1 + i % 3, 1, 10.0, 0) for i in range(60)]
    tx = tx_df(spark, spec)
    comp = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3)], "start_day int, CUSTOMER_ID bigint")
    hits = {r.TRANSACTION_ID: r.hits for r in labels.customer_hits(tx, comp).collect()}
    # start 0 pools all 60 rows -> 20 chosen; start 1 pools 54 (days 1..9) -> 18 chosen
    assert sum(hits.values()) == 20 + 18
    assert max(hits.values()) <= 2
    inflated = tx.select(labels.inflate(F.col("TX_AMOUNT"), F.lit(2)).alias("a")).first().a
    assert inflated == 10.0 * 5 * 5


def test_hash_rank_is_dense_per_group(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), F.col("id"))
    ranked = sampling.hash_rank(df, ["g"], sampling.seed_hash(F.col("g"), F.col("id")), "id")
    for g, n in ((0, 1667), (1, 1667), (2, 1666)):
        ranks = sorted(r._rank for r in ranked.where(F.col("g") == g).collect())
        assert ranks == list(range(n))


def test_sample_k_per_seed(spark):
    ents = spark.range(1, 51).select(F.col("id").alias("TERMINAL_ID"))
    s = labels.compromised_terminals(ents, 10)
    per = {r.start_day: r.n for r in s.groupBy("start_day").agg(F.count("*").alias("n")).collect()}
    assert per == {d: 2 for d in range(10)}
    assert labels.compromised_terminals(ents, 0).count() == 0


def test_scenario_priority_and_counts(spark):
    spec = [(i, (i % 20) * DAY + 3600, i % 4, i % 5, 300.0 if i % 7 == 0 else 20.0, 0) for i in range(400)]
    tx = tx_df(spark, spec)
    terms = tx.select("TERMINAL_ID").distinct()
    custs = tx.select("CUSTOMER_ID").distinct()
    flagged = labels.label_frauds(tx, terms, custs)
    c = labels.scenario_increment_counts(flagged).first()
    lab = labels.labelled(tx, terms, custs)
    assert lab.count() == 400
    assert c.added_by_amount + c.added_by_terminal + c.added_by_customer == c.frauds
    assert lab.where("TX_FRAUD = 1").count() == c.frauds
    # a row hit by scenario 3 carries scenario 3 even when rule 1 or 2 also hit
    bad = flagged.where((F.col("_hits3") > 0) & (F.col("TX_FRAUD_SCENARIO") != 3)).count()
    assert bad == 0


def test_daily_stats_fraud_free_day(spark):
    tx = tx_df(spark, [(1, 0, 1, 1, 1.0, 1), (2, 10, 2, 1, 1.0, 1), (3, 20, 1, 1, 1.0, 1), (4, DAY, 1, 1, 1.0, 0)])
    got = {r.TX_TIME_DAYS: (r.nb_tx, r.nb_fraud, r.nb_fraud_cards) for r in stats.daily_stats(tx).collect()}
    assert got == {0: (3, 3, 2), 1: (1, 0, 0)}
    long = stats.daily_stats_long(stats.daily_stats(tx))
    assert long.count() == 6
    assert {r.value for r in long.where("stat_type = 'nb_tx_per_day'").collect()} == {3 / 50, 1 / 50}


def test_sample_draws_all_when_few_and_spreads(spark):
    few = spark.createDataFrame([(1,), (1,), (2,), (None,)], "CUSTOMER_ID bigint")
    got = labels.compromised_customers(few, 3).collect()
    assert sorted(tuple(r) for r in got) == [(d, c) for d in range(3) for c in (1, 2)]
    ents = spark.range(20).select(F.col("id").alias("TERMINAL_ID"))
    drawn = labels.compromised_terminals(ents, 200).collect()
    assert len(set(map(tuple, drawn))) == 400 and len({r.TERMINAL_ID for r in drawn}) == 20


def test_repeated_and_null_ids(spark):
    # customer 9 shares every id with customer 1 but is never compromised
    spec = [(i, i * 60, c, 1, 10.0, 0) for i in range(30) for c in (1, 9)]
    spec += [(None, 5000 + i, 1, 1, 10.0, 0) for i in range(30)]
    tx = tx_df(spark, spec)
    comp = spark.createDataFrame([(0, 1)], "start_day int, CUSTOMER_ID bigint")
    got = labels.with_customer_hits(tx, comp, max_rows=1).where("_hits3 > 0").collect()
    assert len(got) == 60 // 3 and {r.CUSTOMER_ID for r in got} == {1}
    assert any(r.TRANSACTION_ID is None for r in got)


def test_share_cut_keeps_equal_hashes_together(spark):
    df = spark.createDataFrame([(1, "aaaa1")] * 5 + [(1, "bbbb1")] + [(2, f"{i:04x}0") for i in range(10)], "g int, h string")
    cuts = {r.g: r.cut for r in sampling.share_cut(df, "g", "h", 3).collect()}
    assert cuts == {1: "aaaa1", 2: "00030"}


def test_share_is_exact_among_copies(spark):
    # nine equal rows; NULL ids at one second with other amounts; a run that several start days cut
    spec = [(7, 100, 1, 1, 10.0, 0)] * 9 + [(None, DAY, 2, 1, float(i % 5), 0) for i in range(40)]
    spec += [(5, 2 * DAY, 3, 1, 1.0, 0)] * 5000 + [(i, 2 * DAY, 3, 1, 1.0, 0) for i in range(100, 110)]
    tx = tx_df(spark, spec).repartition(5)
    comp = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (-1, 3), (-2, 3)], "start_day int, CUSTOMER_ID bigint")
    hit = labels.with_customer_hits(tx, comp, max_rows=5)
    assert hit.count() == len(spec) and hit.drop("_hits3").exceptAll(tx.select(*hit.drop("_hits3").columns)).count() == 0
    got = {r.CUSTOMER_ID: r.n for r in hit.groupBy("CUSTOMER_ID").agg(F.sum("_hits3").alias("n")).collect()}
    assert got == {1: 9 // 3, 2: 40 // 3, 3: 3 * (5010 // 3)}
    assert hit.agg(F.max("_hits3")).first()[0] <= 3


def test_labelling_does_not_shuffle_transactions(spark):
    tx = tx_df(spark, [(i, (i % 20) * DAY + i, i % 4, i % 5, 20.0, 0) for i in range(400)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = lambda c, k: spark.range(50).select((F.col("id") % k).alias(c))
        plan = labels.labelled(tx, ids("TERMINAL_ID", 5), ids("CUSTOMER_ID", 4))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.splitlines() if "Join" in line and "TX_TIME_DAYS" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)


def test_labels_of_copies_match_sql(spark, tmp_path):
    """Every event six times (a third of them at one id): the SQL asks exactly floor(n / 3) a start day."""
    import duckdb

    from paylake.plans import catalog, oracle
    from tools.oracle_check import compare
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    same = events.where("event_id = 1").drop("event_id")
    many = events.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(6)))).drop("_c")
    hot = events.where("event_id % 3 = 0").select("event_id").crossJoin(same).select(*events.columns)
    many.unionByName(hot.withColumn("event_id", F.lit(1).cast("bigint"))).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    for t in ("customer", "supplier"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    df = catalog.QUERIES["label_fraud_scenarios"](spark, str(tmp_path))
    asked = con.execute(oracle.SQL["label_fraud_scenarios"])
    columns = [d[0] for d in asked.description]
    assert compare([tuple(r) for r in df.collect()], df.columns, asked.fetchall(), columns) == "exact"


def test_labelling_writes_two_small_tables_beforehand(spark, monkeypatch):
    """Compromises and cuts; nothing else runs while the plan is built."""
    tx = tx_df(spark, [(i, (i % 20) * DAY + i, i % 4, i % 5, 20.0, 0) for i in range(400)])
    ids = lambda c, k: spark.range(50).select((F.col("id") % k).alias(c))
    writes = []
    real = labels.frozen

    def frozen(df, name):
        writes.append(name)
        return real(df, name)

    monkeypatch.setattr(labels, "frozen", frozen)
    for method in ("first", "collect", "isEmpty", "count"):
        monkeypatch.setattr(type(tx), method, lambda *a, m=method: writes.append(m))
    labels.labelled(tx, ids("TERMINAL_ID", 5), ids("CUSTOMER_ID", 4))
    assert writes == ["compromises", "cell-cuts"]
