import math
import random

import pytest
from pyspark.sql import functions as F

from paylake.operators import stats, windows
from tests.helpers import by_id, tx_df

DAY = 86400
CUST = [f"CUSTOMER_ID_{m}_{n}DAY_WINDOW" for n in (1, 7, 30) for m in ("NB_TX", "AVG_AMOUNT")]
TERM = [f"TERMINAL_ID_{m}_{n}DAY_WINDOW" for n in (1, 7, 30) for m in ("NB_TX", "RISK")]


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


def sql_frames(spark, df):
    """Every feature by plain SQL window frames over one temporary view."""
    df.withColumn("s", F.unix_timestamp("TX_DATETIME")).createOrReplaceTempView("plain_tx")
    cols = []
    for n in (1, 7, 30):
        c = f"OVER (PARTITION BY CUSTOMER_ID ORDER BY s RANGE BETWEEN {n * DAY} PRECEDING AND CURRENT ROW)"
        t = (f"OVER (PARTITION BY TERMINAL_ID ORDER BY s RANGE BETWEEN {(7 + n) * DAY} PRECEDING "
             f"AND {7 * DAY + 1} PRECEDING)")
        cols += [f"COUNT(*) {c} AS CUSTOMER_ID_NB_TX_{n}DAY_WINDOW",
                 f"AVG(TX_AMOUNT) {c} AS CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW",
                 f"COUNT(*) {t} AS TERMINAL_ID_NB_TX_{n}DAY_WINDOW",
                 f"COALESCE(AVG(COALESCE(TX_FRAUD, 0)) {t}, 0) AS TERMINAL_ID_RISK_{n}DAY_WINDOW"]
    return spark.sql(f"SELECT *, {', '.join(cols)} FROM plain_tx")


def assert_same(x, y):
    assert x.keys() == y.keys()
    for k in x:
        for a, b in zip(x[k], y[k]):
            assert close(a, b), (k, x[k], y[k])


def test_customer_frame_edges(spark):
    t = 40 * DAY
    spec = [
        (1, t, 7, 1, 10.0, 0),
        (2, t - DAY, 7, 1, 20.0, 0),          # exactly n days old: inside the 1-day frame
        (3, t - DAY - 1, 7, 1, 40.0, 0),      # one second more: outside
        (4, t, 7, 2, 30.0, 0),                # same-second peer of row 1
        (5, t, None, 1, 5.0, 0),              # NULL customer: own group
        (6, None, 7, 1, 8.0, 0),              # NULL time: own peer group
        (7, None, 7, 1, None, 0),
    ]
    df = tx_df(spark, spec)
    got = by_id(windows.with_customer_spending(df), CUST[:2])
    assert got[1] == (3, pytest.approx((10 + 20 + 30) / 3))
    assert got[4] == got[1]
    assert got[3] == (1, 40.0)
    assert got[2] == (2, 30.0)
    assert got[5] == (1, 5.0)
    assert got[6] == (2, 8.0) and got[7] == (2, 8.0)
    plain = by_id(sql_frames(spark, df), CUST)
    assert_same(by_id(windows.with_customer_spending(df), CUST), plain)


def test_terminal_delay_edges(spark):
    d, t = 7 * DAY, 60 * DAY
    spec = [
        (1, t, 5, 9, 1.0, 0),
        (2, t - d, 1, 9, 1.0, 1),             # inside the delay: excluded
        (3, t - d - 1, 1, 9, 1.0, 1),         # just past the delay: in every frame
        (4, t - d - DAY, 1, 9, 1.0, 0),       # 1-day frame lower edge: in
        (5, t - d - DAY - 1, 1, 9, 1.0, 1),   # one second older: out of the 1-day frame
        (6, t - d - 30 * DAY - 1, 1, 9, 1.0, 0),  # out of the 30-day frame
        (7, 5, 1, 8, 1.0, 1),                 # no history: count 0, risk 0
    ]
    df = tx_df(spark, spec)
    got = by_id(windows.with_terminal_risk(df), TERM)
    assert got[1][:2] == (2, 0.5)
    assert got[1][2:4] == (3, pytest.approx(2 / 3))
    assert got[1][4:6] == (3, pytest.approx(2 / 3))
    assert got[7] == (0, 0.0, 0, 0.0, 0, 0.0)
    assert_same(got, by_id(sql_frames(spark, df), TERM))


def random_spec(seed, n=400, keys=5, span_days=70, peers=True):
    rnd = random.Random(seed)
    spec = []
    for i in range(n):
        s = rnd.randrange(0, span_days * DAY)
        if peers and rnd.random() < 0.2 and spec:
            s = spec[-1][1] if spec[-1][1] is not None else s
        if rnd.random() < 0.03:
            s = None
        c = rnd.randrange(keys) if rnd.random() > 0.03 else None
        amt = round(rnd.uniform(0, 300), 2) if rnd.random() > 0.05 else None
        spec.append((i, s, c, rnd.randrange(keys), amt, rnd.randrange(2)))
    return spec


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_features_equal_sql_frames(spark, seed):
    df = tx_df(spark, random_spec(seed))
    got = by_id(windows.gold_features(df), CUST + TERM)
    plain = by_id(sql_frames(spark, df), CUST + TERM)
    assert_same(got, plain)


def test_narrow_buckets_use_history(spark):
    """Bucket width equal to the look-back: every frame crosses a bucket edge."""
    df = tx_df(spark, random_spec(11, n=300, keys=2, span_days=120))
    narrow = by_id(windows.with_customer_spending(df, bucket_seconds=30 * DAY + 1), CUST)
    plain = by_id(sql_frames(spark, df), CUST)
    assert_same(narrow, plain)
    with pytest.raises(ValueError):
        windows.with_customer_spending(df, bucket_seconds=DAY).count()


def test_properties(spark):
    df = tx_df(spark, random_spec(5))
    out = windows.gold_features(df)
    assert out.count() == df.count()
    assert len(out.columns) == 24
    bad = out.where((F.col("CUSTOMER_ID_NB_TX_1DAY_WINDOW") > F.col("CUSTOMER_ID_NB_TX_7DAY_WINDOW"))
                    | (F.col("CUSTOMER_ID_NB_TX_7DAY_WINDOW") > F.col("CUSTOMER_ID_NB_TX_30DAY_WINDOW"))
                    | (F.col("CUSTOMER_ID_NB_TX_1DAY_WINDOW") < 1)
                    | ~F.col("TERMINAL_ID_RISK_30DAY_WINDOW").between(0, 1))
    assert bad.count() == 0


def test_calendar_flags(spark):
    import datetime as dt
    rows = [(1, dt.datetime(2024, 1, 5, 23, 59, 59)), (2, dt.datetime(2024, 1, 6, 0, 0, 0)),
            (3, dt.datetime(2024, 1, 7, 23, 59, 59)), (4, dt.datetime(2024, 1, 8, 0, 0, 0)),
            (5, dt.datetime(2024, 1, 8, 5, 59, 59)), (6, dt.datetime(2024, 1, 8, 6, 0, 0)), (7, None)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID bigint, TX_DATETIME timestamp_ntz")
    got = by_id(windows.add_calendar_flags(df), ["TX_DURING_WEEKEND", "TX_DURING_NIGHT"])
    assert got == {1: (0, 0), 2: (1, 1), 3: (1, 0), 4: (0, 1), 5: (0, 1), 6: (0, 0), 7: (0, 0)}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan):
    return [line for line in plan.split("\n") if "Exchange" in line and "hashpartitioning" in line]


def test_gold_plan_has_one_shuffle_per_key_family(spark):
    """Also at scale: with broadcasts off the plan is that of large tables."""
    df = tx_df(spark, random_spec(7, n=50))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(windows.gold_features(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(_shuffles(plan)) == 2 and "Join" not in plan
    window_lines = [line for line in plan.split("\n") if "Window [" in line]
    assert len(window_lines) == 2  # one per key family, all frames in one operator
    assert all("_b#" in line for line in window_lines)  # partitioned by (key, bucket)


@pytest.mark.parametrize("group_rows", [0, 25, 60])
def test_hot_groups_equal_sql_frames(spark, group_rows):
    """Groups above the bound are pre-aggregated; some, all and null keys and times among them."""
    df = tx_df(spark, random_spec(21, n=500, keys=3, span_days=200) + [(900 + i, 5, None, 1, 1.0, 1) for i in range(80)])
    got = by_id(windows.gold_features(df, group_rows=group_rows), CUST + TERM)
    assert_same(got, by_id(sql_frames(spark, df), CUST + TERM))


def test_hot_group_is_bounded(spark):
    """Half of a million rows share a customer, a terminal and an hour: no window gets them row by row."""
    from paylake.operators import prefix
    tx = spark.range(200_000).select(
        F.col("id").alias("TRANSACTION_ID"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("CUSTOMER_ID"),
        F.timestamp_seconds(F.lit(10**9) + F.col("id") % 3600).cast("timestamp_ntz").alias("TX_DATETIME"),
        F.lit(1).cast("bigint").alias("TERMINAL_ID"), F.lit(2.5).alias("TX_AMOUNT"), F.lit(1).alias("TX_FRAUD"))
    df = windows.add_epoch(tx)
    frames = {"CUSTOMER_ID": windows.customer_frames(), "TERMINAL_ID": windows.terminal_frames()}
    hot = prefix.hot_groups(df, "TX_TS", frames, group_rows=50_000)
    # the bucket and the next one, whose history it may be
    assert {k: v.count() for k, v in hot.items()} == {"CUSTOMER_ID": 2, "TERMINAL_ID": 2}
    out = windows.with_customer_spending(tx, group_rows=50_000)
    assert "HashAggregate" in _plan(out) and "Join" in _plan(out)
    r = out.agg(F.max("CUSTOMER_ID_NB_TX_1DAY_WINDOW").alias("n"), F.count("*").alias("rows")).first()
    assert (r["n"], r["rows"]) == (100_001, 200_000)  # id 7 is one of the others


def exact_means(spec):
    """Mean of every customer frame over exact fractions, rounded once."""
    from fractions import Fraction

    def value(a):
        return Fraction(round(a * 100), 100) if round(a, 2) == a and abs(a) < 9e13 else Fraction(a)

    out = {}
    for i, s, c, *_ in spec:
        means = []
        for n in (1, 7, 30):
            own = [value(r[4]) for r in spec if r[2] == c and r[4] is not None
                   and (r[1] == s if s is None or r[1] is None else s - n * DAY <= r[1] <= s)]
            means.append(float(sum(own) / len(own)) if own else None)
        out[i] = tuple(means)
    return out


def spread_spec(seed, amount, n=150, keys=3):
    rnd = random.Random(seed)
    return [(i, s, c, t, amount(rnd), f) for i, s, c, t, _, f in random_spec(seed, n=n, keys=keys)]


@pytest.mark.parametrize("name, amount, group_rows", [
    ("sub_cent", lambda r: r.uniform(-300, 300), None),
    ("mixed", lambda r: r.choice([round(r.uniform(-9, 9), 2), r.uniform(-1, 1), None, 0.0, -0.0]), 20),
    ("eighths", lambda r: r.choice([r.randrange(-900, 900) / 8, 0.1, 12.34]), None),
    ("cancelling", lambda r: r.choice([1e17, -1e17, 1e17 + 16, 0.1, 1 / 3, 2.5, -1e-9]), 20),
    ("halves", lambda r: r.choice([2.0 ** 53, 1 + 2.0 ** -52, 2.0 ** -53, 3 * 2.0 ** -54, -2.0 ** -60]), None),
    ("large_cents", lambda r: r.choice([8.999999999999e13, 7.77e13, -1.5, 2.0 ** 60]), None),
    ("every_size", lambda r: r.choice([1e300, 5e-324, -1]) * r.uniform(-1, 1) * 2.0 ** r.randrange(-90, 20), None),
])
def test_means_are_exact_quotients(spark, name, amount, group_rows):
    """Equal to the last bit, through running sums as well as pre-aggregated groups."""
    spec = spread_spec(len(name), amount)
    got = by_id(windows.with_customer_spending(tx_df(spark, spec), group_rows=group_rows), CUST[1::2])
    assert got == exact_means(spec)


def test_digits_follow_the_amounts(spark):
    """Whole cents take none; the observed magnitudes of the others give the rest; an empty table has none."""
    frames = {"CUSTOMER_ID": windows.customer_frames()}
    cents = windows.add_epoch(tx_df(spark, random_spec(3, n=50)))
    assert len(windows.survey(cents, frames)[1]) == 0
    assert windows.survey(cents.withColumn("TX_AMOUNT", F.lit(0.125)), frames)[1] == range(-3, 1)
    assert len(windows.survey(cents.limit(0), frames)[1]) == 0
    assert windows.with_customer_spending(cents.limit(0)).count() == 0
    odd = cents.withColumn("TX_AMOUNT", F.when(F.col("TRANSACTION_ID") % 2 == 0, float("nan")).otherwise(F.lit(0.001)))
    assert windows.survey(odd, frames)[1] == range(-3, 1)
