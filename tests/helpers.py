import datetime as dt

TX_DDL = ("TRANSACTION_ID bigint, TX_DATETIME timestamp_ntz, CUSTOMER_ID bigint, TERMINAL_ID bigint, "
          "TX_AMOUNT double, TX_TIME_SECONDS int, TX_TIME_DAYS int, TX_FRAUD int, TX_FRAUD_SCENARIO int")

T0 = dt.datetime(2024, 1, 1)


def tx_rows(spec):
    """spec: (id, seconds-or-None, customer, terminal, amount, fraud) -> silver-shaped rows."""
    rows = []
    for i, s, c, t, a, f in spec:
        ts = None if s is None else T0 + dt.timedelta(seconds=s)
        rows.append((i, ts, c, t, a, None if s is None else s, None if s is None else s // 86400, f, 0))
    return rows


def tx_df(spark, spec):
    return spark.createDataFrame(tx_rows(spec), TX_DDL)


def by_id(df, cols):
    return {r["TRANSACTION_ID"]: tuple(r[c] for c in cols) for r in df.collect()}
