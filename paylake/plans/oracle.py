"""Independent SQL for every named query (DuckDB dialect).

Each statement re-derives the query's answer from the raw test tables with
plain SQL (window frames, EXISTS, GROUP BY), so it shares no code with the
Spark plans it checks.  Tables available: region nation customer supplier
part orders lineitem events documents embeddings pages benchmark labels
conversations.
"""

from __future__ import annotations

# Transactions adapted from ``events`` (see paylake.sources.adapters).
TX = """
tx AS (
  SELECT event_id AS TRANSACTION_ID,
         ts AS TX_DATETIME,
         user_id AS CUSTOMER_ID,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS TERMINAL_ID,
         value AS TX_AMOUNT,
         CAST(floor(epoch(ts)) - epoch(TIMESTAMP '2024-01-01 00:00:00') AS INTEGER) AS TX_TIME_SECONDS,
         CAST(floor((floor(epoch(ts)) - epoch(TIMESTAMP '2024-01-01 00:00:00')) / 86400.0) AS INTEGER) AS TX_TIME_DAYS,
         CAST(event_type = 'error' AS INTEGER) AS TX_FRAUD,
         0 AS TX_FRAUD_SCENARIO,
         CAST(floor(epoch(ts)) AS BIGINT) AS TX_TS,
         CAST(round(value * 100) AS BIGINT) AS units
  FROM events
)"""

CUSTOMER_WINDOWS = """
  WINDOW w1 AS (PARTITION BY CUSTOMER_ID ORDER BY TX_TS NULLS FIRST RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW),
         w7 AS (PARTITION BY CUSTOMER_ID ORDER BY TX_TS NULLS FIRST RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY CUSTOMER_ID ORDER BY TX_TS NULLS FIRST RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW)"""

TERMINAL_WINDOWS = """
  WINDOW v1 AS (PARTITION BY TERMINAL_ID ORDER BY TX_TS NULLS FIRST RANGE BETWEEN 691200 PRECEDING AND 604801 PRECEDING),
         v7 AS (PARTITION BY TERMINAL_ID ORDER BY TX_TS NULLS FIRST RANGE BETWEEN 1209600 PRECEDING AND 604801 PRECEDING),
         v30 AS (PARTITION BY TERMINAL_ID ORDER BY TX_TS NULLS FIRST RANGE BETWEEN 3196800 PRECEDING AND 604801 PRECEDING)"""


def _cust_cols() -> str:
    out = []
    for n in (1, 7, 30):
        out.append(f"COUNT(*) OVER w{n} AS CUSTOMER_ID_NB_TX_{n}DAY_WINDOW")
        out.append(f"CASE WHEN COUNT(TX_AMOUNT) OVER w{n} > 0 THEN CAST(SUM(units) OVER w{n} AS DOUBLE) "
                   f"/ (CAST(100 AS DOUBLE) * CAST(COUNT(TX_AMOUNT) OVER w{n} AS DOUBLE)) END "
                   f"AS CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW")
    return ",\n  ".join(out)


def _term_cols() -> str:
    out = []
    for n in (1, 7, 30):
        out.append(f"COUNT(*) OVER v{n} AS TERMINAL_ID_NB_TX_{n}DAY_WINDOW")
        out.append(f"CASE WHEN COUNT(*) OVER v{n} > 0 THEN CAST(SUM(TX_FRAUD) OVER v{n} AS DOUBLE) "
                   f"/ CAST(COUNT(*) OVER v{n} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END "
                   f"AS TERMINAL_ID_RISK_{n}DAY_WINDOW")
    return ",\n  ".join(out)


SQL: dict[str, str] = {}

SQL["gold_customer_spending"] = f"""
WITH {TX}
SELECT TRANSACTION_ID, CUSTOMER_ID, TX_TS,
  {_cust_cols()}
FROM tx
{CUSTOMER_WINDOWS}
"""

SQL["gold_terminal_risk"] = f"""
WITH {TX}
SELECT TRANSACTION_ID, TERMINAL_ID, TX_TS,
  {_term_cols()}
FROM tx
{TERMINAL_WINDOWS}
"""

SQL["tx_calendar_flags"] = f"""
WITH {TX}
SELECT TRANSACTION_ID, TX_DATETIME,
  CASE WHEN isodow(TX_DATETIME) IN (6, 7) THEN 1 ELSE 0 END AS TX_DURING_WEEKEND,
  CASE WHEN hour(TX_DATETIME) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS TX_DURING_NIGHT
FROM tx
"""

def gold_sql(tx_cte: str) -> str:
    return f"""
WITH {tx_cte}
SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_TIME_SECONDS,
  TX_TIME_DAYS, TX_FRAUD, TX_FRAUD_SCENARIO,
  CASE WHEN isodow(TX_DATETIME) IN (6, 7) THEN 1 ELSE 0 END AS TX_DURING_WEEKEND,
  CASE WHEN hour(TX_DATETIME) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS TX_DURING_NIGHT,
  TX_TS,
  {_cust_cols()},
  {_term_cols()}
FROM tx
{CUSTOMER_WINDOWS},
{TERMINAL_WINDOWS.replace("WINDOW", "", 1)}
"""


SQL["gold_features"] = gold_sql(TX)

# Transactions adapted from ``orders`` x ``lineitem``.
TXB = """
tx AS (
  SELECT l_orderkey * 8 + l_linenumber AS TRANSACTION_ID,
         o_orderdate AS TX_DATETIME,
         o_custkey AS CUSTOMER_ID,
         l_suppkey AS TERMINAL_ID,
         l_extendedprice AS TX_AMOUNT,
         CAST(floor(epoch(o_orderdate)) - epoch(TIMESTAMP '1995-01-01 00:00:00') AS INTEGER) AS TX_TIME_SECONDS,
         CAST(floor((floor(epoch(o_orderdate)) - epoch(TIMESTAMP '1995-01-01 00:00:00')) / 86400.0) AS INTEGER)
           AS TX_TIME_DAYS,
         CAST(l_returnflag = 'R' AS INTEGER) AS TX_FRAUD,
         0 AS TX_FRAUD_SCENARIO,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) AS TX_TS,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS units
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

SQL["gold_features_bulk"] = gold_sql(TXB)

def _edge_cols() -> str:
    out = []
    for n in (1, 7, 30):
        avg = f"AVG(amount) OVER w{n}"
        out.append(f"CASE WHEN isnan({avg}) THEN 'nan' WHEN {avg} = CAST('inf' AS DOUBLE) THEN 'inf' "
                   f"WHEN {avg} = CAST('-inf' AS DOUBLE) THEN '-inf' ELSE 'finite' END AS kind_{n}")
        out.append(f"CASE WHEN isfinite({avg}) THEN {avg} END AS avg_{n}")
    return ",\n  ".join(out)


SQL["gold_edge_amounts"] = f"""
WITH {TX},
edge AS (
  SELECT TRANSACTION_ID, CUSTOMER_ID, TX_TS,
         CASE WHEN TRANSACTION_ID % 101 = 0 THEN CAST('nan' AS DOUBLE)
              WHEN TRANSACTION_ID % 103 = 0 THEN CAST('inf' AS DOUBLE)
              WHEN TRANSACTION_ID % 107 = 0 THEN CAST('-inf' AS DOUBLE)
              ELSE floor(TX_AMOUNT * 8) / CAST(8 AS DOUBLE) END AS amount
  FROM tx
)
SELECT TRANSACTION_ID,
  {_edge_cols()}
FROM edge
{CUSTOMER_WINDOWS}
"""

# amounts are whole numbers of 1/1024, so 128-bit integers sum them exactly
_EXACT_COLS = ",\n  ".join(f"CAST(SUM(part) OVER w{n} AS DOUBLE) / (1024.0::DOUBLE * COUNT(part) OVER w{n}) AS avg_{n}" for n in (1, 7, 30))

SQL["gold_exact_amounts"] = f"""
WITH {TX},
exact AS (
  SELECT TRANSACTION_ID, CUSTOMER_ID, TX_TS,
         CASE TRANSACTION_ID % 3
              WHEN 0 THEN CAST(floor(TX_AMOUNT * 8) AS HUGEINT) * (CAST(1 AS HUGEINT) << 70)
              WHEN 1 THEN -CAST(floor(TX_AMOUNT * 8) AS HUGEINT) * (CAST(1 AS HUGEINT) << 70)
              ELSE CAST(floor(TX_AMOUNT * 1000) AS HUGEINT) END AS part
  FROM tx
)
SELECT TRANSACTION_ID,
  {_EXACT_COLS}
FROM exact
{CUSTOMER_WINDOWS}
"""

SQL["point_lookup"] = f"""
WITH {TX}
SELECT * FROM (
  SELECT TRANSACTION_ID, TX_DATETIME, TX_FRAUD,
    {_term_cols()}
  FROM tx
  {TERMINAL_WINDOWS}
) WHERE TRANSACTION_ID = 777
"""

# ----------------------------------------------------------------- bronze

TX_COLS = ["TRANSACTION_ID", "TX_DATETIME", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT",
           "TX_TIME_SECONDS", "TX_TIME_DAYS", "TX_FRAUD", "TX_FRAUD_SCENARIO"]

BRONZE_SELECT = ",\n  ".join(
    f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" if c == "TX_DATETIME" else f"CAST({c} AS VARCHAR) AS {c}"
    for c in TX_COLS)

SQL["bronze_csv_scan"] = f"""
WITH {TX}
SELECT {BRONZE_SELECT} FROM tx
"""

SQL["bronze_table_roundtrip"] = SQL["bronze_csv_scan"]

# The layers carry whole seconds.
SQL["medallion_gold"] = gold_sql(TX.replace("         ts AS TX_DATETIME,", "         date_trunc('second', ts) AS TX_DATETIME,"))
SQL["gold_late_labels"] = gold_sql(TX.replace("         ts AS TX_DATETIME,", "         date_trunc('second', ts) AS TX_DATETIME,").replace(
    "CAST(event_type = 'error' AS INTEGER) AS TX_FRAUD",
    "CASE WHEN floor((floor(epoch(ts)) - epoch(TIMESTAMP '2024-01-01 00:00:00')) / 86400.0) BETWEEN 3 AND 4 "
    "THEN CAST(event_type <> 'error' AS INTEGER) ELSE CAST(event_type = 'error' AS INTEGER) END AS TX_FRAUD"))
SQL["gold_lookup"] = f"SELECT * FROM ({SQL['medallion_gold']}) WHERE TRANSACTION_ID = 777"

SQL["bronze_topk_string_order"] = f"""
WITH {TX}
SELECT {BRONZE_SELECT} FROM tx ORDER BY CAST(TRANSACTION_ID AS VARCHAR) LIMIT 3
"""

SILVER_CLEAN = """
  SELECT TRANSACTION_ID, date_trunc('second', TX_DATETIME) AS TX_DATETIME, CUSTOMER_ID, TERMINAL_ID,
         TX_AMOUNT, TX_TIME_SECONDS, TX_TIME_DAYS, TX_FRAUD, TX_FRAUD_SCENARIO
  FROM tx"""

SQL["raw_csv_roundtrip"] = f"WITH {TX} {SILVER_CLEAN}"

SQL["preview_topk"] = f"WITH {TX} {SILVER_CLEAN} ORDER BY TRANSACTION_ID LIMIT 3"

# Fixture corruption, by key: amount NULL (id % 97 = 0) or 'abc' (= 1);
# datetime 'bad' (id % 89 = 0); customer '596.0' (id % 83 = 0).
SILVER_CORRUPT = """
  SELECT TRANSACTION_ID,
         CASE WHEN TRANSACTION_ID % 89 = 0 THEN NULL ELSE date_trunc('second', TX_DATETIME) END AS TX_DATETIME,
         CASE WHEN TRANSACTION_ID % 83 = 0 THEN NULL ELSE CUSTOMER_ID END AS CUSTOMER_ID,
         TERMINAL_ID,
         CASE WHEN TRANSACTION_ID % 97 IN (0, 1) THEN NULL ELSE TX_AMOUNT END AS TX_AMOUNT,
         TX_TIME_SECONDS, TX_TIME_DAYS, TX_FRAUD, TX_FRAUD_SCENARIO
  FROM tx"""

SQL["silver_transactions"] = f"WITH {TX} {SILVER_CORRUPT}"


def _null_audit(cols: list[str], null_if: dict[str, str], source: str) -> str:
    parts = ["COUNT(*) AS total_rows"]
    for c in cols:
        cond = null_if.get(c)
        parts.append(f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT) AS nulls_{c}" if cond
                     else f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls_{c}")
    return f"SELECT {', '.join(parts)} FROM {source}"


SQL["null_audit_transactions"] = f"""
WITH {TX}
{_null_audit(TX_COLS, {"TX_AMOUNT": "TRANSACTION_ID % 97 = 0"}, "tx")}
"""

SQL["null_audit_transactions_silver"] = f"""
WITH {TX}, s AS ({SILVER_CORRUPT})
{_null_audit(TX_COLS, {}, "s")}
"""

TX_TYPES = ["bigint", "timestamp_ntz", "bigint", "bigint", "double", "int", "int", "int", "int"]
_LOSS = {"TX_DATETIME": ("0", "TRANSACTION_ID % 89 = 0"),
         "CUSTOMER_ID": ("0", "TRANSACTION_ID % 83 = 0"),
         "TX_AMOUNT": ("TRANSACTION_ID % 97 = 0", "TRANSACTION_ID % 97 IN (0, 1)")}


def _cast_loss() -> str:
    rows = []
    for c in TX_COLS:
        b, s = _LOSS.get(c, ("0", "0"))
        b = "FALSE" if b == "0" else b
        s = "FALSE" if s == "0" else s
        rows.append(f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {b}) AS BIGINT) AS bronze_nulls, "
                    f"CAST(COUNT(*) FILTER (WHERE {s}) AS BIGINT) AS silver_nulls FROM tx")
    return " UNION ALL ".join(rows)


SQL["cast_loss_audit"] = f"""
WITH {TX}, a AS ({_cast_loss()})
SELECT column_name, bronze_nulls, silver_nulls, silver_nulls - bronze_nulls AS lost_cells FROM a
"""


def _schema_report() -> str:
    rows = []
    for pos, (c, t) in enumerate(zip(TX_COLS, TX_TYPES)):
        b, s = _LOSS.get(c, ("0", "0"))
        b = "FALSE" if b == "0" else b
        s = "FALSE" if s == "0" else s
        rows.append(f"SELECT CAST({pos} AS INTEGER) AS position, '{c}' AS column_name, 'string' AS actual_type, "
                    f"'{t}' AS declared_type, CAST(COUNT(*) FILTER (WHERE NOT ({b})) AS BIGINT) AS filled_cells, "
                    f"CAST(COUNT(*) FILTER (WHERE NOT ({s})) AS BIGINT) AS typed_cells FROM tx")
    return " UNION ALL ".join(rows)


SQL["schema_report"] = f"WITH {TX} {_schema_report()}"

# --------------------------------------------------------------- profiles

GEO = """
cust AS (
  SELECT c_custkey AS CUSTOMER_ID,
         CAST((c_custkey * 7919) % 10000 AS DOUBLE) / CAST(100 AS DOUBLE) AS x_customer_id,
         CAST((c_custkey * 6101) % 10000 AS DOUBLE) / CAST(100 AS DOUBLE) AS y_customer_id
  FROM customer
),
term AS (
  SELECT s_suppkey AS TERMINAL_ID,
         CAST((s_suppkey * 4733) % 10000 AS DOUBLE) / CAST(100 AS DOUBLE) AS x_terminal_id,
         CAST((s_suppkey * 3571) % 10000 AS DOUBLE) / CAST(100 AS DOUBLE) AS y_terminal_id
  FROM supplier
),
pairs AS (
  SELECT c.CUSTOMER_ID, t.TERMINAL_ID,
         sqrt((c.x_customer_id - t.x_terminal_id) * (c.x_customer_id - t.x_terminal_id)
              + (c.y_customer_id - t.y_terminal_id) * (c.y_customer_id - t.y_terminal_id)) AS distance
  FROM cust c, term t
  WHERE sqrt((c.x_customer_id - t.x_terminal_id) * (c.x_customer_id - t.x_terminal_id)
             + (c.y_customer_id - t.y_terminal_id) * (c.y_customer_id - t.y_terminal_id)) < 5
)"""

ESTIMATE = """
est AS (
  SELECT CUSTOMER_ID,
         CASE WHEN COUNT(TX_AMOUNT) > 0 THEN CAST(SUM(units) AS DOUBLE)
              / (CAST(100 AS DOUBLE) * CAST(COUNT(TX_AMOUNT) AS DOUBLE)) END AS mean_amount,
         CASE WHEN COUNT(TX_AMOUNT) > 1 THEN
              sqrt(CAST(COUNT(TX_AMOUNT) * SUM(CAST(units AS HUGEINT) * units) - SUM(units) * SUM(units) AS DOUBLE)
                   / CAST(COUNT(TX_AMOUNT) * (COUNT(TX_AMOUNT) - 1) AS DOUBLE)) / CAST(100 AS DOUBLE) END
           AS std_amount,
         CAST(COUNT(*) AS DOUBLE) / CAST((SELECT max(TX_TIME_DAYS) - min(TX_TIME_DAYS) + 1 FROM tx) AS DOUBLE)
           AS mean_nb_tx_per_day
  FROM tx GROUP BY CUSTOMER_ID
)"""

SQL["customer_profile_estimate"] = f"WITH {TX}, {ESTIMATE} SELECT * FROM est"

SQL["customers_within_radius"] = f"WITH {GEO} SELECT CUSTOMER_ID, TERMINAL_ID, distance FROM pairs"

SQL["customer_terminal_counts"] = f"""
WITH {GEO}
SELECT c.CUSTOMER_ID, CAST(COUNT(p.TERMINAL_ID) AS INTEGER) AS nb_terminals
FROM cust c LEFT JOIN pairs p ON c.CUSTOMER_ID = p.CUSTOMER_ID
GROUP BY c.CUSTOMER_ID
"""

SQL["silver_terminals"] = f"WITH {GEO} SELECT * FROM term"

SQL["silver_customer_terminals"] = f"WITH {GEO} SELECT CUSTOMER_ID, TERMINAL_ID FROM pairs"

SQL["silver_customers"] = f"""
WITH {TX}, {GEO}, {ESTIMATE}
SELECT c.CUSTOMER_ID, c.x_customer_id, c.y_customer_id, e.mean_amount, e.std_amount, e.mean_nb_tx_per_day,
       CAST((SELECT COUNT(*) FROM pairs p WHERE p.CUSTOMER_ID = c.CUSTOMER_ID) AS INTEGER) AS available_terminals,
       CAST((SELECT COUNT(*) FROM pairs p WHERE p.CUSTOMER_ID = c.CUSTOMER_ID) AS INTEGER) AS nb_terminals
FROM cust c LEFT JOIN est e ON c.CUSTOMER_ID = e.CUSTOMER_ID
"""

_CUST_COLS = ["CUSTOMER_ID", "x_customer_id", "y_customer_id", "mean_amount", "std_amount",
              "mean_nb_tx_per_day", "available_terminals", "nb_terminals"]

SQL["null_audit_customers"] = f"""
WITH {TX}, {GEO}, {ESTIMATE},
prof AS (
  SELECT c.CUSTOMER_ID, c.x_customer_id, c.y_customer_id, e.mean_amount, e.std_amount, e.mean_nb_tx_per_day,
         '[' || COALESCE(p.ids, '') || ']' AS available_terminals, COALESCE(p.n, 0) AS nb_terminals
  FROM cust c LEFT JOIN est e ON c.CUSTOMER_ID = e.CUSTOMER_ID
  LEFT JOIN (SELECT CUSTOMER_ID, string_agg(CAST(TERMINAL_ID AS VARCHAR), ', ') AS ids, COUNT(*) AS n
             FROM pairs GROUP BY CUSTOMER_ID) p ON c.CUSTOMER_ID = p.CUSTOMER_ID
)
{_null_audit(_CUST_COLS, {}, "prof")}
"""

SQL["null_audit_terminals"] = f"""
WITH {GEO}
{_null_audit(["TERMINAL_ID", "x_terminal_id", "y_terminal_id"], {}, "term")}
"""

# ----------------------------------------------------------------- labels

def _ranks(prefix: str, key: str, source: str) -> str:
    return f"""{prefix}rank AS (
  SELECT {key}, row_number() OVER (ORDER BY md5('entity:' || CAST({key} AS VARCHAR)), {key}) - 1 AS rnk
  FROM (SELECT DISTINCT {source} AS {key} FROM {"supplier" if prefix == "t" else "customer"} WHERE {source} IS NOT NULL)
),
{prefix}n AS (SELECT COUNT(*) AS n FROM {prefix}rank)"""


def _digits(i: int) -> str:
    return f"CAST('0x' || substr(md5(CAST(start_day AS VARCHAR) || ':{i}'), 1, 15) AS BIGINT)"


# Distinct ranks by Floyd's method; the tables hold at least k entities.
SAMPLES = f"""
nd AS (SELECT max(TX_TIME_DAYS) AS n FROM tx),
days AS (SELECT CAST(unnest(range(0, (SELECT n FROM nd))) AS INTEGER) AS start_day),
{_ranks("t", "TERMINAL_ID", "s_suppkey")},
{_ranks("c", "CUSTOMER_ID", "c_custkey")},
tdraw1 AS (SELECT start_day, n, {_digits(0)} % (n - 1) AS r0, {_digits(1)} % n AS r1 FROM days, tn),
tdraw AS (SELECT start_day, unnest([r0, CASE WHEN r1 = r0 THEN n - 1 ELSE r1 END]) AS rnk FROM tdraw1),
tsample AS (SELECT start_day, TERMINAL_ID FROM tdraw JOIN trank USING (rnk)),
cdraw1 AS (SELECT start_day, n, {_digits(0)} % (n - 2) AS r0, {_digits(1)} % (n - 1) AS r1, {_digits(2)} % n AS r2
           FROM days, cn),
cdraw2 AS (SELECT start_day, n, r0, CASE WHEN r1 = r0 THEN n - 2 ELSE r1 END AS r1, r2 FROM cdraw1),
cdraw AS (SELECT start_day, unnest([r0, r1, CASE WHEN r2 IN (r0, r1) THEN n - 1 ELSE r2 END]) AS rnk FROM cdraw2),
csample AS (SELECT start_day, CUSTOMER_ID FROM cdraw JOIN crank USING (rnk)),
txr AS MATERIALIZED (
  SELECT *, row_number() OVER () AS rid, row_number() OVER copies - 1 AS copy, COUNT(*) OVER copies AS same
  FROM tx WINDOW copies AS (PARTITION BY TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT)
),
thit AS (
  SELECT rid FROM txr
  WHERE EXISTS (SELECT 1 FROM tsample s WHERE s.TERMINAL_ID = txr.TERMINAL_ID
                AND txr.TX_TIME_DAYS >= s.start_day AND txr.TX_TIME_DAYS < s.start_day + 28)
),
drawn AS (
  SELECT s.start_day, txr.rid, (copy + s.start_day) % same AS place,
         md5(concat(s.start_day, ':', TRANSACTION_ID, ':', TX_TIME_SECONDS, ':', TERMINAL_ID)) AS h,
         md5(concat(TRANSACTION_ID, ':', txr.CUSTOMER_ID, ':', TERMINAL_ID, ':', TX_TIME_SECONDS, ':', units)) AS tie
  FROM txr JOIN csample s ON s.CUSTOMER_ID = txr.CUSTOMER_ID
   AND txr.TX_TIME_DAYS >= s.start_day AND txr.TX_TIME_DAYS < s.start_day + 14
),
pooled AS (
  SELECT start_day, rid, row_number() OVER (PARTITION BY start_day ORDER BY h, tie, place) AS upto,
         COUNT(*) OVER (PARTITION BY start_day) AS n
  FROM drawn
),
chit AS (SELECT rid, COUNT(*) AS hits FROM pooled WHERE upto <= n // 3 GROUP BY rid),
flags AS (
  SELECT txr.*,
         COALESCE(txr.TX_AMOUNT > 220, FALSE) AS h1,
         thit.rid IS NOT NULL AS h2,
         COALESCE(chit.hits, 0) AS h3
  FROM txr LEFT JOIN thit USING (rid) LEFT JOIN chit USING (rid)
),
labelled AS (
  SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID,
         CASE WHEN h3 = 0 THEN TX_AMOUNT
              ELSE list_reduce(list_concat([TX_AMOUNT], list_transform(range(h3), lambda i: CAST(5 AS DOUBLE))),
                               lambda a, b: a * b) END AS TX_AMOUNT,
         TX_TIME_SECONDS, TX_TIME_DAYS,
         CAST(h1 OR h2 OR h3 > 0 AS INTEGER) AS TX_FRAUD,
         CAST(CASE WHEN h3 > 0 THEN 3 WHEN h2 THEN 2 WHEN h1 THEN 1 ELSE 0 END AS INTEGER) AS TX_FRAUD_SCENARIO,
         h1, h2, h3
  FROM flags
)"""

SQL["label_threshold"] = f"""
WITH {TX}
SELECT TRANSACTION_ID, TX_AMOUNT,
       CAST(COALESCE(TX_AMOUNT > 220, FALSE) AS INTEGER) AS TX_FRAUD,
       CASE WHEN COALESCE(TX_AMOUNT > 220, FALSE) THEN 1 ELSE 0 END AS TX_FRAUD_SCENARIO
FROM tx
"""

SQL["sample_k_per_day"] = f"""
WITH {TX}, {SAMPLES}
SELECT start_day, 'terminal' AS entity_kind, TERMINAL_ID AS entity_id FROM tsample
UNION ALL
SELECT start_day, 'customer' AS entity_kind, CUSTOMER_ID AS entity_id FROM csample
"""

SQL["label_compromised_terminals"] = f"""
WITH {TX}, {SAMPLES}
SELECT TRANSACTION_ID, TERMINAL_ID, TX_TIME_DAYS FROM txr JOIN thit USING (rid)
"""

SQL["label_compromised_customers"] = f"WITH {TX}, {SAMPLES} SELECT TRANSACTION_ID, hits FROM txr JOIN chit USING (rid)"

_LABELLED = f"""{SAMPLES}
SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_TIME_SECONDS, TX_TIME_DAYS,
       TX_FRAUD, TX_FRAUD_SCENARIO
FROM labelled
"""

SQL["label_fraud_scenarios"] = f"WITH {TX}, {_LABELLED}"
SQL["label_fraud_scenarios_bulk"] = f"WITH {TXB}, {_LABELLED}"

SQL["scenario_increment_counts"] = f"""
WITH {TX}, {SAMPLES}
SELECT COUNT(*) FILTER (WHERE h1) AS added_by_amount,
       COUNT(*) FILTER (WHERE h2 AND NOT h1) AS added_by_terminal,
       COUNT(*) FILTER (WHERE h3 > 0 AND NOT h1 AND NOT h2) AS added_by_customer,
       COUNT(*) FILTER (WHERE h1 OR h2 OR h3 > 0) AS frauds
FROM labelled
"""

DAILY = """
daily AS (
  SELECT TX_TIME_DAYS, COUNT(CUSTOMER_ID) AS nb_tx, CAST(COALESCE(SUM(TX_FRAUD), 0) AS BIGINT) AS nb_fraud,
         COUNT(DISTINCT CASE WHEN TX_FRAUD > 0 THEN CUSTOMER_ID END) AS nb_fraud_cards
  FROM labelled GROUP BY TX_TIME_DAYS
)"""

SQL["daily_fraud_stats"] = f"WITH {TX}, {SAMPLES}, {DAILY} SELECT * FROM daily"

SQL["daily_stats_long"] = f"""
WITH {TX}, {SAMPLES}, {DAILY}
SELECT TX_TIME_DAYS, 'nb_tx_per_day' AS stat_type, CAST(nb_tx AS DOUBLE) / CAST(50 AS DOUBLE) AS value FROM daily
UNION ALL
SELECT TX_TIME_DAYS, 'nb_fraud_per_day', CAST(nb_fraud AS DOUBLE) FROM daily
UNION ALL
SELECT TX_TIME_DAYS, 'nb_fraudcard_per_day', CAST(nb_fraud_cards AS DOUBLE) FROM daily
"""

SQL["fraud_rate"] = f"""
WITH {TX}, {SAMPLES}
SELECT COUNT(*) AS nb_tx, CAST(COALESCE(SUM(TX_FRAUD), 0) AS BIGINT) AS nb_fraud,
       CAST(SUM(TX_FRAUD) AS DOUBLE) / CAST(COUNT(TX_FRAUD) AS DOUBLE) AS fraud_rate
FROM labelled
"""

# --------------------------------------------------------------- ordering

_CHRONO = """
SELECT TRANSACTION_ID,
       row_number() OVER (ORDER BY TX_DATETIME NULLS FIRST, CUSTOMER_ID NULLS FIRST, TERMINAL_ID NULLS FIRST,
                          TX_AMOUNT NULLS FIRST, TRANSACTION_ID NULLS FIRST) - 1 AS CHRONO_ID
FROM tx
"""

SQL["chronological_ids"] = f"WITH {TX} {_CHRONO}"
SQL["chronological_ids_bulk"] = f"WITH {TXB} {_CHRONO}"

SQL["tx_time_offsets"] = f"""
WITH {TX},
o AS (
  SELECT TRANSACTION_ID,
         CAST(floor(epoch(TX_DATETIME)) - epoch(TIMESTAMP '2024-01-01 00:00:00') AS BIGINT) AS TX_TIME_SECONDS,
         TX_AMOUNT
  FROM tx
)
SELECT TRANSACTION_ID, TX_TIME_SECONDS,
       CAST(floor(TX_TIME_SECONDS / 86400.0) AS INTEGER) AS TX_TIME_DAYS,
       CAST(((TX_TIME_SECONDS % 86400) + 86400) % 86400 AS INTEGER) AS TX_SECOND_OF_DAY,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(TX_TIME_SECONDS) AS TX_DATETIME_SECONDS,
       round_even(TX_AMOUNT, 2) AS TX_AMOUNT
FROM o
WHERE ((TX_TIME_SECONDS % 86400) + 86400) % 86400 > 0
"""
