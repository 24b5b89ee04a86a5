"""Fraud labelling.

Scenario 1  amount strictly above a threshold (220).
Scenario 2  k=2 terminals compromised per start day d; every transaction at
            such a terminal on days d <= day < d + 28 is fraud.
Scenario 3  k=3 customers compromised per start day d; of the transactions
            of those customers on days d <= day < d + 14 (pooled over the
            three), floor(n / 3) chosen by hash order are fraud and their
            amount is multiplied by 5 - once per start day that chose them.

A later scenario overrides an earlier one's label (3 > 2 > 1); scenario 1
looks at the amount before any inflation.  Start days run over
[0, max(TX_TIME_DAYS)), the last day starting nothing.

Compromise intervals are expanded to their (entity, day) cells - at most
k x length x days rows, independent of the transaction volume.  That product
is checked against MAX_BROADCAST_CELLS: within it the cells are shipped to the
transactions, which are never shuffled; beyond it Spark joins by key.  The
share of scenario 3 becomes one cut-off hash per start day, evaluated on each
row by itself, so transaction ids may repeat or be NULL: a row is hashed by id,
second and terminal, then by its whole numbers (those and customer and cents), then by
all its columns.  Of rows equal in everything that lie across the share, as many
copies are drawn as the share lacks; only such copies are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paylake.functions.time import is_whole_cents, to_minor_units
from paylake.operators.sampling import frozen, sample_k_of_kinds, sample_k_per_seed, seed_hash, share_cut

# Fixed values of the three fraud scenarios.
AMOUNT_THRESHOLD = 220.0
TERMINALS_PER_DAY = 2
TERMINAL_DAYS = 28
CUSTOMERS_PER_DAY = 3
CUSTOMER_DAYS = 14
CUSTOMER_SHARE_DIVISOR = 3
INFLATION = 5.0

_DRAWN = "array<struct<start_day int, cut string, copies bigint, h string>>"
MAX_BROADCAST_CELLS = 2_000_000  # rows of under 50 bytes: 100 MB at most
COPIES_CHUNK = 4096  # copies of one row written out at a time


def n_start_days(tx: DataFrame, day: str = "TX_TIME_DAYS") -> int:
    """max(day): start days are [0, max).  Runs one aggregate over the day
    column, since the number bounds what may be broadcast."""
    return max(0, tx.agg(F.max(day)).first()[0] or 0)


def threshold_hits(tx: DataFrame, threshold: float = AMOUNT_THRESHOLD) -> Column:
    return F.coalesce(F.col("TX_AMOUNT") > F.lit(threshold), F.lit(False))


def compromised_terminals(terminals: DataFrame, n_days: int, k: int = TERMINALS_PER_DAY) -> DataFrame:
    """(start_day, TERMINAL_ID), k per start day."""
    return sample_k_per_seed(terminals, "TERMINAL_ID", n_days, k)


def compromised_customers(customers: DataFrame, n_days: int, k: int = CUSTOMERS_PER_DAY) -> DataFrame:
    """(start_day, CUSTOMER_ID), k per start day."""
    return sample_k_per_seed(customers, "CUSTOMER_ID", n_days, k)


def _ship(cells: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast where a proven bound of the rows allows it."""
    return F.broadcast(cells) if max_rows is not None and max_rows <= MAX_BROADCAST_CELLS else cells


def _times(max_rows: int | None, length: int) -> int | None:
    return None if max_rows is None else max_rows * length


def _cells(compromises: DataFrame, key: str, length: int) -> DataFrame:
    """(start_day, key) -> (start_day, key, TX_TIME_DAYS) for the covered days."""
    return compromises.select(
        "start_day", key,
        F.explode(F.sequence(F.col("start_day"), F.col("start_day") + F.lit(length - 1))).alias("TX_TIME_DAYS"))


def terminal_cells(compromises: DataFrame, length: int = TERMINAL_DAYS) -> DataFrame:
    """Distinct (TERMINAL_ID, TX_TIME_DAYS) cells covered by a compromise."""
    return _cells(compromises, "TERMINAL_ID", length).select("TERMINAL_ID", "TX_TIME_DAYS").distinct()


def terminal_hits(tx: DataFrame, compromises: DataFrame, length: int = TERMINAL_DAYS,
                  max_rows: int | None = None) -> DataFrame:
    """Transactions at a compromised terminal inside its window (semi join).
    ``max_rows`` is a proven bound of the compromises."""
    cells = _ship(terminal_cells(compromises, length), _times(max_rows, length))
    return tx.join(cells, ["TERMINAL_ID", "TX_TIME_DAYS"], "left_semi")


def _draw(start_day: Column) -> Column:
    """A row's place in the draw of a start day."""
    return seed_hash(start_day, F.col("TRANSACTION_ID"), F.col("TX_TIME_SECONDS"), F.col("TERMINAL_ID"))


def _tie(columns: list[str]) -> Column:
    """Orders rows of equal draw: by a hash of their whole numbers (id, customer, terminal, second,
    cents), then by one of all columns.  Rows equal in both are copies."""
    cents = F.when(is_whole_cents("TX_AMOUNT"), to_minor_units("TX_AMOUNT"))
    numbers = seed_hash(*[F.col(c) for c in ("TRANSACTION_ID", "CUSTOMER_ID", "TERMINAL_ID", "TX_TIME_SECONDS")], cents)
    return F.concat(numbers, F.md5(F.to_json(F.struct(*[F.col(f"`{c}`").cast("string") for c in columns]))))


def _among_copies(run: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with ``_sure`` hits and ``_open`` days, whose ``copies`` of all equal rows are chosen:
    equal rows are counted and written out again with a number each.  A start day chooses
    the copies of least (number + start day) mod n."""
    counted = run.groupBy("_tie").agg(
        F.first(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("_row"), F.first("_sure").alias("_sure"),
        F.first("_open").alias("_open"), F.count(F.lit(1)).alias("_n"))
    chunk = F.lit(COPIES_CHUNK).cast("bigint")
    chunks = (counted.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, chunk)))
              .repartition("_tie", "_from"))
    each = chunks.withColumn("_at", F.explode(F.sequence("_from", F.least(F.col("_from") + chunk, F.col("_n")) - 1)))

    def chosen(day: Column) -> Column:
        return F.pmod(F.col("_at") + day["start_day"], F.col("_n")) < day["copies"]

    return each.select(*[F.col("_row")[c].alias(c) for c in columns],
                       (F.col("_sure") + F.size(F.filter("_open", chosen))).alias("_hits3"))


def with_customer_hits(tx: DataFrame, compromises: DataFrame, length: int = CUSTOMER_DAYS,
                       divisor: int = CUSTOMER_SHARE_DIVISOR, max_rows: int | None = None) -> DataFrame:
    """Adds ``_hits3``: how many start days chose the row, floor(n / divisor) of a day's
    n rows each.  ``compromises`` are distinct; ``max_rows`` is a proven bound of them."""
    bound = _times(max_rows, length)
    cells = _cells(compromises, "CUSTOMER_ID", length)
    tie = _tie(tx.columns)
    pool = (tx.join(_ship(cells, bound), ["CUSTOMER_ID", "TX_TIME_DAYS"])
            .select("start_day", F.concat(_draw(F.col("start_day")), tie).alias("_h")))
    cuts = share_cut(pool, "start_day", "_h", divisor)
    by_cell = (cells.join(_ship(cuts, max_rows), "start_day").groupBy("CUSTOMER_ID", "TX_TIME_DAYS")
               .agg(F.sort_array(F.collect_list(F.struct("start_day", "cut", F.col("more").alias("copies")))).alias("_cuts")))  # at most `length` start days
    seen = Observation()
    by_cell = frozen(by_cell.observe(seen, F.count_if(F.exists("_cuts", lambda c: c["copies"] > 0)).alias("open")), "cell-cuts")
    none = F.array().cast(_DRAWN)
    hit = (tx.join(_ship(by_cell, bound), ["CUSTOMER_ID", "TX_TIME_DAYS"], "left")
           .withColumn("_tie", F.when(F.col("_cuts").isNotNull(), tie)))
    drawn = F.transform("_cuts", lambda c: F.struct(*[c[x].alias(x) for x in ("start_day", "cut", "copies")],
                                                    F.concat(_draw(c["start_day"]), F.col("_tie")).alias("h")))
    hit = hit.withColumn("_drawn", F.coalesce(drawn, none)).withColumns({
        "_sure": F.size(F.filter("_drawn", lambda c: c["h"] < c["cut"])),
        "_open": F.filter("_drawn", lambda c: (c["h"] == c["cut"]) & (c["copies"] > 0))})
    alone = hit.where(F.size("_open") == 0).select(*[F.col(f"`{c}`") for c in tx.columns], F.col("_sure").alias("_hits3"))
    if not seen.get["open"]:
        return alone
    return alone.unionByName(_among_copies(hit.where(F.size("_open") > 0), tx.columns))


def customer_hits(tx: DataFrame, compromises: DataFrame, length: int = CUSTOMER_DAYS,
                  divisor: int = CUSTOMER_SHARE_DIVISOR, max_rows: int | None = None) -> DataFrame:
    """(TRANSACTION_ID, hits) of every row that a start day chose."""
    hit = with_customer_hits(tx, compromises, length, divisor, max_rows)
    return hit.where("_hits3 > 0").select("TRANSACTION_ID", F.col("_hits3").cast("bigint").alias("hits"))


def inflate(amount: Column, hits: Column, factor: float = INFLATION) -> Column:
    """amount multiplied by ``factor`` once per hit, in sequence."""
    return F.aggregate(F.array_repeat(F.lit(float(factor)), hits.cast("int")), amount, lambda acc, f: acc * f)


def _compromises(tx: DataFrame, terminals: DataFrame, customers: DataFrame) -> tuple[DataFrame, int]:
    """(kind, start_day, id) of the terminals and customers compromised per start day, written
    once, and the number of its rows."""
    days = tx.select(F.greatest(F.max("TX_TIME_DAYS"), F.lit(0))).scalar()
    both = sample_k_of_kinds({"t": (terminals, "TERMINAL_ID", TERMINALS_PER_DAY),
                              "c": (customers, "CUSTOMER_ID", CUSTOMERS_PER_DAY)}, days)
    seen = Observation()
    written = frozen(both.observe(seen, F.count(F.lit(1)).alias("rows")), "compromises")
    return written, seen.get["rows"]


def label_frauds(tx: DataFrame, terminals: DataFrame, customers: DataFrame,
                 threshold: float = AMOUNT_THRESHOLD) -> DataFrame:
    """Transactions -> TX_AMOUNT (inflated), TX_FRAUD, TX_FRAUD_SCENARIO, and hit flags.

    Adds ``_hit1``/``_hit2``/``_hits3`` helper columns (dropped by
    :func:`labelled`), used by :func:`scenario_increment_counts`.
    """
    chosen, rows = _compromises(tx, terminals, customers)
    by_terminal = chosen.where("kind = 't'").select("start_day", F.col("id").alias("TERMINAL_ID"))
    by_customer = chosen.where("kind = 'c'").select("start_day", F.col("id").alias("CUSTOMER_ID"))
    cells = terminal_cells(by_terminal).withColumn("_hit2", F.lit(True))
    base = tx.drop("TX_FRAUD", "TX_FRAUD_SCENARIO").withColumn("_hit1", threshold_hits(tx, threshold))
    hit = with_customer_hits(base, by_customer, max_rows=rows)
    # cells are distinct, so the (terminal, day) join never multiplies rows
    j = (hit.join(_ship(cells, rows * TERMINAL_DAYS), ["TERMINAL_ID", "TX_TIME_DAYS"], "left")
         .withColumn("_hit2", F.coalesce(F.col("_hit2"), F.lit(False))))
    hit3 = F.col("_hits3") > 0
    scenario = (F.when(hit3, 3).when(F.col("_hit2"), 2).when(F.col("_hit1"), 1).otherwise(0))
    return j.withColumns({
        "TX_AMOUNT": inflate(F.col("TX_AMOUNT"), F.col("_hits3")),
        "TX_FRAUD": (scenario > 0).cast("int"),
        "TX_FRAUD_SCENARIO": scenario.cast("int"),
    })


def labelled(tx: DataFrame, terminals: DataFrame, customers: DataFrame,
             threshold: float = AMOUNT_THRESHOLD) -> DataFrame:
    """The labelled transaction table, in the input's column order."""
    return label_frauds(tx, terminals, customers, threshold).select(*tx.columns)


def scenario_increment_counts(flagged: DataFrame) -> DataFrame:
    """Frauds added by each rule in order: amount, then newly by terminals, then newly by customers."""
    h1, h2, h3 = F.col("_hit1"), F.col("_hit2"), F.col("_hits3") > 0
    return flagged.agg(
        F.count_if(h1).alias("added_by_amount"),
        F.count_if(h2 & ~h1).alias("added_by_terminal"),
        F.count_if(h3 & ~h1 & ~h2).alias("added_by_customer"),
        F.count_if(h1 | h2 | h3).alias("frauds"),
    )
