"""Chronological order, dense ids and top-k.

``number_rows`` numbers all rows 0..n-1 in a total order by one range shuffle
and a write that freezes the places.

``dense_index`` numbers rows without a write, also within groups, when the
order's leading part is given as integer *levels* that split it evenly (as
``sampling.hash_rank`` does):

* counts per level prefix, rolled up from one aggregate -> per-parent prefix
  sums, composed top-down;
* one window per leaf group numbers its rows;
* position = composed offset of the leaf + row number - 1.

A prefix-sum group holds the distinct values of a level below one parent, a
leaf the rows equal in all levels: callers choose levels that bound both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.config import scratch_dir, shuffle_partitions
from paylake.functions.time import (day_index, round_half_even, second_of_day, seconds_since,
                                    timestamp_from_offset)

_MIN_LONG = -(2 ** 63)


def _level(c: Column) -> Column:
    """Non-null long level; NULL maps below every value (NULLS FIRST)."""
    return F.coalesce(c.cast("bigint"), F.lit(_MIN_LONG))


def dense_index(df: DataFrame, levels: dict[str, Column], order: list[Column], out: str = "row_index",
                group: list[str] | None = None, group_size: str | None = None) -> DataFrame:
    """Adds ``out``: 0-based position in the order (levels..., order...),
    counted within ``group`` when given (and the group's size as
    ``group_size`` when named)."""
    # structs compare equal on null fields, so rows with a null group stay
    wrapped = {f"_grp{i}": F.struct(F.col(c).alias("v")) for i, c in enumerate(group or [])}
    group = list(wrapped)
    names = list(levels)
    keyed = df.withColumns({**wrapped, **{n: _level(c) for n, c in levels.items()}})
    # one pass over the rows at the finest level; coarser counts roll up from it
    finest = keyed.groupBy(*group, *names).agg(F.count(F.lit(1)).alias("_n"))
    composed = None
    for i, name in enumerate(names):
        parents = group + names[:i]
        counts = (finest if i == len(names) - 1 else
                  finest.groupBy(*parents, name).agg(F.sum("_n").alias("_n")))
        w = (Window.partitionBy(*parents) if parents else Window.partitionBy()).orderBy(name)
        extra = []
        if i == 0 and group_size:
            extra = [F.sum("_n").over(Window.partitionBy(*group) if group else Window.partitionBy())
                     .alias(group_size)]
        off = counts.select(*parents, name, *extra,
                            F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                       F.lit(0)).alias(f"_off{i}"))
        if composed is None:
            composed = off.withColumnRenamed(f"_off{i}", "_base")
        else:
            composed = (off.join(composed, parents, "inner")
                        .withColumn("_base", F.col("_base") + F.col(f"_off{i}")).drop(f"_off{i}"))
    keys = group + names
    w_leaf = Window.partitionBy(*keys).orderBy(*order)
    numbered = keyed.withColumn("_rn", F.row_number().over(w_leaf))
    return (numbered.join(composed, keys, "inner")
            .withColumn(out, F.col("_base") + F.col("_rn") - 1)
            .drop("_base", "_rn", *names, *group))


def _in_ranges(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Rows in ``n`` sorted ranges of ``order``, equal rows by their place in the input."""
    order = [*order, F.col("_place")]
    return (df.withColumn("_place", F.monotonically_increasing_id())
            .repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_place"))


def number_rows(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Adds ``out``: 0-based position in ``order``, by one range shuffle.

    Rows are range-partitioned on the whole order and, as the mutual order of rows equal in
    all of it is free, on their place in the input, so that a large run of equal rows
    is split too; each partition is sorted and its rows numbered.
    That is written to the shared scratch folder, which freezes partition and
    place against recomputation; partition sizes (a row per shuffle partition)
    then give every partition its first number.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "numbered")
    placed = _in_ranges(df, order, shuffle_partitions(spark)).withColumn("_at", F.monotonically_increasing_id())
    placed.write.parquet(path)
    # an id holds the partition above 33 bits of the place in it
    back = (spark.read.schema(placed.schema).parquet(path)
            .withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (back.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
              .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    return (back.join(F.broadcast(firsts), "_part")
            .withColumn(out, F.col("_base") + F.col("_at")).drop("_part", "_at", "_base"))


def chronological_ids(tx: DataFrame, out: str = "TRANSACTION_ID") -> DataFrame:
    """Dense 0-based ids in time order (ties: customer, terminal, amount, old id).

    The old id column is replaced; pass ``out`` to keep it.
    """
    order = [F.col(c).asc_nulls_first()
             for c in ("TX_DATETIME", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", "TRANSACTION_ID")]
    indexed = number_rows(tx, order, "_new_id")
    if out in tx.columns:
        indexed = indexed.drop(out)
    return indexed.withColumnRenamed("_new_id", out)


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First k rows by ``order`` (per-partition top-k, then a k-row merge)."""
    return df.orderBy(*order).limit(k)


def time_offsets(tx: DataFrame, origin: str, ts: str = "TX_DATETIME") -> DataFrame:
    """Second/day offsets from ``origin``, the second of day, the timestamp
    rebuilt from the offset, and the amount rounded half-even to cents."""
    secs = seconds_since(ts, origin)
    return tx.select(
        "TRANSACTION_ID",
        secs.alias("TX_TIME_SECONDS"),
        day_index(secs).alias("TX_TIME_DAYS"),
        second_of_day(secs).alias("TX_SECOND_OF_DAY"),
        timestamp_from_offset(secs, origin).alias("TX_DATETIME_SECONDS"),
        round_half_even("TX_AMOUNT", 2).alias("TX_AMOUNT"),
    )


def within_day(offsets: DataFrame, col: str = "TX_SECOND_OF_DAY") -> DataFrame:
    """Keep events strictly inside their day (the second of day is below 86400 by itself)."""
    return offsets.where(F.col(col) > 0)
