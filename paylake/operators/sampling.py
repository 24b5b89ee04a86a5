"""Seeded, reproducible sampling by hash (M1, M2).

Seeded random draws are replaced by digits of ``md5``: deterministic,
identical in any SQL engine, and computable in parallel.

``sample_k_per_seed``  k entities per seed (day): entities get dense ranks in
                       hash order once, every seed draws k distinct ranks, and
                       the two are joined.  Linear in entities plus seeds x k.
``hash_rank``          exact 0-based rank by hash inside arbitrarily large
                       groups: two 16-bit levels of the hash split every group
                       into near-equal sub-buckets whose counts are
                       prefix-summed (see ``ordering.dense_index``).
``share_cut``          per group, the hash below which a share of its rows
                       lies, and how many of the rows at it the share lacks;
                       equal hashes are counted, never ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.config import scratch_dir
from paylake.operators.ordering import dense_index


def seed_hash(*parts: Column) -> Column:
    """md5 of the parts joined by ``:`` as 32 hex characters (null part: empty)."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(":", *texts))


def draw_ranks(seed: Column, n: Column, k: int) -> Column:
    """Array of min(k, n) distinct ranks in [0, n), drawn by Floyd's method:
    step i draws from [0, n - k + i] and takes the end itself on a repeat."""
    n = n.cast("bigint")

    def step(chosen: Column, i: Column) -> Column:
        top = n - F.lit(k) + i
        number = F.conv(F.substring(seed_hash(seed, i), 1, 15), 16, 10).cast("bigint")
        r = F.pmod(number, F.greatest(top + 1, F.lit(1).cast("bigint")))
        return F.concat(chosen, F.array(F.when(F.array_contains(chosen, r), top).otherwise(r)))

    none = F.array().cast("array<bigint>")
    drawn = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), none, step)
    every = F.sequence(F.lit(0).cast("bigint"), F.greatest(n - 1, F.lit(0).cast("bigint")))
    return F.when(n >= k, drawn).when(n > 0, every).otherwise(none)


def sample_k_of_kinds(kinds: dict[str, tuple[DataFrame, str, int]], n_seeds: int | Column,
                      seed_col: str = "start_day") -> DataFrame:
    """For each kind ``name -> (entities, key, k)`` and each seed in [0, n_seeds): k distinct
    entities (all of them if fewer).  All kinds are ranked in one pass.

    Repeated and null keys of the entities count once and not at all.  ``n_seeds`` may be a
    scalar subquery.  Output (kind, seed, id), at most n_seeds x k rows of a kind.
    """
    ids = draws = None
    for kind, (entities, key, k) in kinds.items():
        spark = entities.sparkSession
        own = entities.select(F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("id")).where("id is not null").distinct()
        if isinstance(n_seeds, Column):
            last = n_seeds.cast("bigint") - 1
            seeds = spark.range(1).select(F.explode(F.when(last >= 0, F.sequence(F.lit(0).cast("bigint"), last))).alias("id"))
        else:
            seeds = spark.range(n_seeds)
        n = entities.select(F.count_distinct(F.col(key))).scalar()
        drawn = (seeds.select(F.lit(kind).alias("kind"), F.col("id").cast("int").alias(seed_col), n.alias("_n"))
                 .select("kind", seed_col, F.explode(draw_ranks(F.col(seed_col), F.col("_n"), k)).alias("_rank")))
        ids = own if ids is None else ids.unionAll(own)
        draws = drawn if draws is None else draws.unionAll(drawn)
    ranked = hash_rank(ids, ["kind"], seed_hash(F.lit("entity"), F.col("id")), "id").select("kind", "id", "_rank")
    return draws.join(ranked, ["kind", "_rank"]).select("kind", seed_col, "id")


def sample_k_per_seed(entities: DataFrame, key: str, n_seeds: int, k: int,
                      seed_col: str = "start_day") -> DataFrame:
    """The sample of one kind: (seed, key)."""
    return sample_k_of_kinds({"": (entities, key, k)}, n_seeds, seed_col).select(
        seed_col, F.col("id").cast(entities.schema[key].dataType).alias(key))


def hash_rank(df: DataFrame, group: list[str], h: Column, tie: str) -> DataFrame:
    """Adds ``_rank`` (0-based, by (h, tie) within ``group``) and ``_group_n``.

    Two 16-bit levels of the hash (hex digits 1-4 and 5-8) split every group:
    each prefix-sum table holds at most 65,536 rows per parent and a leaf
    holds about n / 2^32 rows, so no task grows with the group.
    """
    keyed = df.withColumn("_h", h)
    levels = {"_h1": F.conv(F.substring("_h", 1, 4), 16, 10).cast("bigint"),
              "_h2": F.conv(F.substring("_h", 5, 4), 16, 10).cast("bigint")}
    ranked = dense_index(keyed, levels, [F.col("_h"), F.col(tie)], "_rank", group=group, group_size="_group_n")
    return ranked.drop("_h")


def share_cut(df: DataFrame, group: str, h: str, divisor: int) -> DataFrame:
    """(group, cut, more): of a group's n rows, floor(n / divisor) have a hash below
    ``cut`` or are ``more`` of the rows at it.  Rows of equal hash fall on the same
    side; such a run that would exceed the share stays at the cut, and ``more`` is 0
    when hashes are distinct.

    Rows are counted per hash before any shuffle; a first level of four hex
    digits finds the part of the group in which the cut lies, so a window holds
    65,536 counts or a 65,536th of the group's hashes.
    """
    sizes = df.groupBy(group, h).agg(F.count(F.lit(1)).alias("_n")).withColumn("_part", F.substring(h, 1, 4))
    w = Window.partitionBy(group)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (sizes.groupBy(group, "_part").agg(F.sum("_n").alias("_n"))
             .select(group, "_part", "_n", (F.sum("_n").over(upto.orderBy("_part")) - F.col("_n")).alias("_before"),
                     F.floor(F.sum("_n").over(w) / F.lit(divisor)).alias("_share"))
             .where("_before <= _share AND _share < _before + _n").drop("_n"))
    near = (sizes.join(parts, [group, "_part"])
            .withColumn("_upto", F.col("_before") + F.sum("_n").over(upto.orderBy(h))))
    return near.where("_upto - _n <= _share AND _share < _upto").select(
        group, F.col(h).alias("cut"), (F.col("_share") - F.col("_upto") + F.col("_n")).alias("more"))


def frozen(df: DataFrame, name: str) -> DataFrame:
    """A small table written to the shared scratch folder and read back: plans stay small."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
