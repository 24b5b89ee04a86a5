"""Exact sums over trailing time frames, split into bounded groups.

A ``Window.partitionBy(key)`` with a sliding RANGE frame re-aggregates the frame
for every row and puts a hot key in one task.  Here time is cut into buckets of
twice the longest look-back L.  A row belongs to its bucket; rows of a bucket's
last L are copied into the next one as history, without their payload.  Per
(key, bucket), running sums with frames (UNBOUNDED PRECEDING, t + o) -
incremental, linear in the group - are taken for every frame edge o, and a frame
[t + lo, t + hi] is C(t + hi) - C(t + lo - 1).  Both running sums start at the
same history row, so the difference is exact for integer measures.
Floating-point measures are summed in the same order on both sides, so a frame
without such values gives exactly 0.

``with_frames``  rows carry their payload through the (key, bucket) window: one
                 shuffle, no join back.  Groups of more than ``GROUP_ROWS`` rows,
                 which ``hot_groups`` finds by counting, take the other way:
``frame_sums``   rows are pre-aggregated to one point per (key, second), map-side
                 combined, so a group holds at most the seconds of its bucket
                 and history, whatever the skew; sums are joined back to the rows
                 on (key, second), a join that AQE splits where it is skewed.

Rows with a NULL time form one peer group per key (as Spark's RANGE frames
treat them): every frame of such a row covers exactly the NULL-time rows of its
key.  Keys are carried as (``_k`` = coalesce(key, 0), ``_kn`` = key is null) so
that a NULL key is its own group and the joins are plain equi-joins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Frames = dict[str, tuple[int, int]]

GROUP_ROWS = 4_000_000  # rows of a (key, bucket) group that pass through one task with their payload
PACK = 1 << 31          # two counts of a group share a number
MAX_HOT = 100_000       # hot groups listed by the driver; more stay a table
KEY_COLS = ["_k", "_kn"]
JOIN_COLS = ["_k", "_kn", "_tn", "_t"]
DAY = 86400


def key_columns(key: str, t: str) -> list[Column]:
    """Derived non-null join columns for a (key, time) pair."""
    return [
        F.coalesce(F.col(key).cast("bigint"), F.lit(0).cast("bigint")).alias("_k"),
        F.col(key).isNull().alias("_kn"),
        F.col(t).isNull().alias("_tn"),
        F.coalesce(F.col(t).cast("bigint"), F.lit(0).cast("bigint")).alias("_t"),
    ]


def _reach(frames: Frames) -> int:
    """Longest look-back in seconds (lo - 1 of the widest frame)."""
    return max(1 - lo for lo, _ in frames.values())


def bucket_width(frames: Frames) -> int:
    """Whole days covering twice the longest look-back, so half of the rows are copied."""
    return 2 * max(1, math.ceil(_reach(frames) / DAY)) * DAY


def _checked_width(frames: Frames, bucket_seconds: int | None) -> int:
    for lo, hi in frames.values():
        if lo > hi or hi > 0:
            raise ValueError("frames must satisfy lo <= hi <= 0")
    width = bucket_seconds or bucket_width(frames)
    if width < _reach(frames):
        raise ValueError("bucket narrower than the longest look-back")
    return width


def _bucket(second: Column, width: int) -> Column:
    return F.floor(second / F.lit(width)).cast("bigint")


def _spread(keyed: DataFrame, width: int, frames: Frames) -> DataFrame:
    """Adds ``_b`` and ``_hist``: every row in its own bucket, and as history in the next
    one if a frame can reach it from there.  NULL times have bucket NULL and no history."""
    late = F.pmod(F.col("_t"), F.lit(width)) >= width - _reach(frames)
    copies = F.when(~F.col("_tn") & late, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    b = _bucket(F.col("_t"), width)
    return (keyed.withColumn("_hist", F.explode(copies))
            .withColumn("_b", F.when(~F.col("_tn"), b + F.col("_hist").cast("bigint"))))


def hot_groups(df: DataFrame, t: str, families: dict[str, Frames], bucket_seconds: int | None = None,
               group_rows: int | None = None) -> dict[str, DataFrame | None]:
    """Per key column the (key, bucket) groups that may hold more than ``group_rows`` rows, None
    if there are none.  One pass over keys and times counts the buckets of all families,
    combined map-side; a bucket of over half the bound counts with the next one, whose history it is.
    """
    return survey_groups(df, t, families, None, bucket_seconds, group_rows)[0]


def survey_groups(df: DataFrame, t: str, families: dict[str, Frames], size: Column | None, bucket_seconds: int | None = None,
                  group_rows: int | None = None) -> tuple[dict[str, DataFrame | None], tuple[float | None, float | None]]:
    """:func:`hot_groups` and the least and greatest value of ``size`` (nulls aside), in the same pass."""
    limit = (GROUP_ROWS if group_rows is None else group_rows) // 2
    none = F.lit(None).cast("bigint")
    cells = []
    for key, frames in families.items():
        k, kn, tn, second = key_columns(key, t)
        b = F.when(~tn, _bucket(second, _checked_width(frames, bucket_seconds)))
        cells.append(F.struct(F.lit(key).alias("_family"), k, kn, b.alias("_b"), F.lit(None).cast("double").alias("_size")))
    cells = F.array(*cells)
    if size is not None:  # one more group, of no family, holds the extremes: a row per task after the map-side combine
        own = F.struct(F.lit("").alias("_family"), F.lit(0).cast("bigint").alias("_k"), F.lit(False).alias("_kn"),
                       none.alias("_b"), size.cast("double").alias("_size"))
        cells = F.when(size.isNull(), cells).otherwise(F.array_append(cells, own))
    counted = (df.select(F.explode(cells).alias("_c")).select("_c.*").groupBy("_family", *KEY_COLS, "_b")
               .agg(F.count(F.lit(1)).alias("_n"), F.min("_size").alias("_low"), F.max("_size").alias("_high")))
    counted = counted.where((F.col("_family") == "") | (F.col("_n") > limit))
    both = F.when(F.col("_b").isNull(), F.array(F.col("_b"))).otherwise(F.array(F.col("_b"), F.col("_b") + 1))
    hot = counted.select("_family", *KEY_COLS, F.explode(both).alias("_b"), "_low", "_high").distinct()
    some = hot.limit(MAX_HOT + 2).collect()  # at most four times as many as there are rows / group_rows
    whole = len(some) <= MAX_HOT + 1
    extremes = [r for r in (some if whole else hot.where(F.col("_family") == "").collect()) if r["_family"] == ""]
    found = set(families)
    if whole:
        listed = [r[:-2] for r in some if r["_family"] != ""]
        found = {r[0] for r in listed}
        hot = df.sparkSession.createDataFrame(listed, hot.drop("_low", "_high").schema)
    else:
        hot = hot.drop("_low", "_high")
    groups = {key: hot.where(F.col("_family") == key).drop("_family") if key in found else None for key in families}
    return groups, (extremes[0]["_low"], extremes[0]["_high"]) if extremes else (None, None)


def _packed(counts: list[str], measures: dict[str, Column]) -> tuple[dict[str, Column], dict[str, tuple[str, int]]]:
    """Measures with the 0/1 ones among them two to a number, and where each of those is: of a
    group of under 2^31 rows both sums fit."""
    out = {m: c for m, c in measures.items() if m not in counts}
    place = {}
    for i in range(0, len(counts), 2):
        pair = counts[i:i + 2]
        out["_".join(pair)] = sum((measures[m] * F.lit(PACK ** j) for j, m in enumerate(pair)), F.lit(0).cast("bigint"))
        place.update({m: ("_".join(pair), j) for j, m in enumerate(pair)})
    return out, place


def with_frames(df: DataFrame, key: str, t: str, inputs: list[str], measures: dict[str, Column], frames: Frames,
                bucket_seconds: int | None = None, hot: DataFrame | None = None, counts: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``{frame}__{measure}``: the sum of each measure over the rows of the same key with
    time in [t + lo, t + hi], for every frame ``name -> (lo, hi)``.

    A measure is a non-null, finite row expression over the columns ``inputs``; those named in
    ``counts`` are 0 or 1.  ``hot`` holds the groups that are to be pre-aggregated (see
    :func:`hot_groups`).
    """
    width = _checked_width(frames, bucket_seconds)
    columns = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.select(*columns, *key_columns(key, t))
    spread = _spread(keyed, width, frames)
    if hot is not None:
        spread = _mark(spread, hot).where(~F.col("_hot")).drop("_hot")
    kept = [F.col(f"`{c}`") if c in inputs else F.when(~F.col("_hist"), F.col(f"`{c}`")).alias(c) for c in df.columns]
    dealt = spread.select(*kept, *JOIN_COLS, "_b", "_hist").repartition(*KEY_COLS, "_b")
    # measures are taken after the shuffle, which moves their inputs only
    packed, place = _packed(list(counts), measures)
    dealt = dealt.withColumns({f"_m_{m}": c for m, c in packed.items()})
    base = Window.partitionBy(*KEY_COLS, "_b").orderBy("_t")

    def c(o: int, m: str) -> Column:
        return F.coalesce(F.sum(f"_m_{m}").over(base.rangeBetween(Window.unboundedPreceding, o)), F.lit(0))

    def frame(lo: int, hi: int, m: str) -> Column:
        own = F.sum(f"_m_{m}").over(base.rangeBetween(Window.unboundedPreceding, 0))  # times of a NULL-time group are all 0
        return F.when(F.col("_tn"), own).otherwise(c(hi, m) - c(lo - 1, m))

    sums = [frame(lo, hi, m).alias(f"{name}__{m}") for name, (lo, hi) in frames.items() for m in packed]
    out = dealt.select(*columns, "_hist", *sums).where(~F.col("_hist"))

    def unpacked(name: str, m: str) -> Column:
        pair, j = place.get(m, (m, None))
        whole = F.col(f"{name}__{pair}")
        return whole if j is None else F.shiftright(whole, 31) if j else whole.bitwiseAND(F.lit(PACK - 1))

    out = out.select(*columns, *[unpacked(name, m).alias(f"{name}__{m}") for name in frames for m in measures])
    if hot is None:
        return out
    return out.unionByName(_hot_rows(keyed, key, t, measures, frames, width, hot))


def _mark(spread: DataFrame, hot: DataFrame) -> DataFrame:
    """Adds ``_hot``: whether the row's group is one of ``hot``, which Spark broadcasts where its size allows."""
    groups = hot.select(*[F.col(c).alias(f"_h{c}") for c in (*KEY_COLS, "_b")])
    same = [F.col(c) == F.col(f"_h{c}") for c in KEY_COLS] + [F.col("_b").eqNullSafe(F.col("_h_b"))]
    return spread.join(groups, same, "left").withColumn("_hot", F.col("_h_k").isNotNull()).drop("_h_k", "_h_kn", "_h_b")


def _hot_rows(keyed: DataFrame, key: str, t: str, measures: dict[str, Column], frames: Frames, width: int,
              hot: DataFrame) -> DataFrame:
    """The rows of hot groups with their frame sums, from points per (key, second)."""
    inside = _mark(_spread(keyed, width, frames), hot).where("_hot").drop("_hot")
    sums = frame_sums(inside, key, t, {m: F.sum(c) for m, c in measures.items()}, frames, width, spread=True)
    own = inside.where(~F.col("_hist")).drop("_b", "_hist")
    return own.join(sums, JOIN_COLS).drop(*JOIN_COLS)


def frame_sums(df: DataFrame, key: str, t: str, measures: dict[str, Column], frames: Frames,
               bucket_seconds: int | None = None, spread: bool = False) -> DataFrame:
    """Per distinct (key, t): sum of each measure over the points of the same
    key with time in [t + lo, t + hi] for every frame ``name -> (lo, hi)``
    (offsets in seconds, lo <= hi <= 0).

    A measure is an aggregate expression over the rows of one (key, second),
    non-null and finite.  Returns JOIN_COLS plus ``{frame}__{measure}``.  With
    ``spread`` the rows hold their buckets and history already.
    """
    names = list(measures)
    width = _checked_width(frames, bucket_seconds)

    # 1. one point per (key, second); NULL-time rows collapse to one point per key.
    if spread:
        points = df.groupBy(*JOIN_COLS, "_b", "_hist").agg(*[measures[m].alias(m) for m in names])
    else:
        points = (df.select(*key_columns(key, t), "*").groupBy(*JOIN_COLS)
                  .agg(*[measures[m].alias(m) for m in names]))

    # 2. owned copy in its bucket, history copy in the next one; a NULL-time
    #    point stays alone in a bucket of its own.
    dealt = points if spread else _spread(points, width, frames)

    # 3. incremental running sums per (key, bucket) for every frame edge.
    offsets = sorted({hi for _, hi in frames.values()} | {lo - 1 for lo, _ in frames.values()})
    base = Window.partitionBy(*KEY_COLS, "_b").orderBy("_t")
    running = {(o, m): F.sum(m).over(base.rangeBetween(Window.unboundedPreceding, o)) for o in offsets for m in names}

    def c(o: int, m: str) -> Column:
        return F.coalesce(running[(o, m)], F.lit(0))

    # 4. frame = C(t + hi) - C(t + lo - 1), kept for owned points only; a
    #    NULL-time point's frames are the point itself.
    def frame(lo: int, hi: int, m: str) -> Column:
        return F.when(F.col("_tn"), F.col(m)).otherwise(c(hi, m) - c(lo - 1, m))

    return (dealt.select(*JOIN_COLS, "_hist",
                          *[frame(lo, hi, m).alias(f"{name}__{m}")
                            for name, (lo, hi) in frames.items() for m in names])
            .where(~F.col("_hist")).drop("_hist"))
