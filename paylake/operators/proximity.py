"""Customers and the terminals within a radius of them.

Both sides are cut by one quadtree over a grid of cells of width ~r.  A cell of
more than ``CELL_POINTS`` points of a side is cut in four, and so on; points that
lie too close together to be told apart by cells are dealt into parts by their
id.  The crowded cells, counted per finest cell with map-side combine, are
written once; where there are none, the plan is a plain grid join.

A terminal belongs to one leaf of the terminals' tree.  A customer descends that
tree from the 3x3 cells around it, into crowded cells only and only into
children that its circle touches, and joins the leaves it reaches.  Customers of
a crowded cell belong to a leaf of their own tree, and terminals are copied to
the customer leaves that touch their circle, so a join key holds a bounded
number of customers and of terminals.  Each pair meets under one key, followed by
the exact test ``distance < r`` (strict, as the reference).

The pairs of a leaf are counted before they meet, and the tasks are as many as the
pairs call for; a leaf of too many is dealt into parts of its customers.

Lists of ids are built without a row per pair, and where they are built they stay: a
customer whose id is its own and who has no crowded cell around lies in one cell, to which
the terminals of the 3x3 cells are copied, so one task lists all its terminals in order and no
list is shuffled.  The others have a list per leaf, which are shuffled by id and joined.
A cell of many pairs is cut in 4, 16, .., and terminals go to the parts that their circle touches.
Tasks give the lists of neighbours one after the other: these differ in few ids, so that a
file's compression leaves little of them.

Counting stops at cells wholly within the circle and takes their number of
terminals; pairs are expanded only in leaves that the circle cuts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.config import shuffle_partitions
from paylake.functions.geo import distance
from paylake.operators.sampling import frozen

# Cells are a hair wider than r so float rounding in x / r can never put two
# points closer than r into cells two apart.
_CELL_SLACK = 1.0 + 1e-9
_EDGE = 1e-6            # part of r by which boxes count as larger, and inner ones as smaller
LEVELS = 12             # a finest cell is r / 2^LEVELS wide
CELL_POINTS = 50_000    # points of a cell that one task joins
COUNT_POINTS = 256      # points of a cell that a count may test one by one
TASK_PAIRS = 16_000_000  # pairs that a task tests, on average
FEW_PAIRS = 1_000_000    # no task is started for fewer
TASK_ROWS = 500_000      # rows of both sides that a task holds, on average
CHUNK = 1 << 16          # pairs tested at a time for lists
CUT_LEVELS = 4           # a cell is cut in 4^CUT_LEVELS at most
_ANY = -1               # level of the customer leaf that stands for all uncrowded cells


def _placed(cols, r: float) -> Column:
    """Whether both coordinates are numbers that cells can tell apart; not so for NULL, NaN and infinity."""
    most = F.lit(float(r) * _CELL_SLACK / (1 << LEVELS) * 2.0 ** 62)
    x, y = (F.coalesce(F.abs(F.col(c).cast("double")) < most, F.lit(False)) for c in cols)
    return x & y


def _points(df: DataFrame, cols, r: float, prefix: str, *more: Column) -> DataFrame:
    """(id, x, y, fx, fy, more): points with both coordinates and their finest cell."""
    key, x, y = cols
    width = float(r) * _CELL_SLACK / (1 << LEVELS)
    # the shifts that give coarser cells keep cells nested exactly
    out = df.where(_placed(cols[1:], r)).select(F.col(key).alias(f"{prefix}k"), F.col(x).cast("double").alias(f"{prefix}x"), F.col(y).cast("double").alias(f"{prefix}y"), *more)
    return out.select("*", *[F.floor(F.col(f"{prefix}{c}") / F.lit(width)).cast("bigint").alias(f"{prefix}f{c}") for c in "xy"])


def _at(finest: str, level) -> Column:
    """A finest cell's index at a coarser level."""
    return F.expr(f"shiftright({finest}, {LEVELS} - ({level}))")


def _around(i, j) -> Column:
    """The 3x3 cells around a cell, as an array of (_x, _y)."""
    i, j = (F.col(v) if isinstance(v, str) else v for v in (i, j))
    return F.array(*[F.struct((i + a).alias("_x"), (j + b).alias("_y")) for a in (-1, 0, 1) for b in (-1, 0, 1)])


def _crowds(sides: dict[str, tuple[DataFrame, str, int]]) -> tuple[DataFrame | None, dict[str, int]]:
    """(side, level, ix, iy, n) of the cells of more than a side's bound, written once, and per side
    the number of levels at which there are some; no table if there are none."""
    every, bound = None, F.lit(0)
    for side, (points, prefix, most) in sides.items():
        own = points.select(F.lit(side).alias("side"), F.col(f"{prefix}fx").alias("fx"), F.col(f"{prefix}fy").alias("fy"))
        every = own if every is None else every.unionAll(own)
        bound = F.when(F.col("side") == side, F.lit(most)).otherwise(bound)
    top = [_at("fx", 0).alias("ix"), _at("fy", 0).alias("iy")]
    widest = every.groupBy("side", *top).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound).drop("n")
    if widest.isEmpty():
        return None, dict.fromkeys(sides, 0)
    finest = every.groupBy("side", "fx", "fy").agg(F.count(F.lit(1)).alias("n")).select("side", "fx", "fy", *top, "n")
    cells = (finest.join(widest, ["side", "ix", "iy"], "left_semi").withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
             .groupBy("side", "level", _at("fx", "level").alias("ix"), _at("fy", "level").alias("iy")).agg(F.sum("n").alias("n")))
    seen = Observation()
    depth = [F.coalesce(F.max(F.when(F.col("side") == side, F.col("level"))) + 1, F.lit(0)).alias(side) for side in sides]
    written = frozen(cells.where(F.col("n") > bound).observe(seen, *depth), "crowded-cells")
    return written, {side: int(seen.get[side]) for side in sides}


def _level(crowd: DataFrame, side: str, level: int) -> DataFrame:
    return crowd.where((F.col("side") == side) & (F.col("level") == level)).select(F.col("ix").alias("_cx"), F.col("iy").alias("_cy"), F.col("n").alias("_cn"))


def _leaf(points: DataFrame, prefix: str, name: str, crowd: DataFrame | None, side: str, depth: int, most: int) -> DataFrame:
    """Adds the leaf that holds each point: {name}l (level), {name}i, {name}j, {name}p (part)."""
    out = points.withColumns({f"{name}l": F.lit(0), f"{name}p": F.lit(0).cast("bigint")})
    for level in range(depth):
        here = _level(crowd, side, level)
        out = out.join(here, (F.col(f"{name}l") == level) & (_at(f"{prefix}fx", level) == F.col("_cx"))
                       & (_at(f"{prefix}fy", level) == F.col("_cy")), "left")
        crowded = F.col("_cx").isNotNull()
        if level < LEVELS:
            out = out.withColumn(f"{name}l", F.when(crowded, level + 1).otherwise(F.col(f"{name}l")))
        else:
            parts = F.ceil(F.col("_cn") / F.lit(most)).cast("bigint")
            out = out.withColumn(f"{name}p", F.when(crowded, F.pmod(F.xxhash64(f"{prefix}k"), parts)).otherwise(F.lit(0)))
        out = out.drop("_cx", "_cy", "_cn")
    return out.withColumns({f"{name}i": _at(f"{prefix}fx", f"{name}l"), f"{name}j": _at(f"{prefix}fy", f"{name}l")})


def _gap(v: Column, i: Column, width: Column, far: bool) -> Column:
    low, high = v - i * width, v - (i + 1) * width
    if far:
        return F.greatest(F.abs(low), F.abs(high))
    return F.greatest(-low, high, F.lit(0.0))


def _box_distance(x: Column, y: Column, level: Column, i: Column, j: Column, r: float, far: bool = False) -> Column:
    """Distance from a point to the nearest (or farthest) place of a cell."""
    width = F.lit(float(r) * _CELL_SLACK) / F.pow(F.lit(2.0), level)
    dx, dy = _gap(x, i, width, far), _gap(y, j, width, far)
    return F.sqrt(dx * dx + dy * dy)


def _reach(points: DataFrame, prefix: str, name: str, r: float, crowd: DataFrame | None, side: str, depth: int, most: int,
           whole: bool = False) -> DataFrame:
    """A row per point and leaf of the side's tree that its circle touches: {name}l, {name}i, {name}j,
    {name}p.  With ``whole`` a point stops at cells within its circle: {name}n is their number of
    points, NULL where the leaf's points are to be tested."""
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    x, y = F.col(f"{prefix}x"), F.col(f"{prefix}y")
    out = (points.withColumn("_di", F.explode(steps)).withColumn("_dj", F.explode(steps))
           .withColumns({f"{name}l": F.lit(0), f"{name}i": _at(f"{prefix}fx", 0) + F.col("_di"),
                         f"{name}j": _at(f"{prefix}fy", 0) + F.col("_dj"), f"{name}p": F.lit(0).cast("bigint"),
                         f"{name}n": F.lit(None).cast("bigint")}).drop("_di", "_dj"))

    def box(far=False):
        return _box_distance(x, y, F.col(f"{name}l"), F.col(f"{name}i"), F.col(f"{name}j"), r, far)

    touched = F.lit(float(r) * (1 + _EDGE))
    for level in range(depth):
        out = out.join(_level(crowd, side, level), (F.col(f"{name}l") == level) & (F.col(f"{name}i") == F.col("_cx"))
                       & (F.col(f"{name}j") == F.col("_cy")) & F.col(f"{name}n").isNull(), "left")
        crowded = F.col("_cx").isNotNull()
        if whole:
            out = out.withColumn(f"{name}n", F.when(crowded & (box(True) < F.lit(float(r) * (1 - _EDGE))), F.col("_cn")).otherwise(F.col(f"{name}n")))
            crowded = crowded & F.col(f"{name}n").isNull()
        if level < LEVELS:
            four = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
            none = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))
            out = out.withColumn("_cut", crowded).withColumn("_four", F.explode(F.when(crowded, four).otherwise(none)))
            out = out.withColumns({f"{name}l": F.when(F.col("_cut"), level + 1).otherwise(F.col(f"{name}l")),
                                   f"{name}i": F.when(F.col("_cut"), F.col(f"{name}i") * 2 + F.col("_four.a")).otherwise(F.col(f"{name}i")),
                                   f"{name}j": F.when(F.col("_cut"), F.col(f"{name}j") * 2 + F.col("_four.b")).otherwise(F.col(f"{name}j"))})
            out = out.drop("_cut", "_four").where(box() < touched)
        else:
            last = F.when(crowded, F.ceil(F.col("_cn") / F.lit(most)).cast("bigint") - 1).otherwise(F.lit(0).cast("bigint"))
            out = out.withColumn(f"{name}p", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        out = out.drop("_cx", "_cy", "_cn")
    return out if whole else out.drop(f"{name}n")


_LEAF = ["tl", "ti", "tj", "tp"]
_OWN = ["ul", "ui", "uj", "up"]


def _dealt(customers: DataFrame, terminals: DataFrame, r: float, crowd: DataFrame | None, depth: dict[str, int], points: int,
           whole: bool = False) -> tuple[DataFrame, DataFrame, list[str], int]:
    """(customers by leaf they reach, terminals, keys, tasks): sides whose rows meet under equal keys.

    Both are counted per leaf first.  A leaf of more than ``TASK_PAIRS`` / 4 pairs is dealt into
    parts of its customers, each with a copy of its terminals, and there are as many
    tasks as the pairs call for, however few bytes the sides have.
    """
    t = _leaf(terminals, "t", "t", crowd, "terminal", depth["terminal"], points)
    c = _reach(customers, "c", "t", r, crowd, "terminal", depth["terminal"], points, whole)
    c = c.where("tn is null").drop("tn") if whole else c
    keys = list(_LEAF)
    if depth["customer"]:
        keys += _OWN
        c = _leaf(c, "c", "u", crowd, "customer", depth["customer"], CELL_POINTS)
        # customers of uncrowded cells share one name; terminals have a copy for it
        plain = F.col("ul") == 0
        c = c.withColumns({k: F.when(plain, F.lit(_ANY if k == "ul" else 0)).otherwise(F.col(k)).cast("bigint") for k in _OWN})
        far = _reach(t, "t", "u", r, crowd, "customer", depth["customer"], CELL_POINTS).where("ul > 0")
        near = t.withColumns({k: F.lit(_ANY if k == "ul" else 0) for k in _OWN})
        t = near.select(*t.columns, *[F.col(k).cast("bigint").alias(k) for k in _OWN]).unionByName(
            far.select(*t.columns, *[F.col(k).cast("bigint").alias(k) for k in _OWN]))
    c, t = (side.withColumns({k: F.col(k).cast("bigint") for k in keys}) for side in (c, t.drop("tfx", "tfy")))
    c = c.drop("cfx", "cfy")
    return _deal(c, t, keys)


def _deal(c: DataFrame, t: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, list[str], int]:
    """Sides that meet under equal keys, with keys that bound the pairs and customers of each, and the number of tasks."""
    limit = TASK_PAIRS // 4
    leaves = (c.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nc"))
              .join(t.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nt")), keys, "left").na.fill(0, ["_nt"])
              .withColumn("_pairs", F.col("_nc") * F.col("_nt")))
    many = (F.col("_pairs") > limit) | (F.col("_nc") > TASK_ROWS)
    seen = Observation()
    leaves = leaves.observe(seen, F.coalesce(F.sum("_pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum(F.col("_nc") + F.col("_nt")), F.lit(0)).alias("rows"),
                            F.count_if(many).alias("large"))
    parts = F.least(F.ceil(F.greatest(F.col("_pairs") / F.lit(limit), F.col("_nc") / F.lit(TASK_ROWS))), F.col("_nc")).cast("bigint").alias("_parts")
    large = frozen(leaves.where(many).select(*[F.col(k).alias(f"_{k}") for k in keys], parts), "large-leaves")
    got = seen.get
    if got["large"]:
        same = [F.col(k) == F.col(f"_{k}") for k in keys]
        c, t = (side.join(large, same, "left").drop(*[f"_{k}" for k in keys]).withColumn("_parts", F.coalesce("_parts", F.lit(1))) for side in (c, t))
        c = c.withColumn("_part", F.pmod(F.xxhash64("ck", "cx", "cy"), F.col("_parts"))).drop("_parts")
        t = t.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))).drop("_parts")
        keys = [*keys, "_part"]
    tasks = max(min(shuffle_partitions(c.sparkSession), -(-got["pairs"] // FEW_PAIRS)), -(-got["pairs"] // TASK_PAIRS),
                -(-got["rows"] // TASK_ROWS), 1)
    return c, t, keys, tasks


def _met(customers: DataFrame, terminals: DataFrame, r: float, crowd: DataFrame | None, depth: dict[str, int], points: int,
         whole: bool = False) -> DataFrame:
    """Customers joined with the terminals of every leaf they reach, under bounded keys."""
    c, t, keys, tasks = _dealt(customers, terminals, r, crowd, depth, points, whole)
    return c.repartition(tasks, *keys).join(t.repartition(tasks, *keys), keys)


def _within(r: float) -> tuple[Column, Column]:
    d = distance(F.col("cx"), F.col("cy"), F.col("tx"), F.col("ty"))
    return d, d < F.lit(float(r))


CUSTOMER = ("CUSTOMER_ID", "x_customer_id", "y_customer_id")
TERMINAL = ("TERMINAL_ID", "x_terminal_id", "y_terminal_id")


def terminals_within_radius(customers: DataFrame, terminals: DataFrame, r: float, customer_cols=CUSTOMER,
                            terminal_cols=TERMINAL, points: int = CELL_POINTS) -> DataFrame:
    """All (customer, terminal) pairs with Euclidean distance strictly below r.
    ``points`` bounds the terminals of a join key."""
    c, t = _points(customers, customer_cols, r, "c"), _points(terminals, terminal_cols, r, "t")
    crowd, depth = _crowds({"terminal": (t, "t", points), "customer": (c, "c", CELL_POINTS)})
    d, near = _within(r)
    return (_met(c, t, r, crowd, depth, points).where(near)
            .select(F.col("ck").alias(customer_cols[0]), F.col("tk").alias(terminal_cols[0]), d.alias("distance")))


def terminal_counts(customers: DataFrame, terminals: DataFrame, r: float, customer_cols=CUSTOMER,
                    terminal_cols=TERMINAL, points: int = COUNT_POINTS) -> DataFrame:
    """Per customer, number of terminals within r (0 for none).  Cells of more than ``points``
    terminals that lie within the circle are counted whole."""
    key = customer_cols[0]
    c, t = _points(customers, customer_cols, r, "c"), _points(terminals, terminal_cols, r, "t")
    crowd, depth = _crowds({"terminal": (t, "t", points), "customer": (c, "c", CELL_POINTS)})
    d, near = _within(r)
    tested = _met(c, t, r, crowd, depth, points, whole=True).where(near)
    counted = tested.groupBy("ck").agg(F.count(F.lit(1)).alias("_n"))
    if depth["terminal"]:
        inner = _reach(c, "c", "t", r, crowd, "terminal", depth["terminal"], points, whole=True).where("tn is not null")
        counted = counted.unionAll(inner.groupBy("ck").agg(F.sum("tn").alias("_n")))
        counted = counted.groupBy("ck").agg(F.sum("_n").alias("_n"))
    return (customers.select(key).join(counted.withColumnRenamed("ck", key), key, "left")
            .select(key, F.coalesce(F.col("_n"), F.lit(0)).cast("int").alias("nb_terminals")))


def available_terminals(customers: DataFrame, pairs: DataFrame, key: str = "CUSTOMER_ID",
                        terminal: str = "TERMINAL_ID") -> DataFrame:
    """Per customer, the sorted list of terminal ids in range and its length.

    The list of one customer holds the terminals within r of it, which is
    what the profile table stores; customers with none get an empty list.
    """
    lists = pairs.groupBy(key).agg(F.sort_array(F.collect_list(terminal)).alias("available_terminals"))
    out = customers.join(lists, key, "left").withColumn(
        "available_terminals", F.coalesce(F.col("available_terminals"), F.array().cast("array<bigint>")))
    return out.withColumn("nb_terminals", F.size("available_terminals").cast("int"))


def _cut(c: DataFrame, t: DataFrame, r: float) -> tuple[DataFrame, DataFrame, list[str]]:
    """Customers by cell (_x, _y) and terminals copied to the 3x3 cells around them, with keys of smaller cells
    where a cell holds more pairs than a key may."""
    limit = TASK_PAIRS // 4
    pairs = F.col("_nc") * F.col("_nt")
    # terminals within r of a cell r / 2^l wide lie on (pi + 4 / 2^l + 1 / 4^l) r^2 of the 9 r^2 around
    level = F.coalesce(*[F.when(pairs * F.lit((math.pi + 4 / 2 ** n + 1 / 4 ** n) / 9 / 4 ** n) <= F.lit(limit), n) for n in range(1, CUT_LEVELS)],
                       F.lit(CUT_LEVELS))
    cells = (c.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_nc"))
             .join(t.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_nt")), ["_x", "_y"]))
    seen = Observation()
    large = cells.where(pairs > limit).select("_x", "_y", level.alias("_l")).observe(seen, F.count(F.lit(1)).alias("cells"))
    large = frozen(large, "cut-cells")
    if not seen.get["cells"]:
        return c, t, ["_x", "_y"]
    c, t = (side.join(large, ["_x", "_y"], "left").withColumn("_l", F.coalesce(F.col("_l"), F.lit(0))) for side in (c, t))
    c = c.select("*", _at("cfx", "_l").alias("_i"), _at("cfy", "_l").alias("_j")).drop("_x", "_y")
    for at, part in (("_x", "_i"), ("_y", "_j")):
        low = F.expr(f"shiftleft({at}, _l)")
        t = t.withColumn(part, F.explode(F.sequence(low, low + F.expr("shiftleft(1L, _l)") - 1)))
    # finest cells between a terminal and a smaller cell, less two for rounding: whole numbers, exact at any place
    first, wide = (lambda part: F.expr(f"shiftleft({part}, {LEVELS} - _l)")), F.expr(f"shiftleft(1L, {LEVELS} - _l)")
    dx, dy = (F.greatest(first(part) - F.col(f), F.col(f) - first(part) - wide + 1, F.lit(2)) - 2 for f, part in (("tfx", "_i"), ("tfy", "_j")))
    t = t.where(dx * dx + dy * dy < F.lit(1 << 2 * LEVELS)).drop("_x", "_y")
    c, t = (side.withColumn("_l", F.col("_l").cast("bigint")) for side in (c, t))
    return c, t, ["_l", "_i", "_j"]


def _neighbourly(x: np.ndarray, y: np.ndarray, r: float) -> np.ndarray:
    """A number per point by which points close to each other mostly follow each other (Z-order within 2 r)."""
    out = np.zeros(len(x), np.int64)
    for shift, v in enumerate((x, y)):
        place = np.floor(v / (r / (1 << LEVELS))).astype(np.int64)
        for bit in range(LEVELS + 1):
            out |= ((place >> bit) & 1) << (2 * bit + shift)
    return out


def _near_lists(r: float, keys: list[str], name: str, empty: bool):
    """(name, ids) per customer and leaf: its column ``name`` and the sorted ids of the terminals in range, by the
    exact test on blocks of a leaf's pairs, neighbours after each other; customers without any if ``empty``."""
    def run(c: pa.Table, t: pa.Table) -> pa.Table:
        names = np.stack([np.concatenate([c.column(k).to_numpy(), t.column(k).to_numpy()]) for k in keys], axis=1)
        code = np.unique(names, axis=0, return_inverse=True)[1].reshape(-1)
        mine, theirs = code[:c.num_rows], code[c.num_rows:]
        tk = t.column("tk").to_numpy()
        cx, cy = (c.column(k).to_numpy() for k in ("cx", "cy"))
        by_leaf, order = np.lexsort((_neighbourly(cx, cy, r), mine)), np.lexsort((tk, theirs))
        cx, cy = cx[by_leaf], cy[by_leaf]
        tk, tx, ty = tk[order], *(t.column(k).to_numpy()[order] for k in ("tx", "ty"))
        mine, theirs = mine[by_leaf], theirs[order]
        starts = np.flatnonzero(np.diff(mine, prepend=-1))
        sizes, found = np.zeros(len(mine), np.int64), [np.zeros(0, np.int64)]
        for a, b in zip(starts, [*starts[1:], len(mine)]):
            low, high = np.searchsorted(theirs, mine[a], "left"), np.searchsorted(theirs, mine[a], "right")
            if low == high:
                continue
            step = max(1, CHUNK // int(high - low))
            for i in range(a, b, step):
                j = min(i + step, b)
                dx, dy = cx[i:j, None] - tx[low:high], cy[i:j, None] - ty[low:high]
                near = np.sqrt(dx * dx + dy * dy) < r
                sizes[i:j] = near.sum(axis=1)
                found.append(np.broadcast_to(tk[low:high], near.shape)[near])
        some = (sizes > 0) | empty
        ends = np.concatenate([[0], np.cumsum(sizes[some])])
        ids = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.concatenate(found), pa.int64()))
        return pa.table({name: c.column(name).take(pa.array(by_leaf[some])), "ids": ids.cast(pa.list_(pa.int64()))})
    return run


def _listed(c: DataFrame, t: DataFrame, keys: list[str], tasks: int, r: float, name: str, empty: bool) -> DataFrame:
    task = F.pmod(F.hash(*keys), F.lit(tasks)).alias("_task")
    schema = T.StructType([T.StructField(name, c.schema[name].dataType), T.StructField("ids", T.ArrayType(T.LongType()))])
    c, t = c.select(task, *dict.fromkeys([name, "cx", "cy", *keys])), t.select(task, F.col("tk").cast("bigint").alias("tk"), "tx", "ty", *keys)
    # as many groups as tasks, each of a bounded number of rows and pairs
    c, t = (side.repartition(tasks, "_task").groupBy("_task") for side in (c, t))
    return c.cogroup(t).applyInArrow(_near_lists(float(r), keys, name, empty), schema)


def _joined_lists(customers: DataFrame, t: DataFrame, r: float, customer_cols, points: int) -> DataFrame:
    """Customers and their ids, lists of a leaf joined by customer id."""
    key = customer_cols[0]
    c = _points(customers, customer_cols, r, "c").where("ck is not null")
    crowd, depth = _crowds({"terminal": (t, "t", points), "customer": (c, "c", CELL_POINTS)})
    ids = _listed(*_dealt(c, t, r, crowd, depth, points), r, "ck", False)
    lists = ids.groupBy("ck").agg(F.sort_array(F.flatten(F.collect_list("ids"))).alias("ids"))
    return customers.join(lists.withColumnRenamed("ck", key), key, "left").select(*customers.columns, "ids")


def with_terminal_lists(customers: DataFrame, terminals: DataFrame, r: float, customer_cols=CUSTOMER, terminal_cols=TERMINAL,
                        points: int = CELL_POINTS) -> DataFrame:
    """What :func:`available_terminals` gives for :func:`terminals_within_radius`, without a row per pair:
    tasks of bounded pairs list the ids of a customer.  Only customers whose id repeats or who are near a
    crowded cell have their lists shuffled and joined."""
    key = customer_cols[0]
    t = _points(terminals, terminal_cols, r, "t").where("tk is not null")
    crowd, depth = _crowds({"terminal": (t, "t", points)})
    rows = customers.select(F.struct(*[F.col(f"`{f}`") for f in customers.columns]).alias("_row"), *[F.col(f).alias(f) for f in customer_cols])
    repeated = customers.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_rk")).agg(F.count(F.lit(1)).alias("_rn")).where("_rn > 1").drop("_rn")
    alone = F.col(key).isNotNull()
    if not repeated.isEmpty():
        rows = rows.join(repeated, F.col(key) == F.col("_rk"), "left")
        alone = alone & F.col("_rk").isNull()
    c = _points(rows.where(alone), customer_cols, r, "c", F.col("_row"))
    others = rows.where(~(alone & _placed(customer_cols[1:], r))).select("_row.*")
    if depth["terminal"]:
        crowded = (_level(crowd, "terminal", 0).select(F.explode(_around("_cx", "_cy")).alias("_at")).select("_at.*").distinct())
        c = c.join(crowded, (_at("cfx", 0) == F.col("_x")) & (_at("cfy", 0) == F.col("_y")), "left")
        others = others.unionAll(c.where("_x is not null").select("_row.*"))
        c = c.where("_x is null").drop("_x", "_y")
    if depth["terminal"] or "_rk" in rows.columns:
        others = _joined_lists(others, t, r, customer_cols, points)
    else:
        others = others.withColumn("ids", F.lit(None).cast("array<bigint>"))  # customers without id or place
    # a customer has one cell, the terminals a copy in each cell around theirs
    c = c.select("*", _at("cfx", 0).alias("_x"), _at("cfy", 0).alias("_y"))
    near = t.withColumn("_at", F.explode(_around(_at("tfx", 0), _at("tfy", 0)))).select("tk", "tx", "ty", "tfx", "tfy", "_at.*")
    own = _listed(*_deal(*_cut(c, near, r)), r, "_row", True).select("_row.*", "ids")
    ids = F.coalesce(F.col("ids"), F.array().cast("array<bigint>")).alias("available_terminals")
    out = own.unionAll(others).select(*[F.col(f"`{f}`") for f in customers.columns], ids)
    return out.withColumn("nb_terminals", F.size("available_terminals").cast("int"))
