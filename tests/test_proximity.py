import math
import random

import pytest

from paylake.operators import proximity


def brute(cust, term, r):
    out = set()
    for ck, cx, cy in cust:
        for tk, tx, ty in term:
            if math.sqrt((cx - tx) * (cx - tx) + (cy - ty) * (cy - ty)) < r:
                out.add((ck, tk))
    return out


def frames(spark, cust, term):
    c = spark.createDataFrame(cust, "CUSTOMER_ID bigint, x_customer_id double, y_customer_id double")
    t = spark.createDataFrame(term, "TERMINAL_ID bigint, x_terminal_id double, y_terminal_id double")
    return c, t


def test_radius_edges(spark):
    cust = [(1, 10.0, 10.0), (2, -3.0, -3.0), (3, 90.0, 90.0)]
    term = [(1, 15.0, 10.0),        # exactly r: out
            (2, 14.999999, 10.0),   # just under r: in
            (3, 10.0, 6.0),         # neighbour cell below: in
            (4, -6.0, -3.5),        # negative coordinates: in
            ]
    c, t = frames(spark, cust, term)
    pairs = proximity.terminals_within_radius(c, t, 5.0)
    got = {(r.CUSTOMER_ID, r.TERMINAL_ID) for r in pairs.collect()}
    assert got == {(1, 2), (1, 3), (2, 4)} == brute(cust, term, 5.0)
    counts = {r.CUSTOMER_ID: r.nb_terminals for r in proximity.terminal_counts(c, t, 5.0).collect()}
    assert counts == {1: 2, 2: 1, 3: 0}
    lists = {r.CUSTOMER_ID: (r.available_terminals, r.nb_terminals)
             for r in proximity.available_terminals(c, pairs).collect()}
    assert lists[1] == ([2, 3], 2) and lists[3] == ([], 0)


def test_grid_join_equals_all_pairs(spark):
    rnd = random.Random(3)
    cust = [(i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for i in range(300)]
    term = [(i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for i in range(400)]
    c, t = frames(spark, cust, term)
    for r in (2.5, 5.0, 13.0):
        got = {(x.CUSTOMER_ID, x.TERMINAL_ID) for x in proximity.terminals_within_radius(c, t, r).collect()}
        assert got == brute(cust, term, r)


def test_radius_join_is_an_equi_join(spark):
    c, t = frames(spark, [(1, 1.0, 1.0)], [(1, 2.0, 2.0)])
    plan = proximity.terminals_within_radius(c, t, 5.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def crowded_points(rnd, n, first):
    """A third at one spot, a third in a tenth of a cell, the rest anywhere; some without a place."""
    spots = [(30.0, 30.0)] * (n // 3) + [(rnd.uniform(31, 31.5), rnd.uniform(31, 31.5)) for _ in range(n // 3)]
    spots += [(rnd.uniform(-20, 60), rnd.uniform(-20, 60)) for _ in range(n - 2 * (n // 3))]
    return [(first + i, x, y) for i, (x, y) in enumerate(spots)]


@pytest.mark.parametrize("points,customer_points", [(10, 50_000), (50_000, 15), (25, 40), (400, 400)])
def test_crowded_cells(spark, monkeypatch, points, customer_points):
    rnd = random.Random(5)
    monkeypatch.setattr(proximity, "CELL_POINTS", customer_points)
    cust = crowded_points(rnd, 180, 0) + [(900, 35.0, 30.0), (901, 30.0, 25.0), (902, 26.5, 33.5)]
    term = crowded_points(rnd, 240, 5000)
    c, t = frames(spark, cust + [(990, None, 1.0), (991, math.nan, 1.0)], term + [(9990, 1.0, None), (9991, math.inf, 1.0)])
    want = brute(cust, term, 5.0)
    pairs = [(x.CUSTOMER_ID, x.TERMINAL_ID) for x in proximity.terminals_within_radius(c, t, 5.0, points=points).collect()]
    assert len(pairs) == len(want) and set(pairs) == want
    counts = {x.CUSTOMER_ID: x.nb_terminals for x in proximity.terminal_counts(c, t, 5.0, points=points).collect()}
    assert counts == {k: sum(1 for a, _ in want if a == k) for k in [*(x[0] for x in cust), 990, 991]}


def test_join_keys_are_bounded(spark, monkeypatch):
    """With a third of all points of both sides at one spot, no join key holds more than the bounds."""
    rnd = random.Random(6)
    monkeypatch.setattr(proximity, "CELL_POINTS", 30)
    c, t = frames(spark, crowded_points(rnd, 600, 0), crowded_points(rnd, 900, 5000))
    cp = proximity._points(c, proximity.CUSTOMER, 5.0, "c")
    tp = proximity._points(t, proximity.TERMINAL, 5.0, "t")
    crowd, depth = proximity._crowds({"terminal": (tp, "t", 40), "customer": (cp, "c", 30)})
    assert depth == {"terminal": proximity.LEVELS + 1, "customer": proximity.LEVELS + 1}
    leaves = proximity._leaf(tp, "t", "t", crowd, "terminal", depth["terminal"], 40).groupBy("tl", "ti", "tj", "tp").count()
    assert leaves.agg({"count": "max"}).first()[0] <= 2 * 40  # parts of one spot are dealt by hash
    own = proximity._leaf(cp, "c", "u", crowd, "customer", depth["customer"], 30).groupBy("ul", "ui", "uj", "up").count()
    assert own.agg({"count": "max"}).first()[0] <= 2 * 30


def test_inner_cells_are_counted_whole(spark):
    """A customer in the middle of 4,000 terminals: few of them are tested one by one."""
    rnd = random.Random(7)
    c, t = frames(spark, [(1, 50.0, 50.0)], [(i, rnd.uniform(45.5, 54.5), rnd.uniform(45.5, 54.5)) for i in range(4000)])
    cp, tp = proximity._points(c, proximity.CUSTOMER, 5.0, "c"), proximity._points(t, proximity.TERMINAL, 5.0, "t")
    crowd, depth = proximity._crowds({"terminal": (tp, "t", 20), "customer": (cp, "c", 50_000)})
    tested = proximity._met(cp, tp, 5.0, crowd, depth, 20, whole=True).count()
    got = proximity.terminal_counts(c, t, 5.0, points=20).first().nb_terminals
    assert got == proximity.terminals_within_radius(c, t, 5.0).count() > 3000 and tested < got / 3
