"""The work of a task is bounded by pairs: few bytes with many pairs are dealt over many tasks."""

import random

import pytest

from paylake.operators import proximity


def crowd(rnd, n, first, spread):
    return [(first + i, rnd.uniform(0, spread), rnd.uniform(0, spread)) for i in range(n)]


def frames(spark, rnd, spread):
    cust = crowd(rnd, 400, 0, spread) + [(3, 1.0, 1.0), (3, 2.0, 2.0), (None, 1.0, 1.0), (5000, None, 1.0), (5001, 900.0, 900.0)]
    term = crowd(rnd, 300, 0, spread) + [(7, 1.5, 1.0), (7, 1.5, 1.0), (None, 1.0, 1.0), (8, None, 1.0)]
    return (spark.createDataFrame(cust, "CUSTOMER_ID bigint, x_customer_id double, y_customer_id double"),
            spark.createDataFrame(term, "TERMINAL_ID bigint, x_terminal_id double, y_terminal_id double"))


@pytest.mark.parametrize("points,spread", [(50_000, 20.0), (40, 20.0), (50_000, 4.0)])
def test_tasks_hold_bounded_pairs(spark, monkeypatch, points, spread):
    monkeypatch.setattr(proximity, "TASK_PAIRS", 4000)
    c, t = frames(spark, random.Random(2), spread)
    pairs = proximity.terminals_within_radius(c, t, 5.0, points=points)
    cp, tp = proximity._points(c, proximity.CUSTOMER, 5.0, "c"), proximity._points(t, proximity.TERMINAL, 5.0, "t")
    bounds, depth = proximity._crowds({"terminal": (tp, "t", points), "customer": (cp, "c", 50_000)})
    met = proximity._met(cp, tp, 5.0, bounds, depth, points)
    per_task = met.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(per_task) > 20_000 and max(per_task) < sum(per_task) / 4 and max(per_task) < 5 * 4000
    assert pairs.count() == met.where("sqrt((cx-tx)*(cx-tx)+(cy-ty)*(cy-ty)) < 5").count()


@pytest.mark.parametrize("points,task_pairs,cell_points", [(50_000, 16_000_000, 50_000), (30, 4000, 50_000), (50_000, 4000, 60)])
def test_lists_equal_lists_of_pairs(spark, monkeypatch, points, task_pairs, cell_points):
    monkeypatch.setattr(proximity, "TASK_PAIRS", task_pairs)
    monkeypatch.setattr(proximity, "CELL_POINTS", cell_points)
    c, t = frames(spark, random.Random(3), 20.0)
    want = proximity.available_terminals(c, proximity.terminals_within_radius(c, t, 5.0))
    got = proximity.with_terminal_lists(c, t, 5.0, points=points)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert proximity.with_terminal_lists(c.where("false"), t, 5.0).count() == 0
    assert {r.nb_terminals for r in proximity.with_terminal_lists(c, t.where("false"), 5.0).collect()} == {0}
