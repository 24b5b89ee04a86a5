"""Lists of terminals: built, printed and parsed once each, and not shuffled where a customer's id is its own."""

import random

import pytest
from pyspark.sql import functions as F

from paylake.functions.text import parse_id_list
from paylake.operators import proximity
from paylake.plans import catalog
from paylake.sources import files


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def frames(spark, repeated):
    rnd = random.Random(5)
    cust = [(i, rnd.uniform(-8, 20), rnd.uniform(-8, 20), f"c{i}") for i in range(150)]
    cust += [(None, 1.0, 1.0, "none"), (900, None, 1.0, "x"), (901, float("nan"), 1.0, "y"), (902, 800.0, 1.0, "far")]
    cust += [(3, 1.0, 1.0, "again"), (3, 15.0, 2.0, "again"), (3, 15.0, 2.0, "again")] if repeated else []
    term = [(500 - i, rnd.uniform(-8, 20), rnd.uniform(-8, 20)) for i in range(120)]
    term += [(rnd.randrange(10), rnd.uniform(0, 1), rnd.uniform(0, 1)) for _ in range(60)] + [(None, 1.0, 1.0), (8, None, 1.0)]
    return (spark.createDataFrame(cust, "CUSTOMER_ID bigint, x_customer_id double, y_customer_id double, note string"),
            spark.createDataFrame(term, "TERMINAL_ID bigint, x_terminal_id double, y_terminal_id double"))


@pytest.mark.parametrize("repeated,points", [(False, 50_000), (True, 50_000), (False, 40), (True, 40)])
def test_lists_of_own_repeated_and_crowded_customers(spark, monkeypatch, repeated, points):
    monkeypatch.setattr(proximity, "TASK_PAIRS", 8000)
    c, t = frames(spark, repeated)
    want = proximity.available_terminals(c, proximity.terminals_within_radius(c, t, 5.0))
    got = proximity.with_terminal_lists(c, t, 5.0, points=points)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # lists are joined by id only where that is called for
    assert ("collect_list" in plan_of(got)) == (repeated or points == 40)


def test_list_is_parsed_once(spark):
    pairs = catalog.silver_customer_terminals(spark, "/root/testdata/sf0.001")
    assert plan_of(pairs).count("from_json") == 1


def test_list_text_as_before(spark):
    lists = [[1, 2], [], [7], None, [None], [None, -3, None], [-1, 2 ** 62]]
    rows = spark.createDataFrame([(i, v, s) for i, v in enumerate(lists) for s in (True, False, None)], "i int, v array<bigint>, s boolean")

    def text(v, s):
        return None if v is None else "[" + ", ".join(f"np.int64({x})" if s else str(x) for x in v if x is not None) + "]"

    shown = rows.select("i", "s", files.list_text(F.col("v"), F.col("s")).alias("t"))
    assert "lambda" not in plan_of(shown)
    for r in shown.collect():
        assert r.t == text(lists[r.i], r.s)
    back = shown.where("t is not null").select("i", parse_id_list(F.col("t")).alias("v")).collect()
    assert all(r.v == [x for x in lists[r.i] if x is not None] for r in back)
