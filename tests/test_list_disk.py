"""Lists of terminals on disk: neighbours follow each other and files are compressed over many rows."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from paylake.operators import proximity
from paylake.plans import jobs
from paylake.sources import files, tables


def frames(spark, n, m, width):
    rnd = random.Random(3)
    cust = [(i, rnd.uniform(0, width), rnd.uniform(0, width)) for i in range(n)]
    term = [(100_000 + i, rnd.uniform(0, width), rnd.uniform(0, width)) for i in range(m)]
    return (spark.createDataFrame(cust, "CUSTOMER_ID bigint, x_customer_id double, y_customer_id double").coalesce(1),
            spark.createDataFrame(term, "TERMINAL_ID bigint, x_terminal_id double, y_terminal_id double").coalesce(1))


def bytes_of(path):
    path = path.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def test_landed_and_saved_lists_take_a_small_part_of_their_text(spark):
    c, t = frames(spark, 1500, 6000, 8.0)
    c = c.withColumns({k: F.lit(1.0) for k in ("mean_amount", "std_amount", "mean_nb_tx_per_day")})
    profiles = proximity.with_terminal_lists(c, t, 5.0)
    text = jobs.raw_customers_text(profiles).agg(F.sum(F.length("available_terminals"))).first()[0]
    path = jobs.land_customers(spark, profiles)
    assert bytes_of(path) < text / 8
    bronze = files.read_bronze_csv(spark, path, "customers")
    assert sorted(map(str, bronze.collect())) == sorted(map(str, jobs.raw_customers_text(profiles).collect()))
    names = jobs.LayerNames("paylake_disk")
    for layout, at in (("customers", path), ("terminals", files.land(spark, files.to_text(jobs.terminal_profiles(t)), "terminals"))):
        jobs.bronze_job(spark, {layout: at}, names)
    assert bytes_of(tables.location(spark, names.name("customers", "bronze"))) < text / 8


def test_neighbours_follow_each_other(spark):
    c, t = frames(spark, 2000, 300, 5.0)
    rows = proximity.with_terminal_lists(c, t, 5.0).select("x_customer_id", "y_customer_id").collect()
    steps = sorted(math.dist(a, b) for a, b in zip(rows, rows[1:]))
    assert steps[len(steps) // 2] < 0.3  # 2.6 on average if dealt at random


@pytest.mark.parametrize("pairs", [4_000, 60_000, 16_000_000])
@pytest.mark.parametrize("at", [0.0, -7.5, 3e9])
def test_cut_cells_give_the_same_lists(spark, monkeypatch, pairs, at):
    monkeypatch.setattr(proximity, "TASK_PAIRS", pairs)
    c, t = frames(spark, 200, 150, 14.0)
    c = c.withColumns({k: F.col(k) + at for k in ("x_customer_id", "y_customer_id")})
    t = t.withColumns({k: F.col(k) + at for k in ("x_terminal_id", "y_terminal_id")})
    terms = t.collect()
    got = proximity.with_terminal_lists(c, t, 5.0).collect()
    assert len(got) == 200
    for r in got:
        want = sorted(k for k, x, y in terms if math.sqrt((r.x_customer_id - x) ** 2 + (r.y_customer_id - y) ** 2) < 5.0)
        assert r.available_terminals == want and r.nb_terminals == len(want)
