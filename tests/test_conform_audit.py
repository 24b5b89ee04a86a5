import datetime as dt

import pytest
from pyspark.sql import functions as F

from paylake.operators import audit, conform
from paylake.functions.text import parse_id_list

LAYOUT = [("A", "bigint"), ("B", "double"), ("T", "timestamp_ntz")]


def test_tolerant_typing_nulls_bad_cells(spark):
    rows = [("1", "2.5", "2018-04-01 00:00:31"), ("abc", "abc", "bad"), ("596.0", "", "2018-04-01 00:00:31.5"),
            (None, None, None), ("", "1e3", "2018-04-01 23:59:59")]
    df = spark.createDataFrame(rows, "A string, B string, T string")
    got = conform.conform(df, LAYOUT).collect()
    assert got[0] == (1, 2.5, dt.datetime(2018, 4, 1, 0, 0, 31))
    assert got[1] == (None, None, None)
    assert got[2] == (None, None, None)
    assert got[3] == (None, None, None)
    assert got[4] == (None, 1000.0, dt.datetime(2018, 4, 1, 23, 59, 59))
    assert [f.dataType.simpleString() for f in conform.conform(df, LAYOUT).schema] == [
        "bigint", "double", "timestamp_ntz"]


def test_strict_typing_raises(spark):
    df = spark.createDataFrame([("abc", "1", "2018-04-01 00:00:00")], "A string, B string, T string")
    with pytest.raises(Exception):
        conform.conform(df, LAYOUT, strict=True).collect()


def test_strict_lists_raise_and_tolerant_lists_are_null(spark):
    df = spark.createDataFrame([('[1, "x"]',)], "L string")
    assert conform.conform(df, [("L", "array<bigint>")]).first().L is None
    with pytest.raises(Exception):
        conform.conform(df, [("L", "array<bigint>")], strict=True).collect()


def test_timestamps_keep_the_hour_of_a_dst_gap(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-11-03 01:30:00",), ("0001-01-01 00:00:00",)], "T string")
        for strict in (False, True):
            got = [r.T for r in conform.conform(df, [("T", "timestamp_ntz")], strict).collect()]
            assert got == [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 11, 3, 1, 30), dt.datetime(1, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_missing_column_raises(spark):
    df = spark.createDataFrame([("1",)], "A string")
    with pytest.raises(ValueError):
        conform.conform(df, LAYOUT)


def test_list_text_variants(spark):
    rows = [("[1, 2]",), ("[]",), ("[np.int64(1), np.int64(2)]",), ("",), (None,), ("[-3]",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(parse_id_list(F.col("s"))).collect()]
    assert got[0] == [1, 2] and got[1] == [] and got[2] == [1, 2] and got[5] == [-3]
    assert got[3] is None and got[4] is None


def test_null_audit_and_empty_input(spark):
    df = spark.createDataFrame([("1", None), (None, None), ("3", "x")], "a string, b string")
    r = audit.null_audit(df).collect()[0]
    assert (r.total_rows, r.nulls_a, r.nulls_b) == (3, 1, 2)
    e = audit.null_audit(df.where("false")).collect()[0]
    assert (e.total_rows, e.nulls_a, e.nulls_b) == (0, 0, 0)


def test_cast_loss_counts_typing_failures(spark):
    df = spark.createDataFrame([("1", "2.0"), ("x", None), ("596.0", "y")], "A string, B string")
    got = {r.column_name: (r.bronze_nulls, r.silver_nulls, r.lost_cells)
           for r in audit.cast_loss_audit(df, [("A", "bigint"), ("B", "double")]).collect()}
    assert got == {"A": (0, 2, 2), "B": (1, 2, 1)}
