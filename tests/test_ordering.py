from pyspark.sql import functions as F

from paylake.operators import ordering
from tests.helpers import tx_df


def test_dense_chronological_ids(spark):
    spec = [(10, 50, 2, 1, 1.0, 0), (11, 50, 1, 1, 1.0, 0), (12, 5, 9, 9, 9.0, 0), (13, None, 1, 1, 1.0, 0),
            (14, 86400 * 3, 1, 1, 1.0, 0), (15, 50, 1, 1, 0.5, 0)]
    got = {r.TRANSACTION_ID: r.CHRONO_ID
           for r in ordering.chronological_ids(tx_df(spark, spec), out="CHRONO_ID").collect()}
    assert got == {13: 0, 12: 1, 15: 2, 11: 3, 10: 4, 14: 5}


def test_dense_index_large_is_permutation(spark):
    df = spark.range(0, 20000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("k"))
    out = ordering.dense_index(df, {"_l": F.col("k")}, [F.col("id")], "ix")
    ix = [r.ix for r in out.orderBy("k", "id").collect()]
    assert ix == list(range(20000))


def test_time_offsets_within_day(spark):
    df = tx_df(spark, [(1, 0, 1, 1, 2.675, 0), (2, 86399, 1, 1, 1.0, 0), (3, 86400 + 5, 1, 1, 1.0, 0)])
    off = ordering.within_day(ordering.time_offsets(df, "2024-01-01 00:00:00"))
    got = {r.TRANSACTION_ID: (r.TX_TIME_DAYS, r.TX_SECOND_OF_DAY) for r in off.collect()}
    assert got == {2: (0, 86399), 3: (1, 5)}


def test_dense_index_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "g int, x int")
    got = ordering.dense_index(df, {"_l": F.col("x")}, [F.col("x")], "i", ["g"])
    assert sorted((r.x, r.i) for r in got.collect()) == [(1, 0), (2, 1), (5, 0)]


def test_number_rows_of_one_instant(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit(None).cast("int").alias("t")).repartition(5)
    out = ordering.number_rows(df, [F.col("t").asc_nulls_first(), F.col("k")], "n")
    assert out.where("k = n").count() == 5000 and out.columns == ["k", "t", "n"]
    assert ordering.number_rows(df.where("false"), [F.col("k")], "n").count() == 0


def test_equal_rows_are_split(spark):
    """Nine rows of ten are equal in every column; no range holds much more than its share, ids stay dense."""
    df = spark.range(20_000, numPartitions=3).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("v"))
    order = [F.col("v").asc_nulls_first()]
    sizes = [r["count"] for r in ordering._in_ranges(df, order, 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 5_000
    rows = sorted((r["at"], r["v"]) for r in ordering.number_rows(df, order, "at").collect())
    assert [at for at, _ in rows] == list(range(20_000))
    assert [v for _, v in rows] == sorted(v for _, v in rows)
