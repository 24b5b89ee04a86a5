"""Snapshot overwrite, clustered layout, quarantine, drift and observed audits."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.config import scratch_dir
from paylake.operators import audit, conform
from paylake.plans import jobs
from paylake.sources import files, tables
from paylake.sources.schemas import TRANSACTION_TYPES, string_schema
from tests.helpers import tx_df

DB = "paylake_tables"


@pytest.fixture(scope="module")
def db(spark):
    return tables.ensure_database(spark, DB)


def numbers(spark, first, last):
    return spark.range(first, last).withColumn("x", F.col("id") * 2)


def ids(df):
    return sorted(r.id for r in df.collect())


def folders(spark, root):
    return sorted(p for found in tables.versions(spark, root).values() for p in found)


def test_overwrite_is_a_snapshot(spark, db):
    name, root = tables.table_name("snap", db), scratch_dir(spark, "snap")
    tables.save_table(numbers(spark, 0, 5), name, path=root)
    reader = spark.table(name)  # planned before the overwrite
    tables.save_table(numbers(spark, 10, 15), name, path=root)
    assert ids(reader) == list(range(5)) and ids(spark.table(name)) == list(range(10, 15))
    for _ in range(3):
        tables.save_table(numbers(spark, 20, 25), name, path=root)
    assert len(folders(spark, root)) == 2  # the current version and the one before
    tables.save_table(numbers(spark, 30, 35), name, path=root, keep=0)
    assert folders(spark, root) == [tables.location(spark, name)] and ids(spark.table(name)) == list(range(30, 35))
    # a table may be rewritten from itself
    tables.save_table(spark.table(name).where("id > 32"), name, path=root, keep=0)
    assert ids(spark.table(name)) == [33, 34]
    tables.drop_table(spark, name, root)
    assert tables.location(spark, name) is None and folders(spark, root) == []


def test_failed_write_leaves_the_table(spark, db):
    name, root = tables.table_name("fails", db), scratch_dir(spark, "fails")
    tables.save_table(numbers(spark, 0, 5), name, path=root)
    before = folders(spark, root)
    with pytest.raises(Exception, match="no luck"):
        tables.save_table(numbers(spark, 0, 100).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("no luck"))).otherwise(F.col("x"))),
                          name, path=root)
    assert folders(spark, root) == before and ids(spark.table(name)) == list(range(5))


def test_columns_may_change_and_tables_be_empty(spark, db):
    name, root = tables.table_name("change", db), scratch_dir(spark, "change")
    tables.save_table(numbers(spark, 0, 3), name, path=root)
    tables.save_table(numbers(spark, 0, 3).withColumn("y", F.lit("a")), name, path=root)
    assert spark.table(name).columns == ["id", "x", "y"]
    tables.save_table(numbers(spark, 0, 0), name, path=root)
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 0


def test_partitioned_overwrite(spark, db):
    name, root = tables.table_name("parts", db), scratch_dir(spark, "parts")
    df = numbers(spark, 0, 10).withColumn("day", (F.col("id") % 3).cast("int"))
    tables.save_table(df, name, path=root, partition_by=["day"])
    tables.save_table(df.where("id > 4"), name, path=root, partition_by=["day"])
    assert ids(spark.table(name).where("day = 2")) == [5, 8] and spark.table(name).count() == 5


def test_three_part_names_and_location(spark, tmp_path):
    tables.ensure_database(spark, "paylake_at", location=f"{tmp_path}/it's here", catalog="spark_catalog")
    where = spark.sql("DESCRIBE DATABASE paylake_at").where("info_name = 'Location'").first().info_value
    assert "here" in where
    name = tables.table_name("transaction", "paylake_at", "bronze", catalog="spark_catalog")
    assert name == "`spark_catalog`.`paylake_at`.`transaction_bronze`"
    for last in (4, 6):
        tables.save_table(numbers(spark, 0, last), name)
    assert spark.table("spark_catalog.paylake_at.transaction_bronze").count() == 6
    assert tables.table_name("odd`name", "d b") == "`d b`.`odd``name`"


def scanned(df):
    """Rows that the scan of an executed plan gave."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan") or "FileScan" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_clustered_lookup_reads_few_row_groups(spark, db):
    shuffled = spark.range(0, 200_000).withColumn("pad", F.sha2(F.col("id").cast("string"), 256)).repartition(6, "pad")
    plain, near = tables.table_name("plain", db), tables.table_name("near", db)
    tables.save_table(shuffled, plain, path=scratch_dir(spark, "plain"))
    tables.save_table(shuffled, near, path=scratch_dir(spark, "near"), cluster_by="id")
    one = lambda name, i: spark.table(name).where(F.col("id") == i)
    some = lambda name: spark.table(name).where("id between 777 and 790")
    assert one(near, 777).first().pad == one(plain, 777).first().pad and some(near).count() == some(plain).count() == 14
    total = 200_000
    assert scanned(some(plain)) > 2 * scanned(some(near))  # every file's range holds some of them
    assert scanned(one(near, 777)) <= total / 3  # one file's range holds it
    assert scanned(one(near, total + 5)) == 0 and spark.table(near).count() == total


def test_ranges_from_a_cheaper_frame_run_the_rows_once(spark, db):
    """Ranges come from the other frame's quantiles; every row is made once, ids may be null or repeat."""
    ids = [None if i % 37 == 0 else i % 300 * (1 << 40) for i in range(400)]
    made = spark.sparkContext.accumulator(0)

    def make(i):
        made.add(1)
        return (i, "x")

    rows = spark.createDataFrame(spark.sparkContext.parallelize(ids, 4).map(make), "id bigint, v string")
    cheap = spark.createDataFrame([(i,) for i in ids], "id bigint")
    name = tables.table_name("ranged", db)
    tables.save_table(rows, name, path=scratch_dir(spark, "ranged"), cluster_by="id", ranges_from=cheap)
    assert made.value == 400
    back = spark.table(name)
    assert sorted(map(str, (r.id for r in back.collect()))) == sorted(map(str, ids))
    spans = sorted(tuple(r) for r in back.where("id is not null").groupBy("_metadata.file_path").agg(F.min("id"), F.max("id")).drop("file_path").collect())
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    for odd in (cheap.where("false"), cheap.where("id is null")):
        tables.save_table(rows, name, path=scratch_dir(spark, "ranged"), cluster_by="id", ranges_from=odd)
        assert spark.table(name).count() == 400


def test_malformed_rows_are_kept_and_quarantined(spark):
    columns = [c for c, _ in TRANSACTION_TYPES]
    good = "1,2024-01-01 00:00:05,7,3,12.5,5,0,0,0"
    lines = [",".join(columns), good, "2,2024-01-01 00:00:06,7", good + ",more,cells", '"3,2024-01-01 00:00:07,7,3,1.0,7,0,0,0', ""]
    path = scratch_dir(spark, "ragged")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    bronze = files.read_bronze_csv(spark, path, "transactions", corrupt=True)
    assert bronze.columns == [*columns, files.CORRUPT] and len(bronze.collect()) == 4
    names = jobs.LayerNames("paylake_ragged")
    made = jobs.bronze_job(spark, {"transactions": path}, names)
    table = spark.table(made["transactions"])
    assert table.columns == columns and table.count() == 4
    held = spark.table(names.name("transactions", "quarantine"))
    assert sorted(r.line for r in held.collect()) == sorted(lines[2:5]) and held.where("file like '%part-%'").count() == 3
    assert audit.null_audit(held).first().total_rows == 3
    # a sound file next time: no quarantine is left
    sound = files.land(spark, files.to_text(tx_df(spark, [(1, 5, 7, 3, 1.0, 0)])), "sound")
    jobs.bronze_job(spark, {"transactions": sound}, names)
    assert tables.location(spark, names.name("transactions", "quarantine")) is None


def test_observed_audit_takes_no_pass_of_its_own(spark, monkeypatch):
    df = tx_df(spark, [(i, i, None if i % 3 == 0 else 1, 2, 1.0, 0) for i in range(30)])
    want = audit.null_audit(df).first().asDict()
    observed, audited = audit.observed_null_audit(df)
    observed.write.format("noop").mode("overwrite").save()
    for method in ("agg", "groupBy", "count"):
        monkeypatch.setattr(type(df), method, None)
    assert audited().first().asDict() == want and want["nulls_CUSTOMER_ID"] == 10
    none, audited = audit.observed_null_audit(df.where("TRANSACTION_ID < 0"))
    none.write.format("noop").mode("overwrite").save()
    assert audited().first().total_rows == 0


def test_schema_drift_reports_every_difference(spark):
    declared = string_schema(TRANSACTION_TYPES)
    assert audit.schema_drift(spark, declared, declared).count() == 0
    names = [f.name for f in declared.fields]
    changed = T.StructType([declared[1], declared[0], *[declared[n] for n in names[2:] if n not in ("TX_AMOUNT", "TX_FRAUD")],
                            T.StructField("TX_AMOUNT", T.DoubleType()), T.StructField("CHANNEL", T.StringType())])
    got = {(r.field, r.drift) for r in audit.schema_drift(spark, changed, declared).collect()}
    assert {("TX_FRAUD", "missing"), ("CHANNEL", "extra"), ("TX_AMOUNT", "retyped"), ("TX_DATETIME", "reordered"),
            ("TRANSACTION_ID", "reordered")} <= got
    nested = "a struct<b: int, c: array<struct<d: string>>>"
    other = "a struct<b: bigint, c: array<struct<d: string, e: int>>>"
    left, right = (spark.createDataFrame([], s).schema for s in (other, nested))
    got = {(r.field, r.drift) for r in audit.schema_drift(spark, left, right).collect()}
    assert {("a.b", "retyped"), ("a.c[].e", "extra"), ("a", "retyped"), ("a.c", "retyped")} == got


def test_schema_report_of_a_missing_column(spark):
    bronze = files.to_text(tx_df(spark, [(1, 5, 7, 3, 1.0, 0)])).drop("TX_FRAUD")
    rows = {r.column_name: r for r in audit.schema_report(bronze, TRANSACTION_TYPES).collect()}
    assert (rows["TX_FRAUD"].actual_type, rows["TX_FRAUD"].filled_cells, rows["TX_FRAUD"].typed_cells) == ("missing", 0, 0)
    with pytest.raises(ValueError):
        conform.conform(bronze, "transactions")
