from pyspark.sql import functions as F

from paylake.config import scratch_dir
from paylake.sources import files, tables
from paylake.sources.schemas import TRANSACTION_TYPES
from paylake.operators import conform
from tests.helpers import tx_df


def test_csv_roundtrip_and_string_order(spark):
    df = tx_df(spark, [(i, 100 * i, 1, 2, 1.25 * i, 0) for i in (0, 1, 2, 10)])
    path = files.land(spark, files.to_text(df), "t")
    bronze = files.read_bronze_csv(spark, path, "transactions")
    assert all(f.dataType.simpleString() == "string" for f in bronze.schema)
    top = [r[0] for r in bronze.orderBy("TRANSACTION_ID").limit(3).collect()]
    assert top == ["0", "1", "10"]
    back = conform.conform(bronze, TRANSACTION_TYPES)
    assert sorted(back.collect()) == sorted(df.collect())


def test_reordered_header_is_rejected(spark):
    df = tx_df(spark, [(1, 5, 1, 2, 3.0, 0)])
    text = files.to_text(df)
    swapped = text.select("CUSTOMER_ID", "TRANSACTION_ID", *[c for c in text.columns
                                                           if c not in ("CUSTOMER_ID", "TRANSACTION_ID")])
    path = files.land(spark, swapped, "swapped")
    try:
        files.read_bronze_csv(spark, path, "transactions").collect()
        raised = False
    except Exception:
        raised = True
    assert raised


def test_table_roundtrip(spark):
    df = tx_df(spark, [(1, 5, 1, 2, 3.0, 0), (2, 9, 1, 2, 4.0, 1)])
    db = tables.ensure_database(spark, "paylake_test")
    name = tables.save_table(df, tables.table_name("tx", db, "bronze"), path=scratch_dir(spark, "tbl"))
    assert sorted(tables.read_table(spark, name).collect()) == sorted(df.collect())


def test_injected_cells_keep_every_row(spark):
    df = tx_df(spark, [(i, i, 1, 2, 1.0, 0) for i in range(200)])
    bad = files.inject_bad_transaction_cells(files.to_text(df))
    assert bad.count() == 200
    assert bad.where(F.col("TX_AMOUNT") == "abc").count() == 3  # ids 1, 98, 195
