from paylake.config import scratch_dir
from paylake.sources import files
from paylake.streaming.ingest import ingest_raw_stream
from tests.helpers import tx_df


def test_incremental_ingest_is_exactly_once(spark):
    raw = scratch_dir(spark, "landing")
    bronze = scratch_dir(spark, "bronze-stream")
    first = tx_df(spark, [(i, i, 1, 2, 1.0, 0) for i in range(10)])
    second = tx_df(spark, [(i, i, 1, 2, 1.0, 0) for i in range(10, 25)])
    files.write_csv(files.to_text(first), f"{raw}/batch=1")
    ingest_raw_stream(spark, f"{raw}/*", "transactions", bronze)
    assert spark.read.parquet(bronze).count() == 10
    files.write_csv(files.to_text(second), f"{raw}/batch=2")
    ingest_raw_stream(spark, f"{raw}/*", "transactions", bronze)
    ingest_raw_stream(spark, f"{raw}/*", "transactions", bronze)
    got = spark.read.parquet(bronze)
    assert got.count() == 25
    assert sorted(int(r.TRANSACTION_ID) for r in got.collect()) == list(range(25))
