"""Incremental raw -> bronze ingest with Structured Streaming.

The batch bronze job re-reads every raw file and overwrites the table.  A
landing folder that keeps receiving files is better served by a file
stream: each run picks up only files not yet committed in the checkpoint,
appends them to the bronze folder, and stops (``availableNow``).  The
checkpoint lives in the shared checkpoint folder, so a restarted or
relocated driver resumes exactly where the last run committed.

Same operator as :func:`paylake.sources.files.read_bronze_csv` (header CSV,
declared all-string schema, header names checked) - only the execution
mode differs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from paylake.sources.schemas import LAYOUTS, string_schema


def ingest_raw_stream(spark: SparkSession, raw_dir: str, layout: str, bronze_dir: str,
                      checkpoint: str | None = None, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> str:
    """Append the raw CSV files not yet ingested to ``bronze_dir``; returns the checkpoint.

    The default checkpoint lies beside ``bronze_dir``: it belongs to that sink's
    log, and every later call resumes from it.
    """
    checkpoint = checkpoint or f"{bronze_dir.rstrip('/')}.checkpoint"
    reader = (spark.readStream.schema(string_schema(LAYOUTS[layout]))
              .option("header", True).option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.csv(raw_dir).writeStream.format(fmt)
         .option("path", bronze_dir).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return checkpoint
