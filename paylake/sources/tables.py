"""Catalog tables (S2, S4, S5, S6): database, snapshot overwrite, scans, clustered layout.

A table is an external catalog table over one *version* folder below its root
(``<root>/v-000007-<random>``).  An overwrite writes a new version beside the old
ones and then moves the table's location, one catalog call: readers see the
former version or the new one, whole, and a failed write leaves the table as it
was and no folder behind.  Versions older than the last ``keep`` former ones are
removed; one is kept by default for readers that planned before the move.  If the
columns change, the catalog entry is replaced, which is not atomic.

``cluster_by`` range-sorts a version by a column and writes Bloom filters for it,
so a lookup by that column skips row groups by their ranges and filters.  Spark finds
ranges by running the rows' whole plan once more; where ``ranges_from`` has the same
numeric column at a lower price, they are its quantiles.

The table format is a parameter (default parquet).
"""

from __future__ import annotations

import math
import re
import uuid

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.config import checkpoint_root, shuffle_partitions

DEFAULT_DATABASE = "fraud_detection"
_VERSION = re.compile(r"/v-(\d{6,})-[0-9a-f]+/?$")
BLOCK_BYTES = 32 << 20  # row groups of clustered tables
COMPRESSION = "zstd"  # of parquet; finds lists again that lie further back than the 64 KB of snappy


def _quoted(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def ensure_database(spark: SparkSession, database: str = DEFAULT_DATABASE, location: str | None = None,
                    catalog: str | None = None) -> str:
    """Create the database if it isn't there, at ``location`` if that is given."""
    name = ".".join(_quoted(p) for p in (catalog, database) if p)
    at = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")
    return database


def table_name(name: str, database: str = DEFAULT_DATABASE, layer: str | None = None, catalog: str | None = None) -> str:
    """``[catalog.]database.name_layer`` (layer suffix as in ``transaction_bronze``), each part quoted."""
    return ".".join(_quoted(p) for p in (catalog, database, f"{name}_{layer}" if layer else name) if p)


def table_root(spark: SparkSession, name: str) -> str:
    """The default folder of a table's versions, in the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/paylake/tables/{name.replace('`', '')}"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _remove(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def versions(spark: SparkSession, root: str) -> dict[int, list[str]]:
    """Folders of the versions below a root, by number."""
    fs, at = _file_system(spark, root)
    found: dict[int, list[str]] = {}
    for status in fs.listStatus(at) if fs.exists(at) else ():
        path = status.getPath().toString()
        if number := _VERSION.search(path):
            found.setdefault(int(number[1]), []).append(path)
    return found


def location(spark: SparkSession, name: str) -> str | None:
    """Where the table's current version lies; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _same_columns(df: DataFrame, table: DataFrame, partition_by: list[str]) -> bool:
    order = [c for c in df.columns if c not in partition_by] + partition_by  # as files are read back
    return table.columns == order and all(table.schema[c].dataType == df.schema[c].dataType for c in order)


def _create(spark: SparkSession, name: str, version: str, fmt: str, df: DataFrame, partition_by: list[str] | None) -> None:
    """A catalog entry over the version; its partitions are those that the files show, as a move
    of the location would not move partitions listed in the catalog."""
    setting = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(setting)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.conf.set(setting, "false")
    try:
        spark.catalog.createTable(name, path=version, source=fmt, schema=None if partition_by else df.schema)
    finally:
        spark.conf.set(setting, before)


def _ranged(df: DataFrame, column: str, ranges_from: DataFrame | None) -> DataFrame:
    """As many parts as a shuffle has, each a range of the column in order; nulls and NaN lie in one part."""
    parts = max(shuffle_partitions(df.sparkSession), 1)
    key = F.col(f"`{column}`")
    numeric = isinstance(df.schema[column].dataType, T.NumericType)
    if ranges_from is None or not numeric or parts == 1:
        return df.repartitionByRange(parts, key).sortWithinPartitions(key)
    cuts = ranges_from.select(key.cast("double").alias("_at")).approxQuantile("_at", [i / parts for i in range(1, parts)], 0.1 / parts)
    ends = [-math.inf, *sorted({c for c in cuts if math.isfinite(c)}), math.inf]
    ranges = Bucketizer(splits=ends if len(ends) > 2 else [-math.inf, 0.0, math.inf], inputCol="_at", outputCol="_part", handleInvalid="keep")
    placed = ranges.transform(df.withColumn("_at", key.cast("double")))
    part = F.coalesce(F.col("_part"), F.lit(0)).cast("int") % F.lit(parts)
    return placed.repartitionById(parts, part).drop("_at", "_part").sortWithinPartitions(key)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
               partition_by: list[str] | None = None, cluster_by: str | None = None, keep: int = 1,
               ranges_from: DataFrame | None = None, rows_per_file: int = 0) -> str:
    """Full-overwrite save into the catalog as a new version below ``path``; returns the name.
    ``rows_per_file`` bounds the rows of a file (0: as the session says)."""
    spark = df.sparkSession
    root = (path or table_root(spark, name)).rstrip("/")
    former = location(spark, name)
    number = int(m[1]) if former and (m := _VERSION.search(former)) else max(versions(spark, root), default=0)
    version = f"{root}/v-{number + 1:06d}-{uuid.uuid4().hex[:12]}"
    if cluster_by:
        df = _ranged(df, cluster_by, ranges_from)
    writer = df.write.format(fmt)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if fmt == "parquet":
        writer = writer.option("compression", COMPRESSION)
    if cluster_by and fmt == "parquet":
        writer = (writer.option(f"parquet.bloom.filter.enabled#{cluster_by}", "true")
                  .option("parquet.block.size", str(BLOCK_BYTES)))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(version)
    except Exception:
        _remove(spark, version)
        raise
    if former and _VERSION.search(former) and _same_columns(df, spark.table(name), partition_by or []):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    else:
        _create(spark, name, version, fmt, df, partition_by)
    for old, folders in versions(spark, root).items():
        if old < number + 1 - keep:
            for folder in folders:
                _remove(spark, folder)
    return name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def drop_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Drop the table with all its versions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _remove(spark, path or table_root(spark, name))
