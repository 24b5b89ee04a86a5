"""Raw CSV landing and bronze CSV scans.

Raw files carry a header row and no index column; the bronze layer reads
them back with every column typed as string.  The reader is given the
declared all-string schema with ``enforceSchema=false``, so the header is
checked against the declared names (a reordered file raises instead of
silently shifting values under the wrong names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.config import scratch_dir
from paylake.sources.schemas import DATETIME_FORMAT, LAYOUTS, string_schema


CORRUPT = "_corrupt_record"
# Parquet's zstd as a codec of text files: Hadoop's own needs a native library.  Its window of some MB
# spans several rows of lists, where gzip's 32 KB or blocks of lz4 hold less than one.
ZSTD = "org.apache.parquet.hadoop.codec.ZstandardCodec"
LIST_ROWS = 1000  # rows of a file of lists, so that scans, which pack files by their few bytes, have tasks of equal rows


def list_text(arr: Column, numpy_style: Column | None = None) -> Column:
    """array<bigint> -> Python list text: ``[1, 2]``; or ``[np.int64(1), np.int64(2)]``
    where ``numpy_style`` is true (how numpy >= 2 prints its integers)."""
    ids = arr.cast("array<string>")
    plain = F.concat(F.lit("["), F.array_join(ids, ", "), F.lit("]"))
    if numpy_style is None:
        return plain
    # the wrapping is the separator, so no function is called per id; lists without any id have none to wrap
    wrapped = F.concat(F.lit("[np.int64("), F.array_join(ids, "), np.int64("), F.lit(")]"))
    return F.when(numpy_style & F.array_max(arr).isNotNull(), wrapped).otherwise(plain)


def to_text(df: DataFrame, overrides: dict[str, Column] | None = None) -> DataFrame:
    """Render every column as raw text, as a CSV export would."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in overrides:
            c = overrides[f.name]
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, DATETIME_FORMAT)
        elif isinstance(f.dataType, T.ArrayType):
            c = list_text(c)
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, compression: str = "none", rows_per_file: int = 0) -> str:
    """CSV with header, no index column, full overwrite.  A compressed file is read by one task;
    ``rows_per_file`` bounds its rows (0: as the session says)."""
    writer = df.write.mode("overwrite").option("header", True).option("compression", compression)
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).csv(path)
    return path


def read_bronze_csv(spark: SparkSession, path: str, layout: str, corrupt: bool = False) -> DataFrame:
    """Header CSV -> DataFrame with every declared column as string.

    Rows that are too short, too long or badly quoted are kept with what could be read;
    with ``corrupt`` their raw line stands in the column CORRUPT, NULL for sound rows.
    """
    schema = string_schema(LAYOUTS[layout])
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    # a row is judged by all its cells, whichever columns are asked for
    return (spark.read.option("header", True).option("enforceSchema", False).option("columnPruning", not corrupt)
            .option("io.compression.codecs", ZSTD)  # besides those that Hadoop knows, by the files' extension
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .schema(schema).csv(path))


def quarantine(corrupt_rows: DataFrame) -> DataFrame:
    """(file, line) of the malformed rows of a ``read_bronze_csv(..., corrupt=True)``."""
    # Spark does not read the raw line alone, so the first column is read along with it
    line = F.coalesce(F.col(CORRUPT), F.col(f"`{corrupt_rows.columns[0]}`"))
    return (corrupt_rows.select(F.col("_metadata.file_path").alias("file"), line.alias("line"), CORRUPT)
            .where(F.col(CORRUPT).isNotNull()).select("file", "line"))


def land(spark: SparkSession, text_df: DataFrame, name: str, compression: str = "none", rows_per_file: int = 0) -> str:
    """Write a text DataFrame to a fresh folder of the shared scratch area."""
    return write_csv(text_df, scratch_dir(spark, f"raw-{name}"), compression, rows_per_file)


def inject_bad_transaction_cells(text_df: DataFrame, id_col: str = "TRANSACTION_ID") -> DataFrame:
    """Corrupt chosen cells by key so audits have something to find.

    Fixed values: amount NULL where id % 97 = 0, amount 'abc' where
    id % 97 = 1, datetime 'bad' where id % 89 = 0, customer '596.0' where
    id % 83 = 0.  Every row is kept.
    """
    i = F.col(id_col).cast("bigint")
    return text_df.withColumns({
        "TX_AMOUNT": F.when(i % 97 == 0, F.lit(None).cast("string"))
                      .when(i % 97 == 1, F.lit("abc")).otherwise(F.col("TX_AMOUNT")),
        "TX_DATETIME": F.when(i % 89 == 0, F.lit("bad")).otherwise(F.col("TX_DATETIME")),
        "CUSTOMER_ID": F.when(i % 83 == 0, F.lit("596.0")).otherwise(F.col("CUSTOMER_ID")),
    })
