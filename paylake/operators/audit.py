"""Data-quality audits (A1, S7, cast loss).

All audits are single-pass global aggregates: partial counts per task,
one tiny final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators.conform import typed_column


def null_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: total_rows and nulls_<column> for every column (0 on empty input)."""
    cols = columns or df.columns
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols])


def observed_null_audit(df: DataFrame):
    """(df, audit): the rows with counters on them, and a function that gives their
    :func:`null_audit` once an action has read them all, without another pass."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("total_rows"),
              *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in df.columns]]
    names = ["total_rows", *[f"nulls_{c}" for c in df.columns]]

    def audit() -> DataFrame:
        got = seen.get
        return df.sparkSession.createDataFrame([tuple(int(got[n]) for n in names)], ", ".join(f"`{n}` bigint" for n in names))

    return df.observe(seen, *counts), audit


def cast_loss_audit(bronze: DataFrame, layout: list[tuple[str, str]]) -> DataFrame:
    """Per declared column: NULLs before typing, after typing, and cells lost by typing."""
    aggs = []
    for c, t in layout:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"b_{c}"),
                 F.count_if(typed_column(F.col(c), t).isNull()).alias(f"s_{c}")]
    wide = bronze.agg(*aggs)
    stack = ", ".join(f"'{c}', `b_{c}`, `s_{c}`" for c, _ in layout)
    long = wide.selectExpr(f"stack({len(layout)}, {stack}) AS (column_name, bronze_nulls, silver_nulls)")
    return long.withColumn("lost_cells", F.col("silver_nulls") - F.col("bronze_nulls"))


def schema_report(bronze: DataFrame, layout: list[tuple[str, str]]) -> DataFrame:
    """Per declared column: position, actual and declared type, filled cells before and
    after typing (one pass over the data).  A column that is missing has type ``missing``
    and no cells."""
    actual = {f.name: f.dataType.simpleString() for f in bronze.schema.fields}
    aggs = []
    for c, t in layout:
        cell = F.col(f"`{c}`") if c in actual else F.lit(None).cast("string")
        aggs += [F.count(cell).alias(f"b_{c}"), F.count(typed_column(cell.cast("string"), t)).alias(f"s_{c}")]
    wide = bronze.agg(*aggs)
    parts = []
    for pos, (c, t) in enumerate(layout):
        parts.append(f"{pos}, '{c}', '{actual.get(c, 'missing')}', '{t}', `b_{c}`, `s_{c}`")
    return wide.selectExpr(
        f"stack({len(layout)}, {', '.join(parts)}) AS "
        "(position, column_name, actual_type, declared_type, filled_cells, typed_cells)")


def _fields(schema: T.StructType, prefix: str = "") -> list[tuple[str, int, str, bool]]:
    """(path, position among its siblings, type, nullable) of every field, nested ones by dotted path."""
    out = []
    for i, f in enumerate(schema.fields):
        path = f"{prefix}{f.name}"
        out.append((path, i, f.dataType.simpleString(), f.nullable))
        inner = f.dataType
        while isinstance(inner, T.ArrayType):
            path, inner = f"{path}[]", inner.elementType
        if isinstance(inner, T.StructType):
            out += _fields(inner, f"{path}.")
    return out


def schema_drift(spark: SparkSession, actual: T.StructType, declared: T.StructType) -> DataFrame:
    """Differences between two schemas, a row each; none if they agree.

    (field, drift, actual_position, declared_position, actual_type, declared_type) by full
    outer join of their fields, nested ones by dotted path.  ``drift`` is missing,
    extra, retyped, or reordered: of the fields that both have, those whose rank among
    them differs.  A field that is retyped and reordered gives two rows.
    """
    ddl = "field string, position int, type string, nullable boolean"
    a, d = (spark.createDataFrame(_fields(s), ddl) for s in (actual, declared))
    parent = F.regexp_extract("field", r"^(.*?)[^.]*$", 1)
    both = a.select("field").intersect(d.select("field"))

    def ranked(side: DataFrame, name: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(parent).orderBy("position"))
        shared = side.join(both, "field").select("field", place.alias(f"{name}_rank"))
        return side.select("field", F.col("position").alias(f"{name}_position"), F.col("type").alias(f"{name}_type")).join(shared, "field", "left")

    rows = ranked(a, "actual").join(ranked(d, "declared"), "field", "full_outer")
    found = F.array_compact(F.array(
        F.when(F.col("actual_type").isNull(), F.lit("missing")),
        F.when(F.col("declared_type").isNull(), F.lit("extra")),
        F.when(F.col("actual_type") != F.col("declared_type"), F.lit("retyped")),
        F.when(F.col("actual_rank") != F.col("declared_rank"), F.lit("reordered"))))
    return rows.select("field", F.explode(found).alias("drift"), "actual_position", "declared_position", "actual_type", "declared_type")
