"""Schema-driven typing of bronze text into silver.

One ``select`` built from a declared layout: every declared column is typed,
names and positions are kept, other columns pass through.  Tolerant mode
(default) turns malformed cells into NULL (``try_cast`` /
``try_to_timestamp``) so audits can count them; strict mode raises on the
first bad cell, as an ANSI cast does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions.text import parse_id_list
from paylake.sources.schemas import DATETIME_FORMAT, LAYOUTS


def typed_column(c: Column, dtype: str, strict: bool = False, fmt: str = DATETIME_FORMAT) -> Column:
    if dtype.startswith("array<"):
        return parse_id_list(c, dtype[len("array<"):-1], strict)
    if dtype == "timestamp_ntz":
        # read as UTC and rebuilt from the epoch: no session zone, so no lost hour in a DST gap
        text, zoned = F.concat(c, F.lit(" +00:00")), f"{fmt} xxx"
        at = F.to_timestamp(text, zoned) if strict else F.try_to_timestamp(text, F.lit(zoned))
        return F.timestamp_add("MICROSECOND", F.unix_micros(at), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if dtype.startswith("timestamp"):
        parsed = F.to_timestamp(c, fmt) if strict else F.try_to_timestamp(c, F.lit(fmt))
        return parsed.cast(dtype)
    return c.cast(dtype) if strict else c.try_cast(dtype)


def conform(df: DataFrame, layout: str | list[tuple[str, str]], strict: bool = False) -> DataFrame:
    """Type the declared columns of ``df``; raise if one is missing."""
    columns = LAYOUTS[layout] if isinstance(layout, str) else layout
    types = dict(columns)
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {missing}")
    return df.select(*[typed_column(F.col(c), types[c], strict).alias(c) if c in types else F.col(c)
                       for c in df.columns])
