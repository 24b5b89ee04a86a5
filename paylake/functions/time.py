"""Calendar and epoch functions on transaction timestamps.

All inputs are ``timestamp_ntz`` wall-clock values, so results do not depend
on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 (fraction truncated), bigint."""
    return F.unix_timestamp(_c(ts))


def weekend_flag(ts: str | Column) -> Column:
    """1 on Saturday or Sunday, else 0; NULL time gives 0."""
    return F.when(F.weekday(_c(ts)) >= 5, 1).otherwise(0)


def night_flag(ts: str | Column) -> Column:
    """1 from 00:00:00 to 05:59:59 inclusive, else 0; NULL time gives 0."""
    return F.when(F.hour(_c(ts)).between(0, 5), 1).otherwise(0)


def seconds_since(ts: str | Column, origin: str) -> Column:
    """Whole seconds between ``origin`` (``yyyy-MM-dd[ HH:mm:ss]``) and ``ts``."""
    return epoch_seconds(ts) - F.unix_timestamp(F.lit(origin).cast("timestamp_ntz"))


def day_index(seconds: str | Column) -> Column:
    """Floor of seconds / 86400: the 0-based day number of a seconds offset."""
    return F.floor(_c(seconds) / F.lit(SECONDS_PER_DAY)).cast("int")


def second_of_day(seconds: str | Column) -> Column:
    return F.pmod(_c(seconds), F.lit(SECONDS_PER_DAY)).cast("int")


def timestamp_from_offset(seconds: str | Column, origin: str) -> Column:
    """``origin`` + ``seconds`` as a timestamp_ntz."""
    return F.timestamp_add("SECOND", _c(seconds), F.lit(origin).cast("timestamp_ntz"))


def round_half_even(x: str | Column, scale: int = 2) -> Column:
    """Banker's rounding, as numpy rounds amounts."""
    return F.bround(_c(x), scale)


def is_whole_cents(amount: str | Column) -> Column:
    """True for amounts of at most two decimals, small enough to count in cents."""
    a = _c(amount)
    return F.coalesce((F.bround(a, 2) == a) & (F.abs(a) < F.lit(9e13)), F.lit(False))


def to_minor_units(amount: str | Column) -> Column:
    """Whole-cent amount as an exact integer number of cents, so that sums over
    frames are exact and differences of running sums lose nothing."""
    return F.round(_c(amount) * F.lit(100), 0).cast("bigint")
