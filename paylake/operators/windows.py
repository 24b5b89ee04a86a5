"""Gold features: calendar flags and trailing-window behaviour features.

W1/W2  customer spending: rows of the same customer with time in
       [t - n days, t] (both ends inclusive, same-second peers included):
       count(*) and mean amount, for n = 1, 7, 30.
W3/W4  terminal risk with a label delay d: rows of the same terminal with
       time in [t - (d + n) days, t - d days - 1 s]: count(*) and
       sum(TX_FRAUD) / count(*), 0 when the frame is empty.

Frame sums come from :mod:`paylake.operators.prefix`: rows pass through one
shuffle per key family, groups are bounded whatever the key skew, and there is
one pass per frame edge instead of a sliding re-aggregation.

A mean is the exact quotient over its frame, rounded once to a double, however
far apart the amounts are: those of whole cents count as that decimal
number and are summed in cents, other finite ones as the binary number they are and
are summed by digits (:mod:`paylake.functions.exact`).  The digits are those that the
amounts' magnitudes need, which the pass that counts the groups also finds; a
table of whole cents takes none.  NaN and infinities are counted, and the mean is
then what ``avg`` gives: NaN if the frame holds a NaN or both infinities, else the
infinity it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions.exact import exact_mean, limb, limb_range
from paylake.functions.time import (SECONDS_PER_DAY, epoch_seconds, is_whole_cents, night_flag,
                                    to_minor_units, weekend_flag)
from paylake.operators.prefix import Frames, hot_groups, survey_groups, with_frames

DEFAULT_WINDOWS = (1, 7, 30)
DEFAULT_DELAY = 7
WHOLE = 1 << 53  # cents below it are exact as a double


def add_calendar_flags(df: DataFrame, ts: str = "TX_DATETIME") -> DataFrame:
    """TX_DURING_WEEKEND (Sat/Sun) and TX_DURING_NIGHT (00:00-05:59:59)."""
    return df.withColumns({"TX_DURING_WEEKEND": weekend_flag(ts), "TX_DURING_NIGHT": night_flag(ts)})


def add_epoch(df: DataFrame, ts: str = "TX_DATETIME") -> DataFrame:
    """TX_TS: whole epoch seconds, the ordering column of every frame."""
    return df if "TX_TS" in df.columns else df.withColumn("TX_TS", epoch_seconds(ts))


def customer_frames(windows_days=DEFAULT_WINDOWS) -> dict[str, tuple[int, int]]:
    return {f"c{n}": (-n * SECONDS_PER_DAY, 0) for n in windows_days}


def terminal_frames(delay_days=DEFAULT_DELAY, windows_days=DEFAULT_WINDOWS) -> dict[str, tuple[int, int]]:
    d = delay_days * SECONDS_PER_DAY
    return {f"t{n}": (-(d + n * SECONDS_PER_DAY), -d - 1) for n in windows_days}


def _is_binary(a: Column) -> Column:
    """Finite and not of whole cents."""
    return F.coalesce((F.abs(a) < F.lit(float("inf"))) & ~F.isnan(a) & ~is_whole_cents(a), F.lit(False))


def survey(df: DataFrame, families: dict[str, Frames], bucket_seconds: int | None = None,
           group_rows: int | None = None) -> tuple[dict[str, DataFrame | None], range]:
    """The hot groups of each family and the digits that the amounts need, in one pass."""
    size = F.when(_is_binary(F.col("TX_AMOUNT").cast("double")), F.abs(F.col("TX_AMOUNT").cast("double")))
    hot, extremes = survey_groups(df, "TX_TS", families, size, bucket_seconds, group_rows)
    return hot, limb_range(*extremes)


def _amount_measures(amount: str, limbs: range) -> dict[str, Column]:
    """Row measures, all integers, from whose sums :func:`_mean` rebuilds the mean."""
    a = F.col(amount).cast("double")
    zero = F.lit(0).cast("bigint")

    def flag(condition):
        return F.when(F.coalesce(condition, F.lit(False)), 1).otherwise(0).cast("bigint")

    return {
        "na": flag(a.isNotNull()),
        "units": F.when(is_whole_cents(a), to_minor_units(a)).otherwise(zero),
        **{f"limb{k}": F.when(_is_binary(a), limb(a, i)).otherwise(zero) for k, i in enumerate(limbs)},
        "up": flag(F.isnan(a) | (a == F.lit(float("inf")))),
        "down": flag(F.isnan(a) | (a == F.lit(float("-inf")))),
    }


def _short_mean(sums: dict[int, Column], units: Column, n: Column) -> tuple[Column, Column]:
    """(condition, mean) where the sum is a multiple of 2^-24 / 100 of under 53 bits: one division of doubles is exact."""
    low = F.lit(100.0) * sums.get(-1, F.lit(0))
    high = (F.lit(100.0) * sums[0] + units) * F.lit(2.0 ** 24)
    fits = (F.abs(low) < F.lit(2.0 ** 52)) & (F.abs(high) < F.lit(2.0 ** 52))
    for i, s in sums.items():
        if i not in (-1, 0):
            fits = fits & (s == 0)
    return fits, (low + high) / (F.lit(100.0) * n) * F.lit(2.0 ** -24)


def _mean(frame: str, limbs: range) -> Column:
    na, units, up, down = (F.col(f"{frame}__{m}") for m in ("na", "units", "up", "down"))
    finite = units / (F.lit(100.0) * na)
    if limbs:
        sums = {i: F.col(f"{frame}__limb{k}") for k, i in enumerate(limbs)}
        plain = F.abs(units) < WHOLE
        for s in sums.values():
            plain = plain & (s == 0)
        finite = F.when(plain, finite).when(*_short_mean(sums, units, na)).otherwise(exact_mean(sums, units, na))
    return F.when(na > 0, F.when((up > 0) & (down > 0), F.lit(float("nan"))).when(up > 0, F.lit(float("inf")))
                  .when(down > 0, F.lit(float("-inf"))).otherwise(finite))


def _risk(frauds: Column, n: Column) -> Column:
    return F.when(n > 0, frauds / n).otherwise(F.lit(0.0))


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _add_customer(df: DataFrame, windows_days, bucket_seconds: int | None, hot: DataFrame | None, limbs: range) -> DataFrame:
    measures = {"n": _one(), **_amount_measures("TX_AMOUNT", limbs)}
    out = with_frames(df, "CUSTOMER_ID", "TX_TS", ["TX_AMOUNT"], measures, customer_frames(windows_days), bucket_seconds, hot,
                      ("n", "na", "up", "down"))
    cols = []
    for n in windows_days:
        cols += [F.col(f"c{n}__n").alias(f"CUSTOMER_ID_NB_TX_{n}DAY_WINDOW"),
                 _mean(f"c{n}", limbs).alias(f"CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW")]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *cols)


def _add_terminal(df: DataFrame, delay_days: int, windows_days, bucket_seconds: int | None, hot: DataFrame | None) -> DataFrame:
    measures = {"n": _one(), "fraud": F.coalesce(F.col("TX_FRAUD").cast("bigint"), F.lit(0).cast("bigint"))}
    out = with_frames(df, "TERMINAL_ID", "TX_TS", ["TX_FRAUD"], measures, terminal_frames(delay_days, windows_days),
                      bucket_seconds, hot)
    cols = []
    for n in windows_days:
        cnt, fraud = F.col(f"t{n}__n"), F.col(f"t{n}__fraud")
        cols += [cnt.alias(f"TERMINAL_ID_NB_TX_{n}DAY_WINDOW"),
                 _risk(fraud, cnt).alias(f"TERMINAL_ID_RISK_{n}DAY_WINDOW")]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *cols)


def with_customer_spending(df: DataFrame, windows_days=DEFAULT_WINDOWS,
                           bucket_seconds: int | None = None, group_rows: int | None = None) -> DataFrame:
    """Adds TX_TS and the 2 x len(windows_days) customer features."""
    df = add_epoch(df)
    families = {"CUSTOMER_ID": customer_frames(windows_days)}
    hot, limbs = survey(df, families, bucket_seconds, group_rows)
    return _add_customer(df, windows_days, bucket_seconds, hot["CUSTOMER_ID"], limbs)


def with_terminal_risk(df: DataFrame, delay_days: int = DEFAULT_DELAY, windows_days=DEFAULT_WINDOWS,
                       bucket_seconds: int | None = None, group_rows: int | None = None) -> DataFrame:
    """Adds TX_TS and the 2 x len(windows_days) delayed terminal features."""
    df = add_epoch(df)
    families = {"TERMINAL_ID": terminal_frames(delay_days, windows_days)}
    hot = hot_groups(df, "TX_TS", families, bucket_seconds, group_rows)
    return _add_terminal(df, delay_days, windows_days, bucket_seconds, hot["TERMINAL_ID"])


def gold_features(silver: DataFrame, windows_days=DEFAULT_WINDOWS, delay_days: int = DEFAULT_DELAY,
                  bucket_seconds: int | None = None, group_rows: int | None = None) -> DataFrame:
    """Silver transactions -> the gold feature table (silver + 15 columns).

    The rows go through one shuffle per key family, on (customer, bucket) and on
    (terminal, bucket).  Groups too large for a task, counted beforehand in one
    pass over keys and times, are pre-aggregated and joined back.
    """
    df = add_epoch(add_calendar_flags(silver))
    families = {"CUSTOMER_ID": customer_frames(windows_days), "TERMINAL_ID": terminal_frames(delay_days, windows_days)}
    hot, limbs = survey(df, families, bucket_seconds, group_rows)
    df = _add_customer(df, windows_days, bucket_seconds, hot["CUSTOMER_ID"], limbs)
    df = _add_terminal(df, delay_days, windows_days, bucket_seconds, hot["TERMINAL_ID"])
    ordered = list(silver.columns) + ["TX_DURING_WEEKEND", "TX_DURING_NIGHT", "TX_TS"]
    ordered += [f"CUSTOMER_ID_{m}_{n}DAY_WINDOW" for n in windows_days for m in ("NB_TX", "AVG_AMOUNT")]
    ordered += [f"TERMINAL_ID_{m}_{n}DAY_WINDOW" for n in windows_days for m in ("NB_TX", "RISK")]
    return df.select(*ordered)
