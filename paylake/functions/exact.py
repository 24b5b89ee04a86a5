"""Sums of doubles without rounding, and quotients of them rounded once.

A finite double is a signed integer times a power of two, so it splits into
digits of 24 bits with weights 2^(24 i).  Sums of each digit are plain integer
sums: they combine in any order and differences of running sums lose nothing.
A double of any magnitude takes few digits when all doubles summed lie near each
other; ``limb_range`` gives those that a column's least and greatest magnitude need.

``exact_mean`` carries the digit sums, divides them by long division and rounds the
quotient to the nearest double, ties to even.  Only quotients below 2^-1022, where
doubles lose precision themselves, may be rounded a second time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 24               # of a digit: a sum of 2^31 of them, times 100, fits a long
MASK = (1 << BITS) - 1
TOP = 3                 # digits above the sums, for their carries and the sign
FRACTION = 6            # digits of the quotient below those of the sums
LOWEST_BIT = -1074      # exponent of the least double


def limb_range(low: float | None, high: float | None) -> range:
    """Indices of the digits of doubles with magnitude in [low, high], that of 1 among them;
    empty if there are none."""
    if low is None or high is None:
        return range(0)
    first = max(math.frexp(low)[1] - 53, LOWEST_BIT) // BITS
    last = (math.frexp(high)[1] - 1) // BITS
    return range(min(first, 0), max(last, 0) + 1)


def limb(a: Column, i: int) -> Column:
    """Digit ``i`` of the finite double ``a``, with its sign.  Remainder and quotient by powers of two are exact."""
    size, weight, over = F.abs(a), BITS * i, BITS * (i + 1)
    if over < 1024:
        size = size % F.lit(2.0 ** over)
    if weight < LOWEST_BIT + 100:  # the weight itself may be no double
        size, weight = size * F.lit(2.0 ** 200), weight + 200
    digit = F.floor(size / F.lit(2.0 ** weight)).cast("bigint")
    return F.when(a < 0, -digit).otherwise(digit)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def _carried(sums: Column) -> Column:
    """(carry, digits) of digit sums, lowest first: digits in [0, 2^24), carry -1 below zero."""
    start = F.struct(_long(0).alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def step(acc: Column, x: Column) -> Column:
        t = acc["carry"] + x
        return F.struct(F.shiftright(t, BITS).alias("carry"),
                        F.array_append(acc["digits"], t.bitwiseAND(_long(MASK))).alias("digits"))

    return F.aggregate(sums, start, step)


def _rounded(digits: Column, divisor: Column, lowest: int) -> Column:
    """The number of these digits (highest first, the last of weight 2^lowest) over ``divisor``, as a double.

    The quotient's digits fill ``head`` to at least 39 bits; ``tail`` is the digit behind it.  Together
    they give 62 bits, the last of which also stands for all that follows, so that
    the cast to double rounds once.
    """
    full = _long(1 << 38)
    start = F.struct(_long(0).alias("left"), _long(0).alias("head"), _long(0).alias("tail"),
                     F.lit(0).alias("behind"), F.lit(False).alias("more"))

    def step(acc: Column, x: Column) -> Column:
        def put(t: Column) -> Column:
            q, open_ = F.call_function("div", t, divisor), acc["head"] < full
            return F.struct(
                (t % divisor).alias("left"),
                F.when(open_, acc["head"] * _long(1 << BITS) + q).otherwise(acc["head"]).alias("head"),
                F.when(~open_ & (acc["behind"] == 0), q).otherwise(acc["tail"]).alias("tail"),
                F.when(open_, F.lit(0)).otherwise(acc["behind"] + 1).alias("behind"),
                (acc["more"] | ((acc["behind"] > 0) & (q != 0))).alias("more"))
        return _let(acc["left"] * _long(1 << BITS) + x, put)

    def finish(acc: Column) -> Column:
        shift = (F.lit(62) - F.length(F.bin(acc["head"]))).cast("int")
        low = F.lit(BITS) - shift
        bits = F.call_function("shiftleft", acc["head"], shift) + F.call_function("shiftright", acc["tail"], low)
        cut = acc["more"] | (acc["left"] != 0) | (acc["tail"] % F.call_function("shiftleft", _long(1), low) != 0)
        e = F.lit(lowest) + F.lit(BITS) * acc["behind"] - shift
        half = F.floor(e / F.lit(2)).cast("int")
        value = (bits.bitwiseOR(F.when(cut, _long(1)).otherwise(_long(0))).cast("double")
                 * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), e - half))
        return F.when(acc["head"] == 0, F.lit(0.0)).otherwise(value)

    return F.aggregate(digits, start, step, finish)


def exact_mean(sums: dict[int, Column], cents: Column, n: Column) -> Column:
    """(sum of sums[i] * 2^(24 i) + cents / 100) / n as the nearest double, for n < 2^32.

    ``sums`` are digit sums over at most 2^31 rows at consecutive indices, 0 among them.
    """
    first = min(sums)
    parts = [sums[i] * _long(100) + (cents if i == 0 else _long(0)) for i in sorted(sums)]
    parts += [_long(0)] * TOP
    divisor = F.greatest(n, _long(1)) * _long(100)

    def quotient(s: Column) -> Column:
        digits = F.concat(F.reverse(s["digits"]), F.array_repeat(_long(0), FRACTION))
        return _rounded(digits, divisor, BITS * (first - FRACTION))

    def signed(s: Column) -> Column:
        return F.when(s["carry"] < 0, -quotient(_carried(F.array(*[-p for p in parts])))).otherwise(quotient(s))

    return _let(_carried(F.array(*parts)), signed)
