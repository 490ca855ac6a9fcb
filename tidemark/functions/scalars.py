"""Scalar semantics shared by the operators, as column expressions."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

PPM = 1_000_000


def ceil_ratio(numerator: Column, denominator: Column | int) -> Column:
    """Smallest integer not under numerator / denominator; both non-negative longs."""
    bottom = F.lit(denominator) if isinstance(denominator, int) else denominator
    return floor_ratio(numerator + bottom - F.lit(1), bottom)


def floor_ratio(numerator: Column, denominator: Column | int) -> Column:
    """Largest integer not over numerator / denominator, for any sign; the denominator is positive."""
    bottom = F.lit(denominator) if isinstance(denominator, int) else denominator
    return F.call_function("div", numerator - F.pmod(numerator, bottom), bottom)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator of doubles as IEEE 754 has it: over zero it is an infinity, or NaN from zero and NaN; null only from null."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    # Spark has one zero: -0.0 compares equal to 0.0, and its sign shows in the text alone
    sign = F.signum(top) * F.when(bottom.cast("string") == "-0.0", F.lit(-1.0)).otherwise(F.lit(1.0))
    over_zero = F.when(F.isnan(top) | (top == 0), F.lit(math.nan)).otherwise(sign * F.lit(math.inf))
    return F.when(top.isNull() | bottom.isNull(), F.lit(None).cast("double")).when(bottom == 0, over_zero).otherwise(F.try_divide(top, bottom))


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero, in decimal arithmetic."""
    return F.round(value.cast("decimal(38,12)"), digits)


def round_binary(value: Column, digits: int) -> Column:
    """A double rounded half away from zero as DuckDB's ROUND does: by the double value * 10^digits, not by its decimal text."""
    power = F.lit(10.0**digits)
    rounded = F.round(value * power) / power
    return F.when(finite(rounded), rounded).otherwise(value)


def finite(value: Column) -> Column:
    """True for numbers that are neither null, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(math.inf))


def utf8_bytes(value: Column) -> Column:
    return F.octet_length(value.cast("string"))


def day_key(value: Column) -> Column:
    """The first ten characters of a written time."""
    return F.substring(value, 1, 10)


def venue(code: Column) -> Column:
    """What stands after the last dot of a code."""
    return F.substring_index(code, ".", -1)


def stable_bucket(value: Column, buckets: int) -> Column:
    """The first eight bytes of a text's SHA-256, as an unsigned number, modulo ``buckets``."""
    number = F.conv(F.substring(F.sha2(value, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (number % F.lit(buckets).cast("decimal(20,0)")).cast("int")


def content_hash(*columns: Column) -> Column:
    """SHA-256 of a row's columns as JSON, nulls included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from one time without zone to a later one."""
    return floor_ratio(F.timestamp_diff("MICROSECOND", start, end), 60_000_000)


def half_open(value: Column, start, end) -> Column:
    """start <= value < end."""
    return (value >= F.lit(start)) & (value < F.lit(end))


def normal_cdf(x: float) -> float:
    return NormalDist().cdf(x)


def two_sided_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def expected_maximum(deviation: float, trials: float) -> float:
    """Expected largest of ``trials`` independent normal values of that deviation (Bailey, Lopez de Prado 2014)."""
    if trials <= 1 or deviation == 0:
        return 0.0
    gamma, normal = 0.5772156649015329, NormalDist()
    return deviation * max(0.0, -(1 - gamma) * normal.inv_cdf(1 / trials) - gamma * normal.inv_cdf(math.exp(-1) / trials))
