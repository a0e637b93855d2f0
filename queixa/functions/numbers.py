"""Numeric expressions: the two rounding rules, safe division, rates and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from queixa.fixed_values import NO_VALUE


def round_half_even(c: Column, places: int) -> Column:
    """Scale, round half to even, unscale: the rule behind every stored percentage."""
    scale = float(10**places)
    return F.rint(c.cast("double") * scale) / scale


def round_half_away(c: Column, places: int) -> Column:
    """Round half away from zero: the rule of the measure layer."""
    scale = float(10**places)
    value = c.cast("double")
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale


def ratio(part: Column, whole: Column) -> Column:
    """Safe division: NULL where the divisor is 0 or either side is missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def percent_change(now: Column, before: Column) -> Column:
    """Change against `before` in percent, two decimals, NULL on a missing or zero base."""
    return round_half_even(ratio(now - before, before) * 100, 2)


def per_100k(volume: Column, millions: Column) -> Column:
    """Complaints per 100,000 subscribers, the base given in millions."""
    return volume / (millions * 1000) * 100


def one_decimal_percent(fraction: Column) -> Column:
    """`0.719` as `71.9%`."""
    return F.format_string("%.1f%%", round_half_away(fraction * 100, 1))


def signed_percent(fraction: Column) -> Column:
    """`0.049` as `+4.9%`, a missing value as `--`."""
    rounded = round_half_away(fraction * 100, 1)
    return F.when(fraction.isNull(), F.lit(NO_VALUE)).otherwise(
        F.concat(
            F.when(rounded > 0, F.lit("+")).when(rounded < 0, F.lit("-")).otherwise(F.lit("")),
            F.format_string("%.1f%%", F.abs(rounded)),
        )
    )


def thousands(c: Column) -> Column:
    """`2908` as `2,908`."""
    return F.format_number(c, 0)
