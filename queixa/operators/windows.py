"""Window operators. They run over aggregates (one row per label, or label and month),
never over complaint rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from queixa.fixed_values import MIN_MAX_EPSILON
from queixa.functions.numbers import percent_change, ratio, round_half_even


def rank_with_gaps(value: Column, *inside: str) -> Column:
    """Largest first; ties share the smaller rank and leave a gap."""
    return F.rank().over(W.partitionBy(*inside).orderBy(value.desc()))


def rank_dense(value: Column, *inside: str) -> Column:
    """Largest first; ties share a rank, no gaps, a missing value ranks as 0."""
    return F.dense_rank().over(W.partitionBy(*inside).orderBy(F.coalesce(value, F.lit(0)).desc()))


def share(value: Column, *inside: str) -> Column:
    """Part of the sum over the rows of `inside` (all rows when empty)."""
    return ratio(value, F.sum(value).over(W.partitionBy(*inside)))


def min_max(value: Column) -> Column:
    """Scaled to 0..1 between the smallest and the largest member."""
    everyone = W.partitionBy()
    low, high = F.min(value).over(everyone), F.max(value).over(everyone)
    return (value - low) / (high - low + MIN_MAX_EPSILON)


def over_largest(value: Column, *inside: str) -> Column:
    """Divided by the largest member; 0 where that is impossible."""
    return F.coalesce(ratio(value, F.max(value).over(W.partitionBy(*inside))), F.lit(0.0))


def z_score(value: Column, *inside: str) -> Column:
    """Distance from the mean in population standard deviations; NULL when nothing varies."""
    group = W.partitionBy(*inside)
    return F.try_divide(value - F.avg(value).over(group),
                        F.nullif(F.stddev_pop(value).over(group), F.lit(0.0)))


def with_row_changes(monthly: DataFrame, key: str, month: str, volume: str = "volume") -> DataFrame:
    """Previous row, row twelve back, their changes and the mean of the last three rows.

    These count rows: a month without complaints is skipped, not taken as zero.
    """
    rows = W.partitionBy(key).orderBy(month)
    v = F.col(volume)
    with_lags = monthly.withColumns({
        "volume_mes_anterior": F.lag(v, 1).over(rows),
        "volume_ano_anterior": F.lag(v, 12).over(rows),
        "media_movel_3m": round_half_even(F.avg(v).over(rows.rowsBetween(-2, 0)), 1),
    })
    return with_lags.withColumns({
        "var_mom_pct": percent_change(v, F.col("volume_mes_anterior")),
        "var_yoy_pct": percent_change(v, F.col("volume_ano_anterior")),
    })


def month_back(value: Column, months: int, keys: Sequence[str], month: str = "mes_idx") -> Column:
    """The value `months` calendar months earlier, NULL when that month has none."""
    w = W.partitionBy(*keys).orderBy(month).rangeBetween(-months, -months)
    return F.sum(value).over(w)


def trailing_months(value: Column, months: int, keys: Sequence[str], month: str = "mes_idx") -> Column:
    """Mean over the last `months` calendar months that have a value."""
    return F.avg(value).over(W.partitionBy(*keys).orderBy(month).rangeBetween(-(months - 1), 0))


def year_to_date(value: Column, keys: Sequence[str], year: str = "ano", month: str = "mes_idx") -> Column:
    w = W.partitionBy(*keys, year).orderBy(month).rangeBetween(W.unboundedPreceding, 0)
    return F.sum(value).over(w)


def pareto(volumes: DataFrame, key: str, volume: str = "volume") -> DataFrame:
    """Rounded shares in descending volume and their running sum."""
    shares = volumes.withColumn("share_pct", round_half_even(share(F.col(volume)) * 100, 2))
    running = W.orderBy(F.desc(volume), key).rowsBetween(W.unboundedPreceding, 0)
    return shares.withColumn("cumshare", round_half_even(F.sum("share_pct").over(running), 2))


def first_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """Exactly k rows (a report's top k), by a total order."""
    return df.orderBy(*order).limit(k)


def top_k_with_ties(df: DataFrame, k: int, value: str, *inside: str) -> DataFrame:
    """The k largest, and whatever ties with the last of them."""
    ranked = df.withColumn("_rank", rank_with_gaps(F.col(value), *inside))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def single_or(many: Column, label: Column) -> Column:
    """In an aggregate: the label when the group has one row, else `many`."""
    return F.when(F.count(F.lit(1)) == 1, F.max(label)).otherwise(many)
