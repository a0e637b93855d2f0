"""Aggregations. Each starts from a grouping of the fact, so that partial sums are made
where the rows are read and only one row per group and task is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from queixa.fixed_values import ANSWERED, HHI_SCALE
from queixa.functions.numbers import ratio, round_half_even
from queixa.functions.text import contains_ignoring_case

Q = "qtd"


def answered(status: Column | None = None) -> Column:
    """Answered complaints are recognised by the word, in any case."""
    return contains_ignoring_case(F.col("status") if status is None else status, ANSWERED)


def total(where: Column | None = None) -> Column:
    """Sum of the additive unit, optionally of the rows that satisfy a condition."""
    return F.sum(Q) if where is None else F.sum(F.when(where, F.col(Q)).otherwise(0))


def _without_missing(grouped: DataFrame, *keys: str) -> DataFrame:
    """Drop groups of a missing key.

    The test is on a count, not on the key: it stays above the grouping, so queries that
    share a grouping keep sharing it, and the grand total beside it keeps all rows.
    """
    present = [f"_has_{k}" for k in keys]
    return grouped.where(" AND ".join(f"{p} > 0" for p in present)).drop(*present)


def _presence(*keys: str) -> list[Column]:
    return [F.count(k).alias(f"_has_{k}") for k in keys]


def volume_by(frame: DataFrame, *keys: str) -> DataFrame:
    """Volume per key. Missing keys get no group."""
    grouped = frame.groupBy(*keys).agg(total().alias("volume"), *_presence(*keys))
    return _without_missing(grouped, *keys)


def with_grand_total(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sum of all groups beside each, the group of a missing key included.

    Groups of one key are as few as its labels. Those of several are too many for a window in one task: there it
    is one value of a subquery that shares the grouping's shuffle."""
    total = F.sum("volume").over(W.partitionBy()) if len(keys) == 1 else grouped.select(F.sum("volume")).scalar()
    return grouped.withColumn("geral", total)


def volume_and_total_by(frame: DataFrame, *keys: str) -> DataFrame:
    """Volume and grand total per key."""
    grouped = frame.groupBy(*keys).agg(total().alias("volume"), *_presence(*keys))
    return _without_missing(with_grand_total(grouped, keys), *keys)


def resolution_by(frame: DataFrame, *keys: str) -> DataFrame:
    """Volume, answered volume and grand total per key."""
    grouped = frame.groupBy(*keys).agg(
        total().alias("volume"), total(answered()).alias("respondidas"), *_presence(*keys))
    return _without_missing(with_grand_total(grouped, keys), *keys)


def hhi(shares_of: DataFrame, volume: str = "volume") -> DataFrame:
    """Concentration index of a frame with one row per member."""
    v = F.col(volume).cast("double")
    share = v / F.sum(v).over(W.partitionBy())
    return shares_of.select((share * share).alias("_s")).agg((F.sum("_s") * HHI_SCALE).alias("hhi"))


def spread_and_mean(rates: DataFrame, rate: str) -> DataFrame:
    """Largest minus smallest group rate, and the unweighted mean of the rates."""
    return rates.agg(
        (F.max(rate) - F.min(rate)).alias("gap"), F.avg(rate).alias("media"))


def arg_max(df: DataFrame, label: str, value: str) -> DataFrame:
    """The row with the largest value; the smallest label wins a tie."""
    return df.orderBy(F.desc(value), label).limit(1)


def matrix(frame: DataFrame, rows: str, columns: str, labels: Sequence[str]) -> DataFrame:
    """Volume of `rows` x `columns`, one column per given label, 0 where nothing happened."""
    cells = volume_by(frame, rows, columns)
    return cells.groupBy(rows).pivot(columns, list(labels)).agg(F.sum("volume")).na.fill(0)


def drill(frame: DataFrame, outer: str, inner: str, axis: str) -> DataFrame:
    """Volume of `outer` x `axis` and, one level down, of `inner` inside it.

    `nivel` is 0 for the expanded rows and 1 for the folded ones.
    """
    cells = frame.groupBy(outer, inner, axis).agg(total().alias("volume"))
    both = cells.groupingSets(
        [[F.col(outer), F.col(inner), F.col(axis)], [F.col(outer), F.col(axis)]],
        F.col(outer), F.col(inner), F.col(axis),
    ).agg(F.sum("volume").alias("volume"), F.grouping(inner).cast("int").alias("nivel"))
    return both.select(outer, inner, axis, "nivel", "volume")


def null_audit(df: DataFrame) -> DataFrame:
    """Columns that have missing cells: how many, what share, of which type. One pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(df.schema)])
    entries = F.array(*[
        F.struct(F.lit(f.name).alias("coluna"), F.col(f"n{i}").alias("nulos"),
                 F.lit(f.dataType.simpleString()).alias("tipo"))
        for i, f in enumerate(df.schema)])
    return (counts.select("_rows", F.inline(entries)).where("nulos > 0")
            .select("coluna", "nulos",
                    round_half_even(ratio(F.col("nulos"), F.col("_rows")) * 100, 2).alias("nulos_pct"),
                    "tipo")
            .orderBy(F.desc("nulos_pct"), "coluna"))


def duplicate_audit(df: DataFrame) -> DataFrame:
    """Rows equal to another one, beyond the first of each kind, and their share.

    Copies collapse before the shuffle: a group of a third of all rows costs one row per task.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.sum("_n").alias("linhas"), F.sum(F.col("_n") - 1).alias("duplicadas")).select(
        "linhas", "duplicadas",
        round_half_even(ratio(F.col("duplicadas"), F.col("linhas")) * 100, 1).alias("duplicadas_pct"))


def monthly_average(frame: DataFrame, *keys: str) -> DataFrame:
    """Mean of the monthly totals over the months that have data."""
    months = frame.groupBy(*keys, "mes_idx").agg(total().alias("volume"))
    return months.groupBy(*keys).agg(F.avg("volume").alias("media_mensal"))


def monthly_spread(frame: DataFrame, *keys: str) -> DataFrame:
    """Mean and population standard deviation of the monthly totals."""
    months = frame.groupBy(*keys, "mes_idx").agg(total().alias("volume"))
    return months.groupBy(*keys).agg(
        F.avg("volume").alias("media"), F.stddev_pop("volume").alias("desvio"))


def month_spine(months: DataFrame, keys: Sequence[str], volume: str = "volume") -> DataFrame:
    """Every month between the first and last of the frame, for every key; 0 where a key has none.

    Each key's own rows are laid on the common span (a one-row aggregate) by exploding a sequence,
    so keys are never paired with a table of months. A key holds at most one entry per month.
    """
    span = F.sequence(months.select(F.min("mes_idx")).scalar(), months.select(F.max("mes_idx")).scalar())
    by_key = months.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("mes_idx", volume))).alias("_v"))
    return by_key.select(*keys, span.alias("_span"), "_v").select(
        *keys, F.explode("_span").alias("mes_idx"), "_v"
    ).select(*keys, "mes_idx",
             F.coalesce(F.try_element_at("_v", F.col("mes_idx")), F.lit(0)).alias(volume))


def slope(spine: DataFrame, keys: Sequence[str], volume: str = "volume") -> DataFrame:
    """Least-squares slope of the volume over the month index, per key."""
    return spine.groupBy(*keys).agg(
        F.regr_slope(F.col(volume).cast("double"), F.col("mes_idx").cast("double")).alias("inclinacao"))
