"""Dense numbers 1..n without one task that sorts or counts all rows.

A stored row is known by the partition that wrote it and its position there. Once stored, both
are fixed, whatever tasks are lost and run again; a partition's first number is the number of
rows in the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from queixa.session import write_and_read_back

PART, POSITION = "_parte", "_posicao"
# A row's place is the lower part of Spark's own row number, the partition the upper.
_INSIDE = (1 << 33) - 1


def with_positions(rows: DataFrame) -> DataFrame:
    """Rows with their partition and position, to be stored as they are."""
    return rows.withColumns({
        PART: F.spark_partition_id(), POSITION: F.monotonically_increasing_id().bitwiseAND(F.lit(_INSIDE))})


def has_positions(rows: DataFrame) -> bool:
    return {PART, POSITION} <= set(rows.columns)


def numbered(stored: DataFrame, id_column: str, kind: str = "long") -> DataFrame:
    """Stored rows with their numbers in place of their positions."""
    counts = stored.groupBy(PART).agg(F.count(F.lit(1)).alias("_linhas"))
    # one row per partition that wrote rows
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(PART, F.coalesce(F.sum("_linhas").over(before), F.lit(0)).alias("_inicio"))
    rest = [c for c in stored.columns if c not in (PART, POSITION)]
    return stored.join(F.broadcast(starts), PART).select(
        (F.col("_inicio") + F.col(POSITION) + 1).cast(kind).alias(id_column), *rest)


def numbered_by_key(rows: DataFrame, id_column: str, keys: Sequence[str], kind: str = "int", partitions: int | None = None) -> DataFrame:
    """Rows numbered in the order of distinct keys, a null key first.

    They are dealt out by ranges of the whole key, so keys with one common beginning are
    sorted by many tasks too."""
    dealt = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    return numbered(write_and_read_back(with_positions(dealt.sortWithinPartitions(*keys)), "numerados"), id_column, kind)
