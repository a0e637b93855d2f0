"""Exact ranks within groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A group's rows are dealt to 2**BITS buckets by their order value; a task sorts single buckets.
BITS = 12
ORDER_BITS = 63


def order_value(*columns: Column | str, seed: int = 0) -> Column:
    """A seeded order: a hash from 0 to 2**63 - 1."""
    return F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << 63) - 1))


def ranked(rows: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """`rows` with their rank from 0 within `keys` (never null) by `order`, a long from 0 to 2**63 - 1, then `ties`.

    Counts per key and bucket of the order's high bits give each bucket's offset; only rows of
    one bucket are sorted together. Rows equal in all of these columns rank in any order.
    """
    rows = rows.withColumn("_bucket", F.shiftright(order, ORDER_BITS - BITS))
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order, *ties)
    joined = rows.join(offsets, [*keys, "_bucket"])
    return joined.withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1).drop("_bucket", "_offset")
