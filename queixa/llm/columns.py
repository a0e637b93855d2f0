"""Results beside columns of any name. Spark takes `Items` and `items` for one name, so names are compared without case."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(columns: Sequence[str], results: Iterable[str]) -> list[str]:
    """The columns that no result replaces."""
    taken = {r.casefold() for r in results}
    return [c for c in columns if c.casefold() not in taken]


def set_aside(rows: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """The columns under plain names (Python stages take no others), those names, and the way back, results behind them."""
    plain = [f"own {i}" for i in range(len(columns))]

    def back(found: DataFrame) -> DataFrame:
        results = [c for c in found.columns if c not in set(plain)]
        return found.select([F.col(f"`{p}`").alias(c) for p, c in zip(plain, columns, strict=True)] + results)
    return rows.select([quoted(c).alias(p) for c, p in zip(columns, plain, strict=True)]), plain, back


def without_results(rows: DataFrame, results: Sequence[str], kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that `kept` leaves, with their own columns alone: those named as a result are set aside meanwhile."""
    taken = set(rows.columns) - set(others(rows.columns, results))
    aside = {c: f"own {i}" if c in taken else c for i, c in enumerate(rows.columns)}
    found = kept(rows.select([quoted(c).alias(aside[c]) for c in rows.columns]))
    return found.select([quoted(aside[c]).alias(c) for c in rows.columns])
