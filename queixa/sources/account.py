"""An account of the rows that reading and cleaning leave out, kept in the pass that writes the rest."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class DropAccount:
    """Counts per reason, known once the watched rows have been written or otherwise computed whole.

    Each watched step counts rows as they pass; nothing is read a second time. A stage that
    is computed again after a lost executor may count its rows again.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[Observation, list[str], int]] = []

    def watch(self, rows: DataFrame, reasons: Mapping[str, Column], sign: int = 1) -> DataFrame:
        """The same rows; as they pass, those that meet a condition are added to its reason, or with -1 taken from it."""
        seen = Observation()
        self._steps.append((seen, list(reasons), sign))
        return rows.observe(seen, *[F.count_if(condition).alias(f"r{i}") for i, condition in enumerate(reasons.values())])

    def counts(self) -> dict[str, int]:
        total: Counter[str] = Counter()
        for seen, reasons, sign in self._steps:
            found = seen.get
            for i, reason in enumerate(reasons):
                total[reason] += sign * found[f"r{i}"]
        return dict(total)

    def rows(self, spark: SparkSession) -> DataFrame:
        """One row per reason: `razao`, `linhas`."""
        return spark.createDataFrame(sorted(self.counts().items()), "razao string, linhas long")
