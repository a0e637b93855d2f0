"""Filter context: which complaints a measure sees in a cell of a report.

A cell is fixed by the report's filters and by its own axis values. Most measures
sum the complaints of their cell; some first lift the filter, the axis, or both, on
certain columns (the share of an operator divides by all operators, whatever the
filter says). Here a quantity names what it lifts, and all quantities of a report
come out of one grouping of the fact:

1. filters that no quantity lifts go down to the scan;
2. one small cube is grouped from the fact by the columns still needed;
3. each quantity is a conditional sum over the cube, per cell;
4. a lifted axis becomes a window over the remaining axes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from queixa.functions.dates import index_month, index_quarter, index_text, index_year
from queixa.operators.star import Star

OPERATOR = frozenset({"operadora", "porte", "grupo"})
STATE = frozenset({"uf", "estado", "regiao"})
TYPE = frozenset({"categoria", "subcategoria"})
CALENDAR = frozenset({"ano", "trimestre", "mes", "mes_idx", "ano_mes"})
STATUS = frozenset({"status"})
SERVICE = frozenset({"servico"})
EVERYTHING = OPERATOR | STATE | TYPE | CALENDAR | STATUS | SERVICE

CALENDAR_OF_INDEX: Mapping[str, Callable[[Column], Column]] = {
    "ano": index_year, "mes": index_month, "trimestre": index_quarter,
    "mes_idx": lambda index: index, "ano_mes": index_text,
}


@dataclass(frozen=True)
class Quantity:
    """A sum of `qtd`: what it lifts, and the condition it adds (with the column it reads).

    `years_back` bounds how far outside the selected years a lifted calendar is read.
    """

    lifts_filters: frozenset[str] = frozenset()
    lifts_axes: frozenset[str] = frozenset()
    reads: str | None = None
    condition: Callable[[Column], Column] | None = None
    years_back: int | None = None


def replacing(column: str, condition: Callable[[Column], Column]) -> Quantity:
    """A condition that replaces any filter or axis on its column."""
    lifted = frozenset({column})
    return Quantity(lifted, lifted, column, condition)


def lifting(columns: frozenset[str]) -> Quantity:
    """Everything in the cell, and beyond it along `columns`."""
    return Quantity(columns, columns)


class Context:
    """Report filters and axes over a star."""

    def __init__(self, star: Star, axes: Sequence[str], filters: Mapping[str, Sequence] | None):
        self.star = star
        self.axes = list(axes)
        self.filters = {c: list(v) for c, v in (filters or {}).items() if v}
        unknown = (set(self.axes) | set(self.filters)) - EVERYTHING
        if unknown:
            raise ValueError(f"unknown columns: {', '.join(sorted(unknown))}")
        if self.by_month and (CALENDAR & set(self.axes)) != {"mes_idx"}:
            raise ValueError("a month axis already fixes year and quarter")

    @property
    def by_month(self) -> bool:
        return "mes_idx" in self.axes

    @property
    def by_period(self) -> bool:
        """A calendar axis coarser than, or across, months."""
        return bool(CALENDAR & set(self.axes)) and not self.by_month

    @property
    def many_cells(self) -> bool:
        """Axes of more than one dimension: their cells are a product of labels."""
        return len(self.axes) > 1 and not any(set(self.axes) <= one for one in (OPERATOR, STATE, TYPE))

    def axes_without(self, columns: Iterable[str]) -> list[str]:
        return [a for a in self.axes if a not in set(columns)]

    def passes(self, lifted: frozenset[str] = frozenset()) -> Column:
        """The filters that remain once those on `lifted` are gone."""
        kept = F.lit(True)
        for column, values in self.filters.items():
            if column not in lifted:
                kept = kept & F.coalesce(F.col(column).isin(values), F.lit(False))
        return kept

    def month_selected(self, index: Column) -> Column:
        """Whether the calendar filters select a month, given by its index."""
        kept = F.lit(True)
        for column, values in self.filters.items():
            if column in CALENDAR:
                kept = kept & CALENDAR_OF_INDEX[column](index).isin(values)
        return kept

    def sum_of(self, quantity: Quantity) -> Column:
        kept = self.passes(quantity.lifts_filters)
        if quantity.condition is not None:
            kept = kept & F.coalesce(quantity.condition(F.col(quantity.reads)), F.lit(False))
        return F.sum(F.when(kept, F.col("qtd")))

    def beyond_axes(self, cells: DataFrame, quantities: Mapping[str, Quantity]) -> dict[str, Column]:
        """The cells' sums, added up along the lifted axes.

        Where several axes are all lifted the sum is one value, of a subquery that shares the
        cells' shuffle: their number is the product of the axes' labels, too many for a window in one task."""
        rest = {name: self.axes_without(q.lifts_axes) for name, q in quantities.items()}
        whole = [name for name, axes in rest.items() if not axes and self.many_cells]
        if whole:
            sums = cells.select(F.struct(*[F.sum(name).alias(name) for name in whole])).scalar()
        return {name: F.col(name) if axes == self.axes else sums[name] if name in whole else F.sum(name).over(W.partitionBy(*axes))
                for name, axes in rest.items()}

    def cube(self, quantities: Iterable[Quantity], extra: Iterable[str] = ()) -> tuple[DataFrame, Context]:
        """The one grouping of the fact that a report needs, and the context that is left over it:
        filters that no quantity lifts are settled by the scan and need not be tested again."""
        quantities = list(quantities)
        lifted = frozenset().union(*[q.lifts_filters for q in quantities])
        pushed = {c: v for c, v in self.filters.items() if c not in lifted}
        left = {c: v for c, v in self.filters.items() if c in lifted}
        columns = [*self.axes, *left, *[q.reads for q in quantities if q.reads], *extra]
        cube = self.star.cube(columns, pushed, self._years_read(quantities))
        return cube, Context(self.star, self.axes, left)

    def _years_read(self, quantities: Sequence[Quantity]) -> tuple[int, int] | None:
        """The years a report can touch, when it selects years and no quantity reads all of time."""
        years = self.filters.get("ano") or [int(text[:4]) for text in self.filters.get("ano_mes", [])] or [
            (index - 1) // 12 for index in self.filters.get("mes_idx", [])]
        back = [q.years_back for q in quantities if "ano" in q.lifts_filters]
        if not years or None in back:
            return None
        return min(years) - max([0, *back]), max(years)

    def calendar_limits(self) -> DataFrame:
        """One row on the calendar: its last month, and the selected months' end, mean and spread."""
        index = F.year("data") * 12 + F.month("data")
        months = self.star.calendar().groupBy(index.alias("x")).agg(F.max("data").alias("fim"))
        chosen = self.month_selected(F.col("x"))
        x = F.when(chosen, F.col("x").cast("double"))
        end = F.max(F.when(chosen, F.col("fim")))
        return months.agg(
            F.max("x").alias("ultimo"),
            F.min(F.when(chosen, F.col("x"))).alias("inicio"),
            F.max(F.when(chosen, F.col("x"))).alias("fim"),
            F.max("fim").alias("ultimo_dia"),
            (end != F.last_day(end)).alias("parcial"),
            F.avg(x).alias("x_medio"),
            (F.var_pop(x) * F.count(x)).alias("x_quadrados"),
        )

    def last_months(self) -> DataFrame:
        """Per cell of the calendar axes: its last selected month (`_fim`), and whether the calendar ends inside that month.

        As small as the calendar: at most a row per month of it."""
        index = F.year("data") * 12 + F.month("data")
        months = self.star.calendar().groupBy(index.alias("x")).agg(F.max("data").alias("dia")).where(self.month_selected(F.col("x")))
        axes = [CALENDAR_OF_INDEX[a](F.col("x")).alias(a) for a in self.axes if a in CALENDAR]
        return months.groupBy(*axes).agg(
            F.max("x").alias("_fim"), F.max_by(F.col("dia") != F.last_day("dia"), "x").alias("_cortado"))
