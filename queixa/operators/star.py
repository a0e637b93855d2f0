"""The star: a fact with dimensions that are joined only when a column of theirs is asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queixa.fixed_values import UNIDENTIFIED
from queixa.functions.dates import TIME_COLUMNS
from queixa.operators.dimensions import subscribers_of
from queixa.session import measured_size


@dataclass(frozen=True)
class Dimension:
    """A table joined on `key`, offering `columns`.

    It is opened only when columns are asked for, and is told which, so that a chain of
    lookups can stop early.

    A dimension that is itself a chain of lookups names the table the chain starts from:
    lookups on unique keys add no rows, so that table's measured size tells whether the
    whole dimension is small. The planner alone would multiply the sizes along the chain.
    """

    table: Callable[[Sequence[str]], DataFrame]
    key: str
    columns: tuple[str, ...]
    starts_from: Callable[[], DataFrame] | None = None
    # Few members (brands, states, complaint types): a cube sums the fact per key first and
    # looks the labels up afterwards, so the fact itself is neither joined nor shuffled.
    compact: bool = False

    def lookup(self, columns: Sequence[str]) -> DataFrame:
        """Key and wanted columns, marked for broadcast only if measured to be small."""
        wanted = self.table(columns).select(self.key, *columns)
        if self.starts_from is not None and measured_small(self.starts_from()):
            return F.broadcast(wanted)
        return wanted


def measured_small(table: DataFrame, headroom: int = 4) -> bool:
    """Whether a stored table's size, with headroom for unpacked columns, is within the
    session's broadcast threshold. Reads file sizes only."""
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return measured_size(table) * headroom <= limit


@dataclass(frozen=True)
class Star:
    """A fact and its dimensions, every relationship one-to-many and left-joined.

    `calendar` opens one row per day of the contiguous calendar (`data`); `operators`
    one row per brand (`operadora`, `assinantes`, and any other brand attribute).
    """

    fact: DataFrame
    dimensions: Mapping[str, Dimension]
    calendar: Callable[[], DataFrame]
    operators: Callable[[], DataFrame]
    unidentified: str
    # Where the fact holds a day's key instead of the day: the column, and the first day with its key.
    day_key: tuple[str, Callable[[], tuple[date, int] | None]] | None = None

    def frame(
        self, columns: Iterable[str], where: Mapping[str, Sequence] | None = None,
        years: tuple[int, int] | None = None,
    ) -> DataFrame:
        """Complaint rows with `columns` and `qtd`, restricted to the values in `where`
        and to an inclusive range of `years`.

        Only the dimensions that supply a wanted column are joined. Joins are left
        joins on a unique key, so leaving one out never changes the row count.
        """
        columns = list(dict.fromkeys(columns))
        return self._rows(columns, where, years).select(*columns, "qtd")

    def cube(
        self, columns: Iterable[str], where: Mapping[str, Sequence] | None = None,
        years: tuple[int, int] | None = None,
    ) -> DataFrame:
        """`qtd` summed per combination of `columns`: the one pass over the fact from which
        a query's other steps start. Its size follows the number of labels, not of complaints."""
        columns = list(dict.fromkeys(columns))
        held = set(self.fact.columns)
        labels_of = {name: [c for c in columns if c in d.columns and c not in held]
                     for name, d in self.dimensions.items()}
        late = {name: found for name, found in labels_of.items()
                if found and (self.dimensions[name].compact or self._worth_summing(name, found, columns))}
        labels = {c for found in late.values() for c in found}
        keys = [c for c in columns if c not in labels] + [self.dimensions[name].key for name in late]
        sums = self._rows(keys, where, years).groupBy(*keys).agg(F.sum("qtd").alias("qtd"))
        for name, found in late.items():
            sums = sums.join(self.dimensions[name].lookup(found), self.dimensions[name].key, "left")
        return sums.groupBy(*columns).agg(F.sum("qtd").alias("qtd")) if late else sums

    def _worth_summing(self, name: str, found: Sequence[str], columns: Sequence[str]) -> bool:
        """Whether to sum per key before joining a dimension that has many members.

        When its labels are all a cube asks for, the sums and the join share one shuffle on the
        key, and a hot key is one row per task in it. With further columns the sums would
        need a shuffle of their own, and the join of rows is cheaper.
        """
        start = self.dimensions[name].starts_from
        return start is not None and list(found) == list(columns) and not measured_small(start())

    def _within(self, df: DataFrame, available: set[str], spans: list[tuple[date, date]] | None) -> DataFrame:
        """Spans of days as filters that reach the stored fact: on its year folders, and on the day or its key."""
        if spans is None:
            return df
        if not spans:
            return df.where(F.lit(False))
        if "ano" in available:  # the stored fact is split by year
            years = sorted({year for a, b in spans for year in range(a.year, b.year + 1)})
            df = df.where(F.col("ano").between(years[0], years[-1]) if len(years) == years[-1] - years[0] + 1
                          else F.col("ano").isin(years))
        whole_years = all((a.month, a.day, b.month, b.day) == (1, 1, 12, 31) for a, b in spans)
        if self.day_key is not None and self.day_key[0] in available:
            if "ano" in available and whole_years:
                return df
            column, first = self.day_key[0], self.day_key[1]()
            if first is None:
                return df
            spans = [(first[1] + (a - first[0]).days, first[1] + (b - first[0]).days) for a, b in spans]
            return df.where(_any_of(F.col(column), spans))
        if "dia" in available:  # a range on the day reaches the scan, a year() would not
            spans = [(F.lit(str(a)).cast("date"), F.lit(str(b)).cast("date")) for a, b in spans]
            return df.where(_any_of(F.col("dia"), spans))
        return df

    def _rows(
        self, columns: Sequence[str], where: Mapping[str, Sequence] | None, years: tuple[int, int] | None
    ) -> DataFrame:
        """The fact with at least `columns`, filtered."""
        where = {name: list(values) for name, values in (where or {}).items() if values}
        df, available = self.fact, set(self.fact.columns)
        df = self._within(df, available, selected_days(where, years))
        # A filter on a dimension none of whose columns is shown keeps the keys that pass it.
        for dimension in self.dimensions.values():
            tested = [c for c in where if c in dimension.columns and c not in available]
            shown = (set(dimension.columns) - available) & set(columns)
            if tested and not shown:
                members = dimension.lookup(tested)
                for name in tested:
                    members = members.where(F.col(name).isin(where.pop(name)))
                df = df.join(members.select(dimension.key), dimension.key, "left_semi")
        wanted = list(dict.fromkeys([*columns, *where]))
        derived = [c for c in wanted if c not in available and c in TIME_COLUMNS]
        sources = [c for c in wanted if c not in derived] + (["dia"] if derived else [])
        for dimension in self.dimensions.values():
            supplied = [c for c in dimension.columns if c in sources and c not in available]
            if supplied:
                df = df.join(dimension.lookup(supplied), dimension.key, "left")
                available.update(supplied)
        df = df.withColumns({c: TIME_COLUMNS[c](F.col("dia")) for c in derived}) if derived else df
        missing = [c for c in wanted if c not in available and c not in derived]
        if missing:
            raise ValueError(f"unknown columns: {', '.join(missing)}")
        for name, values in where.items():
            df = df.where(F.col(name).isin(values))
        return df


def _any_of(c: Column, spans: Sequence[tuple]) -> Column:
    return reduce(lambda kept, one: kept | one, [c.between(a, b) for a, b in spans])


def _first_day(calendar: DataFrame) -> DataFrame:
    """The first day and its key, one row; an error where days or keys are missing in between."""
    days = F.datediff(F.max("data"), F.min("data")) + 1
    keys = F.max("id_data") - F.min("id_data") + 1
    whole = (F.count(F.lit(1)) == 0) | ((days == F.count(F.lit(1))) & (keys == F.count(F.lit(1))))
    refused = F.raise_error(F.lit("the calendar has gaps or repeated days")).cast("struct<data:date,id_data:int>")
    return calendar.select(F.when(whole, F.min(F.struct("data", "id_data"))).otherwise(refused).alias("primeiro"))


def selected_days(where: Mapping[str, Sequence], years: tuple[int, int] | None) -> list[tuple[date, date]] | None:
    """The spans of days that calendar filters and an inclusive range of years leave, in order; None if they are without bound.

    Many spans are joined to one: they only spare the reader rows, and the filters are still tested."""
    if where.get("mes_idx"):
        months = set(where["mes_idx"])
    elif where.get("ano_mes"):
        months = {int(text[:4]) * 12 + int(text[5:]) for text in where["ano_mes"]}
    elif years or where.get("ano"):
        first, last = years or (min(where["ano"]), max(where["ano"]))
        months = set(range(first * 12 + 1, last * 12 + 13))
    else:
        return None
    tests = {"ano": lambda m: (m - 1) // 12, "mes": lambda m: (m - 1) % 12 + 1, "trimestre": lambda m: (m - 1) % 12 // 3 + 1}
    kept = sorted(m for m in months if all(t(m) in where[c] for c, t in tests.items() if where.get(c))
                  and (years is None or years[0] <= (m - 1) // 12 <= years[1]))
    begins = [m for m in kept if m - 1 not in set(kept)]
    ends = [m for m in kept if m + 1 not in set(kept)]
    if len(begins) > MOST_SPANS:
        begins, ends = begins[:1], ends[-1:]

    def first_day(m: int) -> date:
        return date((m - 1) // 12, (m - 1) % 12 + 1, 1)
    return [(first_day(a), first_day(b + 1) - timedelta(days=1)) for a, b in zip(begins, ends, strict=True)]


# Spans of days sent to the reader one by one.
MOST_SPANS = 24


def star_of(
    tables: Mapping[str, DataFrame], subscribers: Column | None = None, unidentified: str = UNIDENTIFIED
) -> Star:
    """The star over the five stored tables, under the names queries use.

    The calendar is numbered without gaps from its first day's key on, so a day follows from its key.
    A calendar with gaps is refused when its days are used.
    """
    calendar = tables["dim_calendario"].select("data")
    first = _first_day(tables["dim_calendario"]).scalar()
    fact = (tables["fato_reclamacoes"].withColumnRenamed("sigla_servico", "servico")
            .withColumn("dia", F.date_add(first["data"], F.col("id_data") - first["id_data"])))
    operators = tables["dim_operadora"].select(
        "id_operadora", F.col("nome").alias("operadora"), "porte",
        F.col("grupo_economico").alias("grupo"))
    states = tables["dim_uf"].select(
        "id_uf", F.col("sigla").alias("uf"), F.col("nome").alias("estado"), "regiao")
    types = tables["dim_tipo_reclamacao"]
    base = subscribers if subscribers is not None else subscribers_of(F.col("operadora"))
    return Star(
        fact=fact,
        dimensions={
            "operadora": Dimension(
                lambda columns: operators, "id_operadora", ("operadora", "porte", "grupo"), compact=True),
            "uf": Dimension(lambda columns: states, "id_uf", ("uf", "estado", "regiao"), compact=True),
            "tipo": Dimension(lambda columns: types, "id_tipo", ("categoria", "subcategoria"), compact=True),
        },
        calendar=lambda: calendar,
        operators=lambda: operators.withColumn("assinantes", base),
        unidentified=unidentified,
        day_key=("id_data", cache(lambda: _first_day(tables["dim_calendario"]).first()[0])),
    )
