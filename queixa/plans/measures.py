"""The measure catalogue: 52 named measures, each evaluated per cell of a report.

`evaluate(star, axes, measures, filters)` returns one row per cell that has complaints, or a
value that looks back on some. Fractions stay fractions. A measure without meaning in its cell is NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from queixa.fixed_values import (
    ANOMALY_DEVIATIONS, ANSWERED, CRITICAL_CHANGE, FIXED_SERVICE, HHI_CLASSES, HHI_COMPETITIVE_BELOW,
    HHI_CONCENTRATED_UP_TO, HHI_SCALE, MOBILE_SERVICE, NEAR_OVERALL_RATE, NO_VALUE, PENDING, RATE_BANDS,
    RESOLUTION_TARGET, RISK_BANDS, RISK_WEIGHTS, SCORE_LOW_UP_TO, SCORE_MIDDLE_UP_TO, SENTENCE, SEVERAL,
    STABLE_CHANGE, TARGET_BANDS, UNDER_REVIEW,
)
from queixa.functions.dates import index_year, month_name
from queixa.functions.numbers import (
    one_decimal_percent, ratio, ratio_or_zero, round_half_away, signed_percent, thousands,
)
from queixa.operators.star import Star
from queixa.operators.windows import (
    month_back, over_largest, rank_dense, rank_with_gaps, single_or, trailing_months, year_to_date,
    z_score,
)
from queixa.plans.context import (
    CALENDAR, CALENDAR_OF_INDEX, EVERYTHING, OPERATOR, STATE, TYPE, Context, Quantity, lifting, replacing,
)

C = F.col


def quantities(star: Star) -> dict[str, Quantity]:
    """The sums that measures are made of."""
    return {
        "total": Quantity(),
        "total_geral": lifting(EVERYTHING),
        "reclamacoes_scm": replacing("servico", lambda c: c == FIXED_SERVICE),
        "reclamacoes_smp": replacing("servico", lambda c: c == MOBILE_SERVICE),
        "respondidas": replacing("status", lambda c: c == ANSWERED),
        "em_aberto": replacing("status", lambda c: ~c.eqNullSafe(ANSWERED)),
        "qtd_pendentes": replacing("status", lambda c: c == PENDING),
        "qtd_em_analise": replacing("status", lambda c: c == UNDER_REVIEW),
        "nao_identificadas": Quantity(reads="operadora", condition=lambda c: c == star.unidentified),
        "_operadoras": lifting(OPERATOR),
        "_tipos": lifting(TYPE),
        "_ufs": lifting(STATE),
        # The selected population: the report's filters without the axes.
        "_selecionadas": Quantity(lifts_axes=EVERYTHING),
        "_selecionadas_respondidas": Quantity(
            frozenset({"status"}), EVERYTHING, "status", lambda c: c == ANSWERED),
        # Peers of the cell: its axes stay, the filter that would hide them goes.
        "_par_operadora": Quantity(lifts_filters=frozenset({"operadora"})),
        "_par_operadoras": Quantity(lifts_filters=OPERATOR),
        "_par_categoria": Quantity(lifts_filters=frozenset({"categoria"})),
        "_par_uf": Quantity(lifts_filters=frozenset({"estado", "uf"})),
        # The monthly series beyond the selected months; no measure looks back over a year.
        "_serie": Quantity(lifts_filters=CALENDAR, years_back=1),
        "_serie_setor": Quantity(lifts_filters=CALENDAR | OPERATOR, years_back=1),
    }


@dataclass(frozen=True)
class Measure:
    """A value computed from other measures and quantities of the same cell."""

    uses: tuple[str, ...]
    value: Callable[[Context], Column]
    axis: str | None = None  # an axis the measure is meaningless without


def _bands(*cases: tuple[Column, str], otherwise: str) -> Column:
    """The label of the first case that holds."""
    choice = F.when(cases[0][0], F.lit(cases[0][1]))
    for condition, text in cases[1:]:
        choice = choice.when(condition, F.lit(text))
    return choice.otherwise(F.lit(otherwise))


def _at_least(value: str, bands: Sequence[tuple[float | None, object]]) -> Column:
    """The label of the highest band whose lower bound the value reaches."""
    *bounded, (_, rest) = bands
    return _bands(*[(C(value) >= bound, text) for bound, text in bounded], otherwise=rest)


def _change(now: str, before: str) -> Callable[[Context], Column]:
    """A cell without complaints counts as none where there were some before."""
    return lambda ctx: ratio(F.coalesce(C(now), F.lit(0)) - C(before), C(before))


def _largest_operator(value: str) -> Callable[[Context], Column]:
    """The largest operator's value among the cells of an operator axis."""
    return lambda ctx: F.max(value).over(W.partitionBy(*ctx.axes_without(OPERATOR)))


def _risk_score(ctx: Context) -> Column:
    w_volume, w_unresolved, w_base = RISK_WEIGHTS

    def scaled(value: str, largest: str) -> Column:
        return F.coalesce(ratio(C(value), C(largest)), F.lit(0.0))
    return round_half_away(
        scaled("total", "_maior_volume") * w_volume + (1 - C("taxa_resolucao")) * w_unresolved
        + scaled("por_100k", "_maior_100k") * w_base, 4)


def _executive_sentence(ctx: Context) -> Column:
    mom, said = C("var_mom"), {name: F.lit(text) for name, text in SENTENCE.items()}
    trend = (F.when(mom.isNull(), said["no_base"])
             .when(mom > STABLE_CHANGE, F.concat(said["up"], one_decimal_percent(mom), said["up_end"]))
             .when(mom < -STABLE_CHANGE, F.concat(
                 said["down"], one_decimal_percent(F.abs(mom)), said["down_end"]))
             .otherwise(said["stable"]))
    return F.concat(
        C("operadora_lider"), said["leader"], one_decimal_percent(C("share_lider")), said["of_total"], trend,
        said["rate"], one_decimal_percent(C("taxa_resolucao")), said["market"], F.lower("classe_hhi"),
        said["index"], thousands(C("hhi")), said["place"], F.coalesce(C("pior_estado"), F.lit("")), said["end"])


def _title(ctx: Context) -> Column:
    """The single operator, state and year in context, joined to the report's name."""
    def single(name: str) -> Column:
        if name in ctx.axes:
            return C(name).cast("string")
        values = ctx.filters.get(name, [])
        return F.lit(str(values[0])) if len(values) == 1 else F.lit(None).cast("string")

    return F.concat_ws(" · ", F.lit("Reclamações"), single("operadora"), single("uf"), single("ano"))


MEASURES: dict[str, Measure] = {
    # volume
    "pct_total": Measure(("total", "total_geral"), lambda ctx: ratio_or_zero(C("total"), C("total_geral"))),
    # resolution
    "taxa_resolucao": Measure(("respondidas", "total"), lambda ctx: ratio_or_zero(C("respondidas"), C("total"))),
    "gap_meta": Measure(("taxa_resolucao",), lambda ctx: C("taxa_resolucao") - RESOLUTION_TARGET),
    "taxa_texto": Measure(("taxa_resolucao",), lambda ctx: F.concat(
        one_decimal_percent(C("taxa_resolucao")), _at_least("taxa_resolucao", RATE_BANDS))),
    "status_meta": Measure(("gap_meta",), lambda ctx: _at_least("gap_meta", TARGET_BANDS)),
    # time
    "var_mom": Measure(("total", "mes_anterior"), _change("total", "mes_anterior")),
    "var_yoy": Measure(("total", "ano_anterior"), _change("total", "ano_anterior")),
    "var_mom_setor": Measure(("setor", "setor_mes_anterior"), _change("setor", "setor_mes_anterior")),
    "var_yoy_texto": Measure(("var_yoy",), lambda ctx: signed_percent(C("var_yoy"))),
    "var_mom_texto": Measure(("var_mom",), lambda ctx: signed_percent(C("var_mom"))),
    "ultimo_mes": Measure(("_limites",), lambda ctx: F.concat(
        month_name(F.month("_limites.ultimo_dia")), F.lit("/"),
        F.year("_limites.ultimo_dia").cast("string"))),
    # ranking
    "rank_volume": Measure(("_par_operadora",), lambda ctx: rank_dense(
        C("_par_operadora"), *ctx.axes_without({"operadora"})), "operadora"),
    "por_100k": Measure(("total", "assinantes"), lambda ctx: ratio(C("total"), C("assinantes") / 100000)),
    "_par_por_100k": Measure(("_par_operadoras", "assinantes"), lambda ctx: ratio(
        C("_par_operadoras"), C("assinantes") / 100000), "operadora"),
    "rank_100k": Measure(("_par_operadora", "assinantes"), lambda ctx: rank_dense(
        ratio(C("_par_operadora"), C("assinantes") / 100000),
        *ctx.axes_without({"operadora"})), "operadora"),
    # market
    "share_operadora": Measure(("total", "_operadoras"), lambda ctx: ratio_or_zero(C("total"), C("_operadoras"))),
    "share_texto": Measure(("share_operadora",), lambda ctx: one_decimal_percent(C("share_operadora"))),
    "classe_hhi": Measure(("hhi",), lambda ctx: _bands(
        (C("hhi") < HHI_COMPETITIVE_BELOW, HHI_CLASSES[0]), (C("hhi") <= HHI_CONCENTRATED_UP_TO, HHI_CLASSES[1]),
        otherwise=HHI_CLASSES[2])),
    # risk
    "_maior_volume": Measure(("_par_operadoras",), _largest_operator("_par_operadoras"), "operadora"),
    "_maior_100k": Measure(("_par_por_100k",), _largest_operator("_par_por_100k"), "operadora"),
    "score_risco": Measure(("total", "taxa_resolucao", "por_100k", "_maior_volume", "_maior_100k"), _risk_score),
    "rating_risco": Measure(("score_risco",), lambda ctx: F.coalesce(
        F.when(C("score_risco").isNotNull(), _at_least("score_risco", RISK_BANDS)), F.lit(NO_VALUE))),
    # The same bands as numbers: 4 for the highest, 0 where there is no score.
    "ordinal_risco": Measure(("score_risco",), lambda ctx: F.when(C("score_risco").isNull(), 0).otherwise(
        _at_least("score_risco", [(bound, 4 - i) for i, (bound, _) in enumerate(RISK_BANDS)]))),
    "faixa_score": Measure(("score_risco",), lambda ctx: _bands(
        (C("score_risco") <= SCORE_LOW_UP_TO, "baixo"), (C("score_risco") <= SCORE_MIDDLE_UP_TO, "medio"),
        otherwise="alto")),
    "flag_anomalia": Measure(("z_mensal",), lambda ctx: F.when(C("z_mensal").isNotNull(), _bands(
        (C("z_mensal") > ANOMALY_DEVIATIONS, "alta"), (C("z_mensal") < -ANOMALY_DEVIATIONS, "baixa"),
        otherwise="normal"))),
    "flag_piora_mom": Measure(("var_mom", "var_mom_setor"), lambda ctx: _bands(
        (C("var_mom").isNull(), NO_VALUE), (C("var_mom") > CRITICAL_CHANGE, "Crítico"),
        (C("var_mom") > C("var_mom_setor"), "Piora"), otherwise="Estável")),
    "direcao_mom": Measure(("var_mom",), lambda ctx: _bands((C("var_mom") > 0, "alta"), otherwise="baixa")),
    # category and geography
    "rank_categoria": Measure(("_par_categoria",), lambda ctx: rank_dense(
        C("_par_categoria"), *ctx.axes_without({"categoria"})), "categoria"),
    "rank_uf": Measure(("_par_uf",), lambda ctx: rank_dense(
        C("_par_uf"), *ctx.axes_without({"uf", "estado"})), "uf"),
    "share_categoria": Measure(("total", "_tipos"), lambda ctx: ratio_or_zero(C("total"), C("_tipos"))),
    "share_uf": Measure(("total", "_ufs"), lambda ctx: ratio_or_zero(C("total"), C("_ufs"))),
    # narrative
    "insight": Measure(("operadora_lider", "share_lider", "var_mom", "taxa_resolucao", "hhi",
                        "classe_hhi", "pior_estado"), _executive_sentence),
    "titulo": Measure((), _title),
    "sumario_operadora": Measure(("total", "taxa_resolucao"), lambda ctx: F.concat(
        C("operadora"), F.lit(": "), thousands(C("total")), F.lit(" reclamações, "),
        one_decimal_percent(C("taxa_resolucao")), F.lit(" resolvidas")), "operadora"),
    "_taxa_geral": Measure(("_selecionadas", "_selecionadas_respondidas"), lambda ctx: ratio_or_zero(
        C("_selecionadas_respondidas"), C("_selecionadas"))),
    "taxa_vs_geral": Measure(("taxa_resolucao", "_taxa_geral"), lambda ctx: _bands(
        (C("taxa_resolucao") - C("_taxa_geral") > NEAR_OVERALL_RATE, "acima"),
        (C("taxa_resolucao") - C("_taxa_geral") < -NEAR_OVERALL_RATE, "abaixo"), otherwise="na faixa")),
    # data quality
    "pct_nao_identificado": Measure(("nao_identificadas", "total_geral"), lambda ctx: ratio(
        C("nao_identificadas"), C("total_geral"))),
    "cobertura": Measure(("pct_nao_identificado",), lambda ctx: 1 - F.coalesce(
        C("pct_nao_identificado"), F.lit(0.0))),
}

# Values that come from their own step, with the quantities each step reads.
TIME = {
    "media_mensal": ("total",), "mes_anterior": ("_serie",), "ano_anterior": ("_serie",),
    "ytd": ("_serie",), "media_movel_3m": ("_serie",), "tendencia": ("_serie",),
    "z_mensal": ("total",), "mom_ultimo_mes": ("_serie",),
    "setor": ("_serie_setor",), "setor_mes_anterior": ("_serie_setor",),
}
# Which of them look at the end of the calendar, with and without a month axis.
LIMITED_BY_MONTH = {"media_movel_3m", "tendencia"}
LIMITED_OVER_PERIOD = set(TIME) - {"media_mensal", "z_mensal", "setor"}
MARKET = ("hhi", "top3", "operadora_lider", "share_lider")
PLACE = ("pior_estado",)
# Without an operator axis the largest operator is found one level below the cells.
PEERS = ("_maior_volume", "_maior_100k")
ATTRIBUTES = ("assinantes", "_limites")
# Measures that can have a value where there are no complaints, and what they look back on.
LOOKING_BACK = {
    "mes_anterior": "mes_anterior", "var_mom": "mes_anterior", "ano_anterior": "ano_anterior", "var_yoy": "ano_anterior",
    "ytd": "ytd", "media_movel_3m": "media_movel_3m", "tendencia": "tendencia", "mom_ultimo_mes": "mom_ultimo_mes",
}
# Months after a month with complaints in which such a measure still sees it.
REACH = {"mes_anterior": (1,), "ano_anterior": (12,), "ytd": tuple(range(1, 12)), "media_movel_3m": (1, 2, 3)}
# Axes that stand for another: a state's name for its code, and what fixes one month for the month.
STANDS_FOR: Mapping[str, tuple[frozenset[str], ...]] = {
    "uf": (frozenset({"estado"}),),
    "mes_idx": (frozenset({"ano_mes"}), frozenset({"ano", "mes"})),
}


def _stands_for(axes: Iterable[str], axis: str) -> bool:
    return any(group <= set(axes) for group in STANDS_FOR.get(axis, ()))


def _looked_back(names: Iterable[str]) -> set[str]:
    return {LOOKING_BACK[n] for n in names if n in LOOKING_BACK}


def _attached(ctx: Context, name: str) -> bool:
    return name in PEERS and "operadora" not in ctx.axes


def _closure(ctx: Context, names: Iterable[str]) -> list[str]:
    """`names` and all they use, each after what it uses."""
    known, ordered = quantities(ctx.star), []
    limited = LIMITED_BY_MONTH | _looked_back(names) if ctx.by_month else LIMITED_OVER_PERIOD

    def visit(name: str) -> None:
        if name in ordered:
            return
        if name in MEASURES and not _attached(ctx, name):
            uses = MEASURES[name].uses
        elif name in TIME:
            uses = TIME[name] + (("_limites",) if name in limited else ())
        elif name in known or name in MARKET or name in PLACE or name in PEERS or name in ATTRIBUTES:
            uses = ()
        else:
            raise ValueError(f"unknown measure: {name}")
        for used in uses:
            visit(used)
        ordered.append(name)

    for name in ["total", *names]:
        visit(name)
    return ordered


def _steps(ctx: Context, ordered: Sequence[str]) -> list[list[str]]:
    """Measures in as few projections as their dependencies allow."""
    depth: dict[str, int] = {}
    for name in ordered:
        if name in MEASURES and not _attached(ctx, name):
            depth[name] = 1 + max([depth.get(used, 0) for used in MEASURES[name].uses], default=0)
    return [[n for n, d in depth.items() if d == level] for level in sorted(set(depth.values()))]


def _time_by_month(ctx: Context, names: set[str]) -> dict[str, Column]:
    """Month axis: calendar windows over the monthly cells."""
    others = ctx.axes_without({"mes_idx"})
    months = W.partitionBy(*others).orderBy("mes_idx")
    s, month, limits = C("_serie"), C("mes_idx"), "_limites."
    chosen = F.when(ctx.month_selected(month), s)
    # A trailing three-month window that ends inside a month also touches a fourth one.
    cut = C(limits + "parcial") & (month == C(limits + "fim"))
    sector = W.partitionBy(*[a for a in others if a not in OPERATOR], "mes_idx")
    values = {
        "media_mensal": C("total").cast("double"),
        "mes_anterior": month_back(s, 1, others),
        "ano_anterior": month_back(s, 12, others),
        "ytd": year_to_date(s, others, "_ano"),
        "media_movel_3m": F.when(cut, F.avg(s).over(months.rangeBetween(-3, 0))).otherwise(
            trailing_months(s, 3, others)),
        "tendencia": F.try_divide(
            F.sum((month - C(limits + "x_medio")) * chosen).over(W.partitionBy(*others)),
            C(limits + "x_quadrados")),
        "z_mensal": z_score(C("total"), *others),
        "mom_ultimo_mes": F.lit(None).cast("double"),
        "setor": F.sum("_serie_setor").over(sector),
    }
    return {name: values[name] for name in TIME if name in names and name in values}


def _sector_month_before(ctx: Context, cells: DataFrame) -> DataFrame:
    """The sector's total of the month before, looked up by month: a window over all operators' months would be one task."""
    keys = [a for a in ctx.axes if a not in OPERATOR]
    months = cells.groupBy(*keys).agg(F.sum("_serie_setor").alias("setor_mes_anterior"))
    return _attach(cells, ctx.axes, keys, months.withColumn("mes_idx", C("mes_idx") + 1))


def _time_over_period(ctx: Context, names: set[str]) -> dict[str, Column]:
    """No month axis: the selected period as a whole, shifted where a measure says so."""
    s, month, limits = C("_serie"), C("mes_idx"), "_limites."

    def shifted(value: Column, months: int) -> Column:
        later = month + months
        return F.sum(F.when(ctx.month_selected(later) & (later <= C(limits + "ultimo")), value))

    end = C(limits + "fim")
    first_of_three = end - F.when(C(limits + "parcial"), 3).otherwise(2)
    last, before = F.sum(F.when(month == end, s)), F.sum(F.when(month == end - 1, s))
    values = {
        "media_mensal": F.avg("total"),
        "mes_anterior": shifted(s, 1),
        "ano_anterior": shifted(s, 12),
        "ytd": F.sum(F.when((index_year(month) == index_year(end)) & (month <= end), s)),
        "media_movel_3m": F.avg(F.when(month.between(first_of_three, end), s)),
        "tendencia": F.try_divide(
            F.sum(F.when(ctx.month_selected(month), (month - C(limits + "x_medio")) * s)),
            F.max(limits + "x_quadrados")),
        "z_mensal": F.max(F.lit(None).cast("double")),
        "mom_ultimo_mes": ratio(last - before, before),
        "setor": F.sum(F.when(ctx.month_selected(month), C("_serie_setor"))),
        "setor_mes_anterior": shifted(C("_serie_setor"), 1),
    }
    return {name: values[name] for name in TIME if name in names}


def _every_selected_month(ctx: Context, cells: DataFrame) -> DataFrame:
    """All selected months for each key: where a slope has a value."""
    others, limits = ctx.axes_without(CALENDAR), "_limites."
    keys = cells.where(C("_serie").isNotNull()).groupBy(*others).agg(F.first("_limites").alias("_limites"))
    months = keys.where(C(limits + "inicio").isNotNull()).select(
        *others, F.explode(F.sequence(C(limits + "inicio"), C(limits + "fim"))).alias("mes_idx"), "_limites")
    return months.where(ctx.month_selected(C("mes_idx")))


def _with_blank_months(ctx: Context, cells: DataFrame, looked_back: set[str], sums: Sequence[str]) -> DataFrame:
    """The monthly cells, and those after them that look back on one of them, up to the calendar's end.

    Each cell is laid out once more for each such month, without its sums, and equal cells are put together."""
    after, shift = sorted({0, *[k for name in looked_back for k in REACH.get(name, ())]}), C("_depois")
    moved = cells.withColumn("_depois", F.explode(F.array(*[F.lit(k) for k in after]))).withColumn("_mes", C("mes_idx") + shift)
    seen = shift == 0
    for name in looked_back & set(REACH):
        one = shift.isin(list(REACH[name]))
        # a year to date sees a month no longer than its year lasts, whatever else looks further
        seen = seen | (one & (index_year(C("_mes")) == index_year(C("mes_idx"))) if name == "ytd" else one)
    selected = (C("_mes") <= C("_limites.ultimo")) & ctx.month_selected(C("_mes"))
    moved = moved.where((shift == 0) | (seen & C("_serie").isNotNull() & selected)).withColumns({
        **{name: F.when(shift == 0, C(name)) for name in sums}, "mes_idx": C("_mes")}).drop("_depois", "_mes")
    if "tendencia" in looked_back:
        moved = moved.unionByName(_every_selected_month(ctx, cells), allowMissingColumns=True)
    return moved.groupBy(*ctx.axes).agg(*[F.sum(name).alias(name) for name in sums], F.first("_limites").alias("_limites"))


def _as_of(ctx: Context, cells: DataFrame) -> DataFrame:
    """Monthly cells once more, for each calendar cell whose last month looks back on them: within its year,
    or as one of its trailing months. A calendar cell sees at most 15 months, so the table of what
    is seen has no more rows than 15 times the calendar's months."""
    year, end = index_year(C("_fim")), C("_fim")
    first_of_year = year * 12 + 1
    seen = ctx.last_months().withColumn("_visto", F.explode(F.sequence(F.least(first_of_year, end - 3), end)))
    seen = seen.withColumns({
        "_no_ano": index_year(C("_visto")) == year,
        "_recente": C("_visto") >= end - F.when(C("_cortado"), 3).otherwise(2),
        "_atras": end - C("_visto"),
    })
    calendar = [a for a in ctx.axes if a in CALENDAR]
    held = [c for c in cells.columns if c not in calendar]
    return cells.select(*held).join(F.broadcast(seen), C("mes_idx") == C("_visto")).drop("_visto", "_fim", "_cortado")


def _time_by_calendar_axis(ctx: Context, cells: DataFrame, names: set[str], sums: Sequence[str], looked_back: set[str]) -> DataFrame:
    """A year, quarter or month-of-year axis: each month also counts for the cell it would fall
    in a month or a year later, and the cells are summed from those. What is told as of a cell's
    last month (year to date, trailing mean) is summed from the months that this one looks back on."""
    calendar = [a for a in ctx.axes if a in CALENDAR]
    needed = {"mes_anterior": 1, "setor_mes_anterior": 1, "ano_anterior": 12}
    shifts = sorted({0, *[months for name, months in needed.items() if name in names]})
    month, shift = C("_mes"), C("_shift")
    moved = cells.withColumn("_shift", F.explode(F.array(*[F.lit(k) for k in shifts]))).withColumn(
        "_mes", C("mes_idx") + shift)
    if shifts != [0]:
        inside = ctx.month_selected(month) & (month <= C("_limites.ultimo"))
        moved = moved.where((shift == 0) | inside)
    if "tendencia" in looked_back:
        moved = moved.unionByName(_every_selected_month(ctx, cells).withColumns({"_shift": F.lit(-1), "_mes": C("mes_idx")}),
                                  allowMissingColumns=True)
    moved = moved.withColumns({a: CALENDAR_OF_INDEX[a](month) for a in calendar}).withColumn(
        "_escolhida", ctx.month_selected(month))
    as_of = names & {"ytd", "media_movel_3m", "mom_ultimo_mes"}
    if as_of:
        moved = moved.unionByName(_as_of(ctx, cells).withColumns({"_shift": F.lit(-1), "_escolhida": F.lit(True)}), allowMissingColumns=True)

    def at(months: int, value: Column) -> Column:
        return F.when(shift == months, value)

    s = C("_serie")
    values = {
        "media_mensal": F.avg(at(0, C("total"))),
        "z_mensal": F.max(F.lit(None).cast("double")),
        "mes_anterior": F.sum(at(1, s)), "ano_anterior": F.sum(at(12, s)),
    }
    if as_of:
        last, before = (F.sum(F.when(C("_atras") == k, s)) for k in (0, 1))
        values |= {"ytd": F.sum(F.when(C("_no_ano"), s)), "media_movel_3m": F.avg(F.when(C("_recente"), s)),
                   "mom_ultimo_mes": ratio(last - before, before)}
    if "tendencia" in names:
        values["tendencia"] = F.sum(at(0, F.when(C("_escolhida"), (C("mes_idx") - C("_limites.x_medio")) * s)))
    if "setor" in names:
        chosen = F.when(C("_escolhida"), C("_serie_setor"))
        values |= {"setor": F.sum(at(0, chosen)), "setor_mes_anterior": F.sum(at(1, C("_serie_setor")))}
    found = moved.groupBy(*ctx.axes).agg(
        *[F.sum(at(0, C(name))).alias(name) for name in sums],
        *[value.alias(name) for name, value in values.items() if name in names],
        *([F.first("_limites", ignorenulls=True).alias("_limites")] if "_limites" in names else []),
        F.max("_escolhida").alias("_escolhida"))
    if "tendencia" in names:
        # each selected month lies in one cell, so the cells' parts make up the slope of all of them
        whole = F.sum("tendencia").over(W.partitionBy(*ctx.axes_without(CALENDAR)))
        found = found.withColumn("tendencia", F.try_divide(whole, C("_limites.x_quadrados")))
    return found


def _market(ctx: Context, cube: DataFrame) -> tuple[list[str], DataFrame]:
    """Concentration of all operators, per cell without its operator axis."""
    rest = ctx.axes_without(OPERATOR)
    member = F.sum(F.when(ctx.passes(frozenset({"operadora"})), C("qtd")))
    whole = F.sum(F.when(ctx.passes(OPERATOR), C("qtd")))
    members = cube.groupBy(*rest, "operadora").agg(member.alias("v"), whole.alias("w"))
    share = ratio(C("v"), F.sum("w").over(W.partitionBy(*rest)))
    ranked = members.select(*rest, "operadora", share.alias("s"),
                            rank_with_gaps(F.coalesce(C("v"), F.lit(0)), *rest).alias("r"))
    top = C("r") == 1
    return rest, ranked.groupBy(*rest).agg(
        round_half_away(F.sum(C("s") * C("s")) * HHI_SCALE, 0).alias("hhi"),
        F.coalesce(F.sum(F.when(C("r") <= 3, C("s"))), F.lit(0.0)).alias("top3"),
        F.max(F.when(top, C("operadora"))).alias("operadora_lider"),
        F.max(F.when(top, C("s"))).alias("share_lider"))


def _risk_peers(ctx: Context, cube: DataFrame) -> tuple[list[str], DataFrame]:
    """The largest volume and the largest rate per subscriber of any operator, per cell without an operator axis."""
    rest = ctx.axes_without(OPERATOR)
    members = cube.groupBy(*rest, "operadora").agg(F.sum(F.when(ctx.passes(OPERATOR), C("qtd"))).alias("v"))
    bases = ctx.star.operators().select(C("operadora").alias("_nome"), "assinantes")
    rated = members.join(bases, C("operadora") == C("_nome"), "left")
    return rest, rated.groupBy(*rest).agg(
        F.max("v").alias("_maior_volume"), F.max(ratio(C("v"), C("assinantes") / 100000)).alias("_maior_100k"))


def _worst_state(ctx: Context, cube: DataFrame) -> tuple[list[str], DataFrame]:
    """The state with most complaints per cell without its state axis; the word for several on a tie."""
    rest = ctx.axes_without(STATE)
    members = cube.groupBy(*rest, "estado").agg(
        F.sum(F.when(ctx.passes(STATE), C("qtd"))).alias("v"))
    first = members.withColumn("r", rank_with_gaps(F.coalesce(C("v"), F.lit(0)), *rest)).where("r = 1")
    return rest, first.groupBy(*rest).agg(
        single_or(F.lit(SEVERAL), C("estado")).alias("pior_estado"))


def _subscribers(ctx: Context) -> tuple[list[str], DataFrame]:
    """The subscriber base, where the operators in context share a single value."""
    keys = [a for a in ctx.axes if a in OPERATOR]
    operators = ctx.star.operators()
    if "operadora" not in keys:
        for column, values in ctx.filters.items():
            if column in OPERATOR:
                operators = operators.where(C(column).isin(values))
    distinct = F.count_distinct(F.coalesce(C("assinantes"), F.lit(-1)))
    return keys, operators.groupBy(*keys).agg(
        F.when(distinct == 1, F.max("assinantes")).alias("assinantes"))


def _attach(cells: DataFrame, axes: list[str], keys: list[str], side: DataFrame) -> DataFrame:
    """Add a step's columns to the cells that share its keys.

    A step without keys is one row, which belongs to every cell. It is put under the cells
    and spread over them: in one plan, without a subquery or a join on nothing, so that the
    planner runs the grouping that cells and step have in common once. The cells of several
    axes may be too many for that and take the row from a subquery.
    """
    if not keys and len(axes) > 1:
        one = side.select(F.struct(*side.columns)).scalar()
        return cells.withColumns({c: one[c] for c in side.columns})
    if not keys:
        rows = cells.withColumn("_cell", F.lit(True)).unionByName(side, allowMissingColumns=True)
        if not axes:
            return rows.agg(*[F.max(c).alias(c) for c in rows.columns]).drop("_cell")
        everyone = W.partitionBy()
        spread = rows.withColumns({c: F.max(c).over(everyone) for c in side.columns})
        return spread.where("_cell").drop("_cell")
    renamed = side.select([C(k).alias(f"_k_{k}") for k in keys]
                          + [C(c) for c in side.columns if c not in keys])
    same = None
    for k in keys:
        one = cells[k].eqNullSafe(renamed[f"_k_{k}"])
        same = one if same is None else same & one
    return cells.join(renamed, same, "left").drop(*[f"_k_{k}" for k in keys])


def _refuse_misuse(ctx: Context, names: Sequence[str]) -> None:
    for name in names:
        needed = MEASURES[name].axis if name in MEASURES and not _attached(ctx, name) else None
        if needed and needed not in ctx.axes:
            raise ValueError(f"{name} needs the axis {needed}")


def _cells(
    ctx: Context, left: Context, cube: DataFrame, sums: Mapping[str, Quantity], names: set[str], looked_back: set[str]
) -> DataFrame:
    """One row per cell with every sum and every time value asked for."""
    timed = bool(names & set(TIME))
    months_first = timed and not ctx.by_month
    grain = [*ctx.axes_without(CALENDAR), "mes_idx"] if months_first else ctx.axes
    cells = cube.groupBy(*grain).agg(*[left.sum_of(q).alias(name) for name, q in sums.items()])
    if "_limites" in names:
        cells = cells.withColumn("_limites", ctx.calendar_limits().select(F.struct("*")).scalar())
    if months_first:
        if ctx.by_period:
            cells = _time_by_calendar_axis(ctx, cells, names, list(sums), looked_back)
        else:
            cells = cells.groupBy(*ctx.axes).agg(
                *[F.sum(name).alias(name) for name in sums],
                *[value.alias(name) for name, value in _time_over_period(ctx, names).items()],
                *([F.first("_limites").alias("_limites")] if "_limites" in names else []))
        sector = W.partitionBy(*ctx.axes_without(OPERATOR))
        cells = cells.withColumns({
            name: F.sum(name).over(sector) for name in ("setor", "setor_mes_anterior") if name in names})
    elif timed:
        if looked_back:
            cells = _with_blank_months(ctx, cells, looked_back, list(sums))
        if "setor_mes_anterior" in names:
            cells = _sector_month_before(ctx, cells)
        cells = cells.withColumn("_ano", index_year(C("mes_idx"))).withColumns(_time_by_month(ctx, names))
    return cells.withColumns(ctx.beyond_axes(cells, sums))


def _canonical_axes(ctx: Context, names: Sequence[str]) -> list[str]:
    """The axes under which the measures are evaluated: where axes stand for one that a measure needs, that one
    takes part too; a month fixed by others takes their place."""
    axes = list(ctx.axes)
    if ctx.by_period and set(names) & set(TIME) and _stands_for(axes, "mes_idx"):
        axes = [*[a for a in axes if a not in CALENDAR], "mes_idx"]
    needed = {MEASURES[n].axis for n in names if n in MEASURES and MEASURES[n].axis}
    return axes + sorted(a for a in needed - set(axes) if _stands_for(axes, a))


def evaluate(
    star: Star, axes: Sequence[str], measures: Sequence[str],
    filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """One row per cell that has complaints, or a value of a measure that looks back: the axes, then the measures.

    The month axis is `mes_idx` (`year * 12 + month`); `queixa.functions.dates` labels it. Axes that
    fix one month, `ano_mes` or `ano` and `mes`, are the month axis too: time measures take them alike. On other
    calendar axes a year to date and a trailing mean are those of the cell's last selected month.
    """
    ctx = Context(star, axes, filters)
    ordered = _closure(ctx, measures)
    canonical = _canonical_axes(ctx, ordered)
    if canonical != ctx.axes:
        found = evaluate(star, canonical, measures, filters)
        labels = [CALENDAR_OF_INDEX[a](C("mes_idx")).alias(a) if a in CALENDAR and a not in canonical else C(a) for a in axes]
        return found.select(*labels, *dict.fromkeys(measures))
    _refuse_misuse(ctx, ordered)
    names, looked_back = set(ordered), _looked_back(measures)
    known = quantities(star)
    sums = {name: known[name] for name in ordered if name in known}
    below = names & set(PEERS) and "operadora" not in ctx.axes
    lifted, extra = [], ["mes_idx"] if names & set(TIME) else []
    if names & set(MARKET) or below:
        lifted, extra = [*lifted, lifting(OPERATOR)], [*extra, "operadora"]
    if names & set(PLACE):
        lifted, extra = [*lifted, lifting(STATE)], [*extra, "estado"]
    cube, left = ctx.cube([*sums.values(), *lifted], extra)

    cells = _cells(ctx, left, cube, sums, names, looked_back)
    if "assinantes" in names:
        cells = _attach(cells, ctx.axes, *_subscribers(ctx))
    if names & set(MARKET):
        cells = _attach(cells, ctx.axes, *_market(left, cube))
    if below:
        cells = _attach(cells, ctx.axes, *_risk_peers(left, cube))
    if names & set(PLACE):
        cells = _attach(cells, ctx.axes, *_worst_state(left, cube))
    for step in _steps(ctx, ordered):
        cells = cells.withColumns({name: MEASURES[name].value(ctx) for name in step})
    has_value = C("total").isNotNull()
    chosen = ctx.month_selected(C("mes_idx")) if ctx.by_month else C("_escolhida") if "_escolhida" in cells.columns else F.lit(True)
    for name in dict.fromkeys(measures):
        if name in LOOKING_BACK:
            has_value = has_value | (C(name).isNotNull() & chosen)
    return cells.where(has_value).select(*ctx.axes, *dict.fromkeys(measures))
