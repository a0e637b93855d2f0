"""The report's datasets: axis columns, measures, sort order, under the page's filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queixa.functions.dates import index_label, index_text
from queixa.operators.aggregates import drill
from queixa.operators.star import Star
from queixa.operators.windows import share
from queixa.plans.measures import evaluate


@dataclass(frozen=True)
class Report:
    axes: tuple[str, ...]
    measures: tuple[str, ...]
    sort: tuple[str, ...] = ()  # measures, largest first; then the axes
    stacked: str | None = None  # outer axis of a 100% stack


REPORTS: dict[str, Report] = {
    "headline_figures": Report((), ("total", "taxa_resolucao", "em_aberto", "var_mom", "hhi")),
    "executive_sentence": Report((), ("insight",)),
    "monthly_evolution": Report(("mes_idx",), ("total", "media_movel_3m")),
    "status_mix": Report(("status",), ("total",), ("total",)),
    "volume_by_operator": Report(("operadora",), ("total",), ("total",)),
    "reasons_by_category": Report(("categoria",), ("total",), ("total",)),
    "volume_resolution_base": Report(("operadora",), ("total", "taxa_resolucao", "por_100k")),
    "per_100k_ranking": Report(("operadora",), ("por_100k",), ("por_100k",)),
    "operator_panel": Report(
        ("operadora", "grupo"),
        ("total", "share_operadora", "taxa_resolucao", "em_aberto", "por_100k", "score_risco",
         "rating_risco"), ("total",)),
    "category_mix": Report(("operadora", "categoria"), ("total",), stacked="operadora"),
    "subcategories": Report(("subcategoria",), ("total",), ("total",)),
    "by_region": Report(("regiao",), ("total",), ("total",)),
    "by_state": Report(("uf",), ("total",), ("total",)),
    "status_by_region": Report(("regiao", "status"), ("total",), stacked="regiao"),
    "state_detail": Report(("uf", "regiao"), ("total", "share_uf", "taxa_resolucao"), ("total",)),
    "risk_table": Report(
        ("operadora",), ("total", "taxa_resolucao", "por_100k", "score_risco", "rating_risco"),
        ("score_risco",)),
    "market_structure": Report((), ("hhi", "top3", "cobertura")),
    "monthly_deviation": Report(("mes_idx",), ("z_mensal",)),
    "structural_trend": Report(("operadora",), ("tendencia",), ("tendencia",)),
    "data_quality": Report((), ("total_geral", "cobertura", "nao_identificadas", "pct_nao_identificado")),
}


def dataset(star: Star, name: str, filters: Mapping[str, Sequence] | None = None) -> DataFrame:
    """One report dataset. `filters` maps a column to the values selected on it
    (year, operator, region, service, or whatever a click on a visual adds)."""
    if name == "category_drill":
        return category_drill(star, filters)
    report = REPORTS[name]
    cells = evaluate(star, report.axes, report.measures, filters)
    if report.stacked:
        cells = cells.withColumn("participacao", share(F.col("total"), report.stacked))
    return by_report_order(cells, report.axes, report.sort)


def by_report_order(cells: DataFrame, axes: Sequence[str], sort: Sequence[str]) -> DataFrame:
    """Sorted by measure and then by axis, so the order is total; the month axis shows its
    label but sorts by its number."""
    order: list[Column] = [F.desc_nulls_last(m) for m in sort] + [F.asc(a) for a in axes]
    ordered = cells.orderBy(*order) if order else cells
    if "mes_idx" not in axes:
        return ordered
    index = F.col("mes_idx")
    rest = [c for c in cells.columns if c != "mes_idx"]
    return ordered.select(index_text(index).alias("ano_mes"), index_label(index).alias("mes_rotulo"), *rest)


def category_drill(star: Star, filters: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Category x operator, each category expandable to its subcategories."""
    rows = star.cube(["categoria", "subcategoria", "operadora"], filters)
    return drill(rows, "categoria", "subcategoria", "operadora").orderBy(
        "categoria", F.desc("nivel"), "subcategoria", "operadora")
