"""The five KPI tables. Each takes complaint rows, or a cube of them: `qtd` is additive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from queixa.fixed_values import (
    DEFAULT_SUBSCRIBERS_MILLIONS, HEADLINE_METRICS, HHI_SCALE, RISK_WEIGHTS, SUBSCRIBERS,
)
from queixa.functions.numbers import per_100k, ratio, round_half_even
from queixa.operators.aggregates import answered, resolution_by, total, volume_and_total_by, volume_by
from queixa.operators.windows import min_max, rank_with_gaps, with_row_changes

CUBE_KEYS = ["operadora", "uf", "categoria", "ano_mes", "status"]


def kpi_cube(frame: DataFrame) -> DataFrame:
    """Everything the five tables need, from one pass over the complaints."""
    return frame.groupBy(*CUBE_KEYS).agg(
        total().alias("qtd"), F.min(first_day(frame)).alias("dia_min"),
        F.max(last_day(frame)).alias("dia_max"))


def first_day(frame: DataFrame) -> Column:
    return F.col("dia_min" if "dia_min" in frame.columns else "dia")


def last_day(frame: DataFrame) -> Column:
    return F.col("dia_max" if "dia_max" in frame.columns else "dia")


def subscribers_millions() -> Column:
    """Subscribers in millions from the fixed table, NULL for other brands."""
    pairs = [F.lit(v) for brand, count in SUBSCRIBERS for v in (brand, count / 1e6)]
    return F.try_element_at(F.create_map(*pairs), F.col("operadora"))


def kpis_consolidado(frame: DataFrame) -> DataFrame:
    """Nine headline figures as metric, text value and unit."""
    cells = frame.groupBy("operadora", "uf", "categoria").agg(
        total().alias("n"), total(answered()).alias("r"),
        F.min(first_day(frame)).alias("first"), F.max(last_day(frame)).alias("last"))
    # Totals per operator, state and reason and over everything, in one more grouping: the distinct members
    # are its rows, and the index is a sum over the operators' rows.
    keys = [F.col(k) for k in ("operadora", "uf", "categoria")]
    folded = cells.groupingSets([[k] for k in keys] + [[]], *keys).agg(
        F.sum("n").alias("n"), F.sum("r").alias("r"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.grouping_id().alias("folded"))
    # which of the three keys are folded, as bits
    by_operator, by_state, by_reason, everything = (F.col("folded") == bits for bits in (0b011, 0b101, 0b110, 0b111))

    def whole(name: str) -> Column:
        return F.max(F.when(everything, F.col(name)))
    volume = F.col("n").cast("double")
    one = folded.agg(
        F.coalesce(whole("n"), F.lit(0)).alias("n"), F.coalesce(whole("r"), F.lit(0)).alias("r"),
        F.count_if(by_operator & F.col("operadora").isNotNull()).alias("ops"),
        F.count_if(by_state & F.col("uf").isNotNull()).alias("ufs"),
        F.count_if(by_reason & F.col("categoria").isNotNull()).alias("reasons"),
        F.sum(F.when(by_operator & F.col("operadora").isNotNull(), volume * volume)).alias("squares"),
        whole("first").alias("first"), whole("last").alias("last"))
    one = one.withColumn("hhi", F.coalesce(ratio(F.col("squares"), F.col("n").cast("double") * F.col("n")), F.lit(0.0)) * HHI_SCALE)
    rate = F.coalesce(round_half_even(ratio(F.col("r"), F.col("n")) * 100, 2), F.lit(0.0))

    def day(name: str) -> Column:
        return F.coalesce(F.date_format(name, "dd/MM/yyyy"), F.lit("-"))

    values = [F.col("n"), rate, F.col("n") - F.col("r"), F.col("ops"), F.col("ufs"), F.col("reasons"),
              F.rint("hhi"), day("first"), day("last")]
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("metrica"), value.cast("string").alias("valor"),
                 F.lit(unit).alias("unidade"))
        for (name, unit), value in zip(HEADLINE_METRICS, values, strict=True)])))


def with_subscriber_base(
    df: DataFrame, subscribers: DataFrame | None, fill: float | None = DEFAULT_SUBSCRIBERS_MILLIONS
) -> DataFrame:
    """`assinantes_mi` per operator from a table (operadora, assinantes_mi) or the fixed one."""
    if subscribers is None:
        df = df.withColumn("assinantes_mi", subscribers_millions())
    else:
        df = df.join(subscribers.select("operadora", "assinantes_mi"), "operadora", "left")
    return df if fill is None else df.na.fill({"assinantes_mi": fill})


def min_max_score(volume: Column, rate: Column, rate_per_100k: Column) -> Column:
    w_volume, w_unresolved, w_base = RISK_WEIGHTS
    return round_half_even(
        min_max(volume.cast("double")) * w_volume
        + min_max(100 - rate) * w_unresolved
        + min_max(rate_per_100k) * w_base, 4)


def kpis_por_operadora(
    frame: DataFrame, subscribers: DataFrame | None = None,
    fill: float | None = DEFAULT_SUBSCRIBERS_MILLIONS,
) -> DataFrame:
    """Volume, resolution, share, rate per 100k, two ranks and the min-max risk score."""
    by_operator = with_subscriber_base(resolution_by(frame, "operadora"), subscribers, fill)
    volume = F.col("volume")
    rates = by_operator.select(
        "operadora", "volume",
        (ratio(F.col("respondidas"), volume) * 100).alias("_rate"),
        round_half_even(ratio(volume, F.col("geral")) * 100, 2).alias("share_pct"),
        "assinantes_mi",
        round_half_even(per_100k(volume, F.col("assinantes_mi")), 2).alias("recl_por_100k"))
    return rates.select(
        "operadora", "volume", round_half_even(F.col("_rate"), 2).alias("taxa_resolucao_pct"),
        "share_pct", "assinantes_mi", "recl_por_100k",
        rank_with_gaps(volume).alias("ranking_volume"),
        rank_with_gaps(F.col("recl_por_100k")).alias("ranking_100k"),
        min_max_score(volume, F.col("_rate"), F.col("recl_por_100k")).alias("score_risco"),
    ).orderBy("ranking_volume", "operadora")


def kpis_temporais(frame: DataFrame) -> DataFrame:
    """Monthly volume per operator with row-based changes and trailing mean."""
    monthly = volume_by(frame, "ano_mes", "operadora")
    return with_row_changes(monthly, "operadora", "ano_mes").select(
        "ano_mes", "operadora", "volume", "volume_mes_anterior", "var_mom_pct",
        "volume_ano_anterior", "var_yoy_pct", "media_movel_3m",
    ).orderBy("operadora", "ano_mes")


def kpis_motivos(frame: DataFrame, top: int | None = None) -> DataFrame:
    """Reasons per operator: share of all complaints and rank inside the operator."""
    ranked = volume_and_total_by(frame, "operadora", "categoria").select(
        "operadora", F.col("categoria").alias("motivo"), "volume",
        round_half_even(ratio(F.col("volume"), F.col("geral")) * 100, 2).alias("share_pct"),
        rank_with_gaps(F.col("volume"), "operadora").alias("ranking"))
    ranked = ranked if top is None else ranked.where(F.col("ranking") <= top)
    return ranked.orderBy("operadora", "ranking", "motivo")


def kpis_regionais(frame: DataFrame) -> DataFrame:
    """Volume, resolution, share and rank per state."""
    volume = F.col("volume")
    return resolution_by(frame, "uf").select(
        "uf", "volume",
        round_half_even(ratio(F.col("respondidas"), volume) * 100, 2).alias("taxa_resolucao"),
        round_half_even(ratio(volume, F.col("geral")) * 100, 2).alias("share_pct"),
        rank_with_gaps(volume).alias("ranking"),
    ).orderBy("ranking", "uf")


KPI_TABLES = {
    "kpis_consolidado": kpis_consolidado,
    "kpis_por_operadora": kpis_por_operadora,
    "kpis_temporais": kpis_temporais,
    "kpis_motivos": kpis_motivos,
    "kpis_regionais": kpis_regionais,
}
