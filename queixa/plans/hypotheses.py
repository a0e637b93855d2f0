"""The exploratory questions: five hypotheses with their evidence, and a verdict table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queixa.fixed_values import CLAIMS, DEFAULT_SUBSCRIBERS_MILLIONS, REASON_WORDS
from queixa.functions.numbers import per_100k, ratio, round_half_away, round_half_even
from queixa.operators.aggregates import (
    arg_max, resolution_by, spread_and_mean, total, volume_by,
)
from queixa.operators.cleaning import region_of_state
from queixa.operators.windows import first_k, pareto, share
from queixa.plans.kpis import min_max_score, with_subscriber_base


def concentration_by_operator(frame: DataFrame) -> DataFrame:
    """H1: operators in descending volume with share and running share."""
    return pareto(volume_by(frame, "operadora"), "operadora").orderBy(F.desc("volume"), "operadora")


def volume_by_reason(frame: DataFrame) -> DataFrame:
    """H2: reasons in descending volume with their share."""
    return volume_by(frame, "categoria").withColumn(
        "share_pct", round_half_even(share(F.col("volume")) * 100, 2)
    ).orderBy(F.desc("volume"), "categoria")


def resolution_by_operator(frame: DataFrame) -> DataFrame:
    """H3: answered share per operator, rounded to two decimals."""
    rates = resolution_by(frame, "operadora")
    return rates.select(
        "operadora", F.col("volume").alias("total"), "respondidas",
        round_half_even(ratio(F.col("respondidas"), F.col("volume")) * 100, 2).alias("taxa_resolucao"),
    ).orderBy(F.desc("taxa_resolucao"), "operadora")


def volume_by_quarter_and_operator(frame: DataFrame) -> DataFrame:
    """H4: operator x quarter (`T1`..`T4`, all years together)."""
    cells = volume_by(frame, "operadora", "trimestre")
    return cells.select(
        "operadora", F.concat(F.lit("T"), F.col("trimestre").cast("string")).alias("trimestre"), "volume")


def volume_by_quarter(frame: DataFrame) -> DataFrame:
    """H4: the quarters, summed over operators."""
    return volume_by_quarter_and_operator(frame).groupBy("trimestre").agg(
        F.sum("volume").alias("volume")).orderBy("trimestre")


def volume_by_region(frame: DataFrame) -> DataFrame:
    """H5: regions in descending volume with their share."""
    return volume_by(frame, "regiao").withColumn(
        "share_pct", round_half_even(share(F.col("volume")) * 100, 2)
    ).orderBy(F.desc("volume"), "regiao")


def _tenth(value: Column) -> Column:
    return F.format_string("%.1f", round_half_away(value, 1))


def _verdict(df: DataFrame, code: str, result: Column, holds: Column, **terms) -> DataFrame:
    return df.select(
        F.lit(code).alias("hipotese"), F.lit(CLAIMS[code].format(**terms)).alias("descricao"),
        result.alias("resultado"), F.coalesce(holds, F.lit(False)).alias("confirmada"))


def verdict_concentration(frame: DataFrame, k: int = 3, above: float = 70.0) -> DataFrame:
    top = first_k(concentration_by_operator(frame), k, F.desc("volume"), "operadora")
    held = top.agg(F.sum("share_pct").alias("s"))
    return _verdict(held, "H1", F.concat(F.lit(f"Top {k} = "), _tenth(F.col("s")), F.lit("%")),
                    F.col("s") > above, k=k, above=above)


def verdict_reason(frame: DataFrame, words: tuple[str, ...] = REASON_WORDS) -> DataFrame:
    first = first_k(volume_by_reason(frame), 1, F.desc("volume"), "categoria")
    mentions = F.lit(False)
    for word in words:
        mentions = mentions | F.lower("categoria").contains(word)
    result = F.concat("categoria", F.lit(" ("), _tenth(F.col("share_pct")), F.lit("%)"))
    return _verdict(first, "H2", result, mentions)


def verdict_resolution(frame: DataFrame, at_least: float = 20.0) -> DataFrame:
    gap = spread_and_mean(resolution_by_operator(frame), "taxa_resolucao")
    return _verdict(gap, "H3", F.concat(F.lit("Gap = "), _tenth(F.col("gap")), F.lit("pp")),
                    F.col("gap") >= at_least, at_least=at_least)


def verdict_quarter(frame: DataFrame, expected: str = "T1") -> DataFrame:
    peak = arg_max(volume_by_quarter(frame), "trimestre", "volume")
    return _verdict(peak, "H4", F.concat(F.lit("Pico em "), F.col("trimestre")),
                    F.col("trimestre") == expected, quarter=expected)


def verdict_region(frame: DataFrame, expected: str = "Sudeste") -> DataFrame:
    """Whether the expected region really is the largest; its own share is the evidence."""
    regions = volume_by_region(frame)
    mine = F.col("regiao") == expected
    held = regions.agg(
        F.coalesce(F.sum(F.when(mine, F.col("share_pct"))), F.lit(0.0)).alias("s"),
        F.max(F.when(mine, F.col("volume"))).alias("v"), F.max("volume").alias("m"))
    return _verdict(held, "H5", F.concat(F.lit(f"{expected}: "), _tenth(F.col("s")), F.lit("%")),
                    F.col("v") == F.col("m"), region=expected)


HYPOTHESIS_KEYS = ["operadora", "categoria", "regiao", "trimestre", "status"]


def hypotheses(frame: DataFrame, region: str = "Sudeste") -> DataFrame:
    """The verdict table, five rows. All five start from the same grouping of the fact,
    whose shuffle the planner runs once and reuses."""
    cube = frame.groupBy(*HYPOTHESIS_KEYS).agg(total().alias("qtd"))
    return (verdict_concentration(cube)
            .unionByName(verdict_reason(cube))
            .unionByName(verdict_resolution(cube))
            .unionByName(verdict_quarter(cube))
            .unionByName(verdict_region(cube, region)))


def monthly_series(frame: DataFrame) -> DataFrame:
    """Monthly volume by operator."""
    return volume_by(frame, "ano_mes", "operadora").orderBy("operadora", "ano_mes")


def composite_score(
    frame: DataFrame, subscribers: DataFrame | None = None,
    fill: float | None = DEFAULT_SUBSCRIBERS_MILLIONS,
) -> DataFrame:
    """The min-max score from inputs that are rounded first."""
    rates = with_subscriber_base(resolution_by_operator(frame), subscribers, fill)
    shares = rates.select(
        "operadora", "total", "respondidas", "taxa_resolucao", F.col("total").alias("volume"),
        round_half_even(share(F.col("total")) * 100, 2).alias("share_pct"),
        F.col("assinantes_mi").alias("assinantes"),
        round_half_even(per_100k(F.col("total"), F.col("assinantes_mi")), 2).alias("recl_por_100k"))
    return shares.withColumn("score_risco", min_max_score(
        F.col("volume"), F.col("taxa_resolucao"), F.col("recl_por_100k"))
    ).orderBy(F.desc("score_risco"), "operadora")


def top_states(frame: DataFrame, k: int = 15, region: Column | None = None) -> DataFrame:
    """The k states with most complaints and their region."""
    top = first_k(volume_by(frame, "uf"), k, F.desc("volume"), "uf")
    return top.withColumn("regiao", region_of_state(F.col("uf")) if region is None else region)


def data_audit(frame: DataFrame) -> DataFrame:
    """Size of the data and what it covers: rows, columns, copies, operators, states.

    Copies collapse on the reading side; everything else is counted on what is left.
    """
    kinds = frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("_n"))
    counted = kinds.agg(
        F.sum("_n").alias("linhas"), F.sum(F.col("_n") - 1).alias("duplicatas"),
        F.count_distinct("operadora").alias("operadoras"), F.count_distinct("uf").alias("ufs"))
    return counted.select(
        "linhas", F.lit(len(frame.columns)).alias("colunas"), "duplicatas",
        round_half_even(ratio(F.col("duplicatas"), F.col("linhas")) * 100, 1).alias("duplicatas_pct"),
        "operadoras", "ufs")
