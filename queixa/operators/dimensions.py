"""The four dimensions and their keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queixa import schema
from queixa.fixed_values import OPERATOR_FACTS, STATES, SUBSCRIBERS
from queixa.functions.dates import day_name, index_label, month_index, month_name
from queixa.operators.numbering import numbered_by_key


def dense_ids(df: DataFrame, id_column: str, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Number distinct keys 1..n in key order, without sorting them all in one task. A null key counts first."""
    return numbered_by_key(df, id_column, keys, partitions=partitions)


def build_operators(
    clean: DataFrame, overrides: Sequence[tuple[str, str, str]] = tuple(OPERATOR_FACTS)
) -> DataFrame:
    """One row per brand. Size and group come from the fixed table where it knows the
    brand, else from the brand's earliest complaint (ties: smallest values)."""
    seen = F.min(F.struct(
        "data_abertura", F.col("porte").isNull().alias("np"), "porte",
        F.col("grupo_economico").isNull().alias("ng"), "grupo_economico",
    ))
    brands = clean.groupBy(F.col("operadora").alias("nome")).agg(seen.alias("_seen"))
    size = F.create_map(*[F.lit(v) for brand, porte, _ in overrides for v in (brand, porte)])
    group = F.create_map(*[F.lit(v) for brand, _, grupo in overrides for v in (brand, grupo)])
    known = F.col("nome").isin([brand for brand, _, _ in overrides])
    return brands.select(
        "nome",
        F.when(known, F.try_element_at(size, "nome")).otherwise(F.col("_seen.porte")).alias("porte"),
        F.when(known, F.try_element_at(group, "nome"))
        .otherwise(F.col("_seen.grupo_economico")).alias("grupo_economico"),
    )


def build_states(spark: SparkSession, states: Sequence[tuple] = tuple(STATES)) -> DataFrame:
    """The 27 fixed states."""
    return spark.createDataFrame(list(states), schema.STATES)


def build_complaint_types(clean: DataFrame) -> DataFrame:
    """Distinct (category, subcategory) pairs."""
    return clean.select(
        F.col("motivo").alias("categoria"), F.col("detalhe_motivo").alias("subcategoria")
    ).distinct()


def calendar_from_bounds(bounds: DataFrame) -> DataFrame:
    """Every day between `primeiro` and `ultimo` of a one-row frame, with its attributes."""
    day = F.col("data")
    days = bounds.where("primeiro IS NOT NULL").select(
        F.posexplode(F.sequence("primeiro", "ultimo", F.expr("interval 1 day"))).alias("pos", "data"))
    return days.select(
        (F.col("pos") + 1).alias("id_data"),
        "data",
        F.year(day).alias("ano"),
        F.quarter(day).alias("trimestre"),
        F.month(day).alias("mes"),
        month_name(F.month(day)).alias("nome_mes"),
        F.weekofyear(day).alias("semana_ano"),
        F.weekday(day).alias("dia_semana"),
        day_name(F.weekday(day)).alias("nome_dia"),
        (F.weekday(day) >= 5).cast("int").alias("fim_semana"),
    )


def build_calendar(clean: DataFrame, day: str = "data_abertura") -> DataFrame:
    """A row per day from the first to the last complaint, without gaps."""
    return calendar_from_bounds(
        clean.agg(F.min(day).alias("primeiro"), F.max(day).alias("ultimo")))


def with_month_labels(calendar: DataFrame) -> DataFrame:
    """The sort key `year*100+month` and the label it sorts (`jan/22`)."""
    return calendar.withColumns({
        "ano_mes_num": F.col("ano") * 100 + F.col("mes"),
        "mes_rotulo": index_label(month_index(F.col("data"))),
    })


def with_subscribers(
    operators: DataFrame, subscribers: Sequence[tuple[str, int]] = tuple(SUBSCRIBERS)
) -> DataFrame:
    """Estimated subscribers of a brand, NULL where no figure exists."""
    return operators.withColumn("assinantes_estimados", subscribers_of(F.col("nome"), subscribers))


def subscribers_of(
    brand: Column, subscribers: Sequence[tuple[str, int]] = tuple(SUBSCRIBERS)
) -> Column:
    pairs = [F.lit(v) for name, count in subscribers for v in (name, count)]
    return F.try_element_at(F.create_map(*pairs), brand).cast("long")
