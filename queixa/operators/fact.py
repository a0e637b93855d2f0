"""The fact: one row per clean complaint, carrying the keys of its dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queixa.operators.numbering import has_positions, numbered


def build_fact(clean: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Look up the four keys; a row whose value has no dimension row keeps a NULL key.

    The day needs no join: the calendar has no gaps, so a day's key is its distance
    from the first one. Whether a dimension is broadcast is left to the planner,
    which compares its size with `spark.sql.autoBroadcastJoinThreshold`.

    Rows that were stored with their positions are numbered 1..n by them; others get a unique
    number that only holds while they are not computed again.
    """
    stored = has_positions(clean)
    if stored:
        clean = numbered(clean, "id_reclamacao")
    operators = dimensions["dim_operadora"].select("id_operadora", F.col("nome").alias("operadora"))
    states = dimensions["dim_uf"].select("id_uf", F.col("sigla").alias("uf_sigla"))
    types = dimensions["dim_tipo_reclamacao"].select(
        "id_tipo", F.col("categoria").alias("motivo"), F.col("subcategoria").alias("detalhe_motivo"))
    first_day = dimensions["dim_calendario"].select(F.min("data")).scalar()
    keyed = (clean
             .join(operators, "operadora", "left")
             .join(states, "uf_sigla", "left")
             .join(types, ["motivo", "detalhe_motivo"], "left"))
    service = F.col("sigla_servico") if "sigla_servico" in clean.columns else F.lit(None).cast("string")
    fact = keyed.select(
        *(["id_reclamacao"] if stored else []),
        (F.datediff("data_abertura", first_day) + 1).alias("id_data"),
        "id_operadora", "id_uf", "id_tipo", "status",
        service.alias("sigla_servico"),
        F.lit(1).alias("qtd"),
        F.year("data_abertura").alias("ano"),
    )
    return fact if stored else add_row_id(fact)


def add_row_id(fact: DataFrame, name: str = "id_reclamacao") -> DataFrame:
    """A unique id per row. It is not dense: 1..n would put the whole fact in one order."""
    return fact.select((F.monotonically_increasing_id() + 1).alias(name), "*")
