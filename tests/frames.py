"""Small stars built from counts: `qtd` is additive, so one row can stand for many complaints."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from queixa.operators.dimensions import calendar_from_bounds, subscribers_of
from queixa.operators.star import Star

COLUMNS = ["dia", "operadora", "uf", "regiao", "categoria", "subcategoria", "status", "servico", "qtd"]
SCHEMA = ("dia date, operadora string, uf string, regiao string, categoria string, subcategoria string, "
          "status string, servico string, qtd long")
DEFAULTS = {"dia": dt.date(2022, 1, 1), "operadora": "CLARO", "uf": "SP", "regiao": "Sudeste", "categoria": "Cobrança",
            "subcategoria": "Indevida", "status": "Respondida", "servico": "SCM", "qtd": 1}

# Published figures: brand, complaints, answered share in percent.
BRANDS = [("CLARO", 3391, 71.87), ("VIVO", 2000, 71.55), ("TIM", 1573, 71.58), ("OI", 775, 74.32),
          ("SERCOMTEL", 166, 68.07), ("NÃO IDENTIFICADA", 95, 73.68)]
# Complaints per month, January 2022 to December 2023.
MONTHS = [313, 324, 304, 344, 323, 311, 319, 298, 346, 347, 306, 342,
          350, 310, 357, 339, 336, 346, 330, 374, 317, 361, 327, 376]


def rows(spark, *cells: dict):
    return spark.createDataFrame([tuple({**DEFAULTS, **c}[k] for k in COLUMNS) for c in cells], SCHEMA)


def star(spark, *cells: dict, last: dt.date | None = None) -> Star:
    fact = rows(spark, *cells).withColumn("estado", F.col("uf"))
    days = [{**DEFAULTS, **c}["dia"] for c in cells]
    bounds = spark.createDataFrame([(min(days), last or max(days))], "primeiro date, ultimo date")
    names = sorted({n for n, _, _ in BRANDS} | {c.get("operadora", "CLARO") or "?" for c in cells})
    operators = spark.createDataFrame([(n,) for n in names], "operadora string")
    return Star(fact, {}, lambda: calendar_from_bounds(bounds).select("data"),
                lambda: operators.withColumn("assinantes", subscribers_of(F.col("operadora"))), "NÃO IDENTIFICADA")


def brand_cells() -> list[dict]:
    cells = []
    for name, volume, rate in BRANDS:
        done = round(volume * rate / 100)
        cells += [{"operadora": name, "qtd": done}, {"operadora": name, "status": "Pendente", "qtd": volume - done}]
    return cells


def month(i: int, day: int = 1) -> dt.date:
    return dt.date(2022 + i // 12, i % 12 + 1, day)


def month_cells() -> list[dict]:
    return [{"dia": month(i), "qtd": n} for i, n in enumerate(MONTHS)]
