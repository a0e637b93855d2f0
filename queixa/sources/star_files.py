"""The stored star schema: Parquet folders, or CSV files written elsewhere."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queixa.functions.dates import with_time_columns
from queixa.operators.cleaning import clean_light
from queixa.operators.star import Star, star_of
from queixa.schema import FACT, MANIFEST, MANIFEST_SCHEMA, STAR_TABLES, STORED_FACT
from queixa.session import size_shuffles
from queixa.sources.raw import path_exists, read_many, union_all

RAW_FILES = ("reclamacoes_scm.csv", "reclamacoes_smp.csv")
FACT_COLUMNS = ["dia", "operadora", "uf", "regiao", "categoria", "subcategoria", "status", "servico"]


def read_star_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five tables by name; Parquet where present, else `<name>.csv` (UTF-8, BOM or not)."""
    tables = {}
    for name, schema in STAR_TABLES.items():
        stored = os.path.join(folder, name)
        if path_exists(spark, stored):
            tables[name] = spark.read.schema(STORED_FACT if schema is FACT else schema).parquet(stored)
        else:
            tables[name] = spark.read.csv(
                f"{stored}.csv", header=True, schema=schema, encoding="UTF-8"
            )
    return tables


def read_star(spark: SparkSession, folder: str) -> Star:
    """The stored star; shuffles over it start with partitions that fit its fact."""
    tables = read_star_tables(spark, folder)
    size_shuffles(tables["fato_reclamacoes"])
    return star_of(tables)


def has_star(spark: SparkSession, folder: str) -> bool:
    """Whether a whole star is stored there: by its manifest, or, without one, by all of its tables."""
    manifest = os.path.join(folder, MANIFEST)
    if path_exists(spark, manifest):
        return {r.tabela for r in spark.read.schema(MANIFEST_SCHEMA).json(manifest).collect()} >= set(STAR_TABLES)
    return all(path_exists(spark, os.path.join(folder, name)) or path_exists(spark, os.path.join(folder, f"{name}.csv"))
               for name in STAR_TABLES)


def missing_rows(spark: SparkSession, folder: str) -> dict[str, int]:
    """Tables whose rows are not as many as the manifest says, and how many are missing."""
    told = spark.read.schema(MANIFEST_SCHEMA).json(os.path.join(folder, MANIFEST)).collect()
    lacking = {r.tabela: r.linhas - spark.read.parquet(os.path.join(folder, r.tabela)).count() for r in told}
    return {name: n for name, n in lacking.items() if n}


def load_fact(spark: SparkSession, processed: str, raw: str) -> DataFrame:
    """One row per complaint from the stored star, else from the raw files; same columns either way."""
    if has_star(spark, processed):
        return read_star(spark, processed).frame(FACT_COLUMNS)
    files = read_many(spark, [os.path.join(raw, name) for name in RAW_FILES])
    size_shuffles(*files)
    return clean_light(union_all(files)).select(*FACT_COLUMNS, "qtd")


def load_cube(spark: SparkSession, processed: str, raw: str, columns: Sequence[str]) -> DataFrame:
    """`qtd` per combination of `columns` from the same source; over a stored star the labels
    are looked up after summing."""
    if has_star(spark, processed):
        return read_star(spark, processed).cube(columns)
    rows = with_time_columns(load_fact(spark, processed, raw))
    return rows.groupBy(*columns).agg(F.sum("qtd").alias("qtd"))
