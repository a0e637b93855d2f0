"""Writers for the star schema and the KPI tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queixa.operators.cleaning import clean_files
from queixa.operators.dimensions import (
    build_calendar, build_complaint_types, build_operators, build_states, dense_ids,
)
from queixa.operators.fact import build_fact
from queixa.operators.numbering import with_positions
from queixa.operators.star import Star, star_of
from queixa.plans.kpis import KPI_TABLES, kpi_cube
from queixa.schema import FACT, MANIFEST, MANIFEST_SCHEMA, STAR_TABLES, STORED_FACT
from queixa.session import size_shuffles, write_and_read_back
from queixa.sources.account import DropAccount


# What dimensions and fact read of the cleaned rows.
STAR_SOURCES = ("data_abertura", "operadora", "porte", "grupo_economico", "uf_sigla", "motivo", "detalhe_motivo", "status", "sigla_servico")


DAYS_TOGETHER = 31


def write_table(df: DataFrame, folder: str, name: str, fmt: str = "parquet") -> None:
    """`<name>` as Parquet, or `<name>.csv` as CSV with a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(os.path.join(folder, f"{name}.csv"))
    else:
        writer.format(fmt).save(os.path.join(folder, name))


def write_star(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """The five tables. The fact is split by year for partition pruning.

    `rebalance` lets the run-time planner cut a heavy year into many files and
    join small ones, so no task has to write a whole year. Rows are sorted by day inside
    a file, which lets a reader skip row groups and packs the columns better.
    """
    for name, table in tables.items():
        if name != "fato_reclamacoes":
            write_table(table, folder, name, fmt)
            continue
        if fmt == "csv":
            write_table(table.drop("ano"), folder, name, fmt)
        else:
            # a month or so of days together: within a year, a reader skips the files of other months
            dealt = table.withColumn("_dias", F.floor(F.col("id_data") / DAYS_TOGETHER)).hint("rebalance", "ano", "_dias")
            (dealt.drop("_dias").sortWithinPartitions("ano", "id_data", "id_operadora")
             .write.mode("overwrite").partitionBy("ano").parquet(os.path.join(folder, name)))


def store_dimensions(clean: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Build the four dimensions, store them, and open them again.

    Once stored, a dimension's size on disk tells the planner how to join it to the fact.
    """
    spark = clean.sparkSession
    dimensions = {
        "dim_operadora": dense_ids(build_operators(clean), "id_operadora", ["nome"]),
        "dim_uf": build_states(spark),
        "dim_tipo_reclamacao": dense_ids(build_complaint_types(clean), "id_tipo", ["categoria", "subcategoria"]),
        "dim_calendario": build_calendar(clean),
    }
    write_star(dimensions, folder)
    return {name: spark.read.schema(table.schema).parquet(os.path.join(folder, name))
            for name, table in dimensions.items()}


def store_clean(raw_files: list[DataFrame], account: DropAccount | None = None) -> DataFrame:
    """The cleaned rows in the shared folder, because three dimensions and the fact all start from them; only
    the columns that these use. Their positions are stored with them and number the fact."""
    rows = clean_files(raw_files, account=account)
    return write_and_read_back(with_positions(rows.select(*[c for c in STAR_SOURCES if c in rows.columns])), "limpo")


def publish(spark: SparkSession, folder: str, write: Callable[[str], None]) -> None:
    """Put `folder` in place as a whole: written beside, then renamed. A write that fails half-way leaves what was there."""
    mark = uuid.uuid4().hex
    beside, before = f"{folder.rstrip('/')}.parcial-{mark}", f"{folder.rstrip('/')}.anterior-{mark}"
    write(beside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = files.exists(path(folder)) and files.rename(path(folder), path(before))
    if not files.rename(path(beside), path(folder)):
        if replaced:
            files.rename(path(before), path(folder))
        raise OSError(f"{beside} could not be renamed to {folder}")
    if replaced:
        files.delete(path(before), True)


def write_manifest(spark: SparkSession, folder: str) -> None:
    """How many rows each stored table has: the last thing written, so a star that has it is whole."""
    rows = [(name, spark.read.parquet(os.path.join(folder, name)).count()) for name in STAR_TABLES]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(os.path.join(folder, MANIFEST))


def run_etl(raw_files: list[DataFrame], folder: str, account: DropAccount | None = None) -> Star:
    """Raw files to a stored star schema, reading the raw files once.

    The star appears under `folder` when all of its tables and the manifest are written; until
    then, and if writing fails, the star stored there before can be read. An `account` that also watched
    the reading knows afterwards what was left out and why.
    """
    size_shuffles(*raw_files)
    clean = store_clean(raw_files, account)
    spark = clean.sparkSession

    def write(beside: str) -> None:
        dimensions = store_dimensions(clean, beside)
        write_star({"fato_reclamacoes": build_fact(clean, dimensions)}, beside)
        write_manifest(spark, beside)
    publish(spark, folder, write)
    return star_of({name: spark.read.schema(STORED_FACT if schema is FACT else schema).parquet(os.path.join(folder, name))
                    for name, schema in STAR_TABLES.items()})


def write_kpis(
    frame: DataFrame, folder: str, fmt: str = "csv",
    targets: Mapping[str, Callable[..., DataFrame]] | None = None,
) -> None:
    """One table per KPI. The fact is read once: all of them start from one small stored cube."""
    cube = write_and_read_back(kpi_cube(frame), "cubo_kpi")
    for name, build in (targets or KPI_TABLES).items():
        write_table(build(cube), folder, name, fmt)
