"""The star and the dirty raw rows as seen in the test tables (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queixa.fixed_values import STATES
from queixa.operators.dimensions import calendar_from_bounds
from queixa.operators.star import Dimension, Star
from queixa.session import size_shuffles

UNIDENTIFIED = "HOUSEHOLD"


@cache
def _schema(path: str) -> T.StructType:
    """A stored table's schema, read from its footer once per process."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def group_of(operator: Column) -> Column:
    return F.when(operator == UNIDENTIFIED, F.lit("Não identificado")).otherwise(
        F.concat(F.lit("Grupo "), operator))


def complaint_star(spark: SparkSession, sf_dir: str) -> Star:
    """`lineitem` as complaints; operator, place and type reached through its keys."""
    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    fact = read("lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey",
        F.col("l_shipdate").cast("date").alias("dia"),
        F.when(F.col("l_returnflag") == "R", "Respondida")
        .when(F.col("l_returnflag") == "N", "Pendente").otherwise("Em Análise").alias("status"),
        F.when(F.col("l_linestatus") == "O", "SCM").otherwise("SMP").alias("servico"),
        F.lit(1).cast("long").alias("qtd"))
    size_shuffles(fact)
    segment = F.col("c_mktsegment")

    def orders() -> DataFrame:
        return read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")

    def filed_against(columns: Sequence[str]) -> DataFrame:
        customers = read("customer").select(
            F.col("c_custkey").alias("o_custkey"), segment.alias("operadora"), group_of(segment).alias("grupo"))
        return orders().join(customers, "o_custkey", "left")

    def suppliers() -> DataFrame:
        return read("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))

    def places(columns: Sequence[str]) -> DataFrame:
        nations = read("nation").select(
            "n_nationkey", F.col("n_name").alias("uf"), F.col("n_name").alias("estado"), "n_regionkey")
        named = suppliers().join(nations, "n_nationkey", "left")
        if "regiao" not in columns:
            return named
        regions = read("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("regiao"))
        return named.join(regions, "n_regionkey", "left")

    def types(columns: Sequence[str]) -> DataFrame:
        return read("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("categoria"),
            F.col("p_brand").alias("subcategoria"))

    def days() -> DataFrame:
        return calendar_from_bounds(
            fact.agg(F.min("dia").alias("primeiro"), F.max("dia").alias("ultimo"))).select("data")

    def operators() -> DataFrame:
        base = F.when(segment != UNIDENTIFIED, F.count(F.lit(1)) * 1000)
        return read("customer").groupBy(segment.alias("operadora")).agg(base.alias("assinantes")).withColumn(
            "grupo", group_of(F.col("operadora")))

    return Star(
        fact=fact,
        dimensions={
            "operadora": Dimension(filed_against, "l_orderkey", ("operadora", "grupo"), orders),
            "uf": Dimension(places, "l_suppkey", ("uf", "estado", "regiao"), suppliers),
            "tipo": Dimension(types, "l_partkey", ("categoria", "subcategoria"), lambda: types(())),
        },
        calendar=days, operators=operators, unidentified=UNIDENTIFIED,
    )


def subscribers_in_millions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complaint_star(spark, sf_dir).operators().select(
        "operadora", (F.col("assinantes") / 1e6).alias("assinantes_mi"))


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty raw rows, one per order: every defect the cleaning has to survive, planted by
    rules on the order key. All orders are used; every fiftieth is filed twice."""
    k, seg = F.col("o_orderkey"), F.col("c_mktsegment")

    def every(n: int) -> Column:
        return k % n == 0

    brands = F.array(*[F.lit(name) for name in RAW_NAMES])
    codes = F.array(*[F.lit(sigla.lower()) for _, sigla, _, _ in STATES])
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        F.when(every(101), F.lit("31/02/2022"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Data_Abertura"),
        F.format_string("%02d:%02d", (k % 24).cast("int"), (k % 60).cast("int")).alias("Hora_Abertura"),
        F.lit("Reclamação").alias("Tipo"),
        F.when(every(33), F.lit("N/A")).otherwise(F.lower("o_orderpriority")).alias("Motivo"),
        F.when(every(41), F.lit("NÃO INFORMADO"))
        .otherwise(F.lit("falha/interrupção do serviço")).alias("Detalhe_Motivo"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Respondida"))
        .when(F.col("o_orderstatus") == "P", F.lit(" pendente "))
        .otherwise(F.lit("Em análise")).alias("Status"),
        F.when(every(2), F.lit("SCM")).otherwise(F.lit("SMP")).alias("Agrupamento"),
        F.when(every(97), F.lit("-")).when(every(89), F.lit(" "))
        .when(every(7), F.concat(F.lower(seg), F.lit(" s.a.")))
        .when(every(5), F.concat(F.lit("  "), seg, F.lit(" S/A ")))
        .otherwise(F.element_at(brands, (F.col("o_custkey") % len(RAW_NAMES) + 1).cast("int")))
        .alias("Nome"),
        F.when(every(13), F.lit("-")).otherwise(F.lit("Grande")).alias("Porte"),
        F.when(every(17), F.lit("NA")).otherwise(F.concat(F.lit("Grupo "), seg)).alias("Grupo_Economico"),
        F.when(every(59), F.lit("-")).when(every(61), F.lit("zz"))
        .otherwise(F.concat(F.lit(" "), F.element_at(codes, (F.col("c_nationkey") + 1).cast("int"))))
        .alias("UF"),
        F.concat(F.lit("Município "), F.col("c_nationkey").cast("string")).alias("Municipio"),
        F.when(every(2), F.lit("SCM")).otherwise(F.lit("SMP")).alias("Sigla"),
        k.alias("_k"),
    )
    filed = F.when(F.col("_k") % 50 == 0, 2).otherwise(1)
    copies = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), filed)))
    return copies.drop("_k", "_copy")


# Names as filed: the known brands in several spellings, and one that no alias covers.
RAW_NAMES = [
    "Claro S.A.", "NET SERVIÇOS DE COMUNICAÇÃO", "Vivo", "TELEFÔNICA BRASIL S.A.", "Tim Celular",
    "OI S.A.", "Oi Móvel", "Sercomtel", "Algar Telecom",
]


def raw_files(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The two files a filing system would deliver, by service."""
    rows = raw_complaints(spark, sf_dir)
    return [rows.where(F.col("Agrupamento") == service) for service in ("SCM", "SMP")]
