"""Every registered query. Each reads the whole test tables.

`_plain` casts what a query returns to the two numeric types SQL engines share,
and rounds fractions to six places so that the order of additions cannot show.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.tables import (
    complaint_star, raw_complaints, raw_files, subscribers_in_millions, table,
)
from queixa.fixed_values import EXPLORATION_ALIASES, IMPLICIT_NULLS
from queixa.functions.dates import index_text
from queixa.functions.numbers import round_half_even
from queixa.functions.text import filed_name, strip
from queixa.operators import aggregates, cleaning, dimensions, windows
from queixa.operators.fact import build_fact
from queixa.operators.star import star_of
from queixa.plans import datasets, hypotheses, kpis
from queixa.plans.measures import evaluate
from queixa.session import shared_folder
from queixa.sources.account import DropAccount
from queixa.sources.raw import canonical_columns, read_many, read_raw_csv
from queixa.sources.sinks import run_etl, store_clean, store_dimensions, write_kpis
from queixa.sources.star_files import RAW_FILES, load_fact, read_star

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    def column(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round_half_even(c, 6)
        return c.alias(f.name)

    return df.select([column(f) for f in df.schema])


REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = lambda spark, sf_dir: _plain(build(spark, sf_dir))
    return build


def frame(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return complaint_star(spark, sf_dir).frame(columns)


def cells(axes: list[str], measures: list[str], filters: dict | None = None) -> Query:
    """A query that evaluates measures over axes; the month axis is shown as `YYYY-MM`."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = evaluate(complaint_star(spark, sf_dir), axes, measures, filters)
        if "mes_idx" in axes:
            df = df.withColumn("ano_mes", index_text(F.col("mes_idx"))).drop("mes_idx")
        return _plain(df)
    return build


# --- cleaning, over the dirty rows --------------------------------------------------

@query
def clean_null_tokens(spark, sf_dir):
    return cleaning.null_implicit(canonical_columns(raw_complaints(spark, sf_dir)))


@query
def clean_parse_day(spark, sf_dir):
    rows = cleaning.drop_bad_days(canonical_columns(raw_complaints(spark, sf_dir)), "data_abertura")
    return rows.groupBy("data_abertura").agg(F.count(F.lit(1)).alias("linhas"))


def _names(spark, sf_dir, brand):
    rows = cleaning.null_implicit(canonical_columns(raw_complaints(spark, sf_dir)))
    named = rows.select("operadora_raw", filed_name(F.col("operadora_raw")).alias("_nome"))
    return named.select("operadora_raw", brand(F.col("_nome")).alias("operadora")).groupBy(
        "operadora_raw", "operadora").agg(F.count(F.lit(1)).alias("linhas"))


@query
def clean_operator_strict(spark, sf_dir):
    return _names(spark, sf_dir, lambda name: cleaning.brand_or_first_word(
        name, cleaning.STRICT_ALIASES, cleaning.UNIDENTIFIED))


@query
def clean_operator_broad(spark, sf_dir):
    return _names(spark, sf_dir, lambda name: cleaning.brand_or_catch_all(
        name, cleaning.BROAD_ALIASES, cleaning.CATCH_ALL))


@query
def clean_text_title(spark, sf_dir):
    rows = cleaning.null_implicit(canonical_columns(raw_complaints(spark, sf_dir)))
    labels = [cleaning.label(strip(F.col(c)), cleaning.NOT_INFORMED).alias(c)
              for c in ("status", "motivo", "detalhe_motivo")]
    return rows.select(labels).groupBy("status", "motivo", "detalhe_motivo").agg(
        F.count(F.lit(1)).alias("linhas"))


@query
def clean_state_upper(spark, sf_dir):
    rows = cleaning.null_implicit(canonical_columns(raw_complaints(spark, sf_dir)))
    state = rows.select(cleaning.code(F.col("uf_sigla"), cleaning.UNKNOWN_STATE).alias("uf"))
    return state.withColumn("regiao", cleaning.region_of_state(F.col("uf"))).groupBy(
        "uf", "regiao").agg(F.count(F.lit(1)).alias("linhas"))


@query
def clean_dedup_union(spark, sf_dir):
    return cleaning.clean_files(raw_files(spark, sf_dir))


@query
def clean_light_rows(spark, sf_dir):
    return cleaning.clean_light(raw_complaints(spark, sf_dir), EXPLORATION_ALIASES)


@query
def null_audit(spark, sf_dir):
    return aggregates.null_audit(cleaning.null_implicit(
        canonical_columns(raw_complaints(spark, sf_dir)), IMPLICIT_NULLS)).drop("tipo")


@query
def duplicate_audit(spark, sf_dir):
    return aggregates.duplicate_audit(raw_complaints(spark, sf_dir))


@query
def data_audit(spark, sf_dir):
    return hypotheses.data_audit(cleaning.clean_light(raw_complaints(spark, sf_dir)))


# --- dimensional model ----------------------------------------------------------------

@query
def dim_operator(spark, sf_dir):
    operators = dimensions.build_operators(cleaning.clean_files(raw_files(spark, sf_dir)))
    return dimensions.with_subscribers(dimensions.dense_ids(operators, "id_operadora", ["nome"]))


@query
def dim_type(spark, sf_dir):
    types = dimensions.build_complaint_types(cleaning.clean_files(raw_files(spark, sf_dir)))
    return dimensions.dense_ids(types, "id_tipo", ["categoria", "subcategoria"])


@query
def dim_calendar(spark, sf_dir):
    return dimensions.with_month_labels(
        dimensions.build_calendar(cleaning.clean_files(raw_files(spark, sf_dir))))


def _star_tables(spark, sf_dir):
    """The star over the dirty rows; the cleaned rows are stored once, then read again and again."""
    clean = store_clean(raw_files(spark, sf_dir))
    folder = os.path.join(shared_folder(spark), f"estrela-{uuid.uuid4().hex}")
    tables = store_dimensions(clean, folder)
    return {**tables, "fato_reclamacoes": build_fact(clean, tables)}


@query
def fact_keys(spark, sf_dir):
    # The row id is unique but not reproducible, so it is left out of the comparison.
    return _star_tables(spark, sf_dir)["fato_reclamacoes"].drop("id_reclamacao")


@query
def fact_ids(spark, sf_dir):
    """The fact's numbers run from 1 to the number of rows, each once, in the stored fact too."""
    stored = _stored_star(spark, sf_dir).fact
    built = _star_tables(spark, sf_dir)["fato_reclamacoes"]
    ids = [F.count(F.lit(1)).alias("linhas"), F.count_distinct("id_reclamacao").alias("ids"),
           F.min("id_reclamacao").alias("primeiro"), F.max("id_reclamacao").alias("ultimo")]
    return built.agg(*ids).withColumn("fato", F.lit("montado")).unionByName(stored.agg(*ids).withColumn("fato", F.lit("gravado")))


@query
def star_denormalised(spark, sf_dir):
    star = star_of(_star_tables(spark, sf_dir))
    return star.frame(["dia", "operadora", "porte", "grupo", "uf", "estado", "regiao", "categoria",
                       "subcategoria", "status", "servico", "ano", "mes", "ano_mes", "trimestre"])


def _write_raw_files(spark, sf_dir) -> str:
    """The dirty rows as the two Latin-1 files a filing system would deliver."""
    folder = os.path.join(shared_folder(spark), f"brutos-{uuid.uuid4().hex}")
    for rows, name in zip(raw_files(spark, sf_dir), RAW_FILES, strict=True):
        rows.write.csv(os.path.join(folder, name), sep=";", header=True, encoding="ISO-8859-1",
                       emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return folder


RAW_WRITER = {"sep": ";", "header": True, "encoding": "ISO-8859-1", "quote": '"', "escape": '"', "emptyValue": "",
              "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@query
def raw_files_with_breaks(spark, sf_dir):
    """Cells with line breaks, separators and quotes, in files that are split among tasks."""
    path = os.path.join(shared_folder(spark), f"quebras-{uuid.uuid4().hex}")
    place = F.col("Municipio")
    broken = F.when(place.endswith("3"), F.concat(place, F.lit('\n"centro"; sul\n'))).when(
        place.endswith("5"), F.concat(F.lit("\n"), place)).otherwise(place)
    raw_complaints(spark, sf_dir).withColumn("Municipio", broken).write.csv(path, **RAW_WRITER)
    rows = canonical_columns(read_raw_csv(spark, path))
    return rows.groupBy("municipio", "status", "sigla_servico").agg(F.count(F.lit(1)).alias("linhas"))


@query
def raw_files_other_headers(spark, sf_dir):
    """One folder whose files name their columns in different orders, some without all of them."""
    path = os.path.join(shared_folder(spark), f"cabecalhos-{uuid.uuid4().hex}")
    scm, smp = raw_files(spark, sf_dir)
    scm.write.csv(path, **RAW_WRITER)
    smp.select([c for c in reversed(smp.columns) if c != "Porte"]).write.mode("append").csv(path, **RAW_WRITER)
    rows = canonical_columns(read_raw_csv(spark, path))
    return rows.groupBy("porte", "grupo_economico", "uf_sigla", "sigla_servico").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct("operadora_raw").alias("nomes"), F.max("data_abertura").alias("maior_texto"))


@query
def left_out_rows(spark, sf_dir):
    """Why rows are left out: lines too long, days that cannot be, exact copies. Counted while the clean rows are stored."""
    folder, place, account = os.path.join(shared_folder(spark), f"contas-{uuid.uuid4().hex}"), F.col("Municipio"), DropAccount()
    # without a quote character a separator in a cell is one more field
    writer = {**RAW_WRITER, "quote": "\u0000"}
    for rows, name in zip(raw_files(spark, sf_dir), RAW_FILES, strict=True):
        longer = F.when(place.endswith("7"), F.concat(place, F.lit(";sobra"))).otherwise(place)
        far = F.when(place.endswith("4"), F.lit("01/01/2999")).when(place.endswith("6"), F.lit("-")).otherwise(F.col("Data_Abertura"))
        rows.withColumns({"Data_Abertura": far, "Municipio": longer}).write.csv(os.path.join(folder, name), **writer)
    store_clean(read_many(spark, [os.path.join(folder, name) for name in RAW_FILES], account), account)
    return account.rows(spark)


@query
def etl_from_files(spark, sf_dir):
    """Files to cleaned rows to a stored star, read back and counted."""
    folder = _write_raw_files(spark, sf_dir)
    files = read_many(spark, [os.path.join(folder, name) for name in (*RAW_FILES, "ausente.csv")])
    stored = os.path.join(folder, "estrela")
    run_etl(files, stored)
    return read_star(spark, stored).cube(["ano", "operadora", "regiao", "categoria", "status", "servico"])


def _stored_star(spark, sf_dir):
    stored = os.path.join(shared_folder(spark), f"estrela-{uuid.uuid4().hex}")
    return run_etl(raw_files(spark, sf_dir), stored)


@query
def stored_star_states(spark, sf_dir):
    """A report over the stored star: filters reach it as keys, labels come after the sums."""
    return datasets.dataset(_stored_star(spark, sf_dir), "state_detail",
                            {"operadora": ["CLARO", "VIVO"], "servico": ["SCM"]})


@query
def stored_star_panel(spark, sf_dir):
    return datasets.dataset(_stored_star(spark, sf_dir), "operator_panel", {"regiao": ["Sudeste", "Norte"]})


@query
def stored_star_kpis(spark, sf_dir):
    """The headline table from a cube of the stored star."""
    return kpis.kpis_consolidado(_stored_star(spark, sf_dir).cube(["operadora", "uf", "categoria", "status", "dia"]))


@query
def stored_star_hypotheses(spark, sf_dir):
    """The verdicts from a cube of the stored star."""
    return hypotheses.hypotheses(_stored_star(spark, sf_dir).cube(hypotheses.HYPOTHESIS_KEYS))


@query
def kpi_files(spark, sf_dir):
    """Files without a stored star, KPI tables written as CSV, one of them read back."""
    folder = _write_raw_files(spark, sf_dir)
    rows = load_fact(spark, os.path.join(folder, "sem_estrela"), folder)
    rows = rows.withColumn("ano_mes", F.date_format("dia", "yyyy-MM"))
    write_kpis(rows, os.path.join(folder, "saida"))
    return spark.read.csv(os.path.join(folder, "saida", "kpis_motivos.csv"), header=True,
                          schema="operadora string, motivo string, volume long, share_pct double, ranking int")


def _kpi_file(name: str) -> Query:
    """All five tables written as CSV from files without a stored star, this one read back."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _write_raw_files(spark, sf_dir)
        rows = load_fact(spark, os.path.join(folder, "sem_estrela"), folder)
        rows = rows.withColumn("ano_mes", F.date_format("dia", "yyyy-MM"))
        write_kpis(rows, os.path.join(folder, "saida"))
        schema = kpis.KPI_TABLES[name](rows).schema
        return _plain(spark.read.csv(os.path.join(folder, "saida", f"{name}.csv"), header=True, schema=schema))
    return build


REGISTRY.update({
    "kpi_files_consolidated": _kpi_file("kpis_consolidado"), "kpi_files_operators": _kpi_file("kpis_por_operadora"),
    "kpi_files_monthly": _kpi_file("kpis_temporais"), "kpi_files_states": _kpi_file("kpis_regionais"),
})


# --- KPI tables -------------------------------------------------------------------------

KPI_COLUMNS = ("operadora", "uf", "categoria", "status", "dia", "ano_mes")


@query
def kpi_consolidated(spark, sf_dir):
    return kpis.kpis_consolidado(frame(spark, sf_dir, *KPI_COLUMNS))


@query
def kpi_by_operator(spark, sf_dir):
    return kpis.kpis_por_operadora(
        frame(spark, sf_dir, "operadora", "status"), subscribers_in_millions(spark, sf_dir))


@query
def risk_score_minmax(spark, sf_dir):
    """The same table with the unidentified brand left without a base."""
    return kpis.kpis_por_operadora(
        frame(spark, sf_dir, "operadora", "status"), subscribers_in_millions(spark, sf_dir), fill=None)


@query
def kpi_monthly(spark, sf_dir):
    return kpis.kpis_temporais(frame(spark, sf_dir, "operadora", "ano_mes"))


@query
def kpi_reasons(spark, sf_dir):
    return kpis.kpis_motivos(frame(spark, sf_dir, "operadora", "categoria"))


@query
def kpi_reasons_top5(spark, sf_dir):
    return kpis.kpis_motivos(frame(spark, sf_dir, "operadora", "categoria"), top=5)


@query
def kpi_states(spark, sf_dir):
    return kpis.kpis_regionais(frame(spark, sf_dir, "uf", "status"))


# --- hypotheses and exploration -------------------------------------------------------------

@query
def pareto_operator(spark, sf_dir):
    return hypotheses.concentration_by_operator(frame(spark, sf_dir, "operadora"))


@query
def top_reason(spark, sf_dir):
    return hypotheses.volume_by_reason(frame(spark, sf_dir, "categoria"))


@query
def resolution_by_operator(spark, sf_dir):
    return hypotheses.resolution_by_operator(frame(spark, sf_dir, "operadora", "status"))


@query
def resolution_gap(spark, sf_dir):
    rates = hypotheses.resolution_by_operator(frame(spark, sf_dir, "operadora", "status"))
    return aggregates.spread_and_mean(rates, "taxa_resolucao")


@query
def quarter_by_operator(spark, sf_dir):
    return hypotheses.volume_by_quarter_and_operator(frame(spark, sf_dir, "operadora", "trimestre"))


@query
def quarter_peak(spark, sf_dir):
    quarters = hypotheses.volume_by_quarter(frame(spark, sf_dir, "operadora", "trimestre"))
    return aggregates.arg_max(quarters, "trimestre", "volume")


@query
def region_share(spark, sf_dir):
    return hypotheses.volume_by_region(frame(spark, sf_dir, "regiao"))


@query
def hypothesis_verdicts(spark, sf_dir):
    return hypotheses.hypotheses(frame(spark, sf_dir, *hypotheses.HYPOTHESIS_KEYS), "ASIA")


@query
def monthly_series(spark, sf_dir):
    return hypotheses.monthly_series(frame(spark, sf_dir, "operadora", "ano_mes"))


@query
def matrix_operator_category(spark, sf_dir):
    return aggregates.matrix(frame(spark, sf_dir, "operadora", "categoria"), "operadora", "categoria",
                             ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])


@query
def composite_score_rounded(spark, sf_dir):
    return hypotheses.composite_score(
        frame(spark, sf_dir, "operadora", "status"), subscribers_in_millions(spark, sf_dir))


@query
def top15_states(spark, sf_dir):
    return hypotheses.top_states(frame(spark, sf_dir, "uf"), 15)


# --- aggregation operators on their own -------------------------------------------------------

@query
def monthly_average(spark, sf_dir):
    return aggregates.monthly_average(frame(spark, sf_dir, "operadora", "mes_idx"), "operadora")


@query
def monthly_spread(spark, sf_dir):
    return aggregates.monthly_spread(frame(spark, sf_dir, "operadora", "mes_idx"), "operadora")


@query
def month_spine(spark, sf_dir):
    months = aggregates.volume_by(frame(spark, sf_dir, "uf", "categoria", "mes_idx"), "uf", "categoria", "mes_idx")
    return aggregates.month_spine(months, ["uf", "categoria"])


@query
def spine_slope(spark, sf_dir):
    months = aggregates.volume_by(frame(spark, sf_dir, "uf", "mes_idx"), "uf", "mes_idx")
    return aggregates.slope(aggregates.month_spine(months, ["uf"]), ["uf"])


@query
def hhi_operator_and_state(spark, sf_dir):
    """The index operator on its own: how concentrated complaints are among operators and among states."""
    rows = frame(spark, sf_dir, "operadora", "uf")
    operators = aggregates.hhi(aggregates.volume_by(rows, "operadora")).withColumn("eixo", F.lit("operadora"))
    states = aggregates.hhi(aggregates.volume_by(rows, "uf")).withColumn("eixo", F.lit("uf"))
    return operators.unionByName(states)


@query
def pair_distinct(spark, sf_dir):
    """Distinct (category, subcategory) pairs of the parts on file."""
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("categoria"), F.col("p_brand").alias("subcategoria")).distinct()


@query
def top3_states_with_ties(spark, sf_dir):
    volumes = aggregates.volume_by(frame(spark, sf_dir, "regiao", "uf"), "regiao", "uf")
    return windows.top_k_with_ties(volumes, 3, "volume", "regiao")


# --- measures ----------------------------------------------------------------------------------

@query
def dropped_service_months(spark, sf_dir):
    """One service ends in the middle of 1997: its next month is down by all, its months a year later still compare."""
    star = complaint_star(spark, sf_dir)
    ended = (F.col("servico") == "SMP") & (F.col("dia") >= F.lit("1997-06-01").cast("date"))
    star = replace(star, fact=star.fact.where(~ended))
    df = evaluate(star, ["servico", "mes_idx"], ["total", "mes_anterior", "ano_anterior", "var_mom", "var_yoy"])
    return df.withColumn("ano_mes", index_text(F.col("mes_idx"))).drop("mes_idx")


REGISTRY.update({
    "share_of_axis_total": cells(
        ["regiao"], ["total", "pct_total", "share_operadora", "share_categoria", "share_uf"],
        {"operadora": ["BUILDING"], "ano": [1998]}),
    "share_by_operator_and_region": cells(
        ["operadora", "regiao"], ["total", "pct_total", "share_operadora", "share_uf", "share_texto"],
        {"servico": ["SCM"]}),
    "hhi_class": cells(["regiao"], ["hhi", "classe_hhi"]),
    "top3_concentration": cells(["uf"], ["top3"]),
    "risk_score_max": cells(["operadora"], [
        "total", "taxa_resolucao", "por_100k", "score_risco", "rating_risco", "ordinal_risco", "faixa_score"]),
    "risk_score_filtered": cells(
        ["operadora"], ["total", "score_risco", "rating_risco", "rank_volume", "rank_100k"],
        {"operadora": ["BUILDING", "HOUSEHOLD"], "ano": [1996, 1997]}),
    "zscore_month_flag": cells(["mes_idx"], ["total", "z_mensal", "flag_anomalia"]),
    "zscore_ano_mes": cells(["ano_mes"], ["total", "z_mensal", "flag_anomalia"]),
    "zscore_ano_and_mes": cells(["ano", "mes"], ["total", "z_mensal", "flag_anomalia"]),
    "moving_average_ano_mes": cells(["ano_mes"], ["total", "media_movel_3m"]),
    "zscore_by_operator": cells(["operadora", "mes_idx"], ["z_mensal", "flag_anomalia"], {"ano": [1997, 1998]}),
    "trend_slope": cells(["operadora"], ["tendencia"]),
    "trend_slope_filtered": cells(["uf"], ["tendencia"], {"ano": [1997, 1998], "categoria": ["PROMO"]}),
    "worst_state": cells(["operadora"], ["pior_estado"]),
    "worst_state_by_category": cells(["categoria", "subcategoria"], ["pior_estado"]),
    "month_previous_and_last_year": cells(
        ["operadora", "mes_idx"], ["total", "mes_anterior", "ano_anterior", "var_mom", "var_yoy"]),
    "month_changes_filtered": cells(
        ["mes_idx"], ["total", "mes_anterior", "ano_anterior", "var_mom", "var_yoy"],
        {"ano": [1998], "regiao": ["ASIA", "EUROPE"]}),
    "period_shift": cells(
        ["operadora"], ["total", "mes_anterior", "ano_anterior", "var_mom", "var_yoy", "mom_ultimo_mes"]),
    "period_shift_filtered": cells(
        [], ["total", "mes_anterior", "ano_anterior", "var_mom", "mom_ultimo_mes", "ytd",
             "media_movel_3m", "media_mensal"], {"ano": [1997, 1998]}),
    "changes_by_year": cells(
        ["operadora", "ano"], ["total", "mes_anterior", "ano_anterior", "var_mom", "var_yoy", "var_mom_setor", "media_mensal"]),
    "changes_by_quarter": cells(
        ["regiao", "ano", "trimestre"], ["total", "mes_anterior", "ano_anterior", "var_yoy"], {"ano": [1997, 1998]}),
    "ytd": cells(["servico", "mes_idx"], ["total", "ytd"]),
    "ytd_by_year_quarter": cells(["operadora", "ano", "trimestre"], ["total", "ytd"]),
    "ytd_by_quarter_filtered": cells(["uf", "trimestre"], ["total", "ytd"], {"ano": [1996, 1998], "mes": [1, 2, 4, 5, 10]}),
    "moving_average_by_quarter": cells(["regiao", "ano", "trimestre"], ["total", "media_movel_3m"]),
    "trend_by_year": cells(["operadora", "ano"], ["total", "tendencia"]),
    "blank_months_sparse": cells(
        ["uf", "mes_idx"], ["total", "mes_anterior", "ano_anterior", "var_mom", "ytd", "media_movel_3m"],
        {"subcategoria": ["Brand#11"], "servico": ["SCM"], "status": ["Pendente"]}),
    "moving_average_by_operator": cells(["operadora", "mes_idx"], ["total", "media_movel_3m"]),
    "mom_flag_vs_sector": cells(
        ["operadora", "mes_idx"], ["var_mom", "var_mom_setor", "flag_piora_mom", "direcao_mom"]),
    "risk_card_one_operator": cells(
        [], ["total", "score_risco", "rating_risco", "ordinal_risco", "faixa_score"], {"operadora": ["BUILDING"]}),
    "risk_by_month_one_operator": cells(
        ["mes_idx"], ["total", "score_risco", "rating_risco"], {"operadora": ["MACHINERY"], "regiao": ["ASIA", "EUROPE"]}),
    "risk_by_region": cells(["regiao"], ["total", "score_risco"]),
    "ranks_dense": cells(["operadora"], ["rank_volume", "rank_100k"]),
    "ranks_categories": cells(["categoria"], ["total", "rank_categoria"], {"operadora": ["MACHINERY"]}),
    "rank_states_by_name": cells(["estado"], ["total", "rank_uf"], {"status": ["Pendente"]}),
    "ranks_states": cells(["uf"], ["total", "rank_uf"], {"status": ["Pendente"]}),
    "rate_bands": cells(
        ["regiao", "categoria"], ["taxa_resolucao", "gap_meta", "taxa_texto", "status_meta", "taxa_vs_geral"]),
    "text_labels": cells(
        ["operadora"], ["ultimo_mes", "var_yoy_texto", "var_mom_texto", "share_texto", "titulo", "sumario_operadora"],
        {"ano": [1998]}),
    "identification_coverage": cells(["regiao"], ["nao_identificadas", "pct_nao_identificado", "cobertura"]),
    "volume_by_service_status": cells(
        ["status", "servico"], ["total", "reclamacoes_scm", "reclamacoes_smp", "respondidas", "taxa_resolucao",
                                "em_aberto", "qtd_pendentes", "qtd_em_analise"]),
    "monthly_average_measure": cells(["regiao"], ["media_mensal"], {"servico": ["SMP"]}),
})


# --- report datasets -----------------------------------------------------------------------------

def report(name: str, filters: dict | None = None) -> Query:
    return lambda spark, sf_dir: _plain(datasets.dataset(complaint_star(spark, sf_dir), name, filters))


REGISTRY.update({name: report(name) for name in [*datasets.REPORTS, "category_drill"]})
REGISTRY.update({
    "filtered_dataset": report("operator_panel", {
        "ano": [1996, 1997], "operadora": ["BUILDING", "FURNITURE"], "regiao": ["ASIA", "AFRICA"],
        "servico": ["SCM"]}),
    "executive_sentence_filtered": report("executive_sentence", {"operadora": ["BUILDING"], "ano": [1998]}),
    "headline_filtered": report("headline_figures", {"regiao": ["ASIA"], "ano": [1999]}),
})
