"""Dimensions, fact, stored star: DIM1-DIM6, FCT1, FCT2, JON1, SRC3, SRC4, SNK1, SNK2, CLN13."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from queixa.fixed_values import STATES
from queixa.operators.cleaning import clean_files
from queixa.operators.dimensions import (
    build_calendar, build_complaint_types, build_operators, build_states, dense_ids, with_month_labels,
    with_subscribers,
)
from queixa.operators.fact import build_fact
from queixa.operators.star import measured_small, selected_days, star_of
from queixa.plans.kpis import KPI_TABLES
from queixa.schema import STAR_TABLES
from queixa.sources import sinks
from queixa.sources.raw import read_raw_csv
from queixa.sources.sinks import run_etl, store_clean, store_dimensions, write_kpis, write_star
from queixa.sources.star_files import RAW_FILES, has_star, load_fact, missing_rows, read_star, read_star_tables
from tests.plans import executed_plan
from tests.test_cleaning import line, write

LINES = {
    "reclamacoes_scm.csv": [
        line(), line(), line(day="28/12/2022", name="Vivo", state="rj", status="Pendente"),
        line(day="02/01/2023", name="Algar Telecom", state="zz", size="-", group="Algar"),
        line(day="01/01/2023", name="Algar Telecom", size="Pequena", group="N/A"),
    ],
    "reclamacoes_smp.csv": [
        line(code="SMP"), line(day="03/01/2023", name="-", code="SMP", size="Grande", group="Claro", reason="cobrança"),
    ],
}


@pytest.fixture()
def raw_folder(tmp_path):
    for name, lines in LINES.items():
        write(tmp_path / name, lines)
    return str(tmp_path)


@pytest.fixture()
def raw(spark, raw_folder):
    return [read_raw_csv(spark, os.path.join(raw_folder, name)) for name in RAW_FILES]


def test_operator_dimension(spark, raw):
    operators = dense_ids(build_operators(clean_files(raw)), "id_operadora", ["nome"])
    rows = [tuple(r) for r in with_subscribers(operators).orderBy("id_operadora").collect()]
    assert rows == [
        (1, "ALGAR", "Pequena", None, None),  # from its earliest complaint
        (2, "CLARO", "Grande", "América Móvil", 35_200_000),
        (3, "NÃO IDENTIFICADA", "N/D", "Não identificado", None),  # the fixed table overrides what was filed
        (4, "VIVO", "Grande", "Telefónica", 33_100_000),
    ]


def test_dense_ids_follow_key_order_across_buckets(spark):
    names = [f"{a}{b}{i}" for a in "ab" for b in "xyz" for i in range(7)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "nome string")
    got = [tuple(r) for r in dense_ids(df, "id", ["nome"]).orderBy("id").collect()]
    assert got == list(enumerate(sorted(names), 1))


def test_type_and_state_dimensions(spark, raw):
    types = dense_ids(build_complaint_types(clean_files(raw)), "id_tipo", ["categoria", "subcategoria"])
    assert [tuple(r) for r in types.orderBy("id_tipo").collect()] == [
        (1, "Cobrança", "Falha/Interrupção"), (2, "Velocidade", "Falha/Interrupção")]
    assert [tuple(r) for r in build_states(spark).orderBy("id_uf").collect()] == STATES


def test_calendar_is_contiguous(spark, raw):
    days = with_month_labels(build_calendar(clean_files(raw))).orderBy("id_data").collect()
    assert (days[0].data, days[-1].data) == (dt.date(2022, 3, 5), dt.date(2023, 1, 3))
    assert [d.id_data for d in days] == list(range(1, len(days) + 1))
    assert len(days) == (days[-1].data - days[0].data).days + 1
    for d in days:
        assert (d.semana_ano, d.dia_semana) == (d.data.isocalendar()[1], d.data.weekday())
        assert d.fim_semana == int(d.data.weekday() >= 5)
    new_year = next(d for d in days if d.data == dt.date(2023, 1, 1))
    assert (new_year.nome_mes, new_year.nome_dia, new_year.trimestre, new_year.ano_mes_num, new_year.mes_rotulo) == (
        "Janeiro", "Domingo", 1, 202301, "jan/23")


def test_fact_keeps_rows_without_a_dimension_row(spark, raw):
    clean = clean_files(raw)
    tables = {
        "dim_operadora": dense_ids(build_operators(clean), "id_operadora", ["nome"]), "dim_uf": build_states(spark),
        "dim_tipo_reclamacao": dense_ids(build_complaint_types(clean), "id_tipo", ["categoria", "subcategoria"]),
        "dim_calendario": build_calendar(clean)}
    fact = build_fact(clean, tables)
    rows = fact.collect()
    assert len(rows) == clean.count() == 6
    assert len({r.id_reclamacao for r in rows}) == 6
    assert [r.id_uf for r in rows].count(None) == 1  # state "ZZ"
    assert all(None not in (r.id_operadora, r.id_tipo, r.id_data) for r in rows)
    star = star_of({**tables, "fato_reclamacoes": fact})
    unmatched = star.frame(["operadora", "uf", "regiao"]).where("uf IS NULL").collect()
    assert [tuple(r) for r in unmatched] == [("ALGAR", None, None, 1)]


def test_etl_round_trip(spark, raw, raw_folder, tmp_path):
    folder = str(tmp_path / "estrela")
    star = run_etl(raw, folder)
    again = read_star(spark, folder)
    columns = ["dia", "operadora", "grupo", "uf", "estado", "regiao", "categoria", "subcategoria", "status", "servico", "ano"]
    key = sorted(map(tuple, star.frame(columns).collect()), key=repr)
    assert key == sorted(map(tuple, again.frame(columns).collect()), key=repr)
    assert len(key) == 6
    assert sorted(d for d in os.listdir(f"{folder}/fato_reclamacoes") if d.startswith("ano=")) == ["ano=2022", "ano=2023"]
    # A year filter opens one folder only, and only the dimensions asked for are joined.
    plan = executed_plan(again.frame(["operadora"], {"ano": [2023]}))
    assert "PartitionFilters: [isnotnull(ano" in plan and "dim_uf" not in plan and "dim_calendario" not in plan
    assert "SortMergeJoin" not in plan
    # An operator filter is applied to the dimension before the join.
    plan = executed_plan(again.frame(["status"], {"operadora": ["VIVO", "CLARO"]}))
    assert "In(nome, [CLARO,VIVO])" in plan or "In(nome, [VIVO,CLARO])" in plan


def test_cube_sums_per_key_before_looking_up_labels(spark, raw, tmp_path):
    star = run_etl(raw, str(tmp_path / "estrela"))
    columns, where = ["operadora", "regiao", "ano_mes"], {"categoria": ["Velocidade"], "ano": [2022, 2023]}
    cube = star.cube(columns, where)
    expected = star.frame(columns, where).groupBy(*columns).agg(F.sum("qtd").alias("qtd"))
    assert sorted(map(tuple, cube.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    plan = executed_plan(cube)
    # Below the label lookups, the fact only meets the keys that pass the filter.
    assert plan.index("LeftSemi") > plan.rindex("LeftOuter") and "partial_sum" in plan[plan.rindex("LeftOuter"):plan.index("LeftSemi")]


def test_csv_star_with_byte_order_mark(spark, raw, tmp_path):
    stored = str(tmp_path / "estrela")
    run_etl(raw, stored)
    tables = read_star_tables(spark, stored)
    csv = tmp_path / "csv"
    csv.mkdir()
    for name, schema in STAR_TABLES.items():
        rows = tables[name].select(*schema.names).collect()
        cells = [",".join("" if v is None else str(v) for v in r) for r in rows]
        (csv / f"{name}.csv").write_text("\n".join([",".join(schema.names), *cells, ""]), encoding="utf-8-sig")
    columns = ["dia", "operadora", "regiao", "categoria", "status", "servico", "ano"]
    got = sorted(map(tuple, read_star(spark, str(csv)).frame(columns).collect()), key=repr)
    assert got == sorted(map(tuple, read_star(spark, stored).frame(columns).collect()), key=repr)


def test_star_written_as_csv_reads_back(spark, raw, tmp_path):
    stored, as_csv = str(tmp_path / "estrela"), str(tmp_path / "csv")
    run_etl(raw, stored)
    write_star(read_star_tables(spark, stored), as_csv, fmt="csv")
    columns = ["dia", "operadora", "estado", "subcategoria", "status", "servico", "ano"]
    got = sorted(map(tuple, read_star(spark, as_csv).frame(columns).collect()), key=repr)
    assert got == sorted(map(tuple, read_star(spark, stored).frame(columns).collect()), key=repr)


def test_load_fact_prefers_the_star_and_falls_back_to_raw(spark, raw, raw_folder, tmp_path):
    from_raw = load_fact(spark, str(tmp_path / "nada"), raw_folder)
    run_etl(raw, str(tmp_path / "estrela"))
    from_star = load_fact(spark, str(tmp_path / "estrela"), raw_folder)
    assert from_raw.columns == from_star.columns
    assert [f.dataType for f in from_raw.schema] == [f.dataType for f in from_star.schema]
    assert (from_raw.count(), from_star.count()) == (7, 6)  # the fallback keeps duplicates
    names = {r.operadora for r in from_raw.select("operadora").distinct().collect()}
    assert names == {"CLARO", "VIVO", "OUTROS"}


def test_write_kpis_from_one_cube(spark, raw, tmp_path):
    star = run_etl(raw, str(tmp_path / "estrela"))
    frame = star.frame(["operadora", "uf", "categoria", "status", "dia", "ano_mes"])
    for fmt in ("csv", "parquet"):
        out = str(tmp_path / fmt)
        write_kpis(frame, out, fmt)
        assert sorted(n.removesuffix(".csv") for n in os.listdir(out)) == sorted(KPI_TABLES)
        for name, build in KPI_TABLES.items():
            direct = build(frame)
            reader = spark.read.schema(direct.schema)
            stored = reader.option("header", True).csv(f"{out}/{name}.csv") if fmt == "csv" else reader.parquet(f"{out}/{name}")
            assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_a_heavy_year_is_written_by_many_tasks(spark, tmp_path):
    """The year that holds nearly everything must not land in one task."""
    rows = spark.range(200000).select(
        F.col("id").alias("id_reclamacao"), (F.col("id") % 700).cast("int").alias("id_data"),
        (F.col("id") % 7).cast("int").alias("id_operadora"), F.sha2(F.col("id").cast("string"), 512).alias("status"),
        F.when(F.col("id") % 100 == 0, 2021).otherwise(2022).alias("ano"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_star({"fato_reclamacoes": rows}, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(tmp_path / "fato_reclamacoes" / "ano=2022") if f.endswith(".parquet")]
    assert len(files) > 3
    assert spark.read.parquet(str(tmp_path / "fato_reclamacoes")).count() == 200000


def test_broadcast_is_marked_only_below_the_threshold(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert measured_small(orders)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        assert not measured_small(orders)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_of_one_beginning_are_numbered_by_many_tasks(spark):
    names = [f"mesmo começo {i:05d}" for i in range(4000)]
    df = spark.createDataFrame([(n,) for n in reversed(names)] + [(None,)], "nome string")
    found = dense_ids(df, "id", ["nome"], partitions=6)
    assert [tuple(r) for r in found.orderBy("id").collect()] == [(1, None), *((i, n) for i, n in enumerate(names, 2))]
    stored = spark.read.parquet(found.inputFiles()[0].rsplit("/", 1)[0])
    sizes = [r["count"] for r in stored.groupBy("_parte").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2000


def test_stored_rows_keep_their_numbers(spark, raw, tmp_path):
    clean = store_clean(raw)
    tables = store_dimensions(clean, str(tmp_path / "dims"))
    fact = build_fact(clean, tables)
    first = sorted(map(repr, fact.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "3")  # another plan, the same numbers
    try:
        assert sorted(map(repr, build_fact(clean, tables).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(r.id_reclamacao for r in fact.collect()) == list(range(1, fact.count() + 1))


def test_a_star_appears_as_a_whole(spark, raw, raw_folder, tmp_path, monkeypatch):
    folder = str(tmp_path / "estrela")

    def killed(*_):
        raise RuntimeError("killed between two tables")
    monkeypatch.setattr(sinks, "build_fact", killed)
    with pytest.raises(RuntimeError):
        run_etl(raw, folder)
    assert not has_star(spark, folder) and load_fact(spark, folder, raw_folder).count() == 7
    monkeypatch.undo()
    run_etl(raw, folder)
    before = sorted(map(repr, read_star(spark, folder).frame(["dia", "operadora"]).collect()))
    monkeypatch.setattr(sinks, "build_fact", killed)
    with pytest.raises(RuntimeError):
        run_etl(raw[:1], folder)
    assert has_star(spark, folder) and missing_rows(spark, folder) == {}
    assert sorted(map(repr, read_star(spark, folder).frame(["dia", "operadora"]).collect())) == before
    monkeypatch.undo()
    run_etl(raw[:1], folder)
    assert read_star(spark, folder).frame(["dia"]).count() < len(before)
    assert not [d for d in os.listdir(tmp_path) if ".anterior-" in d]
    build_states(spark).limit(20).write.mode("overwrite").parquet(f"{folder}/dim_uf")
    assert missing_rows(spark, folder) == {"dim_uf": 7}


def test_half_a_star_is_no_star(spark, raw, tmp_path):
    stored = str(tmp_path / "estrela")
    run_etl(raw, stored)
    tables = read_star_tables(spark, stored)
    some = str(tmp_path / "parte")
    write_star({n: t for n, t in tables.items() if n != "dim_uf"}, some)
    assert not has_star(spark, some)
    write_star({"dim_uf": tables["dim_uf"]}, some)
    assert has_star(spark, some)


def test_a_calendar_with_gaps_is_refused(spark, raw, tmp_path):
    tables = read_star_tables(spark, run_etl(raw, str(tmp_path / "estrela")) and str(tmp_path / "estrela"))
    with pytest.raises(Exception, match="gaps"):
        star_of({**tables, "dim_calendario": tables["dim_calendario"].where("id_data <> 2")}).frame(["dia"]).collect()
    empty = star_of({n: t.limit(0) for n, t in tables.items()})
    assert empty.frame(["dia", "operadora"]).collect() == []


def many_days(spark, raw, folder):
    """A stored star whose fact has a row for each of some 400 days, in small files."""
    run_etl(raw, folder)
    tables = read_star_tables(spark, folder)
    days = tables["dim_calendario"].select("id_data", "ano").withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(150))))
    fact = days.select(
        F.lit(1).cast("long").alias("id_reclamacao"), "id_data", F.lit(1).alias("id_operadora"), F.lit(25).alias("id_uf"), F.lit(1).alias("id_tipo"),
        F.sha2(F.concat_ws("-", "id_data", "_n"), 512).alias("status"), F.lit("SCM").alias("sigla_servico"), F.lit(1).alias("qtd"), "ano")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300KB")
    try:
        write_star({"fato_reclamacoes": fact}, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return read_star(spark, folder)


def test_calendar_filters_reach_the_stored_fact(spark, raw, tmp_path):
    star = many_days(spark, raw, str(tmp_path / "estrela"))
    files = {f for f in os.listdir(tmp_path / "estrela" / "fato_reclamacoes" / "ano=2022") if f.endswith(".parquet")}
    assert len(files) > 2
    for where in ({"ano_mes": ["2022-05"]}, {"ano_mes": ["2022-05", "2022-06", "2022-11"]}, {"mes_idx": [2022 * 12 + 7]},
                  {"ano": [2022], "trimestre": [3]}, {"ano": [2022, 2023], "mes": [1, 12]}, {"ano": [2022]}, {"mes": [6]}, {"ano": [2030]},
                  {"ano_mes": ["2022-05"], "mes": [6]}):
        found = star.frame(["dia", "ano_mes"], where)
        every = star.frame(["dia", "ano", "mes", "trimestre", "mes_idx", "ano_mes"])
        for c, values in where.items():
            every = every.where(F.col(c).isin(values))
        assert sorted(r.dia for r in found.collect()) == sorted(r.dia for r in every.collect())
    plan = executed_plan(star.frame(["status"], {"ano_mes": ["2022-05", "2022-06", "2022-11"]}))
    assert re.search(r"PartitionFilters: \[[^\]]*ano#\d+ >= 2022", plan)
    assert re.search(r"PushedFilters: \[[^\]]*Or\(And\(GreaterThanOrEqual\(id_data,", plan)
    read = sum(1 for f in star.fact.inputFiles() if "ano=2022" in f)
    spans = [spark.read.parquet(f).agg(F.min("id_data"), F.max("id_data")).first() for f in star.fact.inputFiles() if "ano=2022" in f]
    first = (dt.date(2022, 8, 1) - dt.date(2022, 3, 5)).days + 1
    needed = [s for s in spans if s[0] <= first + 30 and s[1] >= first]
    assert len(needed) < read  # the other files' row groups hold no day of that month


def test_spans_of_days():
    days = lambda *x: (dt.date(*x[:3]), dt.date(*x[3:]))
    assert selected_days({}, None) is None and selected_days({"mes": [1]}, None) is None
    assert selected_days({"ano": [2022, 2023]}, None) == [days(2022, 1, 1, 2023, 12, 31)]
    assert selected_days({"ano": [2020], "trimestre": [1, 2], "mes": [2, 3, 4]}, None) == [days(2020, 2, 1, 2020, 4, 30)]
    assert selected_days({"ano_mes": ["2021-12", "2022-01"]}, None) == [days(2021, 12, 1, 2022, 1, 31)]
    assert selected_days({"mes_idx": [2022 * 12 + 12]}, (2022, 2022)) == [days(2022, 12, 1, 2022, 12, 31)]
    assert selected_days({"mes": [1, 3]}, (2022, 2022)) == [days(2022, 1, 1, 2022, 1, 31), days(2022, 3, 1, 2022, 3, 31)]
    assert selected_days({"ano_mes": ["2022-05"], "mes": [6]}, None) == []
    assert selected_days({"mes": [1, 3, 5]}, (1990, 2020)) == [days(1990, 1, 1, 2020, 5, 31)]
