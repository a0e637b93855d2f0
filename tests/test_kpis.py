"""KPI tables and exploration: KPI1-KPI5, HYP1-HYP6, EDA1-EDA5, WIN1-WIN7, T2, T5-T8, X1-X5."""

import pytest
from pyspark.sql import functions as F

from queixa.functions.dates import with_time_columns
from queixa.operators import aggregates, windows
from queixa.plans import hypotheses, kpis
from tests.frames import brand_cells, month, rows


def frame(spark, *cells):
    return with_time_columns(rows(spark, *cells))


# One operator's published monthly table: volume, change on the month, change on the year, trailing mean.
CLARO = [
    (128, None, None, 128.0), (132, 3.12, None, 130.0), (130, -1.52, None, 130.0), (154, 18.46, None, 138.7),
    (119, -22.73, None, 134.3), (131, 10.08, None, 134.7), (139, 6.11, None, 129.7), (119, -14.39, None, 129.7),
    (149, 25.21, None, 135.7), (161, 8.05, None, 143.0), (111, -31.06, None, 140.3), (150, 35.14, None, 140.7),
    (158, 5.33, 23.44, 139.7), (149, -5.7, 12.88, 152.3), (148, -0.67, 13.85, 151.7), (143, -3.38, -7.14, 146.7),
    (136, -4.9, 14.29, 142.3), (147, 8.09, 12.21, 142.0), (141, -4.08, 1.44, 141.3), (150, 6.38, 26.05, 146.0),
    (145, -3.33, -2.68, 145.3), (154, 6.21, -4.35, 149.7), (150, -2.6, 35.14, 149.7), (147, -2.0, -2.0, 150.3),
]


def test_monthly_table_matches_published_values(spark):
    df = kpis.kpis_temporais(frame(spark, *[{"dia": month(i), "qtd": r[0]} for i, r in enumerate(CLARO)]))
    got = [(r.volume, r.var_mom_pct, r.var_yoy_pct, r.media_movel_3m) for r in df.collect()]
    assert got == CLARO


def test_row_based_and_calendar_based_series_differ_on_a_gap(spark):
    cells = [{"dia": month(i), "qtd": n} for i, n in ((0, 10), (1, 20), (3, 40))]
    df = frame(spark, *cells).withColumn("mes_idx", F.year("dia") * 12 + F.month("dia"))
    by_row = kpis.kpis_temporais(df).collect()
    assert [r.volume_mes_anterior for r in by_row] == [None, 10, 20]
    assert by_row[-1].media_movel_3m == 23.3
    monthly = aggregates.volume_by(df, "operadora", "mes_idx")
    by_month = monthly.select(
        windows.month_back(F.col("volume"), 1, ["operadora"]).alias("p"),
        windows.trailing_months(F.col("volume"), 3, ["operadora"]).alias("m")).collect()
    assert [(r.p, r.m) for r in by_month] == [(None, 10.0), (10, 15.0), (None, 30.0)]


def test_operator_table_matches_published_values(spark):
    df = frame(spark, *brand_cells())
    got = {r.operadora: r for r in kpis.kpis_por_operadora(df).collect()}
    published = {"CLARO": (42.39, 9.63, 1, 2, 0.5707), "VIVO": (25.0, 6.04, 2, 5, 0.3952),
                 "TIM": (19.66, 6.34, 3, 3, 0.3436), "OI": (9.69, 6.15, 4, 4, 0.092),
                 "SERCOMTEL": (2.08, 41.5, 5, 1, 0.6086), "NÃO IDENTIFICADA": (1.19, 4.75, 6, 6, 0.0357)}
    for name, (share, per_100k, by_volume, by_base, score) in published.items():
        r = got[name]
        assert (r.share_pct, r.recl_por_100k, r.ranking_volume, r.ranking_100k) == (share, per_100k, by_volume, by_base)
        assert r.score_risco == pytest.approx(score, abs=5e-4)
    assert got["NÃO IDENTIFICADA"].assinantes_mi == 2.0
    blank = {r.operadora: r for r in kpis.kpis_por_operadora(df, fill=None).collect()}
    assert blank["NÃO IDENTIFICADA"].recl_por_100k is None


def test_headline_table(spark):
    cells = [*brand_cells(), {"operadora": None, "uf": None, "status": None, "qtd": 2}]
    df = frame(spark, *cells)
    got = {r.metrica: (r.valor, r.unidade) for r in kpis.kpis_consolidado(df).collect()}
    assert len(got) == 9
    assert got["Total Reclamações"] == ("8002", "reclamações")
    assert got["Operadoras Monitoradas"][0] == "6"
    assert got["HHI Concentração"] == ("2906.0", "pontos (max 10.000)")  # missing brand counts in the base only
    assert got["Período Início"] == ("01/01/2022", "data")
    same = {r.metrica: r.valor for r in kpis.kpis_consolidado(kpis.kpi_cube(df)).collect()}
    assert same == {k: v[0] for k, v in got.items()}
    full = {r.metrica: r.valor for r in kpis.kpis_consolidado(frame(spark, *brand_cells())).collect()}
    assert full["HHI Concentração"] == "2908.0"


def test_headline_table_of_nothing(spark):
    got = {r.metrica: r.valor for r in kpis.kpis_consolidado(frame(spark, {}).where("false")).collect()}
    assert (got["Total Reclamações"], got["Taxa de Resolução"], got["Período Início"]) == ("0", "0.0", "-")


def test_missing_keys_have_no_group_but_count_in_the_total(spark):
    df = frame(spark, {"uf": "SP", "qtd": 3}, {"uf": None, "qtd": 1})
    got = kpis.kpis_regionais(df).collect()
    assert [(r.uf, r.volume, r.share_pct) for r in got] == [("SP", 3, 75.0)]
    assert [r.share_pct for r in kpis.kpis_motivos(frame(spark, {"qtd": 3}, {"operadora": None, "qtd": 1})).collect()] == [75.0]


def test_reason_ranks_leave_gaps_after_ties(spark):
    volumes = [34, 30, 19, 18, 17, 16, 9, 8, 5, 5, 5]
    df = frame(spark, *[{"categoria": f"c{i:02}", "qtd": v} for i, v in enumerate(volumes)], {"categoria": "z", "qtd": 1})
    assert [r.ranking for r in kpis.kpis_motivos(df).collect()] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 9, 12]
    assert kpis.kpis_motivos(df, top=9).count() == 11


def test_status_is_matched_by_word_in_any_case(spark):
    df = frame(spark, {"status": "RESPONDIDA"}, {"status": "Respondida no prazo"}, {"status": None}, {"status": "Pendente"})
    assert kpis.kpis_regionais(df).first().taxa_resolucao == 50.0


def test_hypotheses_on_published_volumes(spark):
    """Volumes before duplicate removal: 8,145 rows."""
    brands = {"CLARO": 3460, "VIVO": 2033, "TIM": 1598, "OI": 789, "SERCOMTEL": 166, "OUTROS": 99}
    df = frame(spark, *[{"operadora": k, "qtd": v} for k, v in brands.items()])
    pareto = hypotheses.concentration_by_operator(df).collect()
    assert [r.volume for r in pareto] == sorted(brands.values(), reverse=True)
    assert [round(r.cumshare, 2) for r in pareto] == [42.48, 67.44, 87.06, 96.75, 98.79, 100.01]
    verdict = hypotheses.verdict_concentration(df).first()
    assert (verdict.resultado, verdict.confirmada) == ("Top 3 = 87.1%", True)
    quarters = {1: 1991, 2: 2036, 3: 2019, 4: 2099}
    df = frame(spark, *[{"dia": month(3 * q - 3), "qtd": n} for q, n in quarters.items()])
    assert [(r.trimestre, r.volume) for r in hypotheses.volume_by_quarter(df).collect()] == [
        (f"T{q}", n) for q, n in quarters.items()]
    assert tuple(hypotheses.verdict_quarter(df).first())[2:] == ("Pico em T4", False)
    regions = {"Sudeste": 3544, "Nordeste": 2013, "Sul": 1187, "Norte": 717, "Centro-Oeste": 684}
    df = frame(spark, *[{"regiao": k, "qtd": v} for k, v in regions.items()])
    assert [f"{r.share_pct:.1f}" for r in hypotheses.volume_by_region(df).collect()] == ["43.5", "24.7", "14.6", "8.8", "8.4"]
    assert hypotheses.verdict_region(df).first().confirmada
    assert not hypotheses.verdict_region(df, "Sul").first().confirmada
    assert not hypotheses.verdict_region(df, "Marte").first().confirmada


def test_reason_and_gap_verdicts(spark):
    df = frame(spark, {"categoria": "Velocidade Da Internet", "qtd": 6}, {"categoria": "Cobrança", "qtd": 3},
               {"operadora": "VIVO", "status": "Pendente", "qtd": 1})
    assert tuple(hypotheses.verdict_reason(df).first())[2:] == ("Velocidade Da Internet (60.0%)", True)
    assert tuple(hypotheses.verdict_resolution(df).first())[2:] == ("Gap = 100.0pp", True)
    assert tuple(aggregates.spread_and_mean(
        hypotheses.resolution_by_operator(df), "taxa_resolucao").first()) == (100.0, 50.0)
    assert [r.hipotese for r in hypotheses.hypotheses(df).collect()] == ["H1", "H2", "H3", "H4", "H5"]


def test_exactly_k_and_k_with_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 3), ("e", 1)], "k string, volume int")
    assert [r.k for r in windows.first_k(df, 3, F.desc("volume"), "k").collect()] == ["a", "b", "c"]
    assert sorted(r.k for r in windows.top_k_with_ties(df, 3, "volume").collect()) == ["a", "b", "c", "d"]
    tied = windows.top_k_with_ties(df.where("volume = 3"), 1, "volume").agg(
        windows.single_or(F.lit("Múltiplos"), F.col("k")).alias("k"))
    assert tied.first().k == "Múltiplos"


def test_dense_rank_takes_missing_as_zero(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", None), ("d", 0), ("e", -1)], "k string, v int")
    assert {r.k: r.r for r in df.select("k", windows.rank_dense(F.col("v")).alias("r")).collect()} == {
        "a": 1, "b": 1, "c": 2, "d": 2, "e": 3}


def test_matrix_fills_with_zero(spark):
    df = frame(spark, {"operadora": "A", "categoria": "x", "qtd": 2}, {"operadora": "B", "categoria": "y", "qtd": 3})
    assert [tuple(r) for r in aggregates.matrix(df, "operadora", "categoria", ["x", "y", "z"]).orderBy("operadora").collect()] == [
        ("A", 2, 0, 0), ("B", 0, 3, 0)]


def test_drill_has_both_levels(spark):
    df = frame(spark, {"subcategoria": "a", "qtd": 2}, {"subcategoria": "b", "qtd": 3})
    got = {(r.subcategoria, r.nivel, r.volume) for r in aggregates.drill(df, "categoria", "subcategoria", "operadora").collect()}
    assert got == {("a", 0, 2), ("b", 0, 3), (None, 1, 5)}


def test_audits(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", None), ("b", 1)], "x string, y int")
    assert [tuple(r) for r in aggregates.null_audit(df).collect()] == [("y", 3, 75.0, "int")]
    assert tuple(aggregates.duplicate_audit(df).first()) == (4, 2, 50.0)


def test_month_spine_and_slope(spark):
    df = spark.createDataFrame([("a", 10, 4), ("a", 13, 7), ("b", 12, 1)], "k string, mes_idx int, volume long")
    spine = aggregates.month_spine(df, ["k"])
    assert [tuple(r) for r in spine.orderBy("k", "mes_idx").collect()] == [
        ("a", 10, 4), ("a", 11, 0), ("a", 12, 0), ("a", 13, 7), ("b", 10, 0), ("b", 11, 0), ("b", 12, 1), ("b", 13, 0)]
    slopes = {r.k: r.inclinacao for r in aggregates.slope(spine, ["k"]).collect()}
    assert slopes["a"] == pytest.approx(0.9) and slopes["b"] == pytest.approx(0.1)


def test_index_stays_within_its_bounds(spark):
    for volumes in ([1], [5, 5], [9, 1, 1, 1]):
        df = spark.createDataFrame([(v,) for v in volumes], "volume long")
        value = aggregates.hhi(df).first().hhi
        assert 10000 / len(volumes) - 1e-6 <= value <= 10000 + 1e-6


def test_scores_survive_a_single_operator(spark):
    got = kpis.kpis_por_operadora(frame(spark, {"qtd": 5})).first()
    assert (got.score_risco, got.ranking_volume) == (0.0, 1)
    assert hypotheses.composite_score(frame(spark, {"qtd": 5})).first().score_risco == 0.0


def test_top_states_carry_their_region(spark):
    df = frame(spark, {"uf": "SP", "qtd": 3}, {"uf": "AC", "qtd": 2}, {"uf": "XX", "qtd": 1})
    assert [(r.uf, r.regiao) for r in hypotheses.top_states(df, 2).collect()] == [("SP", "Sudeste"), ("AC", "Norte")]
