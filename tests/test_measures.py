"""Measures and filter context: M1-M45, M47-M53, CTX1-CTX11, WIN8-WIN16, AGG12-AGG14, X2, X3, X6."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from queixa.plans.datasets import REPORTS, dataset
from queixa.plans.measures import MEASURES, evaluate
from tests.frames import brand_cells, month, month_cells, star


def one(spark_star, measures, filters=None):
    return evaluate(spark_star, [], measures, filters).first()


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_published_market_figures(spark):
    s = star(spark, *brand_cells())
    r = one(s, ["total", "taxa_resolucao", "em_aberto", "hhi", "classe_hhi", "top3", "nao_identificadas", "cobertura"])
    assert (r.total, r.hhi, r.classe_hhi, r.nao_identificadas) == (8000, 2908.0, "Altamente Concentrado", 95)
    assert r.em_aberto == 2247
    assert r.taxa_resolucao == pytest.approx(0.719, abs=5e-4)
    assert r.top3 == pytest.approx(0.8705)
    assert r.cobertura == pytest.approx(0.988, abs=5e-4)


def test_published_risk_scores(spark):
    got = by(evaluate(star(spark, *brand_cells()), ["operadora"], [
        "score_risco", "rating_risco", "ordinal_risco", "faixa_score", "por_100k", "rank_volume", "rank_100k"]), "operadora")
    published = {"CLARO": (0.56, "Risco Elevado", 3), "VIVO": (0.37, "Risco Moderado", 2),
                 "TIM": (0.32, "Risco Moderado", 2), "OI": (0.22, "Baixo Risco", 1),
                 "SERCOMTEL": (0.38, "Risco Moderado", 2), "NÃO IDENTIFICADA": (0.10, "Baixo Risco", 1)}
    for name, (score, rating, ordinal) in published.items():
        assert round(got[name].score_risco, 2) == score
        assert (got[name].rating_risco, got[name].ordinal_risco) == (rating, ordinal)
    assert got["NÃO IDENTIFICADA"].por_100k is None
    assert (got["NÃO IDENTIFICADA"].rank_100k, got["SERCOMTEL"].rank_100k) == (6, 1)
    assert [got[n].faixa_score for n in ("CLARO", "VIVO", "OI")] == ["alto", "medio", "baixo"]


def test_published_month_figures(spark):
    s = star(spark, *month_cells(), last=dt.date(2023, 12, 31))
    whole = one(s, ["mes_anterior", "var_mom", "mom_ultimo_mes", "media_mensal", "z_mensal", "ytd", "media_movel_3m", "ultimo_mes"])
    assert whole.mes_anterior == 8000 - 376  # the shifted period loses its last month
    assert whole.var_mom == pytest.approx(0.0493, abs=5e-5)
    assert whole.mom_ultimo_mes == pytest.approx(0.150, abs=5e-4)
    assert whole.media_mensal == pytest.approx(333.333, abs=1e-3)
    assert whole.z_mensal is None  # no single month in context
    assert whole.ytd == sum(n["qtd"] for n in month_cells()[12:])
    assert whole.media_movel_3m == pytest.approx((361 + 327 + 376) / 3)
    assert whole.ultimo_mes == "Dezembro/2023"
    months = evaluate(s, ["mes_idx"], ["total", "z_mensal", "flag_anomalia"]).orderBy("mes_idx").collect()
    z = [r.z_mensal for r in months]
    assert max(z) == pytest.approx(2.0073, abs=5e-5) and z.index(max(z)) == 23
    assert min(z) == pytest.approx(-1.6623, abs=5e-5)
    assert sum(z) == pytest.approx(0, abs=1e-9)
    assert months[23].flag_anomalia == "alta" and months[0].flag_anomalia == "normal"


def test_calendar_windows_by_month(spark):
    cells = [{"dia": month(i), "qtd": n} for i, n in ((0, 10), (1, 20), (3, 40), (12, 30))]
    s = star(spark, *cells, last=dt.date(2023, 1, 31))
    got = {r[0]: tuple(r[1:]) for r in evaluate(s, ["mes_idx"], [
        "total", "mes_anterior", "ano_anterior", "media_movel_3m", "ytd", "var_mom", "var_yoy", "media_mensal"]).collect()}
    jan = 2022 * 12 + 1
    assert {k - jan: v for k, v in got.items() if v[0] is not None} == {
        0: (10, None, None, 10.0, 10, None, None, 10.0), 1: (20, 10, None, 15.0, 30, 1.0, None, 20.0),
        3: (40, None, None, 30.0, 70, None, None, 40.0), 12: (30, None, 10, 30.0, 30, None, 2.0, 30.0)}
    # months without complaints that look back on some: the month after is down by all of them
    assert {k - jan: v for k, v in got.items() if v[0] is None} == {
        2: (None, 20, None, 15.0, 30, -1.0, None, None), 4: (None, 40, None, 40.0, 70, -1.0, None, None),
        5: (None, None, None, 40.0, 70, None, None, None),
        **{i: (None, None, None, None, 70, None, None, None) for i in range(6, 12)}}
    only_totals = evaluate(s, ["mes_idx"], ["total", "var_mom_texto"])
    assert only_totals.count() == 4


def test_a_measure_keeps_the_cells_it_has_a_value_in(spark):
    cells = [{"operadora": o, "dia": month(i), "qtd": n} for o, i, n in [
        ("CLARO", 0, 10), ("CLARO", 1, 5), ("VIVO", 0, 4), ("VIVO", 3, 6), ("TIM", 12, 1)]]
    s = star(spark, *cells, last=dt.date(2023, 2, 28))

    def shown(measure, axes=("operadora", "mes_idx"), filters=None):
        rows = evaluate(s, list(axes), ["total", measure], filters).collect()
        return {tuple(r[:-2]): r[-1] for r in rows if r.total is None}
    jan = 2022 * 12 + 1
    assert shown("var_mom") == {("CLARO", jan + 2): -1.0, ("VIVO", jan + 1): -1.0, ("VIVO", jan + 4): -1.0, ("TIM", jan + 13): -1.0}
    assert shown("ano_anterior") == {("CLARO", jan + 12): 10, ("CLARO", jan + 13): 5, ("VIVO", jan + 12): 4}
    assert len(shown("ytd")) == (12 - 2) + (12 - 2) + 1
    assert len(shown("tendencia")) == 14 * 3 - 5
    # no months beyond the calendar's end or outside the selected ones
    assert shown("mes_anterior", filters={"ano": [2022]}) == {("CLARO", jan + 2): 5, ("VIVO", jan + 1): 4, ("VIVO", jan + 4): 6}
    assert shown("ano_anterior", ("operadora", "ano")) == {("CLARO", 2023): 15, ("VIVO", 2023): 4}
    assert shown("mes_anterior", ("operadora",), {"ano": [2022]}) == {}
    assert shown("ano_anterior", ("operadora",), {"ano": [2023]}) == {("CLARO",): 15, ("VIVO",): 4}


def test_time_as_of_the_last_month_of_a_cell(spark):
    cells = [{"dia": month(i), "qtd": n} for i, n in ((0, 1), (1, 2), (2, 4), (4, 8), (10, 16), (13, 32), (16, 64))]
    s = star(spark, *cells, last=dt.date(2023, 5, 31))

    def got(axes, measure, filters=None):
        return {tuple(r[:-1]): r[-1] for r in evaluate(s, axes, [measure], filters).collect()}
    assert got(["ano"], "ytd") == {(2022,): 31, (2023,): 96}
    assert got(["ano", "trimestre"], "ytd") == {(2022, 1): 7, (2022, 2): 15, (2022, 3): 15, (2022, 4): 31, (2023, 1): 32, (2023, 2): 96}
    assert got(["trimestre"], "ytd") == {(1,): 32, (2,): 96, (3,): 15, (4,): 31}  # the last year that has the quarter
    assert got(["ano", "trimestre"], "media_movel_3m") == {
        (2022, 1): 7 / 3, (2022, 2): 8.0, (2022, 4): 16.0, (2023, 1): 32.0, (2023, 2): 64.0}
    assert got(["ano"], "media_movel_3m", {"mes": [1, 2, 3]}) == {(2022,): 7 / 3, (2023,): 32.0}
    whole = one(s, ["tendencia"]).tendencia
    assert {k: pytest.approx(v) for k, v in got(["ano"], "tendencia").items()} == {(2022,): whole, (2023,): whole}
    part = one(s, ["tendencia"], {"ano": [2022]}).tendencia
    found = got(["trimestre"], "tendencia", {"ano": [2022]})
    assert set(found) == {(1,), (2,), (3,), (4,)} and all(v == pytest.approx(part) for v in found.values())
    assert got(["ano", "trimestre"], "mom_ultimo_mes")[(2022, 1)] == 1.0 and got(["ano"], "mom_ultimo_mes")[(2022,)] is None
    cut = star(spark, *cells, last=dt.date(2023, 5, 4))
    assert {tuple(r) for r in evaluate(cut, ["ano"], ["media_movel_3m"]).collect()} == {(2022, 16.0), (2023, 48.0)}


def test_risk_without_an_operator_axis(spark):
    cells = brand_cells() + [dict(c, dia=dt.date(2022, 2, 1), qtd=2 * c["qtd"] if c["operadora"] == "VIVO" else c["qtd"]) for c in brand_cells()]
    s = star(spark, *cells)
    by_operator = by(evaluate(s, ["operadora"], ["score_risco", "rating_risco", "ordinal_risco", "faixa_score"]), "operadora")
    for name in ("CLARO", "VIVO", "SERCOMTEL", "NÃO IDENTIFICADA"):
        card = one(s, ["score_risco", "rating_risco", "ordinal_risco", "faixa_score"], {"operadora": [name]})
        assert tuple(card) == tuple(by_operator[name])[1:]
    months = {r.mes_idx: r.score_risco for r in evaluate(s, ["mes_idx"], ["score_risco"], {"operadora": ["VIVO"]}).collect()}
    both = {(r.operadora, r.mes_idx): r.score_risco for r in evaluate(s, ["operadora", "mes_idx"], ["score_risco"]).collect()}
    assert months and months == {m: v for (o, m), v in both.items() if o == "VIVO"}
    # all operators at once: more than the largest alone, and no single subscriber base
    assert one(s, ["score_risco"]).score_risco > max(r.score_risco for r in by_operator.values())


def test_a_name_stands_for_its_code(spark):
    s = star(spark, *[{"uf": u, "qtd": n} for u, n in [("SP", 9), ("RJ", 9), ("AC", 1)]])
    named = replace(s, fact=s.fact.withColumn("estado", F.concat(F.lit("nome de "), F.col("uf"))))
    assert {tuple(r) for r in evaluate(named, ["estado"], ["rank_uf", "share_uf"]).collect()} == {
        ("nome de SP", 1, 9 / 19), ("nome de RJ", 1, 9 / 19), ("nome de AC", 2, 1 / 19)}
    assert {tuple(r) for r in evaluate(named, ["estado"], ["rank_uf"], {"estado": ["nome de AC"]}).collect()} == {("nome de AC", 2)}


def test_trailing_window_that_ends_inside_a_month_touches_four(spark):
    cells = [{"dia": month(i), "qtd": n} for i, n in enumerate([10, 20, 30, 100])]
    full = star(spark, *cells, last=dt.date(2022, 4, 30))
    cut = star(spark, *cells, last=dt.date(2022, 4, 4))
    last = lambda s: evaluate(s, ["mes_idx"], ["media_movel_3m"]).orderBy("mes_idx").collect()[-1].media_movel_3m
    assert (last(full), last(cut)) == (50.0, 40.0)
    assert one(cut, ["media_movel_3m"]).media_movel_3m == 40.0


def test_year_filter_does_not_hide_the_month_before(spark):
    s = star(spark, *month_cells(), last=dt.date(2023, 12, 31))
    rows = evaluate(s, ["mes_idx"], ["total", "mes_anterior", "ano_anterior", "media_movel_3m"], {"ano": [2023]}).orderBy("mes_idx").collect()
    assert len(rows) == 12
    assert (rows[0].total, rows[0].mes_anterior, rows[0].ano_anterior) == (350, 342, 313)
    assert rows[0].media_movel_3m == pytest.approx((306 + 342 + 350) / 3)
    whole = one(s, ["total", "mes_anterior", "ano_anterior"], {"ano": [2023]})
    assert tuple(whole) == (sum(c["qtd"] for c in month_cells()[12:]), sum(c["qtd"] for c in month_cells()[11:23]),
                            sum(c["qtd"] for c in month_cells()[:12]))


def test_empty_months_count_as_zero_in_the_slope_only(spark):
    cells = [{"dia": month(0), "qtd": 4}, {"dia": month(3), "qtd": 7}, {"operadora": "VIVO", "dia": month(2), "qtd": 1}]
    got = by(evaluate(star(spark, *cells), ["operadora"], ["tendencia", "media_mensal"]), "operadora")
    assert got["CLARO"].tendencia == pytest.approx(0.9) and got["VIVO"].tendencia == pytest.approx(0.1)
    assert (got["CLARO"].media_mensal, got["VIVO"].media_mensal) == (5.5, 1.0)


def test_share_lifts_the_operator_filter_only(spark):
    cells = [{"operadora": o, "regiao": r, "dia": dt.date(y, 1, 1), "qtd": n} for o, r, y, n in [
        ("CLARO", "Sul", 2023, 3), ("VIVO", "Sul", 2023, 1), ("CLARO", "Norte", 2023, 1), ("VIVO", "Norte", 2023, 4),
        ("CLARO", "Sul", 2022, 10), ("VIVO", "Sudeste", 2023, 7)]]
    s = star(spark, *cells)
    got = by(evaluate(s, ["regiao"], ["total", "share_operadora", "pct_total"], {"operadora": ["CLARO"], "ano": [2023]}), "regiao")
    assert {k: (r.total, r.share_operadora) for k, r in got.items()} == {"Sul": (3, 0.75), "Norte": (1, 0.2)}
    assert got["Sul"].pct_total == pytest.approx(3 / 26)  # over everything, the other year too
    two = {(r.operadora, r.regiao): r.share_operadora for r in evaluate(
        s, ["operadora", "regiao"], ["share_operadora"], {"operadora": ["CLARO"], "ano": [2023]}).collect()}
    assert two == {("CLARO", "Sul"): 0.75, ("CLARO", "Norte"): 0.2}


def test_status_condition_replaces_the_status_filter(spark):
    cells = [{"status": "Respondida", "qtd": 6}, {"status": "Pendente", "qtd": 3}, {"status": "Em Análise", "qtd": 1}]
    s = star(spark, *cells)
    r = one(s, ["total", "respondidas", "em_aberto", "qtd_pendentes", "qtd_em_analise"], {"status": ["Pendente"]})
    assert tuple(r) == (3, 6, 4, 3, 1)
    rows = evaluate(s, ["status"], ["total", "respondidas"]).collect()
    assert {(x.status, x.total, x.respondidas) for x in rows} == {("Respondida", 6, 6), ("Pendente", 3, 6), ("Em Análise", 1, 6)}


def test_unidentified_share_keeps_the_filter_and_divides_by_everything(spark):
    cells = [{"operadora": "NÃO IDENTIFICADA", "regiao": "Sul", "qtd": 1}, {"regiao": "Sul", "qtd": 4}, {"regiao": "Norte", "qtd": 5}]
    r = one(star(spark, *cells), ["nao_identificadas", "pct_nao_identificado", "cobertura"], {"regiao": ["Sul"]})
    assert tuple(r) == (1, 0.1, 0.9)
    none = one(star(spark, *cells), ["nao_identificadas", "pct_nao_identificado", "cobertura"], {"regiao": ["Norte"]})
    assert tuple(none) == (None, None, 1.0)


def test_subscribers_need_a_single_value_in_context(spark):
    s = star(spark, *brand_cells())
    assert one(s, ["por_100k"]).por_100k is None
    assert one(s, ["por_100k"], {"operadora": ["CLARO"]}).por_100k == pytest.approx(3391 / 352)


def test_rank_and_score_see_the_filtered_out_operators(spark):
    got = by(evaluate(star(spark, *brand_cells()), ["operadora"], ["rank_volume", "score_risco"], {"operadora": ["TIM"]}), "operadora")
    assert list(got) == ["TIM"]
    assert got["TIM"].rank_volume == 3 and round(got["TIM"].score_risco, 2) == 0.32


def test_worst_state_names_ties(spark):
    cells = [{"uf": "SP", "qtd": 2}, {"uf": "RJ", "qtd": 2}, {"operadora": "VIVO", "uf": "BA", "qtd": 1}]
    got = by(evaluate(star(spark, *cells), ["operadora"], ["pior_estado"]), "operadora")
    assert (got["CLARO"].pior_estado, got["VIVO"].pior_estado) == ("Múltiplos", "BA")


def test_month_flag_compares_with_the_sector(spark):
    cells = [{"operadora": o, "dia": month(i), "qtd": n} for o, i, n in [
        ("CLARO", 0, 100), ("CLARO", 1, 110), ("VIVO", 0, 100), ("VIVO", 1, 90), ("OI", 0, 10), ("OI", 1, 12)]]
    got = {(r.operadora, r.mes_idx % 12): r for r in evaluate(
        star(spark, *cells), ["operadora", "mes_idx"], ["var_mom", "var_mom_setor", "flag_piora_mom", "direcao_mom"]).collect()}
    assert got["CLARO", 1].flag_piora_mom == "--"
    assert [got[o, 2].flag_piora_mom for o in ("CLARO", "VIVO", "OI")] == ["Piora", "Estável", "Crítico"]
    assert [got[o, 2].var_mom_setor for o in ("CLARO", "VIVO", "OI")] == [pytest.approx(2 / 210)] * 3
    assert got["VIVO", 2].direcao_mom == "baixa"


def test_texts(spark):
    s = star(spark, *brand_cells())
    got = by(evaluate(s, ["operadora"], ["titulo", "sumario_operadora", "taxa_texto", "status_meta", "taxa_vs_geral", "share_texto",
                                         "var_mom_texto", "var_yoy_texto"], {"uf": ["SP"], "ano": [2022]}), "operadora")
    assert got["CLARO"].titulo == "Reclamações · CLARO · SP · 2022"
    assert got["CLARO"].sumario_operadora == "CLARO: 3,391 reclamações, 71.9% resolvidas"
    assert (got["CLARO"].taxa_texto, got["CLARO"].status_meta, got["CLARO"].share_texto) == ("71.9% Atenção", "Superou", "42.4%")
    assert [got[o].taxa_vs_geral for o in ("OI", "CLARO", "SERCOMTEL")] == ["acima", "na faixa", "abaixo"]
    assert (got["CLARO"].var_mom_texto, got["CLARO"].var_yoy_texto) == ("--", "--")
    assert one(s, ["titulo"], {"operadora": ["OI", "TIM"]}).titulo == "Reclamações"


def test_executive_sentence(spark):
    text = dataset(star(spark, *brand_cells()), "executive_sentence").first().insight
    assert text == ("CLARO lidera as reclamações (42.4% do total), sem base de comparação mensal. Taxa de resolução em 71.9% "
                    "e mercado altamente concentrado (HHI 2,908). Maior concentração geográfica: SP.")
    # Under an operator filter the leader is still the market's, its share still of the whole market.
    text = dataset(star(spark, *brand_cells()), "executive_sentence", {"operadora": ["OI"]}).first().insight
    assert text.startswith("CLARO lidera as reclamações (42.4% do total)") and "74.3%" in text


def test_stacked_shares_add_up(spark):
    cells = [{"operadora": o, "categoria": c, "qtd": n} for o, c, n in [("CLARO", "a", 3), ("CLARO", "b", 1), ("OI", "a", 5)]]
    rows = dataset(star(spark, *cells), "category_mix").collect()
    assert [(r.operadora, r.categoria, r.participacao) for r in rows] == [("CLARO", "a", 0.75), ("CLARO", "b", 0.25), ("OI", "a", 1.0)]


def test_months_sort_by_number_not_by_label(spark):
    rows = dataset(star(spark, *month_cells()), "monthly_evolution").collect()
    assert [r.mes_rotulo for r in rows][:4] == ["jan/22", "fev/22", "mar/22", "abr/22"]
    assert len(rows) == 24


def test_bad_requests_are_refused(spark):
    s = star(spark, {})
    with pytest.raises(ValueError, match="unknown measure"):
        evaluate(s, [], ["nada"])
    with pytest.raises(ValueError, match="unknown columns"):
        evaluate(s, ["nada"], ["total"])
    with pytest.raises(ValueError, match="needs the axis operadora"):
        evaluate(s, ["regiao"], ["rank_volume"])
    with pytest.raises(ValueError, match="month axis"):
        evaluate(s, ["ano", "mes_idx"], ["total"])


def test_year_and_quarter_axes_shift_whole_periods(spark):
    s = star(spark, *month_cells(), last=dt.date(2023, 12, 31))
    counts = [c["qtd"] for c in month_cells()]
    got = by(evaluate(s, ["ano"], ["total", "mes_anterior", "ano_anterior", "var_yoy", "media_mensal", "flag_piora_mom"]), "ano")
    first, second = sum(counts[:12]), sum(counts[12:])
    assert tuple(got[2022])[:4] == (2022, first, sum(counts[:11]), None)
    assert tuple(got[2023])[:4] == (2023, second, sum(counts[11:23]), first)
    assert got[2023].var_yoy == pytest.approx(second / first - 1) and got[2023].media_mensal == pytest.approx(second / 12)
    quarters = {(r.ano, r.trimestre): r for r in evaluate(
        s, ["ano", "trimestre"], ["total", "mes_anterior", "ano_anterior"], {"ano": [2023]}).collect()}
    assert len(quarters) == 4
    assert tuple(quarters[2023, 1])[2:] == (sum(counts[12:15]), sum(counts[11:14]), sum(counts[:3]))


def test_catalogue_is_complete(spark):
    """52 of the 53 documented measures; the palette measure is presentation."""
    base = ["total", "total_geral", "reclamacoes_scm", "reclamacoes_smp", "respondidas", "em_aberto", "qtd_pendentes",
            "qtd_em_analise", "nao_identificadas", "media_mensal", "mes_anterior", "ano_anterior", "ytd", "media_movel_3m",
            "tendencia", "z_mensal", "hhi", "top3", "pior_estado"]
    named = [m for m in MEASURES if not m.startswith("_") and m != "var_mom_setor"]
    assert len(set(base) | set(named)) == 52
    everything = [m for m in [*base, *named] if MEASURES.get(m) is None or MEASURES[m].axis in (None, "operadora")]
    row = evaluate(star(spark, *brand_cells()), ["operadora"], everything).first()
    assert set(everything) <= set(row.asDict())
    assert len(REPORTS) == 20  # and the drill
