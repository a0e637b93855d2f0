"""Scalar expressions: SCA1-SCA15, T1-T3, T9, T10."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from queixa.fixed_values import BROAD_ALIASES, EXPLORATION_ALIASES, STRICT_ALIASES
from queixa.functions import dates, numbers, text
from queixa.operators.cleaning import region_of_state


def values(spark, kind, cells, *build):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    rows = df.select("i", *[b(F.col("c")).alias(f"r{n}") for n, b in enumerate(build)]).orderBy("i").collect()
    return [r[1] if len(build) == 1 else tuple(r)[1:] for r in rows]


def test_title_case_restarts_after_anything_but_a_letter(spark):
    cells = ["falha/interrupção do serviço", "3g lento", "d'água FRIA", "x_y", "a-b c", "ÉTICA  dupla", "4-NOT SPECIFIED",
             "tab\tulado", "", None]
    assert values(spark, "string", cells, text.title_case) == [
        None if c is None else c.title() for c in cells]


def test_strip_like_a_python_string(spark):
    cells = [" a ", "\t a\n", "\xa0a b\xa0", "", "   ", None]
    assert values(spark, "string", cells, text.strip) == [None if c is None else c.strip() for c in cells]


def test_contains_ignores_case_and_missing_cells(spark):
    assert values(spark, "string", ["RESPONDIDA", "não respondida", "Pendente", None],
                  lambda c: text.contains_ignoring_case(c, "Respondida")) == [True, True, False, False]


def test_rounding_rules(spark):
    cells = [3.125, 0.625, 0.925, 0.575, -0.125, 2.5, None]
    even = values(spark, "double", cells, lambda c: numbers.round_half_even(c, 2))
    assert even == [3.12, 0.62, 0.92, 0.57, -0.12, 2.5, None]
    away = values(spark, "double", [0.5, 1.5, 2.5, -2.5, None], lambda c: numbers.round_half_away(c, 0))
    assert away == [1.0, 2.0, 3.0, -3.0, None]


def test_safe_division_and_changes(spark):
    df = spark.createDataFrame([(10, 0), (10, 4), (None, 4), (10, None)], "a int, b int")
    got = df.select(numbers.ratio(F.col("a"), F.col("b")), numbers.ratio_or_zero(F.col("a"), F.col("b")),
                    numbers.percent_change(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(None, 0.0, None), (2.5, 2.5, 150.0), (None, 0.0, None), (None, 0.0, None)]


def test_number_texts(spark):
    assert values(spark, "double", [0.719, 0.0005, 0.9995], numbers.one_decimal_percent) == ["71.9%", "0.1%", "100.0%"]
    assert values(spark, "double", [0.049, -0.05, 0.0, None], numbers.signed_percent) == ["+4.9%", "-5.0%", "0.0%", "--"]
    assert values(spark, "double", [2908.0, 950.0], numbers.thousands) == ["2,908", "950"]
    assert values(spark, "double", [3391.0], lambda c: numbers.round_half_even(numbers.per_100k(c, F.lit(35.2)), 2)) == [9.63]


def test_days(spark):
    cells = [" 05/03/2022 ", "1/3/2022", "31/02/2022", "2022-03-05", "05/03/22", "29/02/2024", "01/01/9999", "", None]
    assert values(spark, "string", cells, dates.parse_day) == [
        dt.date(2022, 3, 5), dt.date(2022, 3, 1), None, None, None, dt.date(2024, 2, 29), None, None, None]
    assert values(spark, "string", [" 05/03/2022"], lambda c: dates.parse_day(c, trim=False)) == [None]


@pytest.mark.parametrize("day", [dt.date(2022, 1, 1), dt.date(2023, 12, 31), dt.date(2024, 2, 29)])
def test_month_index_round_trip(spark, day):
    index = spark.createDataFrame([(day,)], "d date").select(dates.month_index(F.col("d")).alias("x"))
    row = index.select(dates.index_year(F.col("x")), dates.index_month(F.col("x")), dates.index_quarter(F.col("x")),
                       dates.index_text(F.col("x")), dates.index_label(F.col("x"))).first()
    assert tuple(row)[:4] == (day.year, day.month, (day.month + 2) // 3, day.strftime("%Y-%m"))
    assert row[4].endswith(day.strftime("/%y"))


def test_strict_brands(spark):
    cells = ["Claro S.A.", "claro s/a", "NET Serviços de Comunicação", "Embratel", "VIVO", "telefônica brasil s.a.",
             "Tim Celular", "TIM S.A.", "Oi Móvel", "Sercomtel", "Claro", "Algar Telecom", "  ", None]
    got = values(spark, "string", cells, lambda c: text.brand_or_first_word(
        text.filed_name(c), STRICT_ALIASES, "NÃO IDENTIFICADA"))
    assert got == ["CLARO", "CLARO", "CLARO", "CLARO", "VIVO", "VIVO", "TIM", "TIM", "OI", "SERCOMTEL", "CLARO",
                   "ALGAR", "NÃO IDENTIFICADA", "NÃO IDENTIFICADA"]


def test_first_alias_in_list_order_wins(spark):
    got = values(spark, "string", ["VIVO antiga EMBRATEL", "nova TIM S.A. VIVO"], lambda c: text.brand_or_first_word(
        text.filed_name(c), STRICT_ALIASES, "?"))
    assert got == ["CLARO", "VIVO"]


def test_broad_brands(spark):
    cells = ["Claro", "TIM Brasil", "Oi", "NET SERV LTDA", "OI MOVEL", "Algar Telecom", "", None]

    def broad(aliases):
        return values(spark, "string", cells, lambda c: text.brand_or_catch_all(text.filed_name(c), aliases, "OUTROS"))

    assert broad(BROAD_ALIASES) == ["CLARO", "TIM", "OI", "OUTROS", "OI", "OUTROS", "OUTROS", "OUTROS"]
    assert broad(EXPLORATION_ALIASES) == ["CLARO", "TIM", "OI", "CLARO", "OI", "OUTROS", "OUTROS", "OUTROS"]


def test_region_of_state(spark):
    assert values(spark, "string", ["SP", "AC", "DF", "XX", None], region_of_state) == [
        "Sudeste", "Norte", "Centro-Oeste", "Outros", "Outros"]
