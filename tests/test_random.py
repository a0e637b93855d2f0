"""Expressions against plain Python on random cells, and properties of results on random complaints."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from queixa.fixed_values import STRICT_ALIASES
from queixa.functions import dates, numbers, text
from queixa.functions.dates import with_time_columns
from queixa.operators import aggregates, windows
from queixa.plans import hypotheses, kpis
from queixa.plans.measures import evaluate
from tests.frames import rows, star

LETTERS = "abcdefgijlmnopqrstuvxzABCDEOSÇÃÉáâãçéíóõú"
OTHERS = "  /-'._,()&0123456789\t"


def column(spark, cells, kind="string"):
    return spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")


def applied(df, expression):
    return [r.r for r in df.select("i", expression(F.col("c")).alias("r")).orderBy("i").collect()]


def test_title_case_is_python_title(spark):
    rng = random.Random(7)
    cells = ["".join(rng.choices(LETTERS + OTHERS, k=rng.randint(0, 25))) for _ in range(3000)]
    assert applied(column(spark, cells), text.title_case) == [c.title() for c in cells]


@pytest.mark.parametrize("places", [0, 1, 2, 4])
def test_half_even_is_numpy_round(spark, places):
    rng = random.Random(places)
    cells = [rng.uniform(-500, 500) for _ in range(2000)] + [rng.randint(-4000, 4000) / 16 for _ in range(2000)]
    got = applied(column(spark, cells, "double"), lambda c: numbers.round_half_even(c, places))
    assert got == [float(np.round(c, places)) for c in cells]


def test_days_are_strptime_days(spark):
    rng = random.Random(3)
    cells = [f"{rng.randint(0, 33):0{rng.choice([1, 2])}}/{rng.randint(0, 14):0{rng.choice([1, 2])}}/{rng.choice([22, 999, 1900, 2021, 2022, 2024, 12022])}"
             for _ in range(3000)]
    cells += ["1//2022", "/1/2022", "1/2/", "1/2/2022/3", "1-2-2022", "a/b/2022", "1/2/202x", "+1/2/2022", "1 /2/2022"]

    def expected(c):
        try:
            day = dt.datetime.strptime(c, "%d/%m/%Y").date()
        except ValueError:
            return None
        return day if 1678 <= day.year <= 2261 else None

    assert applied(column(spark, cells), dates.parse_day) == [expected(c) for c in cells]


def test_brands_follow_the_list(spark):
    rng = random.Random(5)
    parts = [a for a, _ in STRICT_ALIASES] + ["claro", "Algar", "Telecom", "S.A.", "oi", " "]
    cells = [rng.choice([" ", "", "\t"]).join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(1500)]

    def expected(c):
        name = c.strip().upper()
        return next((b for a, b in STRICT_ALIASES if a in name), name.split()[0] if name else "?")

    got = applied(column(spark, cells).withColumn("c", text.filed_name(F.col("c"))),
                  lambda c: text.brand_or_first_word(c, STRICT_ALIASES, "?"))
    assert got == [expected(c) for c in cells]


@pytest.fixture(scope="module")
def complaints():
    rng = random.Random(11)
    return [{
        "dia": dt.date(2021, 1, 1) + dt.timedelta(days=rng.randint(0, 900)),
        "operadora": rng.choice(["CLARO", "CLARO", "CLARO", "VIVO", "TIM", "NÃO IDENTIFICADA"]),
        "uf": rng.choice(["SP", "RJ", "BA", None]), "regiao": rng.choice(["Sul", "Norte"]),
        "categoria": rng.choice("abc"), "subcategoria": rng.choice("xyz"),
        "status": rng.choice(["Respondida", "Pendente", "Em Análise"]), "servico": rng.choice(["SCM", "SMP"]),
    } for _ in range(2500)]


def test_shares_add_up(spark, complaints):
    s = star(spark, *complaints)
    for axes, measure, inside in [(["operadora", "regiao"], "share_operadora", "regiao"), (["uf", "categoria"], "share_uf", "categoria"),
                                  (["categoria", "operadora"], "share_categoria", "operadora")]:
        sums = evaluate(s, axes, [measure]).groupBy(inside).agg(F.sum(measure).alias("s")).collect()
        assert sums and all(r.s == pytest.approx(1) for r in sums)
    assert evaluate(s, ["servico", "mes_idx"], ["pct_total"]).agg(F.sum("pct_total")).first()[0] == pytest.approx(1)


def test_pareto_ends_at_a_hundred(spark, complaints):
    last = hypotheses.concentration_by_operator(with_time_columns(rows(spark, *complaints))).collect()[-1]
    assert last.cumshare == pytest.approx(100, abs=0.05)


def test_totals_survive_every_grouping(spark, complaints):
    s = star(spark, *complaints)
    for axes in ([], ["operadora"], ["regiao", "status"], ["mes_idx"], ["uf", "categoria", "servico"]):
        assert evaluate(s, axes, ["total"]).agg(F.sum("total")).first()[0] == len(complaints)


def test_monthly_measures_against_plain_python(spark, complaints):
    s = star(spark, *complaints)
    counts: dict = {}
    for c in complaints:
        key = c["operadora"], c["dia"].year * 12 + c["dia"].month
        counts[key] = counts.get(key, 0) + 1
    got = {(r.operadora, r.mes_idx): r for r in evaluate(
        s, ["operadora", "mes_idx"], ["total", "mes_anterior", "ano_anterior", "ytd"], {"ano": [2022]}).collect()}
    assert set(got) == {k for k in counts if (k[1] - 1) // 12 == 2022}
    for (name, m), r in got.items():
        assert r.total == counts[name, m]
        assert r.mes_anterior == counts.get((name, m - 1)) and r.ano_anterior == counts.get((name, m - 12))
        assert r.ytd == sum(counts.get((name, x), 0) for x in range(2022 * 12 + 1, m + 1))


def test_z_scores_average_zero(spark, complaints):
    z = evaluate(star(spark, *complaints), ["operadora", "mes_idx"], ["z_mensal"])
    for r in z.groupBy("operadora").agg(F.avg("z_mensal").alias("a"), F.stddev_pop("z_mensal").alias("s")).collect():
        assert r.a == pytest.approx(0, abs=1e-9) and r.s == pytest.approx(1)


def test_slope_is_the_one_over_the_spine(spark, complaints):
    """The measure needs no empty months laid out; the operator that lays them out agrees."""
    s = star(spark, *complaints)
    frame = s.frame(["operadora", "mes_idx"])
    months = aggregates.volume_by(frame, "operadora", "mes_idx")
    laid_out = {r.operadora: r.inclinacao for r in aggregates.slope(
        aggregates.month_spine(months, ["operadora"]), ["operadora"]).collect()}
    for r in evaluate(s, ["operadora"], ["tendencia"]).collect():
        assert r.tendencia == pytest.approx(laid_out[r.operadora])


def test_the_same_tables_from_rows_and_from_the_cube(spark, complaints):
    frame = with_time_columns(rows(spark, *complaints))
    cube = kpis.kpi_cube(frame)
    for name, build in kpis.KPI_TABLES.items():
        a, b = (sorted(map(tuple, build(x).collect()), key=repr) for x in (frame, cube))
        assert a == b, name


def test_ranks_and_ties_against_plain_python(spark):
    rng = random.Random(2)
    pairs = [(rng.choice("ab"), f"k{i}", rng.randint(0, 9)) for i in range(60)]
    df = spark.createDataFrame(pairs, "g string, k string, v int").select(
        "g", "k", "v", windows.rank_with_gaps(F.col("v"), "g").alias("r"), windows.rank_dense(F.col("v"), "g").alias("d"))
    for r in df.collect():
        peers = [v for g, _, v in pairs if g == r.g]
        assert r.r == 1 + sum(v > r.v for v in peers)
        assert r.d == 1 + len({v for v in peers if v > r.v})
