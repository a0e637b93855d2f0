"""The SQL statement each query is checked against (DuckDB dialect, whole tables)."""

from __future__ import annotations

from catalog.tables import RAW_NAMES
from queixa.fixed_values import (
    BROAD_ALIASES, EXPLORATION_ALIASES, IMPLICIT_NULLS, MONTH_ABBREVIATIONS, MONTH_NAMES,
    DAY_NAMES, OPERATOR_FACTS, READER_NULLS, STATES, STRICT_ALIASES, SUBSCRIBERS,
)


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def r6(expression: str) -> str:
    return f"round_even(CAST({expression} AS DOUBLE), 6)"


def pct(part: str, whole: str, places: int = 2) -> str:
    return f"round_even(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, {places})"


def half_away(expression: str, places: int) -> str:
    return (f"(sign({expression}) * floor(abs({expression}) * {float(10**places)} + 0.5)"
            f" / {float(10**places)})")


def text_pct(fraction: str) -> str:
    return f"printf('%.1f%%', {half_away(f'({fraction}) * 100', 1)})"


def signed_pct(fraction: str) -> str:
    r = half_away(f"({fraction}) * 100", 1)
    return (f"CASE WHEN {fraction} IS NULL THEN '--' ELSE (CASE WHEN {r} > 0 THEN '+' WHEN {r} < 0 "
            f"THEN '-' ELSE '' END) || printf('%.1f%%', abs({r})) END")


def thousands(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def month_text(idx: str) -> str:
    return f"printf('%04d-%02d', CAST(({idx} - 1) // 12 AS INTEGER), CAST(({idx} - 1) % 12 + 1 AS INTEGER))"


# --- the complaint view ------------------------------------------------------------------
COMPLAINTS = """
v AS (
  SELECT *, CAST(year(dia) AS BIGINT) AS ano, CAST(month(dia) AS BIGINT) AS mes,
         CAST(quarter(dia) AS BIGINT) AS trimestre, strftime(dia, '%Y-%m') AS ano_mes,
         CAST(year(dia) * 12 + month(dia) AS BIGINT) AS m
  FROM (
    SELECT CAST(l.l_shipdate AS DATE) AS dia, c.c_mktsegment AS operadora,
           CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Não identificado'
                ELSE 'Grupo ' || c.c_mktsegment END AS grupo,
           n.n_name AS uf, r.r_name AS regiao, p.p_type AS categoria, p.p_brand AS subcategoria,
           CASE l.l_returnflag WHEN 'R' THEN 'Respondida' WHEN 'N' THEN 'Pendente' ELSE 'Em Análise' END AS status,
           CASE l.l_linestatus WHEN 'O' THEN 'SCM' ELSE 'SMP' END AS servico, CAST(1 AS BIGINT) AS qtd
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN part p ON l.l_partkey = p.p_partkey)),
subs AS (
  SELECT c_mktsegment AS operadora,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(count(*) * 1000 AS BIGINT) END AS assinantes
  FROM customer GROUP BY 1),
cal AS (
  SELECT DISTINCT CAST(year(d) * 12 + month(d) AS BIGINT) AS m, CAST(year(d) AS BIGINT) AS ano
  FROM (SELECT unnest(generate_series((SELECT min(dia) FROM v), (SELECT max(dia) FROM v), INTERVAL 1 DAY)) AS d)),
fim AS (SELECT max(dia) AS dia, max(m) AS m, max(dia) <> last_day(max(dia)) AS parcial FROM v)
"""


def over(*ctes_and_select: str) -> str:
    *ctes, select = ctes_and_select
    return f"WITH {', '.join([COMPLAINTS, *ctes])} {select}"


ANSWERED = "coalesce(contains(lower(status), 'respondida'), false)"
RESP = f"CAST(sum(CASE WHEN {ANSWERED} THEN qtd ELSE 0 END) AS BIGINT)"
N = "CAST(sum(qtd) AS BIGINT)"


def sum_if(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN qtd END) AS BIGINT)"


# --- the dirty rows ------------------------------------------------------------------------
def _raw() -> str:
    names = "".join(f"'{n}', " for n in RAW_NAMES)[:-2]
    codes = ", ".join(f"'{sigla.lower()}'" for _, sigla, _, _ in STATES)
    return f"""
bruto AS (
  SELECT CASE WHEN k % 101 = 0 THEN '31/02/2022' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS data_abertura,
         printf('%02d:%02d', k % 24, k % 60) AS "Hora_Abertura", 'Reclamação' AS tipo,
         CASE WHEN k % 33 = 0 THEN 'N/A' ELSE lower(o_orderpriority) END AS motivo,
         CASE WHEN k % 41 = 0 THEN 'NÃO INFORMADO' ELSE 'falha/interrupção do serviço' END AS detalhe_motivo,
         CASE o_orderstatus WHEN 'F' THEN 'Respondida' WHEN 'P' THEN ' pendente ' ELSE 'Em análise' END AS status,
         CASE WHEN k % 2 = 0 THEN 'SCM' ELSE 'SMP' END AS agrupamento,
         CASE WHEN k % 97 = 0 THEN '-' WHEN k % 89 = 0 THEN ' '
              WHEN k % 7 = 0 THEN lower(seg) || ' s.a.' WHEN k % 5 = 0 THEN '  ' || seg || ' S/A '
              ELSE [{names}][o_custkey % {len(RAW_NAMES)} + 1] END AS operadora_raw,
         CASE WHEN k % 13 = 0 THEN '-' ELSE 'Grande' END AS porte,
         CASE WHEN k % 17 = 0 THEN 'NA' ELSE 'Grupo ' || seg END AS grupo_economico,
         CASE WHEN k % 59 = 0 THEN '-' WHEN k % 61 = 0 THEN 'zz'
              ELSE ' ' || [{codes}][c_nationkey + 1] END AS uf_sigla,
         'Município ' || CAST(c_nationkey AS VARCHAR) AS municipio,
         CASE WHEN k % 2 = 0 THEN 'SCM' ELSE 'SMP' END AS sigla_servico
  FROM (SELECT o_orderkey AS k, c_mktsegment AS seg, * FROM orders JOIN customer ON o_custkey = c_custkey) o,
       LATERAL (SELECT unnest(range(CASE WHEN k % 50 = 0 THEN 2 ELSE 1 END))) AS copies)"""


RAW_COLUMNS = ["data_abertura", '"Hora_Abertura"', "tipo", "motivo", "detalhe_motivo", "status", "agrupamento",
               "operadora_raw", "porte", "grupo_economico", "uf_sigla", "municipio", "sigla_servico"]
MISSING = _in(sorted({*IMPLICIT_NULLS, *READER_NULLS}))
NULLED = "nulo AS (SELECT " + ", ".join(
    f"CASE WHEN {c} NOT IN {MISSING} THEN {c} END AS {c}" for c in RAW_COLUMNS) + " FROM bruto)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '[\\p{{L}}]+|[^\\p{{L}}]+'), "
            "lambda w: upper(w[1]) || lower(w[2:])), '')")


def _alias(name: str, aliases, otherwise: str) -> str:
    cases = " ".join(f"WHEN contains({name}, '{fragment}') THEN '{brand}'" for fragment, brand in aliases)
    return f"CASE {cases} ELSE {otherwise} END"


UPPER_NAME = strip("upper(operadora_raw)")
STRICT = (f"CASE WHEN operadora_raw IS NULL OR {UPPER_NAME} = '' THEN 'NÃO IDENTIFICADA' ELSE "
          + _alias(UPPER_NAME, STRICT_ALIASES, f"regexp_split_to_array({UPPER_NAME}, '\\s+')[1]") + " END")


def broad(aliases) -> str:
    return f"CASE WHEN operadora_raw IS NULL THEN 'OUTROS' ELSE {_alias(UPPER_NAME, aliases, repr('OUTROS'))} END"


def label(x: str, default: str = "Não Informado") -> str:
    return f"coalesce({title(strip(x))}, '{default}')"


STATE_CODE = f"coalesce(upper({strip('uf_sigla')}), 'XX')"
STATE_ROWS = "(VALUES " + ", ".join(str(s) for s in STATES) + ") AS t(id_uf, sigla, nome, regiao)"
STATE_TABLE = f"dim_uf AS (SELECT * FROM {STATE_ROWS})"
DAY = "CAST(try_strptime(" + strip("data_abertura") + ", '%d/%m/%Y') AS DATE)"
CLEAN = f"""
limpo AS (
  SELECT DISTINCT * FROM (
    SELECT {DAY} AS data_abertura, "Hora_Abertura", tipo, {label('motivo')} AS motivo,
           {label('detalhe_motivo')} AS detalhe_motivo, {label('status')} AS status, agrupamento, operadora_raw,
           porte, grupo_economico, {STATE_CODE} AS uf_sigla, municipio, sigla_servico, {STRICT} AS operadora
    FROM nulo) WHERE data_abertura IS NOT NULL)"""


def dirty(*ctes_and_select: str) -> str:
    *ctes, select = ctes_and_select
    return f"WITH {', '.join([_raw(), NULLED, *ctes])} {select}"


def known(column: int) -> str:
    cases = " ".join(f"WHEN '{row[0]}' THEN '{row[column]}'" for row in OPERATOR_FACTS)
    return f"CASE nome {cases} END"


KNOWN_BRANDS = _in([row[0] for row in OPERATOR_FACTS])
DIM_OPERATOR = f"""
dim_op AS (
  SELECT CAST(row_number() OVER (ORDER BY nome) AS BIGINT) AS id_operadora, nome,
         CASE WHEN nome IN {KNOWN_BRANDS} THEN {known(1)} ELSE porte END AS porte,
         CASE WHEN nome IN {KNOWN_BRANDS} THEN {known(2)} ELSE grupo_economico END AS grupo_economico
  FROM (SELECT operadora AS nome, porte, grupo_economico, row_number() OVER (
          PARTITION BY operadora ORDER BY data_abertura, porte IS NULL, porte,
          grupo_economico IS NULL, grupo_economico) AS r FROM limpo) WHERE r = 1)"""
DIM_TYPE = """
dim_tipo AS (
  SELECT CAST(row_number() OVER (ORDER BY categoria, subcategoria) AS BIGINT) AS id_tipo, categoria, subcategoria
  FROM (SELECT DISTINCT motivo AS categoria, detalhe_motivo AS subcategoria FROM limpo))"""
DAYS = """
dias AS (SELECT CAST(unnest(generate_series((SELECT min(data_abertura) FROM limpo),
                (SELECT max(data_abertura) FROM limpo), INTERVAL 1 DAY)) AS DATE) AS data)"""
STAR = [CLEAN, DIM_OPERATOR, DIM_TYPE, STATE_TABLE]
STAR_JOIN = """limpo f LEFT JOIN dim_op o ON f.operadora = o.nome LEFT JOIN dim_uf u ON f.uf_sigla = u.sigla
  LEFT JOIN dim_tipo t ON f.motivo = t.categoria AND f.detalhe_motivo = t.subcategoria"""


def light(aliases) -> str:
    return f"""
leve AS (
  SELECT *, CAST(year(dia) AS BIGINT) AS ano, CAST(month(dia) AS BIGINT) AS mes,
         strftime(dia, '%Y-%m') AS ano_mes, CAST(quarter(dia) AS BIGINT) AS trimestre
  FROM (SELECT CAST(try_strptime(data_abertura, '%d/%m/%Y') AS DATE) AS dia, {broad(aliases)} AS operadora,
               {title(strip("coalesce(motivo, 'Outros')"))} AS categoria, detalhe_motivo AS subcategoria,
               {strip("coalesce(status, 'Pendente')")} AS status, {STATE_CODE} AS uf,
               coalesce(upper({strip('agrupamento')}), 'SCM') AS servico, CAST(1 AS BIGINT) AS qtd FROM nulo)
  WHERE dia IS NOT NULL)"""


ORACLES: dict[str, str] = {}

ORACLES["clean_null_tokens"] = dirty("SELECT * FROM nulo")
ORACLES["clean_parse_day"] = dirty(
    f"SELECT {DAY} AS data_abertura, count(*) AS linhas FROM bruto WHERE {DAY} IS NOT NULL GROUP BY 1")
ORACLES["clean_operator_strict"] = dirty(
    f"SELECT operadora_raw, {STRICT} AS operadora, count(*) AS linhas FROM nulo GROUP BY 1, 2")
ORACLES["clean_operator_broad"] = dirty(
    f"SELECT operadora_raw, {broad(BROAD_ALIASES)} AS operadora, count(*) AS linhas FROM nulo GROUP BY 1, 2")
ORACLES["clean_text_title"] = dirty(
    f"SELECT {label('status')} AS status, {label('motivo')} AS motivo, {label('detalhe_motivo')} AS detalhe_motivo, "
    "count(*) AS linhas FROM nulo GROUP BY ALL")
ORACLES["clean_state_upper"] = dirty(
    STATE_TABLE, f"SELECT x.uf, coalesce(u.regiao, 'Outros') AS regiao, count(*) AS linhas "
    f"FROM (SELECT {STATE_CODE} AS uf FROM nulo) x LEFT JOIN dim_uf u ON x.uf = u.sigla GROUP BY 1, 2")
ORACLES["clean_dedup_union"] = dirty(CLEAN, "SELECT * FROM limpo")
ORACLES["clean_light_rows"] = dirty(
    STATE_TABLE, light(EXPLORATION_ALIASES),
    "SELECT l.*, coalesce(u.regiao, 'Outros') AS regiao FROM leve l LEFT JOIN dim_uf u ON l.uf = u.sigla")
_AUDITED = [c.strip('"') for c in RAW_COLUMNS]
ORACLES["null_audit"] = dirty(
    "SELECT coluna, nulos, " + pct("nulos", "n") + " AS nulos_pct FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS coluna, count(*) - count(\"{c}\") AS nulos, count(*) AS n FROM nulo"
                         for c in _AUDITED) + ") WHERE nulos > 0")
ORACLES["duplicate_audit"] = dirty(
    f"SELECT linhas, linhas - unicas AS duplicadas, {pct('linhas - unicas', 'linhas', 1)} AS duplicadas_pct FROM ("
    "SELECT (SELECT count(*) FROM bruto) AS linhas, (SELECT count(*) FROM (SELECT DISTINCT * FROM bruto)) AS unicas)")

ORACLES["data_audit"] = dirty(
    light(BROAD_ALIASES), "t AS (SELECT *, CASE uf " + " ".join(f"WHEN '{u[1]}' THEN '{u[3]}'" for u in STATES)
    + " ELSE 'Outros' END AS regiao FROM leve)",
    f"""SELECT linhas, CAST(13 AS BIGINT) AS colunas, linhas - unicas AS duplicatas,
    {pct('linhas - unicas', 'linhas', 1)} AS duplicatas_pct, operadoras, ufs FROM (
    SELECT count(*) AS linhas, (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS unicas,
           count(DISTINCT operadora) AS operadoras, count(DISTINCT uf) AS ufs FROM t)""")

# --- dimensional model
ORACLES["dim_operator"] = dirty(
    CLEAN, DIM_OPERATOR, "SELECT *, CASE nome " + " ".join(f"WHEN '{b}' THEN {n}" for b, n in SUBSCRIBERS)
    + " END::BIGINT AS assinantes_estimados FROM dim_op")
ORACLES["dim_type"] = dirty(CLEAN, DIM_TYPE, "SELECT * FROM dim_tipo")
ORACLES["dim_calendar"] = dirty(
    CLEAN, DAYS, f"""SELECT row_number() OVER (ORDER BY data) AS id_data, data, CAST(year(data) AS BIGINT) AS ano,
    CAST(quarter(data) AS BIGINT) AS trimestre, CAST(month(data) AS BIGINT) AS mes,
    {_list(MONTH_NAMES)}[month(data)] AS nome_mes, CAST(weekofyear(data) AS BIGINT) AS semana_ano,
    CAST(isodow(data) - 1 AS BIGINT) AS dia_semana, {_list(DAY_NAMES)}[isodow(data)] AS nome_dia,
    CAST(isodow(data) >= 6 AS BIGINT) AS fim_semana, CAST(year(data) * 100 + month(data) AS BIGINT) AS ano_mes_num,
    {_list(MONTH_ABBREVIATIONS)}[month(data)] || strftime(data, '/%y') AS mes_rotulo FROM dias""")
ORACLES["fact_keys"] = dirty(
    *STAR, f"""SELECT CAST(date_diff('day', (SELECT min(data_abertura) FROM limpo), data_abertura) + 1 AS BIGINT) AS id_data,
    id_operadora, CAST(id_uf AS BIGINT) AS id_uf, id_tipo, status, sigla_servico, CAST(1 AS BIGINT) AS qtd,
    CAST(year(data_abertura) AS BIGINT) AS ano FROM {STAR_JOIN}""")
ORACLES["star_denormalised"] = dirty(
    *STAR, f"""SELECT data_abertura AS dia, o.nome AS operadora, o.porte, o.grupo_economico AS grupo, u.sigla AS uf,
    u.nome AS estado, u.regiao, t.categoria, t.subcategoria, f.status, sigla_servico AS servico,
    CAST(year(data_abertura) AS BIGINT) AS ano, CAST(month(data_abertura) AS BIGINT) AS mes,
    strftime(data_abertura, '%Y-%m') AS ano_mes, CAST(quarter(data_abertura) AS BIGINT) AS trimestre,
    CAST(1 AS BIGINT) AS qtd FROM {STAR_JOIN}""")
ORACLES["fact_ids"] = dirty(CLEAN, """SELECT count(*) AS linhas, count(*) AS ids, CAST(1 AS BIGINT) AS primeiro, count(*) AS ultimo,
    unnest(['montado', 'gravado']) AS fato FROM limpo""")
_OUT = "municipio LIKE '%7' OR municipio LIKE '%4' OR municipio LIKE '%6'"
ORACLES["left_out_rows"] = dirty(CLEAN, f"""SELECT razao, CAST(linhas AS BIGINT) AS linhas FROM (
    SELECT 'linha vazia' AS razao, 0 AS linhas
    UNION ALL SELECT 'linha longa', count(*) FROM bruto WHERE municipio LIKE '%7'
    UNION ALL SELECT 'dia ausente', count(*) FROM bruto WHERE municipio LIKE '%6'
    UNION ALL SELECT 'dia fora do calendário', count(*) FROM bruto WHERE municipio LIKE '%4'
    UNION ALL SELECT 'dia impossível', count(*) FROM bruto WHERE data_abertura = '31/02/2022' AND NOT ({_OUT})
    UNION ALL SELECT 'cópia exata', (SELECT count(*) FROM bruto WHERE data_abertura <> '31/02/2022' AND NOT ({_OUT}))
      - (SELECT count(*) FROM limpo WHERE NOT ({_OUT})))""")
ORACLES["raw_files_with_breaks"] = dirty("""SELECT
    CASE WHEN municipio LIKE '%3' THEN municipio || chr(10) || '"centro"; sul' || chr(10)
         WHEN municipio LIKE '%5' THEN chr(10) || municipio ELSE municipio END AS municipio,
    status, sigla_servico, count(*) AS linhas FROM bruto GROUP BY 1, 2, 3""")
ORACLES["raw_files_other_headers"] = dirty("""SELECT CASE WHEN sigla_servico = 'SCM' THEN porte END AS porte, grupo_economico, uf_sigla,
    sigla_servico, count(*) AS linhas, count(DISTINCT operadora_raw) AS nomes, max(data_abertura) AS maior_texto FROM bruto GROUP BY 1, 2, 3, 4""")
ORACLES["etl_from_files"] = dirty(
    *STAR, f"""SELECT CAST(year(data_abertura) AS BIGINT) AS ano, o.nome AS operadora, u.regiao, t.categoria, f.status,
    sigla_servico AS servico, count(*) AS qtd FROM {STAR_JOIN} GROUP BY ALL""")
ORACLES["kpi_files"] = dirty(
    light(BROAD_ALIASES), f"""SELECT operadora, categoria AS motivo, {N} AS volume,
    {pct('sum(qtd)', '(SELECT count(*) FROM leve)')} AS share_pct,
    rank() OVER (PARTITION BY operadora ORDER BY sum(qtd) DESC) AS ranking FROM leve GROUP BY 1, 2""")

_STORED = f"""e AS (SELECT o.nome AS operadora, o.grupo_economico AS grupo, u.sigla AS uf, u.regiao, t.categoria, f.status,
    sigla_servico AS servico, data_abertura AS dia, CAST(1 AS BIGINT) AS qtd FROM {STAR_JOIN})"""
_BASE = "CASE operadora " + " ".join(f"WHEN '{b}' THEN {n}" for b, n in SUBSCRIBERS) + " END"
ORACLES["stored_star_states"] = dirty(
    *STAR, _STORED, f"""SELECT uf, regiao, CAST(sum(x) AS BIGINT) AS total, {r6('sum(x) / sum(sum(x)) OVER ()')} AS share_uf,
    {r6("coalesce(sum(CASE WHEN status = 'Respondida' THEN x END) / sum(x), 0)")} AS taxa_resolucao
    FROM (SELECT uf, regiao, status, qtd AS x FROM e WHERE operadora IN ('CLARO', 'VIVO') AND servico = 'SCM') GROUP BY 1, 2""")
ORACLES["stored_star_panel"] = dirty(
    *STAR, _STORED, f"""a AS (SELECT operadora, grupo, sum(qtd) AS n, coalesce({sum_if("status = 'Respondida'")} / sum(qtd), 0) AS taxa,
    {sum_if("status <> 'Respondida'")} AS aberto, sum(qtd) / ({_BASE} / 100000) AS p100k
    FROM e WHERE regiao IN ('Sudeste', 'Norte') GROUP BY 1, 2)""",
    f"""b AS (SELECT *, {half_away('(n / max(n) OVER () * 0.40 + (1 - taxa) * 0.35 + coalesce(p100k / max(p100k) OVER (), 0) * 0.25)', 4)} AS score FROM a)""",
    f"""SELECT operadora, grupo, CAST(n AS BIGINT) AS total, {r6('n / sum(n) OVER ()')} AS share_operadora, {r6('taxa')} AS taxa_resolucao,
    aberto AS em_aberto, {r6('p100k')} AS por_100k, {r6('score')} AS score_risco,
    CASE WHEN score >= 0.75 THEN 'Alto Risco' WHEN score >= 0.5 THEN 'Risco Elevado' WHEN score >= 0.25 THEN 'Risco Moderado'
    ELSE 'Baixo Risco' END AS rating_risco FROM b""")

# --- KPI tables


def _headlines(source: str) -> list[str]:
    return [
        f"t AS (SELECT {N} AS n, {RESP} AS r, count(DISTINCT operadora) AS ops, count(DISTINCT uf) AS ufs, "
        f"count(DISTINCT categoria) AS mot, min(dia) AS d0, max(dia) AS d1 FROM {source})",
        "h AS (SELECT sum((x / (SELECT n FROM t)) * (x / (SELECT n FROM t))) * 10000 AS hhi FROM "
        f"(SELECT CAST(sum(qtd) AS DOUBLE) AS x FROM {source} WHERE operadora IS NOT NULL GROUP BY operadora))",
        f"""SELECT unnest(['Total Reclamações', 'Taxa de Resolução', 'Pendentes', 'Operadoras Monitoradas',
        'Estados Cobertos', 'Motivos Distintos', 'HHI Concentração', 'Período Início', 'Período Fim']) AS metrica,
        unnest([CAST(n AS VARCHAR), CAST({pct('r', 'n')} AS VARCHAR), CAST(n - r AS VARCHAR), CAST(ops AS VARCHAR),
        CAST(ufs AS VARCHAR), CAST(mot AS VARCHAR), CAST(round_even(hhi, 0) AS VARCHAR),
        strftime(d0, '%d/%m/%Y'), strftime(d1, '%d/%m/%Y')]) AS valor,
        unnest(['reclamações', '%', 'reclamações', 'operadoras', 'UFs', 'motivos', 'pontos (max 10.000)', 'data', 'data'])
        AS unidade FROM t, h"""]


ORACLES["stored_star_kpis"] = dirty(*STAR, _STORED, *_headlines("e"))
ORACLES["kpi_consolidated"] = over(*_headlines("v"))


def _minmax(x: str) -> str:
    return f"(({x}) - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER () + 1e-9)"


def _kpi_by_operator(fill: str) -> str:
    return over(
        f"g AS (SELECT operadora, {N} AS volume, {RESP} AS r FROM v GROUP BY 1)",
        "tot AS (SELECT CAST(sum(volume) AS BIGINT) AS n FROM g)",
        f"a AS (SELECT g.operadora, volume, CAST(r AS DOUBLE) / volume * 100 AS rate, "
        f"{pct('volume', 'n')} AS share_pct, {fill} AS mi FROM g LEFT JOIN subs USING (operadora), tot "
        "WHERE g.operadora IS NOT NULL)",
        "b AS (SELECT *, round_even(volume / (mi * 1000) * 100, 2) AS r100 FROM a)",
        f"""SELECT operadora, volume, round_even(rate, 2) AS taxa_resolucao_pct, share_pct, {r6('mi')} AS assinantes_mi,
        r100 AS recl_por_100k, rank() OVER (ORDER BY volume DESC) AS ranking_volume,
        rank() OVER (ORDER BY r100 DESC NULLS LAST) AS ranking_100k,
        round_even({_minmax('CAST(volume AS DOUBLE)')} * 0.40 + {_minmax('100 - rate')} * 0.35
                   + {_minmax('r100')} * 0.25, 4) AS score_risco FROM b""")


MILLIONS = "assinantes / 1e6"
ORACLES["kpi_by_operator"] = _kpi_by_operator(f"coalesce({MILLIONS}, 2.0)")
ORACLES["risk_score_minmax"] = _kpi_by_operator(MILLIONS)
_W = "PARTITION BY operadora ORDER BY ano_mes"
ORACLES["kpi_monthly"] = over(
    f"g AS (SELECT ano_mes, operadora, {N} AS volume FROM v WHERE operadora IS NOT NULL AND ano_mes IS NOT NULL GROUP BY 1, 2)",
    f"h AS (SELECT *, lag(volume, 1) OVER ({_W}) AS p, lag(volume, 12) OVER ({_W}) AS y, "
    f"avg(volume) OVER ({_W} ROWS 2 PRECEDING) AS mm FROM g)",
    f"""SELECT ano_mes, operadora, volume, p AS volume_mes_anterior, {pct('volume - p', 'p')} AS var_mom_pct,
    y AS volume_ano_anterior, {pct('volume - y', 'y')} AS var_yoy_pct, round_even(mm, 1) AS media_movel_3m FROM h""")
_REASONS = f"""SELECT operadora, categoria AS motivo, {N} AS volume,
    {pct('sum(qtd)', '(SELECT count(*) FROM v)')} AS share_pct,
    rank() OVER (PARTITION BY operadora ORDER BY sum(qtd) DESC) AS ranking FROM v
    WHERE operadora IS NOT NULL AND categoria IS NOT NULL GROUP BY 1, 2"""
ORACLES["kpi_reasons"] = over(_REASONS)
ORACLES["kpi_reasons_top5"] = over(f"SELECT * FROM ({_REASONS}) WHERE ranking <= 5")
ORACLES["kpi_states"] = over(
    f"SELECT uf, {N} AS volume, {pct(RESP, 'sum(qtd)')} AS taxa_resolucao, "
    f"{pct('sum(qtd)', '(SELECT count(*) FROM v)')} AS share_pct, "
    "rank() OVER (ORDER BY sum(qtd) DESC) AS ranking FROM v WHERE uf IS NOT NULL GROUP BY 1")

# The same four tables over the rows of the raw files.
_FILED = ", ".join([
    _raw(), NULLED, light(BROAD_ALIASES), "v AS (SELECT * FROM leve)",
    "subs AS (SELECT * FROM (VALUES " + ", ".join(f"('{b}', {n})" for b, n in SUBSCRIBERS) + ") AS s(operadora, assinantes))"])
for _name, _same in (("kpi_files_consolidated", "kpi_consolidated"), ("kpi_files_operators", "kpi_by_operator"),
                     ("kpi_files_monthly", "kpi_monthly"), ("kpi_files_states", "kpi_states")):
    ORACLES[_name] = ORACLES[_same].replace(COMPLAINTS, _FILED)

# --- hypotheses and exploration


def _volumes(key: str) -> str:
    return f"SELECT {key}, {N} AS volume FROM v WHERE {key} IS NOT NULL GROUP BY 1"


def _shares(key: str) -> str:
    return f"SELECT *, {pct('volume', 'sum(volume) OVER ()')} AS share_pct FROM ({_volumes(key)})"


_PARETO = (f"SELECT *, round_even(sum(share_pct) OVER (ORDER BY volume DESC, operadora "
           f"ROWS UNBOUNDED PRECEDING), 2) AS cumshare FROM ({_shares('operadora')})")
_RATES = (f"SELECT operadora, {N} AS total, {RESP} AS respondidas, {pct(RESP, 'sum(qtd)')} AS taxa_resolucao "
          "FROM v WHERE operadora IS NOT NULL GROUP BY 1")
_QUARTERS = (f"SELECT operadora, 'T' || trimestre AS trimestre, {N} AS volume FROM v "
             "WHERE operadora IS NOT NULL AND trimestre IS NOT NULL GROUP BY 1, 2")
_QUARTER = f"SELECT trimestre, CAST(sum(volume) AS BIGINT) AS volume FROM ({_QUARTERS}) GROUP BY 1"
_PEAK = f"SELECT * FROM ({_QUARTER}) ORDER BY volume DESC, trimestre LIMIT 1"
ORACLES["pareto_operator"] = over(_PARETO)
ORACLES["top_reason"] = over(_shares("categoria"))
ORACLES["resolution_by_operator"] = over(_RATES)
ORACLES["resolution_gap"] = over(
    f"SELECT {r6('max(taxa_resolucao) - min(taxa_resolucao)')} AS gap, {r6('avg(taxa_resolucao)')} AS media FROM ({_RATES})")
ORACLES["quarter_by_operator"] = over(_QUARTERS)
ORACLES["quarter_peak"] = over(_PEAK)
ORACLES["region_share"] = over(_shares("regiao"))


def _tenth(x: str) -> str:
    return f"printf('%.1f', {half_away(x, 1)})"


ORACLES["hypothesis_verdicts"] = over(
    f"""SELECT 'H1' AS hipotese, 'Top 3 operadoras > 70% das reclamacoes' AS descricao,
      'Top 3 = ' || {_tenth('s')} || '%' AS resultado, s > 70 AS confirmada
    FROM (SELECT sum(share_pct) AS s FROM (SELECT * FROM ({_shares('operadora')}) ORDER BY volume DESC, operadora LIMIT 3))
    UNION ALL SELECT 'H2', 'Velocidade e motivo mais frequente (SCM)',
      categoria || ' (' || {_tenth('share_pct')} || '%)',
      contains(lower(categoria), 'velocidade') OR contains(lower(categoria), 'internet')
    FROM (SELECT * FROM ({_shares('categoria')}) ORDER BY volume DESC, categoria LIMIT 1)
    UNION ALL SELECT 'H3', 'Taxa resolucao varia >= 20pp entre operadoras', 'Gap = ' || {_tenth('g')} || 'pp', g >= 20
    FROM (SELECT max(taxa_resolucao) - min(taxa_resolucao) AS g FROM ({_RATES}))
    UNION ALL SELECT 'H4', 'Pico de reclamacoes no T1 (jan-mar)', 'Pico em ' || trimestre, trimestre = 'T1' FROM ({_PEAK})
    UNION ALL SELECT 'H5', 'ASIA domina volume absoluto', 'ASIA: ' || {_tenth('s')} || '%', w = m
    FROM (SELECT coalesce(sum(share_pct) FILTER (regiao = 'ASIA'), 0) AS s,
                 max(volume) FILTER (regiao = 'ASIA') AS w, max(volume) AS m FROM ({_shares('regiao')}))""")
ORACLES["stored_star_hypotheses"] = ORACLES["hypothesis_verdicts"].replace("ASIA", "Sudeste").replace(COMPLAINTS, ", ".join([
    _raw(), NULLED, *STAR, _STORED, "v AS (SELECT *, CAST(quarter(dia) AS BIGINT) AS trimestre FROM e)"]))
ORACLES["monthly_series"] = over(
    f"SELECT ano_mes, operadora, {N} AS volume FROM v WHERE operadora IS NOT NULL AND ano_mes IS NOT NULL GROUP BY 1, 2")
ORACLES["matrix_operator_category"] = over(
    "SELECT operadora, " + ", ".join(
        f"CAST(sum(CASE WHEN categoria = '{c}' THEN qtd ELSE 0 END) AS BIGINT) AS \"{c}\""
        for c in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])
    + " FROM v WHERE operadora IS NOT NULL AND categoria IS NOT NULL GROUP BY 1")
ORACLES["composite_score_rounded"] = over(
    f"a AS (SELECT x.*, coalesce({MILLIONS}, 2.0) AS mi FROM ({_RATES}) x LEFT JOIN subs USING (operadora))",
    "b AS (SELECT *, round_even(total / (mi * 1000) * 100, 2) AS r100 FROM a)",
    f"""SELECT operadora, total, respondidas, taxa_resolucao, total AS volume,
    {pct('total', 'sum(total) OVER ()')} AS share_pct, {r6('mi')} AS assinantes, r100 AS recl_por_100k,
    round_even({_minmax('CAST(total AS DOUBLE)')} * 0.40 + {_minmax('100 - taxa_resolucao')} * 0.35
               + {_minmax('r100')} * 0.25, 4) AS score_risco FROM b""")
ORACLES["top15_states"] = over(
    f"SELECT *, 'Outros' AS regiao FROM ({_volumes('uf')}) ORDER BY volume DESC, uf LIMIT 15")

# --- aggregation operators
_MONTHS = f"SELECT operadora, m, {N} AS x FROM v GROUP BY 1, 2"
ORACLES["monthly_average"] = over(
    f"SELECT operadora, {r6('avg(x)')} AS media_mensal FROM ({_MONTHS}) GROUP BY 1")
ORACLES["monthly_spread"] = over(
    f"SELECT operadora, {r6('avg(x)')} AS media, {r6('stddev_pop(x)')} AS desvio FROM ({_MONTHS}) GROUP BY 1")
ORACLES["month_spine"] = over(
    f"""SELECT k.uf, k.categoria, s.m AS mes_idx, CAST(coalesce(x.n, 0) AS BIGINT) AS volume
    FROM (SELECT DISTINCT uf, categoria FROM v) k
    CROSS JOIN (SELECT unnest(range((SELECT min(m) FROM v), (SELECT max(m) + 1 FROM v))) AS m) s
    LEFT JOIN (SELECT uf, categoria, m, sum(qtd) AS n FROM v GROUP BY ALL) x
      ON x.uf = k.uf AND x.categoria = k.categoria AND x.m = s.m""")
ORACLES["spine_slope"] = over(
    f"""SELECT k.uf, {r6('regr_slope(CAST(coalesce(x.n, 0) AS DOUBLE), CAST(s.m AS DOUBLE))')} AS inclinacao
    FROM (SELECT DISTINCT uf FROM v) k CROSS JOIN (SELECT unnest(range((SELECT min(m) FROM v), (SELECT max(m) + 1 FROM v))) AS m) s
    LEFT JOIN (SELECT uf, m, sum(qtd) AS n FROM v GROUP BY ALL) x ON x.uf = k.uf AND x.m = s.m GROUP BY 1""")
ORACLES["hhi_operator_and_state"] = over(" UNION ALL ".join(
    f"SELECT {r6('sum(s * s) * 10000')} AS hhi, '{k}' AS eixo FROM (SELECT sum(qtd) / sum(sum(qtd)) OVER () AS s FROM v "
    f"WHERE {k} IS NOT NULL GROUP BY {k})" for k in ("operadora", "uf")))
ORACLES["pair_distinct"] = "SELECT DISTINCT p_type AS categoria, p_brand AS subcategoria FROM part"
ORACLES["top3_states_with_ties"] = over(
    f"SELECT regiao, uf, volume FROM (SELECT regiao, uf, {N} AS volume, rank() OVER (PARTITION BY regiao "
    "ORDER BY sum(qtd) DESC) AS r FROM v GROUP BY 1, 2) WHERE r <= 3")

# --- measures
ORACLES["share_of_axis_total"] = over(
    f"""SELECT regiao, {sum_if("operadora = 'BUILDING' AND ano = 1998")} AS total,
    {r6("sum(CASE WHEN operadora = 'BUILDING' AND ano = 1998 THEN qtd END) / (SELECT count(*) FROM v)")} AS pct_total,
    {r6("sum(CASE WHEN operadora = 'BUILDING' AND ano = 1998 THEN qtd END) / sum(CASE WHEN ano = 1998 THEN qtd END)")} AS share_operadora,
    CAST(1 AS DOUBLE) AS share_categoria,
    {r6("sum(CASE WHEN operadora = 'BUILDING' AND ano = 1998 THEN qtd END) / (SELECT count(*) FROM v WHERE operadora = 'BUILDING' AND ano = 1998)")} AS share_uf
    FROM v GROUP BY 1 HAVING sum(CASE WHEN operadora = 'BUILDING' AND ano = 1998 THEN qtd END) IS NOT NULL""")
ORACLES["share_by_operator_and_region"] = over(
    f"g AS (SELECT operadora, regiao, {N} AS total FROM v WHERE servico = 'SCM' GROUP BY 1, 2)",
    f"""SELECT operadora, regiao, total, {r6('total / (SELECT count(*) FROM v)')} AS pct_total,
    {r6('total / sum(total) OVER (PARTITION BY regiao)')} AS share_operadora,
    {r6('total / sum(total) OVER (PARTITION BY operadora)')} AS share_uf,
    {text_pct('total / sum(total) OVER (PARTITION BY regiao)')} AS share_texto FROM g""")


def _market(keys: str, where: str = "true") -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    k = f"{keys}, " if keys else ""
    return (f"mem AS (SELECT {k}operadora, CAST(sum(qtd) AS DOUBLE) / sum(sum(qtd)) OVER ({part}) AS s, "
            f"rank() OVER ({part} ORDER BY sum(qtd) DESC) AS r FROM v WHERE {where} GROUP BY {k}operadora)")


HHI = half_away("sum(s * s) * 10000", 0)


def _class(h: str) -> str:
    return (f"CASE WHEN {h} < 1500 THEN 'Competitivo' WHEN {h} <= 2500 THEN 'Concentrado' "
            "ELSE 'Altamente Concentrado' END")


TOP3 = "coalesce(sum(CASE WHEN r <= 3 THEN s END), 0)"
ORACLES["hhi_class"] = over(
    _market("regiao"), f"SELECT regiao, {HHI} AS hhi, {_class(HHI)} AS classe_hhi FROM mem GROUP BY 1")
ORACLES["top3_concentration"] = over(_market("uf"), f"SELECT uf, {r6(TOP3)} AS top3 FROM mem GROUP BY 1")


def _risk(where: str) -> str:
    """Per operator: volume, rate, per 100k, ranks and score among all operators."""
    return f"""
risk AS (
  SELECT *, {half_away('(total / max(total) OVER () * 0.40 + (1 - taxa) * 0.35 + coalesce(p100k / max(p100k) OVER (), 0) * 0.25)', 4)} AS score,
         dense_rank() OVER (ORDER BY total DESC) AS rank_volume,
         dense_rank() OVER (ORDER BY coalesce(p100k, 0) DESC) AS rank_100k
  FROM (SELECT operadora, {N} AS total, {sum_if("status = 'Respondida'")} AS resp,
               coalesce({sum_if("status = 'Respondida'")} / sum(qtd), 0) AS taxa, {sum_if("status <> 'Respondida'")} AS aberto,
               sum(qtd) / (any_value(assinantes) / 100000) AS p100k
        FROM v LEFT JOIN subs USING (operadora) WHERE {where} GROUP BY 1))"""


RATING = ("CASE WHEN score IS NULL THEN '--' WHEN score >= 0.75 THEN 'Alto Risco' WHEN score >= 0.5 THEN 'Risco Elevado' "
          "WHEN score >= 0.25 THEN 'Risco Moderado' ELSE 'Baixo Risco' END")
ORACLES["risk_score_max"] = over(_risk("true"), f"""SELECT operadora, total, {r6('taxa')} AS taxa_resolucao, {r6('p100k')} AS por_100k,
    {r6('score')} AS score_risco, {RATING} AS rating_risco, CAST(CASE WHEN score >= 0.75 THEN 4 WHEN score >= 0.5 THEN 3
    WHEN score >= 0.25 THEN 2 ELSE 1 END AS BIGINT) AS ordinal_risco,
    CASE WHEN score <= 0.30 THEN 'baixo' WHEN score <= 0.45 THEN 'medio' ELSE 'alto' END AS faixa_score FROM risk""")
ORACLES["risk_score_filtered"] = over(
    _risk("ano IN (1996, 1997)"), f"""SELECT operadora, total, {r6('score')} AS score_risco, {RATING} AS rating_risco,
    rank_volume, rank_100k FROM risk WHERE operadora IN ('BUILDING', 'HOUSEHOLD')""")


def _risk_of(where: str, keys: str, columns: str, shown: str) -> str:
    """Score of whatever operators a cell holds, scaled by the largest single operator there."""
    k, group = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return over(
        f"""o AS (SELECT {k}operadora, sum(qtd) AS n, sum(qtd) / (any_value(assinantes) / 100000) AS p
        FROM v LEFT JOIN subs USING (operadora) WHERE {where} GROUP BY {k}operadora)""",
        f"top AS (SELECT {k}max(n) AS n, max(p) AS p FROM o {group})",
        f"""c AS (SELECT {k}{N} AS total, coalesce({sum_if("status = 'Respondida'")} / sum(qtd), 0) AS taxa,
        CASE WHEN count(DISTINCT coalesce(assinantes, -1)) = 1 THEN sum(qtd) / (any_value(assinantes) / 100000) END AS p100k
        FROM v LEFT JOIN subs USING (operadora) WHERE {where} AND {shown} {group})""",
        f"""risk AS (SELECT c.*, {half_away('(c.total / top.n * 0.40 + (1 - c.taxa) * 0.35 + coalesce(c.p100k / top.p, 0) * 0.25)', 4)} AS score
        FROM c JOIN top {f'USING ({keys})' if keys else 'ON true'})""",
        f"SELECT {columns} FROM risk")


ORACLES["risk_card_one_operator"] = _risk_of("true", "", f"""total, {r6('score')} AS score_risco, {RATING} AS rating_risco,
    CAST(CASE WHEN score >= 0.75 THEN 4 WHEN score >= 0.5 THEN 3 WHEN score >= 0.25 THEN 2 ELSE 1 END AS BIGINT) AS ordinal_risco,
    CASE WHEN score <= 0.30 THEN 'baixo' WHEN score <= 0.45 THEN 'medio' ELSE 'alto' END AS faixa_score""", "operadora = 'BUILDING'")
ORACLES["risk_by_month_one_operator"] = _risk_of(
    "regiao IN ('ASIA', 'EUROPE')", "m", f"total, {r6('score')} AS score_risco, {RATING} AS rating_risco, {month_text('m')} AS ano_mes",
    "operadora = 'MACHINERY'")
ORACLES["risk_by_region"] = _risk_of("true", "regiao", f"regiao, total, {r6('score')} AS score_risco", "true")


def _z(part: str) -> str:
    return f"(total - avg(total) OVER ({part})) / nullif(stddev_pop(total) OVER ({part}), 0)"


FLAG = "CASE WHEN z > 2 THEN 'alta' WHEN z < -2 THEN 'baixa' WHEN z IS NOT NULL THEN 'normal' END"
ORACLES["zscore_month_flag"] = over(
    f"g AS (SELECT m, {N} AS total FROM v GROUP BY 1)", f"h AS (SELECT *, {_z('')} AS z FROM g)",
    f"SELECT total, {r6('z')} AS z_mensal, {FLAG} AS flag_anomalia, {month_text('m')} AS ano_mes FROM h")
ORACLES["zscore_ano_mes"] = ORACLES["zscore_month_flag"]
ORACLES["zscore_ano_and_mes"] = over(
    f"g AS (SELECT m, {N} AS total FROM v GROUP BY 1)", f"h AS (SELECT *, {_z('')} AS z FROM g)",
    f"SELECT total, {r6('z')} AS z_mensal, {FLAG} AS flag_anomalia, CAST((m - 1) // 12 AS INTEGER) AS ano, "
    "CAST((m - 1) % 12 + 1 AS INTEGER) AS mes FROM h")
ORACLES["zscore_by_operator"] = over(
    f"g AS (SELECT operadora, m, {N} AS total FROM v WHERE ano IN (1997, 1998) GROUP BY 1, 2)",
    f"h AS (SELECT *, {_z('PARTITION BY operadora')} AS z FROM g)",
    f"SELECT operadora, {r6('z')} AS z_mensal, {FLAG} AS flag_anomalia, {month_text('m')} AS ano_mes FROM h")


def _slope(key: str, where: str, months: str) -> str:
    return over(
        f"""SELECT k.{key}, {r6('regr_slope(CAST(coalesce(x.n, 0) AS DOUBLE), CAST(c.m AS DOUBLE))')} AS tendencia
        FROM (SELECT DISTINCT {key} FROM v WHERE {where} AND {months}) k CROSS JOIN (SELECT m FROM cal WHERE {months}) c
        LEFT JOIN (SELECT {key}, m, sum(qtd) AS n FROM v WHERE {where} GROUP BY ALL) x ON x.{key} = k.{key} AND x.m = c.m
        GROUP BY 1""")


ORACLES["trend_slope"] = _slope("operadora", "true", "true")
ORACLES["structural_trend"] = ORACLES["trend_slope"]
ORACLES["trend_slope_filtered"] = _slope("uf", "categoria = 'PROMO'", "ano IN (1997, 1998)")


def _worst(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return (f"(SELECT {k}uf, rank() OVER ({part} ORDER BY sum(qtd) DESC) AS r FROM v GROUP BY {k}uf)")


WORST = "CASE WHEN count(*) = 1 THEN max(uf) ELSE 'Múltiplos' END AS pior_estado"
ORACLES["worst_state"] = over(f"SELECT operadora, {WORST} FROM {_worst('operadora')} WHERE r = 1 GROUP BY 1")
ORACLES["worst_state_by_category"] = over(
    f"SELECT categoria, subcategoria, {WORST} FROM {_worst('categoria, subcategoria')} WHERE r = 1 GROUP BY 1, 2")


def _back(months: int, keys: str) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    return f"sum(x) OVER ({part}ORDER BY m RANGE BETWEEN {months} PRECEDING AND {months} PRECEDING)"


def _changes(keys: str, where: str, shown: str) -> str:
    k = f"{keys}, " if keys else ""
    return over(
        f"g AS (SELECT {k}m, any_value(ano) AS ano, {N} AS x FROM v WHERE {where} GROUP BY {k}m)",
        f"h AS (SELECT {k}m, ano, x, CAST({_back(1, keys)} AS BIGINT) AS p, CAST({_back(12, keys)} AS BIGINT) AS y FROM g)",
        f"""SELECT {k}x AS total, p AS mes_anterior, y AS ano_anterior, {r6('(x - p) / nullif(p, 0)')} AS var_mom,
        {r6('(x - y) / nullif(y, 0)')} AS var_yoy, {month_text('m')} AS ano_mes FROM h WHERE {shown}""")


ORACLES["month_changes_filtered"] = _changes("", "regiao IN ('ASIA', 'EUROPE')", "ano = 1998")


def _shifted_cells(keys: str, period: str, months: str) -> tuple[str, str]:
    """Per key and period: its own total, and the totals of its months moved back by one and by twelve."""
    def part(k: int, name: str) -> str:
        return (f"(SELECT {keys}, {period}, {N} AS {name} FROM (SELECT x.{keys}, x.qtd, (x.m + {k} - 1) // 12 AS ano, "
                f"((x.m + {k} - 1) % 12) // 3 + 1 AS trimestre, x.m + {k} AS mk FROM v x) "
                f"WHERE mk IN (SELECT m FROM cal WHERE {months}) GROUP BY {keys}, {period})")
    using = f"USING ({keys}, {period})"
    return (f"h AS (SELECT * FROM {part(0, 'total')} LEFT JOIN {part(1, 'p')} {using} LEFT JOIN {part(12, 'y')} {using})",
            f"total, p AS mes_anterior, y AS ano_anterior, {r6('(total - y) / nullif(y, 0)')} AS var_yoy")


_YEARS, _YEAR_COLUMNS = _shifted_cells("operadora", "ano", "true")
ORACLES["changes_by_year"] = over(
    _YEARS, "s AS (SELECT ano, sum(total) AS t, sum(p) AS p FROM h GROUP BY 1)",
    "md AS (SELECT operadora, ano, avg(x) AS media FROM (SELECT operadora, ano, m, sum(qtd) AS x FROM v GROUP BY ALL) GROUP BY 1, 2)",
    f"""SELECT operadora, ano, {_YEAR_COLUMNS.replace('p AS', 'h.p AS')}, {r6('(total - h.p) / nullif(h.p, 0)')} AS var_mom,
    {r6('(s.t - s.p) / nullif(s.p, 0)')} AS var_mom_setor, {r6('media')} AS media_mensal
    FROM h JOIN s USING (ano) JOIN md USING (operadora, ano)""")
_QUARTER_CTE, _QUARTER_COLUMNS = _shifted_cells("regiao", "ano, trimestre", "ano IN (1997, 1998)")
ORACLES["changes_by_quarter"] = over(
    _QUARTER_CTE, f"SELECT regiao, CAST(ano AS BIGINT) AS ano, CAST(trimestre AS BIGINT) AS trimestre, {_QUARTER_COLUMNS} FROM h")
ORACLES["period_shift"] = over(
    f"""h AS (SELECT operadora, {N} AS total, {sum_if('m + 1 <= (SELECT m FROM fim)')} AS p,
    {sum_if('m + 12 <= (SELECT m FROM fim)')} AS y, sum(CASE WHEN m = (SELECT m FROM fim) THEN qtd END) AS l,
    sum(CASE WHEN m = (SELECT m FROM fim) - 1 THEN qtd END) AS b FROM v GROUP BY 1)""",
    f"""SELECT operadora, total, p AS mes_anterior, y AS ano_anterior, {r6('(total - p) / nullif(p, 0)')} AS var_mom,
    {r6('(total - y) / nullif(y, 0)')} AS var_yoy, {r6('(l - b) / nullif(b, 0)')} AS mom_ultimo_mes FROM h""")
_TWO_YEARS = "ano IN (1997, 1998)"
ORACLES["period_shift_filtered"] = over(
    f"g AS (SELECT m, any_value(ano) AS ano, {N} AS x FROM v GROUP BY 1)",
    f"""SELECT CAST(sum(x) FILTER ({_TWO_YEARS}) AS BIGINT) AS total,
    CAST(sum(x) FILTER (m + 1 IN (SELECT m FROM cal WHERE {_TWO_YEARS})) AS BIGINT) AS mes_anterior,
    CAST(sum(x) FILTER (m + 12 IN (SELECT m FROM cal WHERE {_TWO_YEARS})) AS BIGINT) AS ano_anterior,
    {r6(f"(sum(x) FILTER ({_TWO_YEARS}) - sum(x) FILTER (m + 1 IN (SELECT m FROM cal WHERE {_TWO_YEARS}))) / sum(x) FILTER (m + 1 IN (SELECT m FROM cal WHERE {_TWO_YEARS}))")} AS var_mom,
    {r6('(sum(x) FILTER (m = 1998*12+12) - sum(x) FILTER (m = 1998*12+11)) / sum(x) FILTER (m = 1998*12+11)')} AS mom_ultimo_mes,
    CAST(sum(x) FILTER (ano = 1998) AS BIGINT) AS ytd, {r6('avg(x) FILTER (m BETWEEN 1998*12+10 AND 1998*12+12)')} AS media_movel_3m,
    {r6(f'avg(x) FILTER ({_TWO_YEARS})')} AS media_mensal FROM g""")
ORACLES["ytd"] = over(
    f"""SELECT servico, {N} AS total, CAST(sum(sum(qtd)) OVER (PARTITION BY servico, any_value(ano) ORDER BY m) AS BIGINT) AS ytd,
    {month_text('m')} AS ano_mes FROM v GROUP BY servico, m""")


def _quarter(m: str) -> str:
    return f"(({m} - 1) % 12) // 3 + 1"


def _as_of(keys: str, period: str, months: str, value: str) -> str:
    """Per key and period: its own total, and a value over the months that the period's last one looks back on."""
    names = [c.strip().split(" AS ")[-1] for c in period.split(", ")]
    same = " AND ".join(f"{c.split(' AS ')[0].replace('(m ', '(g.m ')} = k.{n}" if " AS " in c else f"g.{c} = k.{c}"
                        for c, n in zip(period.split(", "), names, strict=True))
    return over(
        f"g AS (SELECT {keys}, m, any_value(ano) AS ano, sum(qtd) AS x FROM v GROUP BY {keys}, m)",
        f"k AS (SELECT {period}, max(m) AS e FROM cal WHERE {months} GROUP BY ALL)",
        f"""t AS (SELECT {keys}, {', '.join(f'k.{n}' for n in names)},
        CAST(sum(x) FILTER ({same} AND g.m IN (SELECT m FROM cal WHERE {months})) AS BIGINT) AS total, {value}
        FROM k JOIN g ON g.m <= k.e OR {same} GROUP BY ALL)""",
        f"SELECT {keys}, {', '.join(f'CAST({n} AS BIGINT) AS {n}' for n in names)}, t.* EXCLUDE ({keys}, {', '.join(names)}) FROM t "
        f"WHERE total IS NOT NULL OR {value.split(' AS ')[-1]} IS NOT NULL")


_YTD = "CAST(sum(x) FILTER ((g.m - 1) // 12 = (k.e - 1) // 12 AND g.m <= k.e) AS BIGINT) AS ytd"
_TRAILING = r6("avg(x) FILTER (g.m BETWEEN k.e - CASE WHEN k.e = (SELECT m FROM fim) AND (SELECT parcial FROM fim) "
               "THEN 3 ELSE 2 END AND k.e)") + " AS media_movel_3m"
ORACLES["ytd_by_year_quarter"] = _as_of("operadora", f"ano, {_quarter('m')} AS trimestre", "true", _YTD)
ORACLES["ytd_by_quarter_filtered"] = _as_of(
    "uf", f"{_quarter('m')} AS trimestre", "ano IN (1996, 1998) AND (m - 1) % 12 + 1 IN (1, 2, 4, 5, 10)", _YTD)
ORACLES["moving_average_by_quarter"] = _as_of("regiao", f"ano, {_quarter('m')} AS trimestre", "true", _TRAILING)
ORACLES["trend_by_year"] = (
    f"""SELECT s.operadora, y.ano, t.total, s.tendencia FROM ({ORACLES['trend_slope']}) s
    CROSS JOIN ({over("SELECT DISTINCT ano FROM cal")}) y
    LEFT JOIN ({over(f"SELECT operadora, ano, {N} AS total FROM v GROUP BY 1, 2")}) t ON t.operadora = s.operadora AND t.ano = y.ano""")


def _every_month(key: str, where: str, columns: str, kept: str) -> str:
    """All months of the calendar for each key, with what they look back on; those without any value go."""
    return over(
        f"w AS (SELECT * FROM v WHERE {where})",
        f"k AS (SELECT DISTINCT {key} FROM w)",
        f"""g AS (SELECT k.{key}, c.m, c.ano, any_value(x.n) AS x FROM k CROSS JOIN cal c
        LEFT JOIN (SELECT {key}, m, sum(qtd) AS n FROM w GROUP BY 1, 2) x ON x.{key} = k.{key} AND x.m = c.m GROUP BY 1, 2, 3)""",
        f"""h AS (SELECT *, CAST({_back(1, key)} AS BIGINT) AS p, CAST({_back(12, key)} AS BIGINT) AS y,
        CAST(sum(x) OVER (PARTITION BY {key}, ano ORDER BY m) AS BIGINT) AS ytd,
        CASE WHEN (SELECT parcial FROM fim) AND m = (SELECT m FROM fim) THEN avg(x) OVER (PARTITION BY {key} ORDER BY m RANGE 3 PRECEDING)
             ELSE avg(x) OVER (PARTITION BY {key} ORDER BY m RANGE 2 PRECEDING) END AS mm FROM g)""",
        f"""SELECT {key}, CAST(x AS BIGINT) AS total, p AS mes_anterior, y AS ano_anterior,
        {r6('(coalesce(x, 0) - p) / nullif(p, 0)')} AS var_mom, {columns}, {month_text('m')} AS ano_mes FROM h WHERE {kept}""")


ORACLES["month_previous_and_last_year"] = _every_month(
    "operadora", "true", f"{r6('(coalesce(x, 0) - y) / nullif(y, 0)')} AS var_yoy", "coalesce(x, p, y) IS NOT NULL")
ORACLES["moving_average_by_operator"] = (
    "SELECT operadora, total, media_movel_3m, ano_mes FROM ("
    + _every_month("operadora", "true", f"{r6('mm')} AS media_movel_3m", "coalesce(x, mm) IS NOT NULL") + ")")
ORACLES["blank_months_sparse"] = _every_month(
    "uf", "subcategoria = 'Brand#11' AND servico = 'SCM' AND status = 'Pendente'", f"ytd, {r6('mm')} AS media_movel_3m",
    "coalesce(x, p, y, ytd, mm) IS NOT NULL")
ORACLES["dropped_service_months"] = _every_month(
    "servico", "NOT (servico = 'SMP' AND dia >= DATE '1997-06-01')", f"{r6('(coalesce(x, 0) - y) / nullif(y, 0)')} AS var_yoy",
    "coalesce(x, p, y) IS NOT NULL")


def _moving(keys: str, extra: str) -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    return over(
        f"g AS (SELECT {k}m, {N} AS x FROM v GROUP BY {k}m)",
        f"""h AS (SELECT *, CASE WHEN (SELECT parcial FROM fim) AND m = (SELECT m FROM fim)
        THEN avg(x) OVER ({part}ORDER BY m RANGE 3 PRECEDING) ELSE avg(x) OVER ({part}ORDER BY m RANGE 2 PRECEDING) END AS mm FROM g)""",
        f"SELECT {k}{month_text('m')} AS ano_mes, {extra}x AS total, {r6('mm')} AS media_movel_3m FROM h")


ORACLES["moving_average_ano_mes"] = _moving("", "")
MONTH_LABEL = (f"{_list(MONTH_ABBREVIATIONS)}[(m - 1) % 12 + 1] || printf('/%02d', CAST(((m - 1) // 12) % 100 AS INTEGER)) "
               "AS mes_rotulo")
ORACLES["monthly_evolution"] = _moving("", f"{MONTH_LABEL}, ")
ORACLES["mom_flag_vs_sector"] = over(
    f"""g AS (SELECT k.operadora, c.m, any_value(x.n) AS x FROM (SELECT DISTINCT operadora FROM v) k CROSS JOIN cal c
    LEFT JOIN (SELECT operadora, m, {N} AS n FROM v GROUP BY 1, 2) x ON x.operadora = k.operadora AND x.m = c.m GROUP BY 1, 2)""",
    f"s AS (SELECT m, {N} AS x FROM v GROUP BY 1)",
    f"h AS (SELECT operadora, m, x, (coalesce(x, 0) - {_back(1, 'operadora')}) / nullif({_back(1, 'operadora')}, 0) AS vm FROM g)",
    f"t AS (SELECT m, (x - {_back(1, '')}) / nullif({_back(1, '')}, 0) AS vs FROM s)",
    f"""SELECT operadora, {r6('vm')} AS var_mom, {r6('vs')} AS var_mom_setor,
    CASE WHEN vm IS NULL THEN '--' WHEN vm > 0.15 THEN 'Crítico' WHEN vm > vs THEN 'Piora' ELSE 'Estável' END AS flag_piora_mom,
    CASE WHEN vm > 0 THEN 'alta' ELSE 'baixa' END AS direcao_mom, {month_text('h.m')} AS ano_mes FROM h JOIN t USING (m)
    WHERE h.x IS NOT NULL OR vm IS NOT NULL""")
ORACLES["ranks_dense"] = over(_risk("true"), "SELECT operadora, rank_volume, rank_100k FROM risk")
ORACLES["ranks_categories"] = over(
    f"SELECT categoria, {N} AS total, dense_rank() OVER (ORDER BY sum(qtd) DESC) AS rank_categoria FROM v "
    "WHERE operadora = 'MACHINERY' GROUP BY 1")
ORACLES["ranks_states"] = over(
    f"SELECT uf, {N} AS total, dense_rank() OVER (ORDER BY sum(qtd) DESC) AS rank_uf FROM v "
    "WHERE status = 'Pendente' GROUP BY 1")
ORACLES["rank_states_by_name"] = ORACLES["ranks_states"].replace("SELECT uf,", "SELECT uf AS estado,")
ORACLES["rate_bands"] = over(
    f"g AS (SELECT regiao, categoria, coalesce({sum_if(ANSWERED)} / sum(qtd), 0) AS t FROM v GROUP BY 1, 2)",
    f"a AS (SELECT {sum_if(ANSWERED)} / sum(qtd) AS t FROM v)",
    f"""SELECT regiao, categoria, {r6('g.t')} AS taxa_resolucao, {r6('g.t - 0.60')} AS gap_meta,
    {text_pct('g.t')} || CASE WHEN g.t >= 0.8 THEN ' OK' WHEN g.t >= 0.6 THEN ' Atenção' ELSE ' Crítico' END AS taxa_texto,
    CASE WHEN g.t - 0.60 >= 0.1 THEN 'Superou' WHEN g.t - 0.60 >= 0 THEN 'Atingiu' WHEN g.t - 0.60 >= -0.1 THEN 'Abaixo' ELSE 'Critico' END AS status_meta,
    CASE WHEN g.t - a.t > 0.02 THEN 'acima' WHEN g.t - a.t < -0.02 THEN 'abaixo' ELSE 'na faixa' END AS taxa_vs_geral FROM g, a""")
ORACLES["text_labels"] = over(
    f"""h AS (SELECT operadora, {sum_if('ano = 1998')} AS total, {sum_if('m + 1 IN (SELECT m FROM cal WHERE ano = 1998)')} AS p,
    {sum_if('m + 12 IN (SELECT m FROM cal WHERE ano = 1998)')} AS y, {sum_if(f'ano = 1998 AND {ANSWERED}')} AS r FROM v GROUP BY 1)""",
    f"""SELECT operadora, {_list(MONTH_NAMES)}[month((SELECT dia FROM fim))] || '/' || year((SELECT dia FROM fim)) AS ultimo_mes,
    {signed_pct('(total - y) / nullif(y, 0)')} AS var_yoy_texto, {signed_pct('(total - p) / nullif(p, 0)')} AS var_mom_texto,
    {text_pct('total / sum(total) OVER ()')} AS share_texto, 'Reclamações · ' || operadora || ' · 1998' AS titulo,
    operadora || ': ' || {thousands('total')} || ' reclamações, ' || {text_pct('coalesce(r, 0) / total')} || ' resolvidas' AS sumario_operadora
    FROM h WHERE total IS NOT NULL""")
_UNID = sum_if("operadora = 'HOUSEHOLD'")
ORACLES["identification_coverage"] = over(
    f"""SELECT regiao, {_UNID} AS nao_identificadas, {r6(f'{_UNID} / (SELECT count(*) FROM v)')} AS pct_nao_identificado,
    {r6(f'1 - coalesce({_UNID} / (SELECT count(*) FROM v), 0)')} AS cobertura FROM v GROUP BY 1""")
ORACLES["data_quality"] = over(
    f"""SELECT {N} AS total_geral, {r6(f'1 - coalesce({_UNID} / sum(qtd), 0)')} AS cobertura, {_UNID} AS nao_identificadas,
    {r6(f'{_UNID} / sum(qtd)')} AS pct_nao_identificado FROM v""")


def _by_status(condition: str) -> str:
    return f"(SELECT {sum_if(condition)} FROM v w WHERE w.servico = g.servico)"


ORACLES["volume_by_service_status"] = over(
    f"g AS (SELECT status, servico, {N} AS total FROM v GROUP BY 1, 2)",
    f"""SELECT status, servico, total,
    (SELECT {sum_if("w.servico = 'SCM'")} FROM v w WHERE w.status = g.status) AS reclamacoes_scm,
    (SELECT {sum_if("w.servico = 'SMP'")} FROM v w WHERE w.status = g.status) AS reclamacoes_smp,
    {_by_status("status = 'Respondida'")} AS respondidas,
    {r6(f'''coalesce({_by_status("status = 'Respondida'")} / total, 0)''')} AS taxa_resolucao,
    {_by_status("status <> 'Respondida'")} AS em_aberto, {_by_status("status = 'Pendente'")} AS qtd_pendentes,
    {_by_status("status = 'Em Análise'")} AS qtd_em_analise FROM g""")
ORACLES["monthly_average_measure"] = over(
    f"SELECT regiao, {r6('avg(x)')} AS media_mensal FROM (SELECT regiao, m, sum(qtd) AS x FROM v "
    "WHERE servico = 'SMP' GROUP BY 1, 2) GROUP BY 1")

# --- report datasets
def _headline(where: str, months: str) -> str:
    return over(
        _market("", f"{where} AND {months}"),
        f"""a AS (SELECT {sum_if(months)} AS total, {sum_if(f'{months} AND {ANSWERED}')} AS r,
        {sum_if(f'{months} AND NOT {ANSWERED}')} AS aberto, {sum_if(f'm + 1 IN (SELECT m FROM cal WHERE {months})')} AS p
        FROM v WHERE {where})""",
        f"""SELECT total, {r6('coalesce(r / total, 0)')} AS taxa_resolucao, aberto AS em_aberto,
        {r6('(total - p) / nullif(p, 0)')} AS var_mom, (SELECT {HHI} FROM mem) AS hhi FROM a""")


ORACLES["headline_figures"] = _headline("true", "true")
ORACLES["headline_filtered"] = _headline("regiao = 'ASIA'", "ano = 1999")


def _sentence(operator: str, months: str) -> str:
    """Leader, share and index over all operators; the rest under the operator filter."""
    return over(
        _market("", months),
        f"""a AS (SELECT {sum_if(months)} AS total, {sum_if(f'{months} AND {ANSWERED}')} AS r,
        {sum_if(f'm + 1 IN (SELECT m FROM cal WHERE {months})')} AS p FROM v WHERE {operator})""",
        f"mk AS (SELECT {HHI} AS hhi, max(operadora) FILTER (r = 1) AS nome, max(s) FILTER (r = 1) AS s FROM mem)",
        f"""pe AS (SELECT {WORST} FROM (SELECT uf, rank() OVER (ORDER BY sum(qtd) DESC) AS r FROM v
        WHERE {operator} AND {months} GROUP BY 1) WHERE r = 1)""",
        "b AS (SELECT *, (total - p) / nullif(p, 0) AS vm, coalesce(a.r / total, 0) AS t FROM a, mk, pe)",
        f"""SELECT nome || ' lidera as reclamações (' || {text_pct('s')} || ' do total), ' ||
        CASE WHEN vm IS NULL THEN 'sem base de comparação mensal'
             WHEN vm > 0.05 THEN 'com volume em ALTA de ' || {text_pct('vm')} || ' no mês (atenção)'
             WHEN vm < -0.05 THEN 'com volume em QUEDA de ' || {text_pct('abs(vm)')} || ' no mês'
             ELSE 'com volume estável no mês' END || '. Taxa de resolução em ' || {text_pct('t')} || ' e mercado ' ||
        lower({_class('hhi')}) || ' (HHI ' || {thousands('hhi')} || '). Maior concentração geográfica: ' || pior_estado || '.'
        AS insight FROM b""")


ORACLES["executive_sentence"] = _sentence("true", "true")
ORACLES["executive_sentence_filtered"] = _sentence("operadora = 'BUILDING'", "ano = 1998")
for _name, _key in {"status_mix": "status", "volume_by_operator": "operadora", "reasons_by_category": "categoria",
                    "subcategories": "subcategoria", "by_region": "regiao", "by_state": "uf"}.items():
    ORACLES[_name] = over(f"SELECT {_key}, {N} AS total FROM v GROUP BY 1")
_RISK_ROW = f"total, {r6('taxa')} AS taxa_resolucao, {r6('p100k')} AS por_100k"
ORACLES["volume_resolution_base"] = over(_risk("true"), f"SELECT operadora, {_RISK_ROW} FROM risk")
ORACLES["per_100k_ranking"] = over(_risk("true"), f"SELECT operadora, {r6('p100k')} AS por_100k FROM risk")
ORACLES["risk_table"] = over(
    _risk("true"), f"SELECT operadora, {_RISK_ROW}, {r6('score')} AS score_risco, {RATING} AS rating_risco FROM risk")


def _panel(where: str, shown: str) -> str:
    return over(_risk(where), f"""SELECT operadora, CASE WHEN operadora = 'HOUSEHOLD' THEN 'Não identificado'
    ELSE 'Grupo ' || operadora END AS grupo, total, share AS share_operadora, {r6('taxa')} AS taxa_resolucao,
    aberto AS em_aberto, {r6('p100k')} AS por_100k, {r6('score')} AS score_risco, {RATING} AS rating_risco
    FROM (SELECT *, {r6('total / sum(total) OVER ()')} AS share FROM risk) WHERE {shown}""")


ORACLES["operator_panel"] = _panel("true", "true")
ORACLES["filtered_dataset"] = _panel(
    "ano IN (1996, 1997) AND regiao IN ('ASIA', 'AFRICA') AND servico = 'SCM'", "operadora IN ('BUILDING', 'FURNITURE')")


def _stack(outer: str, inner: str) -> str:
    return over(f"SELECT {outer}, {inner}, {N} AS total, "
                f"{r6(f'sum(qtd) / sum(sum(qtd)) OVER (PARTITION BY {outer})')} AS participacao FROM v GROUP BY 1, 2")


ORACLES["category_mix"] = _stack("operadora", "categoria")
ORACLES["status_by_region"] = _stack("regiao", "status")
ORACLES["state_detail"] = over(
    f"SELECT uf, regiao, {N} AS total, {r6('sum(qtd) / sum(sum(qtd)) OVER ()')} AS share_uf, "
    f"{r6(f'coalesce({sum_if(ANSWERED)} / sum(qtd), 0)')} AS taxa_resolucao FROM v GROUP BY 1, 2")
ORACLES["market_structure"] = over(
    _market(""), f"SELECT {HHI} AS hhi, {r6(TOP3)} AS top3, "
    f"(SELECT {r6(f'1 - coalesce({_UNID} / sum(qtd), 0)')} FROM v) AS cobertura FROM mem")
ORACLES["monthly_deviation"] = over(
    f"g AS (SELECT m, {N} AS total FROM v GROUP BY 1)",
    f"SELECT {month_text('m')} AS ano_mes, {MONTH_LABEL}, {r6(_z(''))} AS z_mensal FROM g")
ORACLES["category_drill"] = over(
    f"""SELECT categoria, subcategoria, operadora, CAST(grouping(subcategoria) AS BIGINT) AS nivel, {N} AS volume FROM v
    GROUP BY GROUPING SETS ((categoria, subcategoria, operadora), (categoria, operadora))""")
