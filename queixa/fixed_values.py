"""Values that must be exactly these for results to agree with published figures."""

# --- fixed values: cleaning -------------------------------------------------
IMPLICIT_NULLS = ["-", "N/A", "NA", "NÃO INFORMADO", "NAO INFORMADO", " ", ""]
# Cells a data-frame CSV reader already turns into a missing value.
READER_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
UNIDENTIFIED = "NÃO IDENTIFICADA"
CATCH_ALL = "OUTROS"
NOT_INFORMED = "Não Informado"
UNKNOWN_STATE = "XX"
OTHER_REGION = "Outros"

RAW_COLUMNS = [
    "Data_Abertura", "Hora_Abertura", "Tipo", "Motivo", "Detalhe_Motivo", "Status", "Agrupamento",
    "Nome", "Porte", "Grupo_Economico", "UF", "Municipio", "Sigla",
]
COLUMN_NAMES = {
    "Data_Abertura": "data_abertura",
    "Tipo": "tipo",
    "Motivo": "motivo",
    "Detalhe_Motivo": "detalhe_motivo",
    "Status": "status",
    "Agrupamento": "agrupamento",
    "Nome": "operadora_raw",
    "Porte": "porte",
    "Grupo_Economico": "grupo_economico",
    "UF": "uf_sigla",
    "Municipio": "municipio",
    "Sigla": "sigla_servico",
}

# --- fixed values: brand aliases, first match wins --------------------------
STRICT_ALIASES = [
    ("CLARO S.A.", "CLARO"),
    ("CLARO S/A", "CLARO"),
    ("NET SERVIÇOS", "CLARO"),
    ("EMBRATEL", "CLARO"),
    ("VIVO", "VIVO"),
    ("TELEFONICA BRASIL", "VIVO"),
    ("TELEFÔNICA BRASIL", "VIVO"),
    ("TIM CELULAR", "TIM"),
    ("TIM S.A.", "TIM"),
    ("OI S.A.", "OI"),
    ("OI MÓVEL", "OI"),
    ("SERCOMTEL", "SERCOMTEL"),
]
BROAD_ALIASES = [
    ("CLARO S.A.", "CLARO"),
    ("CLARO S/A", "CLARO"),
    ("NET SERVIÇOS", "CLARO"),
    ("EMBRATEL", "CLARO"),
    ("CLARO", "CLARO"),
    ("TELEFONICA BRASIL", "VIVO"),
    ("TELEFÔNICA BRASIL", "VIVO"),
    ("VIVO", "VIVO"),
    ("TIM S.A.", "TIM"),
    ("TIM", "TIM"),
    ("OI S.A.", "OI"),
    ("OI S/A", "OI"),
    ("OI MÓVEL", "OI"),
    ("OI", "OI"),
    ("SERCOMTEL", "SERCOMTEL"),
]
EXPLORATION_ALIASES = [
    ("CLARO S.A.", "CLARO"),
    ("CLARO S/A", "CLARO"),
    ("NET SERV", "CLARO"),
    ("EMBRATEL", "CLARO"),
    ("CLARO", "CLARO"),
    ("TELEFONICA BRASIL", "VIVO"),
    ("VIVO", "VIVO"),
    ("TIM S.A.", "TIM"),
    ("TIM", "TIM"),
    ("OI S.A.", "OI"),
    ("OI S/A", "OI"),
    ("OI MOVEL", "OI"),
    ("OI", "OI"),
    ("SERCOMTEL", "SERCOMTEL"),
]

# --- fixed values: dimensions ------------------------------------------------
OPERATOR_FACTS = [
    # brand, size, economic group
    ("CLARO", "Grande", "América Móvil"),
    ("VIVO", "Grande", "Telefónica"),
    ("TIM", "Grande", "TIM Group"),
    ("OI", "Grande", "Oi S.A."),
    ("SERCOMTEL", "Médio", "Sercomtel"),
    (UNIDENTIFIED, "N/D", "Não identificado"),
]
SUBSCRIBERS = [
    # brand, subscribers at the end of 2023; no figure for unidentified brands
    ("CLARO", 35_200_000),
    ("VIVO", 33_100_000),
    ("TIM", 24_800_000),
    ("OI", 12_600_000),
    ("SERCOMTEL", 400_000),
]
DEFAULT_SUBSCRIBERS_MILLIONS = 2.0
STATES = [
    # id, code, name, macro-region
    (1, "AC", "Acre", "Norte"),
    (2, "AL", "Alagoas", "Nordeste"),
    (3, "AP", "Amapá", "Norte"),
    (4, "AM", "Amazonas", "Norte"),
    (5, "BA", "Bahia", "Nordeste"),
    (6, "CE", "Ceará", "Nordeste"),
    (7, "DF", "Distrito Federal", "Centro-Oeste"),
    (8, "ES", "Espírito Santo", "Sudeste"),
    (9, "GO", "Goiás", "Centro-Oeste"),
    (10, "MA", "Maranhão", "Nordeste"),
    (11, "MT", "Mato Grosso", "Centro-Oeste"),
    (12, "MS", "Mato Grosso do Sul", "Centro-Oeste"),
    (13, "MG", "Minas Gerais", "Sudeste"),
    (14, "PA", "Pará", "Norte"),
    (15, "PB", "Paraíba", "Nordeste"),
    (16, "PR", "Paraná", "Sul"),
    (17, "PE", "Pernambuco", "Nordeste"),
    (18, "PI", "Piauí", "Nordeste"),
    (19, "RJ", "Rio de Janeiro", "Sudeste"),
    (20, "RN", "Rio Grande do Norte", "Nordeste"),
    (21, "RS", "Rio Grande do Sul", "Sul"),
    (22, "RO", "Rondônia", "Norte"),
    (23, "RR", "Roraima", "Norte"),
    (24, "SC", "Santa Catarina", "Sul"),
    (25, "SP", "São Paulo", "Sudeste"),
    (26, "SE", "Sergipe", "Nordeste"),
    (27, "TO", "Tocantins", "Norte"),
]
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Marco", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
MONTH_ABBREVIATIONS = [
    "jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez",
]
DAY_NAMES = ["Segunda", "Terca", "Quarta", "Quinta", "Sexta", "Sabado", "Domingo"]

# --- fixed values: statuses, services, weights and thresholds ----------------
ANSWERED = "Respondida"
PENDING = "Pendente"
UNDER_REVIEW = "Em Análise"
FIXED_SERVICE = "SCM"
MOBILE_SERVICE = "SMP"
RISK_WEIGHTS = (0.40, 0.35, 0.25)  # volume, unresolved share, complaints per 100k
MIN_MAX_EPSILON = 1e-9
RESOLUTION_TARGET = 0.60
HHI_SCALE = 10_000

# --- fixed values: texts and bands of results ----------------------------------
HEADLINE_METRICS = [
    # metric, unit
    ("Total Reclamações", "reclamações"),
    ("Taxa de Resolução", "%"),
    ("Pendentes", "reclamações"),
    ("Operadoras Monitoradas", "operadoras"),
    ("Estados Cobertos", "UFs"),
    ("Motivos Distintos", "motivos"),
    ("HHI Concentração", "pontos (max 10.000)"),
    ("Período Início", "data"),
    ("Período Fim", "data"),
]
CLAIMS = {
    "H1": "Top {k} operadoras > {above:.0f}% das reclamacoes",
    "H2": "Velocidade e motivo mais frequente (SCM)",
    "H3": "Taxa resolucao varia >= {at_least:.0f}pp entre operadoras",
    "H4": "Pico de reclamacoes no {quarter} (jan-mar)",
    "H5": "{region} domina volume absoluto",
}
REASON_WORDS = ("velocidade", "internet")
# A band is its lower bound and its label; the last one takes the rest.
RATE_BANDS = [(0.8, " OK"), (0.6, " Atenção"), (None, " Crítico")]
TARGET_BANDS = [(0.10, "Superou"), (0, "Atingiu"), (-0.10, "Abaixo"), (None, "Critico")]
RISK_BANDS = [(0.75, "Alto Risco"), (0.50, "Risco Elevado"), (0.25, "Risco Moderado"), (None, "Baixo Risco")]
HHI_COMPETITIVE_BELOW, HHI_CONCENTRATED_UP_TO = 1500, 2500
HHI_CLASSES = ("Competitivo", "Concentrado", "Altamente Concentrado")
SCORE_LOW_UP_TO, SCORE_MIDDLE_UP_TO = 0.30, 0.45
ANOMALY_DEVIATIONS = 2
STABLE_CHANGE = 0.05
CRITICAL_CHANGE = 0.15
NEAR_OVERALL_RATE = 0.02
NO_VALUE = "--"
SEVERAL = "Múltiplos"
SENTENCE = {
    "leader": " lidera as reclamações (",
    "of_total": " do total), ",
    "no_base": "sem base de comparação mensal",
    "up": "com volume em ALTA de ",
    "up_end": " no mês (atenção)",
    "down": "com volume em QUEDA de ",
    "down_end": " no mês",
    "stable": "com volume estável no mês",
    "rate": ". Taxa de resolução em ",
    "market": " e mercado ",
    "index": " (HHI ",
    "place": "). Maior concentração geográfica: ",
    "end": ".",
}
