"""Explicit schemas; nothing is inferred."""

from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


FACT = _table(
    ("id_reclamacao", T.LongType()),
    ("id_data", T.IntegerType()),
    ("id_operadora", T.IntegerType()),
    ("id_uf", T.IntegerType()),
    ("id_tipo", T.IntegerType()),
    ("status", T.StringType()),
    ("sigla_servico", T.StringType()),
    ("qtd", T.IntegerType()),
)
# Stored as Parquet the fact is split by year, which shows as one more column.
STORED_FACT = T.StructType([*FACT.fields, T.StructField("ano", T.IntegerType())])
OPERATORS = _table(
    ("id_operadora", T.IntegerType()),
    ("nome", T.StringType()),
    ("porte", T.StringType()),
    ("grupo_economico", T.StringType()),
)
STATES = _table(
    ("id_uf", T.IntegerType()),
    ("sigla", T.StringType()),
    ("nome", T.StringType()),
    ("regiao", T.StringType()),
)
COMPLAINT_TYPES = _table(
    ("id_tipo", T.IntegerType()),
    ("categoria", T.StringType()),
    ("subcategoria", T.StringType()),
)
CALENDAR = _table(
    ("id_data", T.IntegerType()),
    ("data", T.DateType()),
    ("ano", T.IntegerType()),
    ("trimestre", T.IntegerType()),
    ("mes", T.IntegerType()),
    ("nome_mes", T.StringType()),
    ("semana_ano", T.IntegerType()),
    ("dia_semana", T.IntegerType()),
    ("nome_dia", T.StringType()),
    ("fim_semana", T.IntegerType()),
)
STAR_TABLES = {
    "fato_reclamacoes": FACT,
    "dim_operadora": OPERATORS,
    "dim_uf": STATES,
    "dim_tipo_reclamacao": COMPLAINT_TYPES,
    "dim_calendario": CALENDAR,
}
# Beside the tables of a stored star: how many rows each has.
MANIFEST = "manifesto"
MANIFEST_SCHEMA = _table(("tabela", T.StringType()), ("linhas", T.LongType()))
