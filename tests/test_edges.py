"""Keys, names and calendars off the beaten path."""

import datetime

from pyspark.sql import functions as F

from queixa import schema
from queixa.functions.text import brand_or_first_word, filed_name
from queixa.operators.dimensions import dense_ids
from queixa.operators.star import star_of


def test_first_word_ends_at_a_no_break_space(spark):
    df = spark.createDataFrame([("ALGAR\u00a0TELECOM",), ("ALGAR TELECOM",), ("ALGAR",)], "nome string")
    got = df.select(brand_or_first_word(filed_name(F.col("nome")), [], "?").alias("b")).distinct().collect()
    assert [r.b for r in got] == ["ALGAR"]


def test_a_null_key_keeps_its_row(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    assert sorted((r.id, r.k or "") for r in dense_ids(df, "id", ["k"]).collect()) == [(1, ""), (2, "a"), (3, "b")]


def test_calendar_numbered_from_ten(spark):
    kinds = next(v for v in vars(schema).values() if isinstance(v, dict) and "dim_calendario" in v)
    tables = {name: spark.createDataFrame([], kind) for name, kind in kinds.items()}
    days = spark.createDataFrame([(10 + i, datetime.date(2023, 1, 1 + i)) for i in range(3)], "id_data int, data date")
    facts = spark.createDataFrame([(10,), (12,)], "id_data int").withColumn("sigla_servico", F.lit("SMP"))
    tables |= {"dim_calendario": days, "fato_reclamacoes": facts}
    assert sorted(r.dia.day for r in star_of(tables).fact.collect()) == [1, 3]
