"""Raw files and cleaning: SRC1-SRC5, CLN1-CLN12, SET1, T4, T11, T12."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from queixa.fixed_values import COLUMN_NAMES, IMPLICIT_NULLS, RAW_COLUMNS
from queixa.operators.cleaning import clean, clean_files, clean_light, null_implicit
from queixa.sources.raw import canonical_columns, read_many, read_raw_csv

HEADER = ";".join(RAW_COLUMNS)


def line(day="05/03/2022", hour="10:00", reason="velocidade", detail="falha/interrupção", status="Respondida",
         name="Claro S.A.", size="Grande", group="Claro", state="sp", city="São Paulo", code="SCM", extra=""):
    return f"{day};{hour};Reclamação;{reason};{detail};{status};SCM;{name};{size};{group};{state};{city};{code}{extra}"


def write(path, lines, header=HEADER):
    path.write_bytes("\n".join([header, *lines, ""]).encode("latin-1"))
    return str(path)


def test_latin1_strings_and_line_lengths(spark, tmp_path):
    path = write(tmp_path / "scm.csv", [
        line(),
        line(hour="10:01", extra=";sobra"),          # 14 fields: skipped
        line(hour="10:02", extra=";"),               # an empty fourteenth field is one too many as well
        line(hour="10:03").rsplit(";", 1)[0],        # 12 fields: kept, the last one missing
        line(hour="10:04", detail='"com ; dentro"'),  # a separator inside quotes
        line(hour="10:05", detail='"diz ""não"""'),
        line(hour="10:06", detail='de 20" ou 30"', city='"A";"B"').rsplit(";", 1)[0],  # quotes inside a cell
        line(hour="10:07", detail='20";30"'),        # not quoted: one field too many
        line(hour="10:08", status='""', name='"Vivo"', city='"a;b;c"'),
        "",
    ])
    df = read_raw_csv(spark, path)
    assert df.columns == RAW_COLUMNS
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    rows = {r["Hora_Abertura"]: r for r in df.collect()}
    assert sorted(rows) == ["10:00", "10:03", "10:04", "10:05", "10:06", "10:08"]
    assert rows["10:00"]["Municipio"] == "São Paulo"
    assert rows["10:03"]["Sigla"] is None
    assert rows["10:04"]["Detalhe_Motivo"] == "com ; dentro"
    assert rows["10:05"]["Detalhe_Motivo"] == 'diz "não"'
    assert (rows["10:06"]["Detalhe_Motivo"], rows["10:06"]["Sigla"]) == ('de 20" ou 30"', "B")
    assert (rows["10:08"]["Nome"], rows["10:08"]["Municipio"], rows["10:08"]["Sigla"]) == ("Vivo", "a;b;c", "SCM")


def test_line_breaks_inside_quotes_on_request(spark, tmp_path):
    path = write(tmp_path / "scm.csv", [
        line(), line(hour="10:01", extra=";sobra"), line(hour="10:02", detail='"duas\nlinhas; São"'),
        line(hour="10:03").rsplit(";", 1)[0]])
    rows = {r["Hora_Abertura"]: r for r in read_raw_csv(spark, path, multi_line=True).collect()}
    assert sorted(rows) == ["10:00", "10:02", "10:03"]
    assert rows["10:02"]["Detalhe_Motivo"] == "duas\nlinhas; São" and rows["10:03"]["Sigla"] is None


def test_headers_are_trimmed_renamed_and_may_be_absent(spark, tmp_path):
    path = write(tmp_path / "x.csv", ["05/03/2022;algo"], header=" Data_Abertura ; Outra ")
    df = canonical_columns(read_raw_csv(spark, path))
    assert df.columns == ["data_abertura", "Outra"]
    assert set(COLUMN_NAMES) < set(RAW_COLUMNS)


def test_missing_files_are_skipped_but_not_all(spark, tmp_path):
    path = write(tmp_path / "scm.csv", [line()])
    assert len(read_many(spark, [path, str(tmp_path / "smp.csv")])) == 1
    with pytest.raises(FileNotFoundError):
        read_many(spark, [str(tmp_path / "nada.csv")])


def test_implicit_nulls_are_exact_cells(spark):
    cells = [*IMPLICIT_NULLS, "null", "NaN", " - ", "na", "N/A ", "algo"]
    df = spark.createDataFrame([(c, 1) for c in cells], "c string, n int")
    got = [r.c for r in null_implicit(df).collect()]
    assert got == [None] * (len(IMPLICIT_NULLS) + 2) + [" - ", "na", "N/A ", "algo"]


def test_clean_rows(spark, tmp_path):
    path = write(tmp_path / "scm.csv", [
        line(),
        line(status="respondida"),                  # the same row once the status is in title case
        line(day="31/02/2022"),                     # no such day
        line(day="1/3/2022", reason="-", detail=" ", status="Em análise", name="N/A", state="-"),
        line(day="02/03/2022", name="Algar Telecom", state="zz", reason=" cobrança "),
    ])
    rows = {r.data_abertura: r for r in clean(read_raw_csv(spark, path)).collect()}
    assert len(rows) == 3
    first, gaps, other = rows[dt.date(2022, 3, 5)], rows[dt.date(2022, 3, 1)], rows[dt.date(2022, 3, 2)]
    # The cell as filed stays; spelling differences in status vanish, so the copy goes.
    assert (first.status, first.motivo, first.detalhe_motivo, first.uf_sigla, first.operadora) == (
        "Respondida", "Velocidade", "Falha/Interrupção", "SP", "CLARO")
    assert (gaps.motivo, gaps.detalhe_motivo, gaps.status, gaps.uf_sigla, gaps.operadora) == (
        "Não Informado", "Não Informado", "Em Análise", "XX", "NÃO IDENTIFICADA")
    assert (other.motivo, other.uf_sigla, other.operadora) == ("Cobrança", "ZZ", "ALGAR")


def test_duplicates_go_within_a_file_only(spark, tmp_path):
    one = read_raw_csv(spark, write(tmp_path / "a.csv", [line(), line(), line(hour="11:00")]))
    two = read_raw_csv(spark, write(tmp_path / "b.csv", [line()]))
    assert clean_files([one, two]).count() == 3


def test_light_cleaning(spark, tmp_path):
    path = write(tmp_path / "x.csv", ["05/03/2022;Oi;sp", " 06/03/2022;Oi;sp", "07/03/2022;-;", "07/03/2022;-;"],
                 header="Data_Abertura;Nome;UF")
    rows = clean_light(read_raw_csv(spark, path)).orderBy("dia").collect()
    assert len(rows) == 3  # the untrimmed day is not a day; copies stay
    assert rows[0].asDict() == {
        "dia": dt.date(2022, 3, 5), "operadora": "OI", "categoria": "Outros", "subcategoria": None,
        "status": "Pendente", "uf": "SP", "servico": "SCM", "qtd": 1, "regiao": "Sudeste",
        "ano": 2022, "mes": 3, "ano_mes": "2022-03", "trimestre": 1}
    assert (rows[1].operadora, rows[1].uf, rows[1].regiao) == ("OUTROS", "XX", "Outros")


def test_a_third_of_all_rows_being_one_copy_collapses_before_the_shuffle(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    plan = df.dropDuplicates()
    assert plan.count() == 20001
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") >= 2  # one on each side of the exchange
