"""The batch programs, end to end on small files."""

import os

import pytest

from queixa.__main__ import main
from queixa.plans.kpis import KPI_TABLES
from tests.test_star import raw, raw_folder  # noqa: F401


def test_programs(spark, raw_folder, tmp_path, capsys):  # noqa: F811
    star, out = str(tmp_path / "estrela"), str(tmp_path / "kpis")
    main(["kpis", star, raw_folder, out])  # nothing stored yet: from the raw files
    assert sorted(os.listdir(out)) == sorted(f"{name}.csv" for name in KPI_TABLES)
    capsys.readouterr()
    main(["etl", raw_folder, star])
    told = {line.split(None, 1)[1]: int(line.split(None, 1)[0]) for line in capsys.readouterr().out.splitlines() if line.strip()}
    assert told == {"linha vazia": 0, "linha longa": 0, "dia ausente": 0, "dia fora do calendário": 0, "dia impossível": 0, "cópia exata": 1}
    main(["kpis", star, raw_folder, out, "--format", "parquet"])
    rows = spark.read.parquet(f"{out}/kpis_por_operadora").collect()
    assert {r.operadora: r.volume for r in rows} == {"CLARO": 2, "VIVO": 1, "ALGAR": 2, "NÃO IDENTIFICADA": 1}
    capsys.readouterr()
    main(["hypotheses", raw_folder])
    shown = capsys.readouterr().out
    assert all(code in shown for code in ("H1", "H2", "H3", "H4", "H5"))
    main(["hypotheses", str(tmp_path / "nada"), "--star", star])
    assert all(code in capsys.readouterr().out for code in ("H1",))
    main(["report", star, "volume_by_operator", "--where", "ano=2022", "--where", "uf=SP,RJ"])
    shown = capsys.readouterr().out
    assert "CLARO" in shown and "VIVO" in shown and "ALGAR" not in shown
    with pytest.raises(SystemExit):
        main(["report", star, "nada"])


def test_report_writes_all_its_rows(spark, tmp_path, monkeypatch):
    from queixa import __main__ as programs

    many = spark.range(1500).withColumnRenamed("id", "total")
    monkeypatch.setattr(programs, "read_star", lambda *_: None)
    monkeypatch.setattr(programs, "dataset", lambda *_: many)
    programs.main(["report", "anywhere", "volume_by_operator", "--out", str(tmp_path), "--format", "parquet"])
    assert spark.read.parquet(str(tmp_path / "volume_by_operator")).count() == 1500
