"""The batch programs: `spark-submit -m queixa <program> ...` or `python -m queixa <program> ...`.

etl RAW STAR           raw files to a stored star, and an account of the rows left out
kpis STAR RAW OUT      the five KPI tables, from the star if it is stored, else from the raw files
hypotheses RAW         the five verdicts over the raw files, duplicates kept; with --star, over the stored star if there is one
report STAR NAME       one report dataset; repeat --where ano=2023,2022. --out writes all its rows to a
                       folder; without it the first rows are shown as a preview
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from queixa.fixed_values import EXPLORATION_ALIASES
from queixa.operators.cleaning import clean_light
from queixa.plans.context import CALENDAR
from queixa.plans.datasets import REPORTS, dataset
from queixa.plans.hypotheses import HYPOTHESIS_KEYS, hypotheses
from queixa.plans.kpis import CUBE_KEYS
from queixa.session import build_session, size_shuffles
from queixa.sources.account import DropAccount
from queixa.sources.raw import read_many, union_all
from queixa.sources.sinks import run_etl, write_kpis, write_table
from queixa.sources.star_files import RAW_FILES, has_star, load_cube, read_star

PREVIEW = 50


def _raw(spark: SparkSession, folder: str, account: DropAccount | None = None):
    return read_many(spark, [os.path.join(folder, name) for name in RAW_FILES], account)


def _filters(conditions: Sequence[str]) -> dict[str, list]:
    """`column=a,b` to {column: [a, b]}; calendar columns hold numbers, but for `YYYY-MM`."""
    filters = {}
    for condition in conditions:
        column, _, values = condition.partition("=")
        numeric = column in CALENDAR and column != "ano_mes"
        filters[column] = [int(v) if numeric else v for v in values.split(",")]
    return filters


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="queixa", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    programs = parser.add_subparsers(dest="program", required=True)
    etl = programs.add_parser("etl")
    etl.add_argument("raw")
    etl.add_argument("star")
    kpis = programs.add_parser("kpis")
    kpis.add_argument("star")
    kpis.add_argument("raw")
    kpis.add_argument("out")
    kpis.add_argument("--format", choices=["csv", "parquet"], default="csv")
    verdicts = programs.add_parser("hypotheses")
    verdicts.add_argument("raw")
    verdicts.add_argument("--star")
    report = programs.add_parser("report")
    report.add_argument("star")
    report.add_argument("name", choices=[*REPORTS, "category_drill"])
    report.add_argument("--where", action="append", default=[], metavar="COLUMN=VALUE,...")
    report.add_argument("--out")
    report.add_argument("--format", choices=["csv", "parquet"], default="csv")
    asked = parser.parse_args(arguments)

    spark = build_session()
    if asked.program == "etl":
        account = DropAccount()
        run_etl(_raw(spark, asked.raw, account), asked.star, account)
        for reason, rows in sorted(account.counts().items()):
            print(f"{rows:>12}  {reason}")
    elif asked.program == "kpis":
        write_kpis(load_cube(spark, asked.star, asked.raw, [*CUBE_KEYS, "dia"]), asked.out, asked.format)
    elif asked.program == "hypotheses":
        if asked.star and has_star(spark, asked.star):
            rows = read_star(spark, asked.star).cube(HYPOTHESIS_KEYS)
        else:
            files = _raw(spark, asked.raw)
            size_shuffles(*files)
            rows = clean_light(union_all(files), EXPLORATION_ALIASES)
        hypotheses(rows).show(truncate=False)
    else:
        rows = dataset(read_star(spark, asked.star), asked.name, _filters(asked.where))
        if asked.out:
            write_table(rows, asked.out, asked.name, asked.format)
        else:
            rows.show(PREVIEW, truncate=False)
            print(f"Preview of at most {PREVIEW} rows; --out writes all of them.")


if __name__ == "__main__":
    main()
