"""From raw string rows to typed, labelled complaint rows.

Everything up to the duplicate removal is one narrow stage. Exact duplicates are
removed by a grouping on all columns, which collapses copies before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queixa.fixed_values import (
    BROAD_ALIASES, CATCH_ALL, FIXED_SERVICE, IMPLICIT_NULLS, NOT_INFORMED, OTHER_REGION, PENDING,
    READER_NULLS, STATES, STRICT_ALIASES, UNIDENTIFIED, UNKNOWN_STATE,
)
from queixa.functions.dates import FIRST_YEAR, LAST_YEAR, parse_day, with_time_columns
from queixa.functions.text import (
    brand_or_catch_all, brand_or_first_word, filed_name, strip, title_case,
)
from queixa.sources.account import DropAccount
from queixa.sources.raw import canonical_columns, union_all


def null_implicit(df: DataFrame, tokens: Sequence[str] = tuple(IMPLICIT_NULLS)) -> DataFrame:
    """Exact, untrimmed cells that mean "nothing" become NULL in every string column."""
    missing = sorted({*tokens, *READER_NULLS})
    return df.select([
        F.when(~F.col(f.name).isin(missing), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema
    ])


def drop_bad_days(df: DataFrame, column: str, trim: bool = True, account: DropAccount | None = None) -> DataFrame:
    """Parse the day and drop rows without a valid one; an account tells missing, far and impossible days apart."""
    if account is not None:
        text = F.coalesce(strip(F.col(column)) if trim else F.col(column), F.lit(""))
        missing, parsed = text.isin(["", *IMPLICIT_NULLS]), parse_day(F.col(column), trim)
        # a day that only its year keeps out
        far = parse_day(F.regexp_replace(text, r"/\d{4}$", "/2000")).isNotNull() & text.rlike(r"/\d{4}$") & ~text.rlike(
            "^29/0?2/") & ~F.substring(text, -4, 4).between(FIRST_YEAR, LAST_YEAR)
        df = account.watch(df, {"dia ausente": missing, "dia fora do calendário": ~missing & parsed.isNull() & far,
                                "dia impossível": ~missing & parsed.isNull() & ~far})
    return df.withColumn(column, parse_day(F.col(column), trim)).where(F.col(column).isNotNull())


def label(stripped: Column, default: str) -> Column:
    """Title-cased, with a default for missing cells."""
    return F.coalesce(title_case(stripped), F.lit(default))


def code(c: Column, default: str) -> Column:
    """Trimmed, upper-cased, with a default for missing cells."""
    return F.coalesce(F.upper(strip(c)), F.lit(default))


def clean(
    raw: DataFrame,
    aliases: Sequence[tuple[str, str]] = tuple(STRICT_ALIASES),
    unidentified: str = UNIDENTIFIED,
    account: DropAccount | None = None,
) -> DataFrame:
    """One raw file to clean rows; exact duplicates within the file go.

    The brand follows from the name as filed, so it is read off the rows that are left."""
    # Days first: a token that means "nothing" is not a day either, and fewer rows go on.
    df = null_implicit(drop_bad_days(canonical_columns(raw), "data_abertura", account=account))
    labels = ("status", "motivo", "detalhe_motivo")
    labelled = df.withColumns({c: strip(F.col(c)) for c in labels}).withColumns({
        **{c: label(F.col(c), NOT_INFORMED) for c in labels}, "uf_sigla": code(F.col("uf_sigla"), UNKNOWN_STATE)})
    copies = {"cópia exata": F.lit(True)}
    kept = (account.watch(labelled, copies) if account is not None else labelled).dropDuplicates()
    kept = account.watch(kept, copies, sign=-1) if account is not None else kept
    return kept.withColumn("operadora", filed_name(F.col("operadora_raw"))).withColumn(
        "operadora", brand_or_first_word(F.col("operadora"), aliases, unidentified))


def clean_files(
    files: Sequence[DataFrame],
    aliases: Sequence[tuple[str, str]] = tuple(STRICT_ALIASES),
    unidentified: str = UNIDENTIFIED,
    account: DropAccount | None = None,
) -> DataFrame:
    """Clean each file on its own, then put them together: equal rows of two files both stay."""
    return union_all([clean(raw, aliases, unidentified, account) for raw in files])


def region_of_state(c: Column, states: Sequence[tuple] = tuple(STATES)) -> Column:
    """Macro-region of a state code, "Outros" for any other code."""
    pairs = [F.lit(v) for _, sigla, _, region in states for v in (sigla, region)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(OTHER_REGION))


def clean_light(
    raw: DataFrame,
    aliases: Sequence[tuple[str, str]] = tuple(BROAD_ALIASES),
    catch_all: str = CATCH_ALL,
    defaults: Mapping[str, str] | None = None,
) -> DataFrame:
    """The lighter cleaning used when no star schema is stored: no duplicate removal,
    looser brand matching, columns that a file lacks are tolerated."""
    defaults = {"motivo": "Outros", "status": PENDING, "uf": UNKNOWN_STATE,
                "servico": FIXED_SERVICE, **(defaults or {})}
    df = raw.toDF(*[c.strip() for c in raw.columns])
    df = drop_bad_days(df, "Data_Abertura", trim=False)
    df = null_implicit(df, [t for t in IMPLICIT_NULLS if t != "NA"])

    def cell(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    rows = df.withColumn("_nome", filed_name(cell("Nome"))).select(
        F.col("Data_Abertura").alias("dia"),
        brand_or_catch_all(F.col("_nome"), aliases, catch_all).alias("operadora"),
        title_case(strip(F.coalesce(cell("Motivo"), F.lit(defaults["motivo"])))).alias("categoria"),
        cell("Detalhe_Motivo").alias("subcategoria"),
        strip(F.coalesce(cell("Status"), F.lit(defaults["status"]))).alias("status"),
        code(cell("UF"), defaults["uf"]).alias("uf"),
        code(cell("Agrupamento"), defaults["servico"]).alias("servico"),
        F.lit(1).alias("qtd"),
    )
    return with_time_columns(rows.withColumn("regiao", region_of_state(F.col("uf"))))
