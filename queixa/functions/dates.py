"""Date expressions and the month index (`year * 12 + month`)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from queixa.fixed_values import DAY_NAMES, MONTH_ABBREVIATIONS, MONTH_NAMES
from queixa.functions.text import strip


# Years a nanosecond timestamp covers in full; they also bound the calendar.
FIRST_YEAR, LAST_YEAR = "1678", "2261"


def parse_day(c: Column, trim: bool = True) -> Column:
    """`DD/MM/YYYY` (one or two digits for day and month) to a date, NULL for anything that
    is not a real day in range.

    The parts are turned round and cast, which is much cheaper than a pattern parser. The
    cast refuses days that do not exist; the tests before it refuse other notations.
    """
    text = strip(c) if trim else c
    only_digits = F.translate(text, "0123456789", "") == "//"
    four_digit_year = F.substring(text, -5, 1) == "/"
    in_range = F.substring(text, -4, 4).between(FIRST_YEAR, LAST_YEAR)
    day_and_month = F.substring_index(text, "/", 2)
    year_first = F.concat_ws(
        "-", F.substring(text, -4, 4), F.substring_index(day_and_month, "/", -1),
        F.substring_index(day_and_month, "/", 1))
    return F.when(only_digits & four_digit_year & in_range, year_first.try_cast("date"))


def _pick(names: list[str], one_based: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), one_based)


def month_name(month: Column) -> Column:
    return _pick(MONTH_NAMES, month)


def day_name(monday_zero: Column) -> Column:
    return _pick(DAY_NAMES, monday_zero + 1)


def month_index(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def index_year(index: Column) -> Column:
    return F.floor((index - 1) / 12).cast("int")


def index_month(index: Column) -> Column:
    return ((index - 1) % 12 + 1).cast("int")


def index_quarter(index: Column) -> Column:
    return F.floor((index_month(index) + 2) / 3).cast("int")


def index_text(index: Column) -> Column:
    """`2023-01`."""
    return F.format_string("%04d-%02d", index_year(index), index_month(index))


def index_label(index: Column) -> Column:
    """`jan/23`, free of the session locale."""
    return F.concat(
        _pick(MONTH_ABBREVIATIONS, index_month(index)),
        F.format_string("/%02d", index_year(index) % 100),
    )


TIME_COLUMNS = {
    "ano": lambda day: F.year(day),
    "trimestre": lambda day: F.quarter(day),
    "mes": lambda day: F.month(day),
    "mes_idx": month_index,
    "ano_mes": lambda day: F.date_format(day, "yyyy-MM"),
    "ano_mes_num": lambda day: F.year(day) * 100 + F.month(day),
}


def with_time_columns(df, day: str = "dia"):
    """Year, quarter, month and `YYYY-MM` of a day column."""
    wanted = ["ano", "mes", "ano_mes", "trimestre"]
    return df.withColumns({name: TIME_COLUMNS[name](F.col(day)) for name in wanted})
