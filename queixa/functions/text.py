"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters that count as blank in single-byte text.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"


def strip(c: Column) -> Column:
    """Remove blanks, tabs, line ends and no-break spaces at both ends."""
    return F.btrim(c, F.lit(BLANKS))


# A code point that is never a character; it marks blanks put in for a moment.
MARK = "\uffff"


def title_case(c: Column) -> Column:
    """Upper-case the first letter after anything that is not a letter.

    `initcap` only restarts after a blank, so a marked blank is put before each letter that
    follows something else, and taken out again.
    """
    parted = F.regexp_replace(c, r"([^\p{L} ])(?=\p{L})", f"$1{MARK} ")
    return F.replace(F.initcap(parted), F.lit(f"{MARK} "), F.lit(""))


def contains_ignoring_case(c: Column, needle: str) -> Column:
    """True when `needle` occurs in the cell; a missing cell is false."""
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def _first_alias(name: Column, aliases: Sequence[tuple[str, str]], otherwise: Column) -> Column:
    choice = None
    for fragment, brand in aliases:
        hit = name.contains(fragment)
        choice = F.when(hit, F.lit(brand)) if choice is None else choice.when(hit, F.lit(brand))
    return otherwise if choice is None else choice.otherwise(otherwise)


def filed_name(c: Column) -> Column:
    """An operator's name as the alias rules read it. Make it a column of its own first:
    every rule looks at it again."""
    return strip(F.upper(c))


def brand_or_first_word(
    name: Column, aliases: Sequence[tuple[str, str]], unidentified: str
) -> Column:
    """First alias contained in the filed name, else its first word, else `unidentified`."""
    brand = _first_alias(name, aliases, F.split(name, f"[{BLANKS}]+", 2)[0])
    return F.when(name.isNull() | (name == ""), F.lit(unidentified)).otherwise(brand)


def brand_or_catch_all(name: Column, aliases: Sequence[tuple[str, str]], catch_all: str) -> Column:
    """First alias contained in the filed name, else `catch_all`."""
    return F.when(name.isNull(), F.lit(catch_all)).otherwise(
        _first_alias(name, aliases, F.lit(catch_all))
    )
