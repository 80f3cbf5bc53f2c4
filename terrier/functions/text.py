"""Tolerant parsing of source text: a bad value becomes NULL, never an error."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrier.functions.numeric import as_column

NO_BREAK_SPACE = " "

# Prefixes of the overseas codes, whose department has 3 letters.
OVERSEAS_PREFIXES = ("97", "98")

QUARTER = r"^\s*(\d+)-T(\d+)\s*$"


def to_date_or_null(c: Column | str, *formats: str) -> Column:
    """ISO date (with or without a time), then each of ``formats``."""
    text = as_column(c).cast("string")
    tries = [text.try_cast("date")]
    tries += [F.try_to_date(text, fmt) for fmt in formats]
    return F.coalesce(*tries) if len(tries) > 1 else tries[0]


def to_double_or_null(c: Column | str) -> Column:
    """Number or NULL; a NaN spelled out counts as missing.

    The cast also takes Java suffixes ('12d', '12f'), which are not numbers here.
    """
    text = F.trim(as_column(c).cast("string"))
    number = F.when(~F.lower(F.right(text, F.lit(1))).isin("d", "f"), text.try_cast("double"))
    return F.nullif(number, F.lit(float("nan")))


def to_int_or_null(c: Column | str) -> Column:
    """Whole number or NULL; '3.0' is 3."""
    return to_double_or_null(c).try_cast("int")


def comma_number(c: Column | str) -> Column:
    """Number with a decimal comma."""
    return to_double_or_null(F.translate(as_column(c).cast("string"), ",", "."))


def fr_number(c: Column | str) -> Column:
    """Number with a decimal comma and blanks between the thousands."""
    return to_double_or_null(F.translate(as_column(c).cast("string"), f",{NO_BREAK_SPACE} ", "."))


def blank_null(c: Column | str) -> Column:
    """NULL text becomes ''."""
    return F.coalesce(as_column(c).cast("string"), F.lit(""))


def null_blank(c: Column | str) -> Column:
    """'' becomes NULL."""
    return F.nullif(as_column(c), F.lit(""))


def dept_from_commune(c: Column | str) -> Column:
    """Department of a commune: 3 letters overseas, else 2; '' stays ''."""
    code = as_column(c)
    return F.when(
        F.substring(code, 1, 2).isin(*OVERSEAS_PREFIXES), F.substring(code, 1, 3)
    ).otherwise(F.substring(code, 1, 2))


def split_quarter(c: Column | str) -> tuple[Column, Column]:
    """'2024-T3' gives 2024 and 3; anything else gives NULLs."""
    text = as_column(c)
    return (
        F.regexp_extract(text, QUARTER, 1).try_cast("int"),
        F.regexp_extract(text, QUARTER, 2).try_cast("int"),
    )


def quarter_label(year: Column | str, quarter: Column | str) -> Column:
    return F.concat(as_column(year).cast("string"), F.lit("-T"), as_column(quarter).cast("string"))


def label_of(c: Column | str, labels: dict[str, str]) -> Column:
    """Text for a code; the code itself when it has none."""
    code = as_column(c)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.coalesce(F.try_element_at(table, code), code)
