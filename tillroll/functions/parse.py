"""Text to date and number. Cells that do not parse become NULL, never an error.

Filters on parsed columns are pushed down to the scan and repeat the parsing
expression there. Each parser therefore starts from the raw cell and uses no regular
expressions, instead of building on other steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import tidied


def _date_as(text: Column, date_format: str) -> Column:
    """Date in one format. A cell without the format's slashes and dashes is not tried.

    A failed try costs two exceptions, many times a successful one, and in a column
    of mixed formats most cells would fail at least once.
    """
    tried = F.try_to_date(text, date_format)
    plain = not set(date_format) & set("[]{}#'")
    marks = [m for m in "/-" if plain and m in date_format]
    if not marks:
        return tried
    return F.when(reduce(Column.__and__, (text.contains(m) for m in marks)), tried)


def parsed_date(cell: Column, formats: Sequence[str]) -> Column:
    """Date by the first of the formats that reads the whole cell; does not depend on other rows."""
    text = tidied(cell, [""])
    return F.coalesce(*(_date_as(text, f) for f in formats))


def parsed_number(cell: Column) -> Column:
    """Finite double in plain or scientific notation.

    A cast alone would also accept a type suffix (``12d``), hexadecimal digits
    (``0x1p3``), ``nan`` (greater than anything in Spark) and ``inf``.
    """
    value = cell.try_cast("double")
    finite = F.abs(value) < F.lit(float("inf"))
    # A finite number holds these letters only as a suffix or in hexadecimal notation.
    lettered = reduce(Column.__or__, (cell.contains(c) for c in "dDfFxX"))
    return F.when(finite & ~lettered, value)
