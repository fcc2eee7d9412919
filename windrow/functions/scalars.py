"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_commas(line: Column | str, first: int | None = None) -> Column:
    """Cut at every comma; trailing empty fields are dropped, quotes mean nothing.

    A line of commas only has no field at all; an empty line has one empty field.
    With ``first`` only that many fields are cut, and what is left of the line
    stays together as one more; use it where later fields are not needed.
    """
    line = _col(line)
    trimmed = F.rtrim(line, F.lit(","))
    only_commas = (trimmed == "") & (line != "")
    limit = -1 if first is None else first + 1
    return F.when(only_commas, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, ",", limit)
    )


def field(cols: Column | str, position: int) -> Column:
    """Field at a position; a row that is too short fails the job, with or without ANSI."""
    missing = F.raise_error(F.lit(f"row without a field at position {position}")).cast("string")
    return F.coalesce(F.get(_col(cols), position), missing)


def to_int(text: Column | str) -> Column:
    """Strict text to int: an optional sign and digits only, null for anything else."""
    text = _col(text)
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def equals_ignore_case(a: Column | str, literal: str) -> Column:
    a = _col(a)
    if literal.lower() == literal.upper():
        return a == literal
    return F.lower(a) == literal.lower()


def pad_number(number: Column, digits: int) -> Column:
    """Zero-pad to a minimum width; wider numbers are kept whole."""
    text = number.cast("string")
    return F.when(F.length(text) < digits, F.lpad(text, digits, "0")).otherwise(text)
