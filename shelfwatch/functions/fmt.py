"""Display formatting scalars (X8-X11). Inputs are already rounded to cents, so
``format_string('%.2f')`` never has to break a tie and agrees with Python's formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: Column | str) -> Column:
    """'£%.2f' (format_string needs a double, not a decimal)."""
    return F.format_string("£%.2f", _c(col).cast("double"))


def money_drop(col: Column | str) -> Column:
    """'-£%.2f' of the absolute change."""
    return F.format_string("-£%.2f", F.abs(_c(col).cast("double")))


def money_gain(col: Column | str) -> Column:
    """'+£%.2f'."""
    return F.format_string("+£%.2f", _c(col).cast("double"))


def money_signed(col: Column | str) -> Column:
    """'£%.2f' keeping the sign inside (report style: '£-5.78')."""
    return F.format_string("£%.2f", _c(col).cast("double"))


def percent(col: Column | str) -> Column:
    """'%.2f%%'."""
    return F.format_string("%.2f%%", _c(col).cast("double"))


def percent_gain(col: Column | str) -> Column:
    """'+%.2f%%'."""
    return F.format_string("+%.2f%%", _c(col).cast("double"))


def thousands(col: Column | str) -> Column:
    """Integer with thousands separators ('1,234')."""
    return F.format_number(_c(col), 0)


def star_bar(col: Column | str, per_star: int = 10) -> Column:
    """One '*' per ``per_star`` units, truncated."""
    return F.repeat(F.lit("*"), F.floor(_c(col) / per_star).cast("int"))


def right_align(col: Column | str, width: int = 3) -> Column:
    """X11: integer right-aligned to ``width`` (wider values are not cut)."""
    return F.format_string(f"%{width}d", _c(col))


def plain_number(col: Column | str) -> Column:
    """Shortest decimal text of a double ('4.65', '5.0'), as printed by str(float)."""
    return _c(col).cast("double").cast("string")
