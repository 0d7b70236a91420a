"""Numbers as text. Values are rounded before printing, half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_text(c: Column | str) -> Column:
    """Whole number with thousands separators."""
    return F.format_string("%,d", _column(c).cast("long"))


def money(c: Column | str) -> Column:
    """Number rounded to a whole one, with thousands separators."""
    return F.format_string("%,d", F.round(_column(c).cast("double"), 0).cast("long"))


def fixed_text(c: Column | str, digits: int) -> Column:
    """Number with a fixed number of decimals."""
    return F.format_string(f"%.{digits}f", F.round(_column(c).cast("double"), digits))


def percent_text(c: Column | str, digits: int = 1) -> Column:
    """Percentage with its sign."""
    return F.concat(fixed_text(c, digits), F.lit("%"))
