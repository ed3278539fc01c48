"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_number(name: Column) -> Column:
    """``JAN`` or ``Jan`` to 1."""
    return F.month(F.to_date(F.initcap(name), "MMM"))


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def iso_text_to_date(text: Column) -> Column:
    """``2025-01-04T00:00:00.000`` to a date."""
    return F.to_date(text, "yyyy-MM-dd'T'HH:mm:ss.SSS")
