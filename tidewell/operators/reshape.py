"""Reshaping: unpivot, pivot, grids, lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month column names, in calendar order, and the other columns of a station file.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
SEASON_COLUMNS = ["D-J-F", "M-A-M", "J-J-A", "S-O-N", "metANN"]
MISSING = 999.9


def sentinel_to_null(x: Column, sentinel: float = MISSING) -> Column:
    """The sentinel and NaN become NULL (averages skip NULL but not NaN)."""
    return F.when(x.isNull() | F.isnan(x) | (x == F.lit(sentinel)), F.lit(None)).otherwise(x)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def pivot_first(df: DataFrame, ids: Sequence[str], name: str, values: Sequence, value: str) -> DataFrame:
    """Wide form with one column per listed value; the list makes it one pass and fixes the schema."""
    return df.groupBy(*ids).pivot(name, list(values)).agg(F.first(value))


def complete_grid(df: DataFrame, step: str, area: str, value: str) -> DataFrame:
    """Every step in [min, max] for every area, gaps NULL.

    Only the distinct areas are multiplied by the steps, each area generating its
    own rows.
    """
    bounds = df.agg(F.min(step).alias("lo"), F.max(step).alias("hi")).select(F.struct("lo", "hi").alias("b"))
    areas = df.select(area).distinct()
    grid = areas.withColumn("_b", bounds.scalar()).select(
        area, F.explode(F.sequence(F.col("_b.lo"), F.col("_b.hi"))).alias(step)
    )
    return grid.join(df.select(area, step, value), [area, step], "left")


def replace_strict(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, lookup_value: str, out: str) -> DataFrame:
    """Dictionary replacement: keys that are not in the dictionary become NULL.

    No broadcast hint: Spark broadcasts the dictionary by its measured size.
    """
    d = lookup.select(F.col(lookup_key).alias("_k"), F.col(lookup_value).alias(out))
    return df.join(d, df[key] == F.col("_k"), "left").drop("_k")


def dense_index(df: DataFrame, col: str, name: str, first: int = 1) -> DataFrame:
    """Rank of each distinct value, counting from ``first``, joined back to the rows."""
    from tidewell.operators.ordered import sorted_index

    ranks = sorted_index(df.select(col).distinct(), col, "_rank").select(
        col, (F.col("_rank") + first).cast("int").alias(name)
    )
    return df.join(ranks, col)
