"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``sql`` computes the same rows elsewhere."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    Later reads survive lost executors and compute nothing again.  The files stay
    as long as the shared folder: the frames that callers get still read them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of a text; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def utf8_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as the empty text."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
