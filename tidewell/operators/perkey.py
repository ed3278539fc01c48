"""One Python function per key."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def run_per_key(df: DataFrame, key: str, work: Callable[[object, pd.DataFrame], dict], result: str) -> DataFrame:
    """(key, result columns, error): ``work(key, rows)`` once per key.

    Keys run in parallel and a failing key becomes a row with ``error`` set, so the
    others are kept.  A key's rows must fit one task: aggregate before calling this,
    or use ``operators.linear.grouped_gram`` for sums over series of any length.
    """
    fields = T.StructType.fromDDL(result).fields if hasattr(T.StructType, "fromDDL") else _fields(df, result)
    schema = T.StructType([df.schema[key], *fields, T.StructField("error", T.StringType())])
    names = [f.name for f in fields]

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        value = rows[key].iloc[0]
        try:
            out = work(value, rows)
            return pd.DataFrame([{key: value, **{n: out.get(n) for n in names}, "error": None}])
        except Exception as e:  # noqa: BLE001 - the reason is part of the result
            return pd.DataFrame([{key: value, **{n: None for n in names}, "error": f"{type(e).__name__}: {e}"}])

    return df.groupBy(key).applyInPandas(task, schema)


def _fields(df: DataFrame, ddl: str) -> list[T.StructField]:
    return df.sparkSession.createDataFrame([], ddl).schema.fields
