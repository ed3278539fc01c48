"""Stores for fitted models, forecasts and run metrics: partitioned parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyedStore:
    """One parquet partition per key.

    ``save`` replaces only the partitions it has rows for; ``load`` with keys reads
    only their folders.
    """

    def __init__(self, path: str, key: str):
        self.path, self.key = path, key

    def save(self, df: DataFrame) -> None:
        # several keys share a file writer per task: cluster by key so that a key has few files
        spread = df.repartition(F.col(self.key))
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.key).parquet(self.path)

    def load(self, spark: SparkSession, keys: Sequence[str] | None = None) -> DataFrame:
        df = spark.read.option("basePath", self.path).parquet(self.path)
        df = df.withColumn(self.key, F.col(self.key).cast("string"))
        return df if keys is None else df.where(F.col(self.key).isin(*keys))


class ForecastStore(KeyedStore):
    """(key, chain, draw, obs_id, value); a long series of draws is split over several files."""

    def __init__(self, path: str, key: str = "city", rows_per_file: int = 5_000_000, spread: int = 16):
        super().__init__(path, key)
        self.rows_per_file, self.spread = rows_per_file, spread

    def save(self, df: DataFrame) -> None:
        salted = df.repartition(F.col(self.key), F.pmod(F.xxhash64("draw"), F.lit(self.spread)))
        w = salted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        w.option("maxRecordsPerFile", self.rows_per_file).partitionBy(self.key).parquet(self.path)


class RunLog:
    """Append-only rows (run_id, parent_run_id, city, kind, key, value)."""

    COLUMNS = ["run_id", "parent_run_id", "city", "kind", "key", "value"]

    def __init__(self, path: str):
        self.path = path

    def append_metrics(self, df: DataFrame, run_id: str, city: str, metrics: Sequence[str], kind: str = "metric") -> None:
        """Each metric column of a per-city table becomes one row per city, under a child run."""
        texts = df.select(F.col(city).alias("city"), *[F.col(m).cast("string").alias(m) for m in metrics])
        long = texts.unpivot(["city"], list(metrics), "key", "value")
        self._append(
            long.select(
                F.concat(F.lit(f"{run_id}/"), "city").alias("run_id"), F.lit(run_id).alias("parent_run_id"), "city",
                F.lit(kind).alias("kind"), "key", "value",
            )
        )

    def append_parameters(self, spark: SparkSession, run_id: str, parameters: dict, kind: str = "parameter") -> None:
        rows = [(run_id, None, None, kind, k, str(v)) for k, v in parameters.items()]
        self._append(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in self.COLUMNS)))

    def _append(self, df: DataFrame) -> None:
        df.select(*self.COLUMNS).write.mode("append").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)
