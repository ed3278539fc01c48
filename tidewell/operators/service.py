"""Fitted models as a package that is saved, loaded and asked for forecasts, also from SQL."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.series import TrendSpec, draw_values

#: Draws made at once; ``forecast_draws`` seeds its generators by the same portions.
PORTION = 1000


def design_matrix(t: np.ndarray, lo: float, hi: float, spec: TrendSpec) -> np.ndarray:
    """The terms of ``series.design_row`` for many times, a row per time."""
    mid, length = (lo + hi) / 2, spec.boundary * (hi - lo) / 2
    j = np.arange(1, spec.n_basis + 1)
    trend = np.sqrt(1 / length) * np.sin(np.pi * j * (t[:, None] - mid + length) / (2 * length))
    angle = 2 * np.pi * t[:, None] / spec.period * np.arange(1, spec.n_fourier + 1)
    return np.hstack([trend, np.stack([np.sin(angle), np.cos(angle)], axis=2).reshape(len(t), -1)])


@dataclass
class ForecastPackage:
    """A row per key from ``series.fit_models``, with what is needed to draw from it.

    ``register`` makes the package a table function of the session; then

        SELECT * FROM name(TABLE(name_models) PARTITION BY key, n_ahead => 12)

    gives (key, obs_id, forecast), the means that ``series.back_transform`` finds in the
    draws of ``series.forecast_draws``.  Keys spread over the tasks, any number of keys
    shares one; a task holds ``PORTION`` draws of one key.  A key without a model gives no
    rows, ``n_ahead`` of null or below one gives none at all.
    """

    models: DataFrame
    key: str
    spec: TrendSpec = TrendSpec()
    n_draws: int = 4000
    start_after_last: bool = False
    seed: int = 42

    def save(self, path: str) -> None:
        """Write models and settings below ``path``; what was there is replaced."""
        settings = {"key": self.key, "n_draws": self.n_draws, "start_after_last": self.start_after_last, "seed": self.seed, **asdict(self.spec)}
        spark = self.models.sparkSession
        self.models.write.mode("overwrite").parquet(f"{path}/models")
        spark.createDataFrame([Row(**settings)]).coalesce(1).write.mode("overwrite").json(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForecastPackage:
        settings = spark.read.json(f"{path}/settings").first().asDict()
        own = {k: settings.pop(k) for k in ("key", "n_draws", "start_after_last", "seed")}
        return cls(models=spark.read.parquet(f"{path}/models"), spec=TrendSpec(**settings), **own)

    def register(self, name: str) -> None:
        """Make the function ``name`` and the view ``name_models`` known to SQL."""
        spark = self.models.sparkSession
        fitted = self.models.where(F.col("mean").isNotNull()).select(
            self.key, "mean", "factor", "t_lo", "t_hi", "y_mean", "y_std", F.pmod(F.xxhash64(self.key), F.lit(2**31)).alias("key_hash")
        )
        fitted.createOrReplaceTempView(f"{name}_models")
        key, spec, n_draws, seed = self.key, self.spec, self.n_draws, self.seed
        shift = 1.0 if self.start_after_last else 0.0

        class Forecast:
            def eval(self, model: Row, n_ahead: int) -> Iterator[tuple]:
                if n_ahead is None or n_ahead < 1:
                    return
                times = model["t_hi"] + np.arange(n_ahead) + shift
                terms = design_matrix(times, model["t_lo"], model["t_hi"], spec)
                mean, factor = np.asarray(model["mean"]), np.asarray(model["factor"]).reshape(spec.size, spec.size)
                total = np.zeros(n_ahead)
                for portion, done in enumerate(range(0, n_draws, PORTION)):
                    rng = np.random.default_rng([seed, model["key_hash"], portion])
                    total += draw_values(rng, min(PORTION, n_draws - done), mean, factor, terms, spec.error).sum(axis=0)
                for step, value in enumerate(total / n_draws * model["y_std"] + model["y_mean"]):
                    yield model[key], step, float(value)

        kind = self.models.schema[key].dataType.simpleString()
        spark.udtf.register(name, F.udtf(Forecast, returnType=f"`{key}` {kind}, obs_id int, forecast double"))

    def predict(self, n_ahead: int, name: str = "forecast_package") -> DataFrame:
        """(key, obs_id, record): JSON records as ``series.predict_service`` gives them, through SQL."""
        self.register(name)
        return self.models.sparkSession.sql(
            f"""SELECT `{self.key}`, obs_id, to_json(named_struct('obs_id', obs_id, 'forecast', round(forecast, 6))) AS record
                FROM {name}(TABLE({name}_models) PARTITION BY `{self.key}`, n_ahead => {int(n_ahead)})"""
        )
