"""Grouped time series: ingest, split, features, fit, forecast, score."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.dates import month_number, month_start
from tidewell.functions.text import title_parts
from tidewell.operators.linear import solve_normal_equations
from tidewell.operators.ordered import position, top_n_per_key
from tidewell.operators.reshape import MONTHS, SEASON_COLUMNS, sentinel_to_null, unpivot


def climate_long(wide: DataFrame, value: str = "temperature") -> DataFrame:
    """Wide station table to ``(city, temperature, date)``: one row per month, gaps NULL."""
    slim = wide.drop(*[c for c in SEASON_COLUMNS if c in wide.columns])
    long = unpivot(slim, ["city", "YEAR"], MONTHS, "month", value)
    return long.select(
        title_parts(F.col("city")).alias("city"),
        sentinel_to_null(F.col(value)).alias(value),
        month_start(F.col("YEAR"), month_number(F.col("month"))).alias("date"),
    )


def holdout_split(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Label the last ``n`` rows of each key ``test`` and the others ``train``.

    Rows are counted, not dates, so gaps and NULL values keep their place.  Only
    ``n`` rows per key and task are shuffled to find where the test rows begin;
    the table itself is then labelled in place.
    """
    last = top_n_per_key(df.select(*keys, *order), keys, [F.col(c).desc() for c in order], n)
    first_test = last.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first_test"))
    labelled = df.join(first_test, list(keys))
    is_test = F.struct(*order) >= F.col("_first_test")
    return labelled.select(*df.columns, F.when(is_test, "test").otherwise("train").alias("split"))


def trailing_window(df: DataFrame, date: str, months: int | None) -> DataFrame:
    """Rows later than ``months`` months before the latest date; all rows when ``months`` is None."""
    if months is None:
        return df
    latest = df.agg(F.max(date).alias("latest"))
    return df.where(F.col(date) > F.add_months(latest.scalar(), -months))


def standardise(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Add ``y_mean``, ``y_std`` (population) and ``y_norm`` per key, skipping NULL.

    Aggregate and join back, not a window: partial sums travel instead of rows.
    """
    stats = df.groupBy(*keys).agg(F.avg(value).alias("y_mean"), F.stddev_pop(value).alias("y_std"))
    return df.join(stats, list(keys)).withColumn(
        "y_norm", F.try_divide(F.col(value) - F.col("y_mean"), F.col("y_std"))
    )


def time_index(df: DataFrame, keys: Sequence[str], date: str, name: str = "t") -> DataFrame:
    """0-based position by date per key (a series has one row per date)."""
    out = position(df.withColumn("_d", F.unix_date(date)), ["_d"], keys, name, width=4096)
    return out.drop("_d")


@dataclass(frozen=True)
class TrendSpec:
    """Structural model: smooth trend plus seasonal terms, Gaussian noise.

    The scale parameters are held at the means of their priors: half-normal
    amplitude and error, Gamma(48, 2) length scale.
    """

    n_fourier: int = 10
    period: float = 12.0
    n_basis: int = 10
    boundary: float = 5.0
    amplitude: float = 1.0 * math.sqrt(2.0 / math.pi)
    length_scale: float = 48.0 / 2.0
    error: float = 0.2 * math.sqrt(2.0 / math.pi)
    beta_sd: float = 0.5

    @property
    def size(self) -> int:
        return self.n_basis + 2 * self.n_fourier


def trend_basis(t: Column, lo: Column, hi: Column, spec: TrendSpec = TrendSpec()) -> Column:
    """Array of sine basis values on ``[mid - L, mid + L]`` with ``L = boundary * half range``."""
    mid = (lo + hi) / F.lit(2.0)
    length = F.lit(spec.boundary) * (hi - lo) / F.lit(2.0)
    return F.transform(
        F.sequence(F.lit(1), F.lit(spec.n_basis)),
        lambda j: F.sqrt(F.lit(1.0) / length) * F.sin(F.lit(math.pi) * j * (t - mid + length) / (F.lit(2.0) * length)),
    )


def basis_variance(lo: Column, hi: Column, spec: TrendSpec = TrendSpec()) -> Column:
    """Array of prior variances of the basis weights: the squared-exponential spectral density."""
    length = F.lit(spec.boundary) * (hi - lo) / F.lit(2.0)
    top = spec.amplitude * math.sqrt(2.0 * math.pi) * spec.length_scale

    def density(j: Column) -> Column:
        w = F.lit(math.pi) * j / (F.lit(2.0) * length)
        return F.lit(top) * F.exp(F.lit(-0.5) * F.pow(F.lit(spec.length_scale) * w, F.lit(2.0)))

    return F.transform(F.sequence(F.lit(1), F.lit(spec.n_basis)), density)


def season_terms(t: Column, spec: TrendSpec = TrendSpec()) -> Column:
    """Array ``sin_1, cos_1, sin_2, ...``."""
    angle = F.lit(2.0 * math.pi) * t.cast("double") / F.lit(spec.period)
    return F.flatten(
        F.transform(F.sequence(F.lit(1), F.lit(spec.n_fourier)), lambda k: F.array(F.sin(angle * k), F.cos(angle * k)))
    )


def design_row(t: Column, lo: Column, hi: Column, spec: TrendSpec = TrendSpec()) -> Column:
    """All model terms at time ``t`` as one array: trend basis, then seasonal terms."""
    return F.concat(trend_basis(t, lo, hi, spec), season_terms(t, spec))


def fit_models(train: DataFrame, keys: Sequence[str], date: str, value: str, spec: TrendSpec = TrendSpec()) -> DataFrame:
    """One model per key: posterior mean and covariance factor of its weights.

    Sufficient statistics are summed where the rows are, so the size of a series
    does not matter; only the small solve happens per key.  A key that cannot be
    solved keeps its row, with the reason in ``error``.
    """
    keys = list(keys)
    bounds = train.groupBy(*keys).agg(
        F.lit(0.0).alias("t_lo"),
        (F.count(F.lit(1)) - 1).cast("double").alias("t_hi"),
        F.max(date).alias("last_date"),
        F.avg(value).alias("y_mean"),
        F.stddev_pop(value).alias("y_std"),
    )
    # a series that never varies, or has one row, has no scale or span to fit
    fittable = bounds.where((F.col("t_hi") > F.col("t_lo")) & (F.col("y_std") > 0))
    rows = (
        time_index(train.select(*keys, date, value), keys, date, "t")
        .where(F.col(value).isNotNull())
        .join(fittable, keys)
        .select(
            *keys,
            design_row(F.col("t"), F.col("t_lo"), F.col("t_hi"), spec).alias("x"),
            ((F.col(value) - F.col("y_mean")) / F.col("y_std")).alias("y"),
        )
    )
    prior = fittable.select(
        *keys,
        F.concat(
            basis_variance(F.col("t_lo"), F.col("t_hi"), spec),
            F.array_repeat(F.lit(spec.beta_sd**2), 2 * spec.n_fourier),
        ).alias("prior_var"),
    )
    solved = solve_normal_equations(rows, keys, spec.size, prior, noise_var=spec.error**2)
    return bounds.join(solved, keys, "left").withColumn(
        "error", F.when(F.col("mean").isNull() & F.col("error").isNull(), "too few different values").otherwise(F.col("error"))
    )


def draw_values(rng: np.random.Generator, n: int, mean: np.ndarray, factor: np.ndarray, terms: np.ndarray, error: float) -> np.ndarray:
    """``n`` predictive draws (rows) for every row of ``terms``: weights first, then noise."""
    weights = mean + rng.standard_normal((n, len(mean))) @ factor.T
    mu = weights @ terms.T
    return mu + error * rng.standard_normal(mu.shape)


def forecast_draws(
    models: DataFrame,
    keys: Sequence[str],
    n_ahead: int,
    n_draws: int,
    spec: TrendSpec = TrendSpec(),
    start_after_last: bool = False,
    seed: int = 42,
) -> DataFrame:
    """Posterior predictive draws in normalised units: ``n_draws`` rows per key and step ahead.

    The first forecast index is the last training index; ``start_after_last``
    moves it one on.  The generator of every thousand draws is seeded by key and
    chunk, so any task can redo its rows and many draws of one key spread out.
    """
    keys = list(keys)
    p, chunk = spec.size, 1000
    shift = F.lit(1.0 if start_after_last else 0.0)
    terms = F.transform(
        F.sequence(F.lit(0), F.lit(n_ahead - 1)),
        lambda h: design_row(F.col("t_hi") + h + shift, F.col("t_lo"), F.col("t_hi"), spec),
    )
    work = models.where(F.col("mean").isNotNull()).select(
        *keys, "mean", "factor", "y_mean", "y_std", "last_date",
        F.flatten(terms).alias("terms"),
        F.pmod(F.xxhash64(*keys), F.lit(2**31)).alias("key_hash"),
        F.explode(F.sequence(F.lit(0), F.lit((n_draws - 1) // chunk))).alias("chunk"),
    )
    fields = [work.schema[c] for c in [*keys, "y_mean", "y_std", "last_date"]]
    schema = T.StructType(
        [*fields, T.StructField("draw", T.IntegerType()), T.StructField("obs_id", T.IntegerType()), T.StructField("value", T.DoubleType())]
    )
    error = spec.error

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                m = min(chunk, n_draws - row.chunk * chunk)
                rng = np.random.default_rng([seed, row.key_hash, row.chunk])
                terms = np.asarray(row.terms).reshape(n_ahead, p)
                value = draw_values(rng, m, np.asarray(row.mean), np.asarray(row.factor).reshape(p, p), terms, error)
                out = pd.DataFrame({f.name: [getattr(row, f.name)] * value.size for f in fields})
                out["draw"] = np.repeat(np.arange(m, dtype=np.int32) + row.chunk * chunk, n_ahead)
                out["obs_id"] = np.tile(np.arange(n_ahead, dtype=np.int32), m)
                out["value"] = value.ravel()
                yield out

    drawn = work.mapInPandas(draw, schema)
    return drawn.select(*keys, "draw", "obs_id", "value", "y_mean", "y_std", "last_date")


def back_transform(draws: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean forecast per key and step in original units."""
    return draws.groupBy(*keys, "obs_id").agg(
        (F.avg("value") * F.first("y_std") + F.first("y_mean")).alias("forecast")
    )


def rmse(truth: Column, predicted: Column) -> Column:
    """Root mean squared error; rows with either side missing are skipped."""
    return F.sqrt(F.avg(F.pow(truth - predicted, F.lit(2.0))))


def coverage(truth: Column, low: Column, high: Column) -> Column:
    """Share of known truths inside ``[low, high]``."""
    inside = F.when((truth >= low) & (truth <= high), 1.0).otherwise(0.0)
    return F.avg(F.when(truth.isNotNull(), inside))


def predict_service(draws: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One JSON record per key and step: what a prediction endpoint would return."""
    mean = back_transform(draws, keys)
    return mean.select(*keys, "obs_id", F.to_json(F.struct("obs_id", F.round("forecast", 6).alias("forecast"))).alias("record"))
