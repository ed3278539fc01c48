"""Expected counts, incidence ratios and risk summaries by area and week."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.hashing import normal
from tidewell.operators.reshape import dense_index


def keep_both_keys(left: DataFrame, right: DataFrame, on: str, how: str = "full") -> DataFrame:
    """Outer join that keeps both key columns: ``on`` from the left, ``<on>_right`` from the right."""
    r = right.withColumnRenamed(on, f"{on}_right")
    return left.join(r, left[on] == r[f"{on}_right"], how)


def expected_counts(counts: DataFrame, population: DataFrame) -> DataFrame:
    """``E = population * cases of the week / population of the week`` and ``SIR = cases / E``.

    ``counts`` has (week_date, states, cases), ``population`` (states, population).
    Weeks are numbered over all rows, areas without a name included, before those are left
    out.  Weekly totals use only the areas present in that week.  Population is in
    millions.  Totals are aggregated and joined back, so the rows of one week are
    never gathered.
    """
    weeks = dense_index(counts, "week_date", "week").where(F.col("states").isNotNull())
    both = keep_both_keys(weeks, population, "states")
    # whole people are summed before scaling: integer sums do not depend on the order of rows
    totals = (
        both.groupBy("week")
        .agg(
            F.sum(F.col("cases").cast("double")).alias("total_cases"),
            (F.sum("population") / F.lit(1e6)).alias("total_pop"),
        )
        .dropna()
    )
    return (
        both.join(totals, "week")
        .withColumn("population", F.col("population") / F.lit(1e6))
        .withColumn("E", F.try_divide(F.col("population") * F.col("total_cases"), F.col("total_pop")))
        .withColumn("SIR", F.try_divide(F.col("cases").cast("double"), F.col("E")))
    )


def relative_risk(x: Column, beta0: Column) -> Column:
    return F.exp(beta0 + x)


def log_factorial(n: Column) -> Column:
    """``log(n!)``: exact up to 20, Stirling's series (error below 1e-12) above."""
    m = n.cast("double")
    series = (
        m * F.log(m) - m + F.lit(0.5) * F.log(F.lit(2.0 * math.pi) * m)
        + F.lit(1.0) / (F.lit(12.0) * m)
        - F.lit(1.0) / (F.lit(360.0) * F.pow(m, F.lit(3.0)))
        + F.lit(1.0) / (F.lit(1260.0) * F.pow(m, F.lit(5.0)))
    )
    return F.when(n <= 20, F.log(F.factorial(n.cast("int")).cast("double"))).otherwise(series)


def poisson_loglik(y: Column, mu: Column) -> Column:
    """Aggregate: log-likelihood of counts; missing counts are skipped."""
    return F.sum(y.cast("double") * F.log(mu) - mu - log_factorial(y))


def forecast_risk(x_last: DataFrame, scalars: DataFrame, seed: int = 42) -> DataFrame:
    """One AR(1) step ahead per (area, sample): ``x' = alpha * x + N(0, sigma)``.

    ``x_last`` has (area, sample, x), ``scalars`` (sample, alpha, sigma, rho, beta0).
    """
    j = x_last.join(scalars, "sample")
    x_new = F.col("alpha") * F.col("x") + F.col("sigma") * normal(F.col("area"), F.col("sample"), seed=seed)
    return j.select("area", "sample", "beta0", x_new.alias("x_new"))


def impute_risk(
    edges: DataFrame, new_areas: DataFrame, field: DataFrame, scalars: DataFrame, seed: int = 43
) -> DataFrame:
    """One step ahead for areas without observations, from their observed neighbours.

    With neighbours: mean of their ``x`` and ``w``, noise ``sigma * sqrt(1 - rho)``.
    Without: prior mean 0 and noise ``sigma``.
    """
    near = (
        edges.join(new_areas.select(F.col("area").alias("src")), "src")
        .join(field.select(F.col("area").alias("dst"), "sample", "x", "w"), "dst")
        .groupBy("src", "sample")
        .agg(F.avg("x").alias("x_near"), F.avg("w").alias("w_near"))
    )
    # every new area lists the samples itself; the scalars then follow by their key
    samples = scalars.agg(F.collect_list("sample").alias("s")).scalar()
    grid = new_areas.select("area", F.explode(samples).alias("sample")).join(scalars, "sample")
    j = grid.join(near.withColumnRenamed("src", "area"), ["area", "sample"], "left")
    noise = normal(F.col("area"), F.col("sample"), seed=seed) * F.when(
        F.col("x_near").isNull(), F.col("sigma")
    ).otherwise(F.col("sigma") * F.sqrt(F.lit(1.0) - F.col("rho")))
    x_new = F.col("alpha") * F.coalesce("x_near", F.lit(0.0)) + F.coalesce("w_near", F.lit(0.0)) + noise
    return j.select("area", "sample", "beta0", x_new.alias("x_new"))


def mean_risk(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("area").agg(F.avg(F.exp(F.col("beta0") + F.col("x_new"))).alias("risk"))
