"""Grouped time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.numeric import fourier_terms
from tidewell.operators import series as ts
from tidewell.operators.reshape import MONTHS, sentinel_to_null, unpivot
from tidewell.operators.service import ForecastPackage
from tidewell.operators.summaries import hdi
from tidewell.plans.base import query
from tidewell.plans.standins import SERIES_SQL, monthly_sums, series, station_table
from tidewell.session import cut_lineage, scratch_path

KEYS = ["city"]
ISO = "yyyy-MM-dd"


def _iso(c: str = "date"):
    return F.date_format(c, ISO).alias(c)


@query(
    "ts1_climate_long",
    f"WITH {SERIES_SQL} SELECT city, temperature, strftime(date, '%Y-%m-%d') AS date FROM series",
)
def ts1(spark, d):
    return series(spark, d).select("city", "temperature", _iso())


@query(
    "r1_unpivot",
    f"""WITH {SERIES_SQL} SELECT lower(city) AS city, CAST(year(date) AS INTEGER) AS "YEAR",
        upper(strftime(date, '%b')) AS month, coalesce(temperature, 999.9::DOUBLE) AS temperature FROM series""",
)
def r1(spark, d):
    slim = station_table(spark, d).select("city", "YEAR", *MONTHS)
    return unpivot(slim, ["city", "YEAR"], MONTHS, "month", "temperature")


@query(
    "r3_pivot",
    """SELECT lower(n_name) AS city, CAST(year(l_shipdate) AS INTEGER) AS "YEAR", """
    + ", ".join(
        f"round(sum(CASE WHEN month(l_shipdate) = {i + 1} THEN l_extendedprice END), 2) AS {m}" for i, m in enumerate(MONTHS)
    )
    + " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL",
)
def r3(spark, d):
    from tidewell.operators.reshape import pivot_first

    wide = pivot_first(monthly_sums(spark, d), ["city", "YEAR"], "m", list(range(1, 13)), "v")
    return wide.select("city", "YEAR", *[F.col(str(i + 1)).alias(m) for i, m in enumerate(MONTHS)])


@query(
    "p3_sentinel_null",
    f"""WITH {SERIES_SQL} SELECT city, count(*) AS n_rows, count(*) - count(temperature) AS n_missing,
        count(temperature) AS n_known FROM series GROUP BY city""",
)
def p3(spark, d):
    s = station_table(spark, d)
    long = unpivot(s.select("city", "YEAR", *MONTHS), ["city", "YEAR"], MONTHS, "m", "v")
    known = sentinel_to_null(F.col("v"))
    from tidewell.functions.text import title_parts

    return long.groupBy(title_parts(F.col("city")).alias("city")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count(F.lit(1)) - F.count(known)).alias("n_missing"),
        F.count(known).alias("n_known"),
    )


@query(
    "p4_one_city",
    f"""WITH {SERIES_SQL} SELECT city, temperature, strftime(date, '%Y-%m-%d') AS date
        FROM series WHERE city = 'Nation_7' ORDER BY date""",
)
def p4(spark, d):
    return series(spark, d).where(F.col("city") == "Nation_7").orderBy("date").select("city", "temperature", _iso())


@query(
    "p10_trailing_window",
    f"""WITH {SERIES_SQL}, latest AS (SELECT max(date) AS m FROM series)
        SELECT y.years, s.city, count(*) AS n_months, count(temperature) AS n_known, strftime(min(date), '%Y-%m-%d') AS first_date
        FROM series s, latest, (SELECT unnest([1, 5, 10]) AS years) y
        WHERE s.date > latest.m - to_months(CAST(12 * y.years AS INTEGER)) GROUP BY y.years, s.city""",
)
def p10(spark, d):
    s = series(spark, d)
    parts = [ts.trailing_window(s, "date", 12 * y).withColumn("years", F.lit(y)) for y in (1, 5, 10)]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("years", "city").agg(
        F.count(F.lit(1)).alias("n_months"),
        F.count("temperature").alias("n_known"),
        F.date_format(F.min("date"), ISO).alias("first_date"),
    )


_SPLIT_SQL = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS back FROM series),
split AS (SELECT city, temperature, date, CASE WHEN back <= 12 THEN 'test' ELSE 'train' END AS split FROM ranked)
"""


def _split(spark, d):
    return ts.holdout_split(series(spark, d), KEYS, ["date"], 12)


@query(
    "w1_holdout",
    f"WITH {SERIES_SQL}, {_SPLIT_SQL} SELECT city, temperature, strftime(date, '%Y-%m-%d') AS date, split FROM split",
)
def w1(spark, d):
    return _split(spark, d).select("city", "temperature", _iso(), "split")


@query(
    "w1_holdout_orders",
    """WITH r AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS back FROM orders)
       SELECT o_custkey, o_orderkey, o_totalprice, CASE WHEN back <= 3 THEN 'test' ELSE 'train' END AS split FROM r""",
)
def w1_orders(spark, d):
    from tidewell.plans.base import table

    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return ts.holdout_split(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], 3).drop("o_orderdate")


@query(
    "a13_head_tail",
    f"""WITH {SERIES_SQL}, {_SPLIT_SQL}
        SELECT city, split, count(*) AS n, strftime(min(date), '%Y-%m-%d') AS first_date,
               strftime(max(date), '%Y-%m-%d') AS last_date, round(avg(temperature), 6) AS mean
        FROM split GROUP BY city, split""",
)
def a13(spark, d):
    return (
        _split(spark, d)
        .groupBy("city", "split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.date_format(F.min("date"), ISO).alias("first_date"),
            F.date_format(F.max("date"), ISO).alias("last_date"),
            F.round(F.avg("temperature"), 6).alias("mean"),
        )
    )


@query(
    "r5_explode_lists",
    f"WITH {SERIES_SQL}, {_SPLIT_SQL} SELECT city, temperature, strftime(date, '%Y-%m-%d') AS date FROM split WHERE split = 'test'",
)
def r5(spark, d):
    """Parallel lists of the twelve test months per city, back to rows."""
    test = _split(spark, d).where("split = 'test'")
    lists = test.groupBy("city").agg(F.array_sort(F.collect_list(F.struct("date", "temperature"))).alias("r"))
    lists = lists.select("city", F.col("r.date").alias("dates"), F.col("r.temperature").alias("temperatures"))
    rows = lists.select("city", F.explode(F.arrays_zip("dates", "temperatures")).alias("z"))
    return rows.select("city", F.col("z.temperatures").alias("temperature"), F.date_format("z.dates", ISO).alias("date"))


@query(
    "w3_time_index",
    f"""WITH {SERIES_SQL} SELECT city, strftime(date, '%Y-%m-%d') AS date,
        row_number() OVER (PARTITION BY city ORDER BY date) - 1 AS t FROM series""",
)
def w3(spark, d):
    return ts.time_index(series(spark, d), KEYS, "date").select("city", _iso(), "t")


@query(
    "ts2_fourier",
    f"""WITH {SERIES_SQL}, idx AS (SELECT city, row_number() OVER (PARTITION BY city ORDER BY date) - 1 AS t FROM series)
        SELECT city, t, """
    + ", ".join(
        f"round({f}(2.0::DOUBLE * pi() * (t / 12.0::DOUBLE) * {k}), 6) + 0.0::DOUBLE AS {f}_order_{k}"
        for k in range(1, 11)
        for f in ("sin", "cos")
    )
    + " FROM idx",
)
def ts2(spark, d):
    idx = ts.time_index(series(spark, d), KEYS, "date").select("city", "t")
    wide = idx.select("city", "t", *fourier_terms(F.col("t"), 10, 12.0))
    return wide.select("city", "t", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in wide.columns[2:]])


@query(
    "ts3_standardise",
    f"""WITH {SERIES_SQL} SELECT s.city, strftime(date, '%Y-%m-%d') AS date, round(y_mean, 4) AS y_mean, round(y_std, 4) AS y_std,
        round((temperature - y_mean) / y_std, 6) AS y_norm
        FROM series s JOIN (SELECT city, avg(temperature) AS y_mean, stddev_pop(temperature) AS y_std FROM series GROUP BY city) g
        ON s.city = g.city""",
)
def ts3(spark, d):
    z = ts.standardise(series(spark, d), KEYS, "temperature")
    return z.select("city", _iso(), F.round("y_mean", 4).alias("y_mean"), F.round("y_std", 4).alias("y_std"), F.round("y_norm", 6).alias("y_norm"))


@query(
    "a5_mean_std",
    f"""WITH {SERIES_SQL} SELECT city, round(avg(temperature), 4) AS y_mean, round(stddev_pop(temperature), 4) AS y_std,
        count(temperature) AS n FROM series GROUP BY city""",
)
def a5(spark, d):
    return series(spark, d).groupBy("city").agg(
        F.round(F.avg("temperature"), 4).alias("y_mean"),
        F.round(F.stddev_pop("temperature"), 4).alias("y_std"),
        F.count("temperature").alias("n"),
    )


_BASIS_SQL = ", ".join(
    f"round(sqrt(1.0::DOUBLE / len) * sin(pi() * {j} * (t - mid + len) / (2.0::DOUBLE * len)), 6) + 0.0::DOUBLE AS phi_{j}, "
    f"round({ts.TrendSpec().amplitude * (2 * 3.141592653589793) ** 0.5 * ts.TrendSpec().length_scale!r}::DOUBLE"
    f" * exp(-0.5::DOUBLE * pow(24.0::DOUBLE * (pi() * {j} / (2.0::DOUBLE * len)), 2)), 6) AS var_{j}"
    for j in range(1, 11)
)


@query(
    "ts4_trend_basis",
    f"""WITH {SERIES_SQL}, idx AS (SELECT city, CAST(row_number() OVER (PARTITION BY city ORDER BY date) - 1 AS DOUBLE) AS t FROM series),
        b AS (SELECT city, (min(t) + max(t)) / 2.0::DOUBLE AS mid, 5.0::DOUBLE * (max(t) - min(t)) / 2.0::DOUBLE AS len FROM idx GROUP BY city)
        SELECT idx.city, CAST(t AS BIGINT) AS t, {_BASIS_SQL} FROM idx JOIN b ON idx.city = b.city""",
)
def ts4(spark, d):
    idx = ts.time_index(series(spark, d), KEYS, "date").select("city", "t")
    b = idx.groupBy("city").agg(F.min("t").cast("double").alias("lo"), F.max("t").cast("double").alias("hi"))
    j = idx.join(b, "city")
    phi = ts.trend_basis(F.col("t").cast("double"), F.col("lo"), F.col("hi"))
    var = ts.basis_variance(F.col("lo"), F.col("hi"))
    cols = []
    for i in range(10):
        cols.append((F.round(F.element_at(phi, i + 1), 6) + F.lit(0.0)).alias(f"phi_{i + 1}"))
        cols.append(F.round(F.element_at(var, i + 1), 6).alias(f"var_{i + 1}"))
    return j.select("city", "t", *cols)


# ---- fitted models: checked against a NumPy solve in the tests ----
CHAINS, CHAIN_DRAWS = 4, 1000
N_DRAWS = CHAINS * CHAIN_DRAWS


def _kept_split(spark, d):
    """The split is read several times below: write the (small, aggregated) table once."""
    return cut_lineage(_split(spark, d))


def _models(split):
    train = split.where("split = 'train'").select("city", "date", "temperature")
    return ts.fit_models(train, KEYS, "date", "temperature")


def _draws(split):
    return ts.forecast_draws(_models(split), KEYS, 12, N_DRAWS)


def _truth(split):
    """Held-out months with their step ahead; at most twelve per city."""
    test = split.where("split = 'test'").select("city", "date", "temperature")
    return ts.time_index(test, KEYS, "date", "obs_id")


@query("ts5_fit_models")
def ts5(spark, d):
    m = _models(_kept_split(spark, d))
    return m.select("city", "t_lo", "t_hi", "y_mean", "y_std", "error", F.posexplode("mean").alias("term", "weight")).select(
        "city", "t_lo", "t_hi", F.round("y_mean", 4).alias("y_mean"), F.round("y_std", 4).alias("y_std"), "error", "term", F.round("weight", 6).alias("weight")
    )


@query(
    "ts5_posterior_identity",
    f"""WITH {SERIES_SQL}, {_SPLIT_SQL}, fitted AS (SELECT city FROM split WHERE split = 'train' GROUP BY city HAVING count(*) > 1 AND stddev_pop(temperature) > 0)
        SELECT city, term, 0.0::DOUBLE AS difference FROM fitted, (SELECT unnest(range({ts.TrendSpec().size}))::INTEGER AS term)""",
)
def ts5_identity(spark, d):
    """What defines the posterior mean: each weight is its prior variance times the term's sum with the residuals, over the noise."""
    split, spec = _kept_split(spark, d), ts.TrendSpec()
    fitted = cut_lineage(_models(split).where(F.col("mean").isNotNull()))
    train = ts.time_index(split.where("split = 'train'").select("city", "date", "temperature"), KEYS, "date", "t")
    lo, hi = F.col("t_lo"), F.col("t_hi")
    rows = train.where(F.col("temperature").isNotNull()).join(fitted, "city")
    rows = rows.withColumn("x", ts.design_row(F.col("t"), lo, hi, spec))
    fit = F.aggregate(F.zip_with("x", "mean", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    residual = (F.col("temperature") - F.col("y_mean")) / F.col("y_std") - fit
    sums = rows.select("city", residual.alias("r"), F.posexplode("x").alias("term", "x"))
    sums = sums.groupBy("city", "term").agg((F.sum(F.col("x") * F.col("r")) / spec.error**2).alias("pull"))
    prior = F.concat(ts.basis_variance(lo, hi, spec), F.array_repeat(F.lit(spec.beta_sd**2), 2 * spec.n_fourier))
    weights = fitted.select("city", F.posexplode(F.arrays_zip("mean", prior.alias("variance"))).alias("term", "w"))
    both = sums.join(weights, ["city", "term"])
    return both.select("city", "term", (F.round(F.col("w.mean") - F.col("w.variance") * F.col("pull"), 6) + F.lit(0.0)).alias("difference"))


@query("ts6_forecast_draws")
def ts6(spark, d):
    return _draws(_kept_split(spark, d)).select(
        "city", F.floor(F.col("draw") / CHAIN_DRAWS).cast("int").alias("chain"), (F.col("draw") % CHAIN_DRAWS).alias("draw"), "obs_id",
        F.round("value", 6).alias("value"),
    )


@query("ts7_back_transform")
def ts7(spark, d):
    f = ts.back_transform(_draws(_kept_split(spark, d)), KEYS)
    return f.select("city", "obs_id", F.round("forecast", 4).alias("forecast"))


def _scored(split):
    # two consumers (interval and mean): draw once, keep the draws
    draws = cut_lineage(_draws(split).select("city", "draw", "obs_id", (F.col("value") * F.col("y_std") + F.col("y_mean")).alias("value")))
    mean = draws.groupBy("city", "obs_id").agg(F.avg("value").alias("forecast"))
    return mean.join(hdi(draws, ["city", "obs_id"], "value", 0.8), ["city", "obs_id"])


@query("ts8_rmse")
def ts8(spark, d):
    split = _kept_split(spark, d)
    f = ts.back_transform(_draws(split), KEYS).join(_truth(split), ["city", "obs_id"])
    return f.groupBy("city").agg(F.round(ts.rmse(F.col("temperature"), F.col("forecast")), 4).alias("rmse"), F.count("temperature").alias("n"))


@query("ts9_coverage")
def ts9(spark, d):
    split = _kept_split(spark, d)
    f = _scored(split).join(_truth(split), ["city", "obs_id"])
    return f.groupBy("city").agg(
        F.round(ts.rmse(F.col("temperature"), F.col("forecast")), 4).alias("rmse"),
        F.round(ts.coverage(F.col("temperature"), F.col("hdi_low"), F.col("hdi_high")), 6).alias("hdi_coverage"),
    )


@query("ts10_forecast_band")
def ts10(spark, d):
    """Actuals of both splits; the held-out months also carry the forecast and its band."""
    s = _kept_split(spark, d)
    train = s.where("split = 'train'").select("city", "date", "split", F.col("temperature").alias("actual"))
    test = _truth(s).join(_scored(s), ["city", "obs_id"]).select(
        "city", "date", F.lit("test").alias("split"), F.col("temperature").alias("actual"),
        F.round("forecast", 4).alias("forecast"), F.round("hdi_low", 4).alias("low"), F.round("hdi_high", 4).alias("high"),
    )
    return train.unionByName(test, allowMissingColumns=True).withColumn("date", F.date_format("date", ISO))


@query("ts11_predict_service")
def ts11(spark, d):
    return ts.predict_service(_draws(_kept_split(spark, d)), KEYS)


def _package(spark, d) -> ForecastPackage:
    """The models of all cities, written as a package and loaded again."""
    path = scratch_path(spark, "package")
    ForecastPackage(_models(_kept_split(spark, d)), "city", n_draws=N_DRAWS).save(path)
    return ForecastPackage.load(spark, path)


@query("u4_packaged_model")
def u4(spark, d):
    """The records of the prediction service, asked of a loaded package through SQL."""
    return _package(spark, d).predict(12)


@query(
    "u4_record_shape",
    f"""WITH {SERIES_SQL}, {_SPLIT_SQL}, fitted AS (SELECT city FROM split WHERE split = 'train' GROUP BY city HAVING count(*) > 1 AND stddev_pop(temperature) > 0)
        SELECT city, obs_id, true AS is_record FROM fitted, (SELECT unnest(range(24))::INTEGER AS obs_id)""",
)
def u4_shape(spark, d):
    """Two years ahead: a record per city and step, holding its step and a finite forecast."""
    r = _package(spark, d).predict(24).withColumn("r", F.from_json("record", "obs_id int, forecast double"))
    finite = F.abs(F.col("r.forecast")) < F.lit(float("inf"))
    return r.select("city", "obs_id", ((F.col("r.obs_id") == F.col("obs_id")) & finite).alias("is_record"))


# ---- scores with an exact check: last year's value as the forecast ----
_NAIVE_SQL = f"""
WITH {SERIES_SQL}, {_SPLIT_SQL},
scored AS (
  SELECT a.city, a.date, a.temperature AS truth, b.temperature AS predicted,
         b.temperature * 0.7::DOUBLE AS low, b.temperature * 1.3::DOUBLE AS high
  FROM split a JOIN split b ON a.city = b.city AND b.date = a.date - INTERVAL 1 YEAR WHERE a.split = 'test')
"""


def _naive(spark, d):
    s = _split(spark, d)
    last_year = s.select("city", F.add_months("date", 12).alias("date"), F.col("temperature").alias("predicted"))
    return s.where("split = 'test'").join(last_year, ["city", "date"]).select(
        "city", F.col("temperature").alias("truth"), "predicted",
        (F.col("predicted") * 0.7).alias("low"), (F.col("predicted") * 1.3).alias("high"),
    )


@query("ts8_rmse_seasonal_naive", _NAIVE_SQL + "SELECT city, round(sqrt(avg(pow(truth - predicted, 2))), 4) AS rmse FROM scored GROUP BY city")
def ts8_naive(spark, d):
    return _naive(spark, d).groupBy("city").agg(F.round(ts.rmse(F.col("truth"), F.col("predicted")), 4).alias("rmse"))


@query(
    "a6_conditional_mean",
    _NAIVE_SQL
    + """SELECT city, round(avg(CASE WHEN truth IS NULL THEN NULL WHEN truth >= low AND truth <= high THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
         AS coverage FROM scored GROUP BY city""",
)
def a6(spark, d):
    return _naive(spark, d).groupBy("city").agg(F.round(ts.coverage(F.col("truth"), F.col("low"), F.col("high")), 6).alias("coverage"))
