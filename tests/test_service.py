"""A forecast package: saved, loaded, and asked through SQL."""

import numpy as np
import pytest

from tidewell.operators import series
from tidewell.operators.service import ForecastPackage, design_matrix


@pytest.fixture(scope="module")
def models(spark):
    rows = [(f"c{c}", f"{2000 + m // 12}-{m % 12 + 1:02d}-01", 20.0 + c + 3 * np.sin(m / 2) + 0.01 * m) for c in range(5) for m in range(60)]
    rows += [("flat", f"2001-{m + 1:02d}-01", 7.0) for m in range(12)] + [("one", "2001-01-01", 3.0)]
    d = spark.createDataFrame([(c, t, float(y)) for c, t, y in rows], "city string, date string, y double").selectExpr("city", "date(date) AS date", "y")
    return series.fit_models(d, ["city"], "date", "y").persist()


def test_package_gives_the_records_of_the_service(spark, models, tmp_path):
    want = series.predict_service(series.forecast_draws(models, ["city"], 7, 2500), ["city"])
    package = ForecastPackage(models, "city", n_draws=2500)
    package.save(str(tmp_path / "p"))
    package.save(str(tmp_path / "p"))
    loaded = ForecastPackage.load(spark, str(tmp_path / "p"))
    assert (loaded.key, loaded.spec, loaded.n_draws, loaded.seed) == (package.key, package.spec, 2500, 42)
    got = loaded.predict(7)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r["city"] for r in got.collect()} == {f"c{c}" for c in range(5)}


def test_package_in_sql(spark, models):
    ForecastPackage(models, "city", n_draws=300, start_after_last=True).register("outlook")
    draws = series.forecast_draws(models, ["city"], 3, 300, start_after_last=True)
    want = {(r["city"], r["obs_id"]): r["forecast"] for r in series.back_transform(draws, ["city"]).collect()}
    rows = spark.sql("SELECT * FROM outlook(TABLE(outlook_models) PARTITION BY city, n_ahead => 3)").collect()
    assert {(r["city"], r["obs_id"]) for r in rows} == set(want)
    assert all(abs(r["forecast"] - want[r["city"], r["obs_id"]]) < 1e-9 for r in rows)
    few = spark.sql("SELECT * FROM outlook(TABLE(SELECT * FROM outlook_models WHERE city = 'c2') PARTITION BY city, n_ahead => 2)")
    assert sorted((r["city"], r["obs_id"]) for r in few.collect()) == [("c2", 0), ("c2", 1)]
    for none in ("0", "NULL"):
        assert spark.sql(f"SELECT * FROM outlook(TABLE(outlook_models) PARTITION BY city, n_ahead => {none})").count() == 0


def test_terms_are_those_of_the_columns(spark):
    from pyspark.sql import functions as F

    d = spark.range(0, 40).select(F.col("id").cast("double").alias("t"), F.lit(0.0).alias("lo"), F.lit(33.0).alias("hi"))
    want = np.array([r[0] for r in d.orderBy("t").select(series.design_row(F.col("t"), F.col("lo"), F.col("hi"))).collect()])
    assert np.allclose(design_matrix(np.arange(40.0), 0.0, 33.0, series.TrendSpec()), want, atol=1e-12)
