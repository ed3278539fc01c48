"""Incidence by area and week, adjacency and risk."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.hashing import normal_sql
from tidewell.operators import graph
from tidewell.operators import incidence as inc
from tidewell.operators.reshape import complete_grid, dense_index
from tidewell.operators.summaries import geometric_mean, hdi
from tidewell.plans.base import query, table
from tidewell.plans.standins import (
    CUSTOMER_EDGES_SQL,
    POLYGON_EDGES_SQL,
    WEEKLY_SQL,
    area_draws,
    customer_edges,
    draws_sql,
    polygons,
    populations,
    scalar_draws,
    weekly_counts,
)

_SIR_SQL = f"""
WITH {WEEKLY_SQL},
idx AS (SELECT week_date, row_number() OVER (ORDER BY week_date) AS week FROM (SELECT DISTINCT week_date FROM weekly)),
j AS (SELECT w.week_date, i.week, w.states, w.cases, p.population / 1e6::DOUBLE AS population, p.population AS people
      FROM weekly w JOIN idx i ON w.week_date = i.week_date JOIN pops p ON p.states = w.states),
tot AS (SELECT week, CAST(sum(cases) AS DOUBLE) AS total_cases, sum(people)::DOUBLE / 1e6::DOUBLE AS total_pop FROM j GROUP BY week),
sir AS (SELECT j.*, total_cases, total_pop, population * total_cases / total_pop AS e,
               cases / (population * total_cases / total_pop) AS sir FROM j JOIN tot ON j.week = tot.week)
"""


def _sir(spark, d):
    return inc.expected_counts(weekly_counts(spark, d), populations(spark, d))


@query(
    "g1_sir",
    _SIR_SQL
    + """SELECT strftime(week_date, '%Y-%m-%d') AS week_date, CAST(week AS INTEGER) AS week, states, states AS states_right, cases,
        population, total_cases, e AS expected, sir FROM sir""",
)
def g1(spark, d):
    return _sir(spark, d).select(
        F.date_format("week_date", "yyyy-MM-dd").alias("week_date"), "week", "states", "states_right", "cases",
        "population", "total_cases", F.col("E").alias("expected"), F.col("SIR").alias("sir"),
    )


@query("a1_weekly_totals", _SIR_SQL + "SELECT CAST(week AS INTEGER) AS week, total_cases, round(total_pop, 6) AS total_pop FROM tot")
def a1(spark, d):
    s = _sir(spark, d)
    return s.groupBy("week").agg(F.first("total_cases").alias("total_cases"), F.round(F.first("total_pop"), 6).alias("total_pop"))


@query(
    "w2_week_index",
    f"""WITH {WEEKLY_SQL} SELECT strftime(week_date, '%Y-%m-%d') AS week_date, states,
        CAST(dense_rank() OVER (ORDER BY week_date) AS INTEGER) AS week FROM weekly""",
)
def w2(spark, d):
    return dense_index(weekly_counts(spark, d), "week_date", "week").select(
        F.date_format("week_date", "yyyy-MM-dd").alias("week_date"), "states", "week"
    )


@query("j1_counts_population", f"WITH {WEEKLY_SQL} SELECT strftime(w.week_date, '%Y-%m-%d') AS week_date, w.states, cases, population FROM weekly w JOIN pops p ON w.states = p.states")
def j1(spark, d):
    j = weekly_counts(spark, d).join(populations(spark, d), "states", "inner")
    return j.select(F.date_format("week_date", "yyyy-MM-dd").alias("week_date"), "states", "cases", "population")


@query(
    "j2_full_join_both_keys",
    f"""WITH {WEEKLY_SQL}, a AS (SELECT states, sum(cases)::BIGINT AS cases FROM weekly WHERE states <> 'NATION_3' GROUP BY states),
        b AS (SELECT * FROM pops WHERE states <> 'NATION_5')
        SELECT a.states, b.states AS states_right, cases, population FROM a FULL JOIN b ON a.states = b.states""",
)
def j2(spark, d):
    a = weekly_counts(spark, d).where("states <> 'NATION_3'").groupBy("states").agg(F.sum("cases").alias("cases"))
    return inc.keep_both_keys(a, populations(spark, d).where("states <> 'NATION_5'"), "states")


@query(
    "j3_outer_merge_geometry",
    f"""WITH {WEEKLY_SQL}, a AS (SELECT states, sum(cases)::BIGINT AS cases FROM weekly WHERE states <> 'NATION_3' GROUP BY states)
        SELECT a.states, n.n_name AS name, cases, 5::INTEGER AS n_vertices FROM a FULL JOIN nation n ON a.states = n.n_name""",
)
def j3(spark, d):
    a = weekly_counts(spark, d).where("states <> 'NATION_3'").groupBy("states").agg(F.sum("cases").alias("cases"))
    p = polygons(spark, d)
    return a.join(p, a["states"] == p["name"], "full").select("states", "name", "cases", F.size(F.element_at("geometry", 1)).alias("n_vertices"))


@query(
    "a4_drop_duplicates",
    "SELECT DISTINCT n_name AS name, CAST(n_nationkey % 5 AS DOUBLE) AS x0, CAST(n_nationkey // 5 AS DOUBLE) AS y0 FROM nation JOIN customer ON c_nationkey = n_nationkey",
)
def a4(spark, d):
    """Area and geometry once per area, from one row per customer of the area."""
    c = table(spark, d, "customer").select("c_nationkey")
    rows = c.join(polygons(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
    # geometry is constant per area, so the smallest is the first
    g = rows.groupBy("name").agg(F.min("geometry").alias("geometry"))
    first = F.element_at(F.element_at("geometry", 1), 1)
    return g.select("name", first["x"].alias("x0"), first["y"].alias("y0"))


@query("a7_min_max", f"WITH {WEEKLY_SQL} SELECT states, strftime(min(week_date), '%Y-%m-%d') AS first_week, strftime(max(week_date), '%Y-%m-%d') AS last_week, min(cases) AS low, max(cases) AS high FROM weekly GROUP BY states")
def a7(spark, d):
    return weekly_counts(spark, d).groupBy("states").agg(
        F.date_format(F.min("week_date"), "yyyy-MM-dd").alias("first_week"),
        F.date_format(F.max("week_date"), "yyyy-MM-dd").alias("last_week"),
        F.min("cases").alias("low"),
        F.max("cases").alias("high"),
    )


_GRID_SQL = _SIR_SQL + """, grid AS (
  SELECT g.week, s.states, sir.cases, sir.e FROM (SELECT unnest(range(1, (SELECT max(week) + 1 FROM sir))) AS week) g
  CROSS JOIN (SELECT DISTINCT states FROM sir) s LEFT JOIN sir ON sir.week = g.week AND sir.states = s.states)
"""


@query("r4_complete_grid", _GRID_SQL + "SELECT CAST(week AS INTEGER) AS week, states, cases FROM grid")
def r4(spark, d):
    w = dense_index(weekly_counts(spark, d), "week_date", "week")
    return complete_grid(w, "week", "states", "cases")


@query("p9_fill_missing", _GRID_SQL + "SELECT CAST(week AS INTEGER) AS week, states, coalesce(e, 1.0::DOUBLE) AS expected FROM grid")
def p9(spark, d):
    g = complete_grid(_sir(spark, d), "week", "states", "E")
    return g.select("week", "states", F.coalesce("E", F.lit(1.0)).alias("expected"))


@query("p1_derived_columns", f"WITH {WEEKLY_SQL} SELECT states, population, population / 1e6::DOUBLE AS millions, 'city_' || lower(states) AS tag FROM pops")
def p1(spark, d):
    return populations(spark, d).select("states", "population", (F.col("population") / F.lit(1e6)).alias("millions"), F.concat(F.lit("city_"), F.lower("states")).alias("tag"))


@query("p11_round", _SIR_SQL + "SELECT CAST(week AS INTEGER) AS week, states, round(sir + 1e-9::DOUBLE, 2) AS sir FROM sir")
def p11(spark, d):
    return _sir(spark, d).select("week", "states", F.round(F.col("SIR") + F.lit(1e-9), 2).alias("sir"))


# ---- adjacency ----
def _edges(spark, d):
    e = graph.shared_vertex_edges(polygons(spark, d), "n_nationkey")
    return e.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))


@query("g2_queen_edges", f"WITH {POLYGON_EDGES_SQL} SELECT CAST(src AS BIGINT) AS src, CAST(dst AS BIGINT) AS dst FROM edges")
def g2(spark, d):
    return _edges(spark, d)


@query(
    "j5_shared_vertices",
    f"WITH {POLYGON_EDGES_SQL} SELECT a.n_name AS src_name, b.n_name AS dst_name FROM edges JOIN nation a ON src = a.n_nationkey JOIN nation b ON dst = b.n_nationkey",
)
def j5(spark, d):
    return graph.shared_vertex_edges(polygons(spark, d), "name").select(F.col("src").alias("src_name"), F.col("dst").alias("dst_name"))


@query(
    "g3_precision_triples",
    f"""WITH {CUSTOMER_EDGES_SQL} SELECT src AS i, src AS j, CAST(count(*) AS DOUBLE) AS value FROM cedges GROUP BY src
        UNION ALL SELECT src, dst, -1.0::DOUBLE FROM cedges""",
)
def g3(spark, d):
    return graph.precision_triples(customer_edges(spark, d))


_COMPONENT_SQL = f"""
WITH RECURSIVE {CUSTOMER_EDGES_SQL},
reach(node, other) AS (
  SELECT c_custkey, c_custkey FROM customer UNION SELECT r.node, e.dst FROM reach r JOIN cedges e ON e.src = r.other),
comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
"""


def _components(spark, d):
    nodes = table(spark, d, "customer").select(F.col("c_custkey").alias("node"))
    return graph.connected_components(nodes, customer_edges(spark, d))


@query("g4_components", _COMPONENT_SQL + "SELECT node, component FROM comp")
def g4(spark, d):
    return _components(spark, d)


@query("g5_icar_scaling")
def g5(spark, d):
    s = graph.icar_components(_components(spark, d), customer_edges(spark, d))
    return s.where("i = j").select("component", "n", F.round("scale", 6).alias("scale"), F.col("i").alias("node"))


@query("g12_mixed_covariance")
def g12(spark, d):
    s = graph.icar_components(_components(spark, d), customer_edges(spark, d))
    return graph.mixed_covariance(s, 0.2).select("i", "j", F.round("value", 6).alias("value"))


@query(
    "a10_geometric_mean",
    "SELECT c_nationkey AS area, round(exp(avg(ln(o_totalprice))), 4) AS geo_mean FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 0 GROUP BY c_nationkey",
)
def a10(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 0").select("o_custkey", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("area")).agg(
        F.round(geometric_mean(F.col("o_totalprice")), 4).alias("geo_mean")
    )


# ---- latent field ----
_D = draws_sql()


@query(
    "j8_neighbour_values",
    f"WITH {POLYGON_EDGES_SQL}, {_D} SELECT CAST(src AS BIGINT) AS area, sample, round(avg(x), 6) AS near_mean, count(*) AS degree FROM edges JOIN area_draws ON dst = area GROUP BY src, sample",
)
def j8(spark, d):
    m = graph.neighbour_mean(_edges(spark, d), area_draws(spark, d), "x", ["sample"])
    return m.select("area", "sample", F.round("near_mean", 6).alias("near_mean"), "degree")


@query(
    "g6_conditional_field",
    f"""WITH {POLYGON_EDGES_SQL}, {_D} SELECT CAST(src AS BIGINT) AS area, a.sample, round(avg(x), 6) AS cond_mean,
        round(any_value(sigma) * any_value(sigma) / count(*), 6) AS cond_var
        FROM edges JOIN area_draws a ON dst = area JOIN scalar_draws s ON s.sample = a.sample GROUP BY src, a.sample""",
)
def g6(spark, d):
    m = graph.neighbour_mean(_edges(spark, d), area_draws(spark, d), "x", ["sample"]).join(scalar_draws(spark, d), "sample")
    return m.select("area", "sample", F.round("near_mean", 6).alias("cond_mean"), F.round(F.col("sigma") * F.col("sigma") / F.col("degree"), 6).alias("cond_var"))


@query(
    "g7_smoothness_penalty",
    f"""WITH {POLYGON_EDGES_SQL}, {_D} SELECT a.sample, round(sum(pow(a.x - b.x, 2)) / (0.3::DOUBLE * 0.3::DOUBLE), 6) AS penalty
        FROM edges JOIN area_draws a ON a.area = src JOIN area_draws b ON b.area = dst AND b.sample = a.sample WHERE src < dst GROUP BY a.sample""",
)
def g7(spark, d):
    p = graph.smoothness_penalty(_edges(spark, d), area_draws(spark, d), "x", ["sample"], 0.3)
    return p.select("sample", F.round("penalty", 6).alias("penalty"))


def _expected(spark, d):
    """Cases and expected counts of every week and area."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("area"), "n_name")
    cells = _sir(spark, d).join(n, F.col("states") == F.col("n_name")).where("cases IS NOT NULL AND E IS NOT NULL")
    return cells.select("area", "week", F.col("cases").alias("y"), F.col("E").alias("expected"))


_CELLS_SQL = _SIR_SQL + f""", {_D}, cells AS (
  SELECT CAST(n_nationkey AS BIGINT) AS area, CAST(week AS INTEGER) AS week, cases AS y, e AS expected
  FROM sir JOIN nation ON n_name = states WHERE cases IS NOT NULL AND e IS NOT NULL)
"""


@query(
    "g8_relative_risk",
    _CELLS_SQL
    + """SELECT a.area, b.week, a.sample, round(exp(beta0 + x), 6) AS theta, round(exp(beta0 + x) * expected, 6) AS mu
         FROM area_draws a JOIN scalar_draws s ON a.sample = s.sample JOIN cells b ON a.area = b.area""",
)
def g8(spark, d):
    j = area_draws(spark, d).join(scalar_draws(spark, d), "sample").join(_expected(spark, d), "area")
    theta = inc.relative_risk(F.col("x"), F.col("beta0"))
    return j.select("area", "week", "sample", F.round(theta, 6).alias("theta"), F.round(theta * F.col("expected"), 6).alias("mu"))


@query(
    "g9_poisson_loglik",
    _CELLS_SQL
    + """SELECT a.sample, round(sum(y * ln(exp(beta0 + x) * expected) - exp(beta0 + x) * expected - lgamma(CAST(y + 1 AS DOUBLE))), 4) AS loglik
         FROM area_draws a JOIN scalar_draws s ON a.sample = s.sample JOIN cells b ON a.area = b.area GROUP BY a.sample""",
)
def g9(spark, d):
    j = area_draws(spark, d).join(scalar_draws(spark, d), "sample").join(_expected(spark, d), "area")
    mu = inc.relative_risk(F.col("x"), F.col("beta0")) * F.col("expected")
    return j.groupBy("sample").agg(F.round(inc.poisson_loglik(F.col("y"), mu), 4).alias("loglik"))


_STEP_SQL = f"alpha * x + sigma * {normal_sql('area', 'a.sample', seed=42)}"


@query(
    "g10_risk_forecast",
    f"WITH {_D} SELECT area, round(avg(exp(beta0 + {_STEP_SQL})), 6) AS risk FROM area_draws a JOIN scalar_draws s ON a.sample = s.sample GROUP BY area",
)
def g10(spark, d):
    f = inc.forecast_risk(area_draws(spark, d), scalar_draws(spark, d))
    return inc.mean_risk(f).select("area", F.round("risk", 6).alias("risk"))


@query(
    "g11_impute_areas",
    f"""WITH {POLYGON_EDGES_SQL}, {_D},
        obs AS (SELECT * FROM area_draws WHERE area % 4 <> 0 AND area < 23),
        fresh AS (SELECT CAST(n_nationkey AS BIGINT) AS area FROM nation WHERE n_nationkey % 4 = 0 OR n_nationkey >= 23),
        near AS (SELECT src, sample, avg(x) AS x_near, avg(w) AS w_near FROM edges JOIN obs ON dst = area GROUP BY src, sample),
        steps AS (
          SELECT area, beta0, {_STEP_SQL} AS x_new FROM obs a JOIN scalar_draws s ON a.sample = s.sample
          UNION ALL
          SELECT f.area, beta0, alpha * coalesce(x_near, 0) + coalesce(w_near, 0)
             + CASE WHEN x_near IS NULL THEN sigma ELSE sigma * sqrt(1.0::DOUBLE - rho) END * {normal_sql('f.area', 's.sample', seed=43)}
          FROM fresh f CROSS JOIN scalar_draws s LEFT JOIN near n ON n.src = f.area AND n.sample = s.sample)
        SELECT area, round(avg(exp(beta0 + x_new)), 6) AS risk FROM steps GROUP BY area""",
)
def g11(spark, d):
    field = area_draws(spark, d)
    seen = (F.col("area") % 4 != 0) & (F.col("area") < 23)
    obs, fresh = field.where(seen), field.where(~seen).select("area").distinct()
    scalars = scalar_draws(spark, d)
    both = inc.forecast_risk(obs, scalars).unionByName(inc.impute_risk(_edges(spark, d), fresh, obs, scalars))
    return inc.mean_risk(both).select("area", F.round("risk", 6).alias("risk"))


@query(
    "a12_posterior_summary",
    f"""WITH {_D}, s AS (SELECT area, x, row_number() OVER (PARTITION BY area ORDER BY x) - 1 AS i, count(*) OVER (PARTITION BY area) AS n FROM area_draws),
        w AS (SELECT a.area, a.i, a.x AS lo, b.x AS hi FROM s a JOIN s b ON a.area = b.area AND b.i = a.i + CAST(floor(0.94::DOUBLE * a.n) AS BIGINT)),
        best AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY hi - lo, i) AS r FROM w)
        SELECT s.area, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS sd, round(any_value(lo), 6) AS low, round(any_value(hi), 6) AS high
        FROM s JOIN best ON best.area = s.area AND r = 1 GROUP BY s.area""",
)
def a12(spark, d):
    from tidewell.operators.summaries import posterior_summary

    p = posterior_summary(area_draws(spark, d), ["area"], "x")
    return p.select("area", *[F.round(c, 6).alias(o) for c, o in [("mean", "mean"), ("sd", "sd"), ("hdi_low", "low"), ("hdi_high", "high")]])


@query(
    "w5_hdi",
    """WITH s AS (SELECT o_orderpriority AS grp, o_totalprice AS x, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i,
              count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
        w AS (SELECT a.grp, a.i, a.x AS lo, b.x AS hi FROM s a JOIN s b ON a.grp = b.grp AND b.i = a.i + CAST(floor(0.8::DOUBLE * a.n) AS BIGINT)),
        best AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY hi - lo, i) AS r FROM w)
        SELECT grp, round(lo, 2) AS low, round(hi, 2) AS high FROM best WHERE r = 1""",
)
def w5(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("grp"), "o_totalprice")
    return hdi(o, ["grp"], "o_totalprice", 0.8).select("grp", F.round("hdi_low", 2).alias("low"), F.round("hdi_high", 2).alias("high"))


@query(
    "r6_parse_names",
    f"""WITH {_D} SELECT CAST(sample AS INTEGER) AS week, 'NATION_' || area AS state, round(x, 6) AS value FROM area_draws""",
)
def r6(spark, d):
    named = area_draws(spark, d).select(F.concat(F.lit("th["), "sample", F.lit(", NATION_"), "area", F.lit("]")).alias("name"), "x")
    pattern = r"^th\[(\d+), (.*)\]$"
    return named.select(
        F.regexp_extract("name", pattern, 1).cast("int").alias("week"), F.regexp_extract("name", pattern, 2).alias("state"), F.round("x", 6).alias("value")
    )


@query(
    "r7_stack_keys",
    f"""WITH {_D} SELECT area, CAST(sample // 10 AS BIGINT) AS chain, CAST(sample % 10 AS BIGINT) AS draw, CAST(sample AS BIGINT) AS stacked, round(x, 6) AS value FROM area_draws""",
)
def r7(spark, d):
    a = area_draws(spark, d).select("area", F.floor(F.col("sample") / 10).alias("chain"), (F.col("sample") % 10).cast("long").alias("draw"), "x")
    return a.select("area", "chain", "draw", (F.col("chain") * 10 + F.col("draw")).alias("stacked"), F.round("x", 6).alias("value"))


@query(
    "r2_melt_weeks",
    f"""WITH {WEEKLY_SQL}, y AS (SELECT states, year(week_date) AS yr, sum(cases) AS cases FROM weekly GROUP BY ALL)
        SELECT s.states, CAST(k.yr AS VARCHAR) AS week_key, CAST(y.cases AS BIGINT) AS cases, k.yr || '-01-01' AS week_start
        FROM (SELECT DISTINCT states FROM y) s CROSS JOIN (SELECT unnest(range(1995, 2002)) AS yr) k LEFT JOIN y ON y.states = s.states AND y.yr = k.yr""",
)
def r2(spark, d):
    """Columns named by period become rows, then a text-keyed join brings the dates back."""
    y = weekly_counts(spark, d).select("states", F.year("week_date").alias("yr"), "cases")
    keys = [str(k) for k in range(1995, 2002)]
    wide = y.groupBy("states").pivot("yr", [int(k) for k in keys]).agg(F.sum("cases"))
    long = wide.unpivot(["states"], keys, "week_key", "cases")
    dates = table(spark, d, "orders").select(F.year(F.date_trunc("week", "o_orderdate")).cast("string").alias("week_key")).distinct()
    dates = dates.withColumn("week_start", F.concat("week_key", F.lit("-01-01")))
    return long.join(dates, "week_key").select("states", "week_key", "cases", "week_start")
