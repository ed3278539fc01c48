"""The given tables seen as the inputs the operators were designed for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.hashing import normal, normal_sql, uniform, uniform_sql
from tidewell.functions.text import words
from tidewell.operators.reshape import MISSING, MONTHS
from tidewell.operators.series import climate_long
from tidewell.plans.base import table
from tidewell.session import spread


# ---- monthly series by city: supplier nation takes the place of the city ----
def monthly_sums(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice", "l_shipdate")
    su = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    na = table(spark, d, "nation").select("n_nationkey", "n_name")
    # nation names are joined after the aggregation: the big join carries integers only
    sums = (
        li.join(su, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", F.year("l_shipdate").alias("YEAR"), F.month("l_shipdate").alias("m"))
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("v"))
    )
    return sums.join(na, F.col("s_nationkey") == F.col("n_nationkey")).select(F.lower("n_name").alias("city"), "YEAR", "m", "v")


def station_table(spark: SparkSession, d: str) -> DataFrame:
    """Wide: city, YEAR, JAN..DEC, the season columns and the annual mean; 999.9 where a month is missing."""
    wide = monthly_sums(spark, d).groupBy("city", "YEAR").pivot("m", list(range(1, 13))).agg(F.first("v"))
    months = [F.coalesce(F.col(str(i + 1)), F.lit(MISSING)).alias(name) for i, name in enumerate(MONTHS)]
    seasons = [F.lit(MISSING).alias(c) for c in ["D-J-F", "M-A-M", "J-J-A", "S-O-N", "metANN"]]
    return wide.select("city", "YEAR", *months, *seasons)


def series(spark: SparkSession, d: str) -> DataFrame:
    return climate_long(station_table(spark, d))


SERIES_SQL = """
sums AS (
  SELECT lower(n_name) AS city0, year(l_shipdate) AS y, month(l_shipdate) AS m,
         round(sum(l_extendedprice), 2) AS v
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL),
series AS (
  SELECT array_to_string(list_transform(string_split(c.city0, '_'), lambda x: upper(x[1]) || lower(x[2:])), '_') AS city,
         s.v AS temperature, make_date(c.y, k.m, 1) AS date
  FROM (SELECT DISTINCT city0, y FROM sums) c
  CROSS JOIN (SELECT unnest(range(1, 13)) AS m) k
  LEFT JOIN sums s ON s.city0 = c.city0 AND s.y = c.y AND s.m = k.m)
"""


# ---- weekly counts by area: order weeks and customer nations ----
def weekly_counts(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    counts = (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.to_date(F.date_trunc("week", "o_orderdate")).alias("week_date"))
        .agg(F.count(F.lit(1)).alias("cases"))
    )
    return counts.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "week_date", F.col("n_name").alias("states"), "cases"
    )


def populations(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("population"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("states"), "population")


WEEKLY_SQL = """
weekly AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_date, n_name AS states, count(*) AS cases
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL),
pops AS (
  SELECT n_name AS states, count(*) AS population
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
"""


# ---- polygons: every nation is a unit square on a grid five wide ----
def polygons(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    x, y = (F.col("n_nationkey") % 5).cast("double"), F.floor(F.col("n_nationkey") / 5).cast("double")

    def pt(dx, dy):
        return F.struct((x + dx).alias("x"), (y + dy).alias("y"))

    ring = F.array(pt(0.0, 0.0), pt(1.0, 0.0), pt(1.0, 1.0), pt(0.0, 1.0), pt(0.0, 0.0))
    return n.select("n_nationkey", "name", F.array(ring).alias("geometry"))


POLYGON_EDGES_SQL = """
edges AS (
  SELECT a.n_nationkey AS src, b.n_nationkey AS dst
  FROM nation a JOIN nation b ON a.n_nationkey <> b.n_nationkey
   AND abs(a.n_nationkey % 5 - b.n_nationkey % 5) <= 1
   AND abs(a.n_nationkey // 5 - b.n_nationkey // 5) <= 1)
"""


# ---- a sparse graph over many nodes: customers linked by a hashed rule ----
def customer_edges(spark: SparkSession, d: str) -> DataFrame:
    """Undirected edges between customers: each links to a hashed lower key in its own block of 16.

    About a third link to nothing, so components of many sizes and single nodes exist.
    """
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("src"))
    base = F.floor(F.col("src") / 16) * 16
    target = base + F.floor((F.col("src") - base) * uniform(F.col("src"), seed=5)).cast("long")
    e = c.where(uniform(F.col("src"), seed=6) < 0.66).select("src", target.alias("dst")).where("src <> dst")
    return e.union(e.select(F.col("dst"), F.col("src"))).distinct()


CUSTOMER_EDGES_SQL = f"""
half AS (
  SELECT c_custkey AS src,
         (c_custkey // 16) * 16 + CAST(floor((c_custkey % 16) * {uniform_sql('c_custkey', seed=5)}) AS BIGINT) AS dst
  FROM customer WHERE {uniform_sql('c_custkey', seed=6)} < 0.66),
cedges AS (
  SELECT src, dst FROM half WHERE src <> dst UNION SELECT dst, src FROM half WHERE src <> dst)
"""


# ---- text ----
def articles(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, text, label, split: the language is the class, every fifth document is held out."""
    return spread(
        table(spark, d, "documents").select(
            "doc_id",
            "text",
            F.col("lang").alias("label"),
            F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train").alias("split"),
        )
    )


def plain_texts(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def doc_words(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.explode(words(F.col("text"))).alias("token"))


WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
MARKS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')"
SPACES_SQL = r"list_filter(regexp_split_to_array(text, '[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]+'), lambda w: w <> '')"


# ---- draws and curves: hashed values on the keys of a given table ----
def area_draws(spark: SparkSession, d: str, n_draws: int = 40) -> DataFrame:
    """Latent field draws ``x``, ``w`` per (area, sample), for areas that have observations."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("area"))
    s = n.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(n_draws - 1))))
    return s.select(
        "area",
        "sample",
        (F.lit(0.3) * normal(F.col("area"), F.col("sample"), seed=11)).alias("x"),
        (F.lit(0.1) * normal(F.col("area"), F.col("sample"), seed=21)).alias("w"),
    )


def scalar_draws(spark: SparkSession, d: str, n_draws: int = 40) -> DataFrame:
    """``alpha``, ``sigma``, ``rho``, ``beta0`` per sample."""
    s = (
        table(spark, d, "region")
        .agg(F.min("r_regionkey").alias("lo"))
        .select(F.explode(F.sequence(F.lit(0), F.lit(n_draws - 1))).alias("sample"))
    )
    return s.select(
        "sample",
        (F.lit(0.3) + F.lit(0.4) * uniform(F.col("sample"), seed=31)).alias("alpha"),
        (F.lit(0.1) + F.lit(0.2) * uniform(F.col("sample"), seed=32)).alias("sigma"),
        (F.lit(0.1) + F.lit(0.2) * uniform(F.col("sample"), seed=33)).alias("rho"),
        (F.lit(0.1) * normal(F.col("sample"), seed=34)).alias("beta0"),
    )


def draws_sql(n_draws: int = 40) -> str:
    return f"""
area_draws AS (
  SELECT CAST(n_nationkey AS BIGINT) AS area, s.sample,
         0.3::DOUBLE * {normal_sql('n_nationkey', 's.sample', seed=11)} AS x,
         0.1::DOUBLE * {normal_sql('n_nationkey', 's.sample', seed=21)} AS w
  FROM nation CROSS JOIN (SELECT unnest(range(0, {n_draws})) AS sample) s),
scalar_draws AS (
  SELECT sample, 0.3::DOUBLE + 0.4::DOUBLE * {uniform_sql('sample', seed=31)} AS alpha,
         0.1::DOUBLE + 0.2::DOUBLE * {uniform_sql('sample', seed=32)} AS sigma,
         0.1::DOUBLE + 0.2::DOUBLE * {uniform_sql('sample', seed=33)} AS rho,
         0.1::DOUBLE * {normal_sql('sample', seed=34)} AS beta0
  FROM (SELECT unnest(range(0, {n_draws})) AS sample))
"""


def loss_curve(spark: SparkSession, d: str) -> DataFrame:
    """run, step, loss: one run per event type, one step per event in id order."""
    from tidewell.operators.ordered import position

    e = table(spark, d, "events").select(F.col("event_type").alias("run"), "event_id", F.col("value").alias("loss"))
    return position(e, ["event_id"], ["run"], "step", width=1 << 16).select("run", "step", "loss", "event_id")


CURVE_SQL = """
curve AS (
  SELECT event_type AS run, event_id, value AS loss,
         row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS step
  FROM events)
"""
