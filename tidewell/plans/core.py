"""Plain table operators, curves, sources, stores, streams and the function surface."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import dates as dt
from tidewell.functions import numeric as nm
from tidewell.functions.hashing import uniform, uniform_sql
from tidewell.functions.text import title_parts
from tidewell.operators import summaries as sm
from tidewell.operators.ordered import affine_scan, running, top_n_per_key
from tidewell.operators.reshape import MONTHS, replace_strict
from tidewell.plans.base import query, table
from tidewell.plans.standins import CURVE_SQL, SERIES_SQL, loss_curve, polygons, station_table
from tidewell.session import scratch_path, spread
from tidewell.sources import files, stores


# ---- projections and filters ----
@query("p2_select_rename", "SELECT p_partkey AS part, p_brand AS brand, p_size AS size FROM part")
def p2(spark, d):
    return table(spark, d, "part").drop("p_name", "p_type", "p_retailprice").withColumnsRenamed(
        {"p_partkey": "part", "p_brand": "brand", "p_size": "size"}
    )


@query("p5_not_in", "SELECT n_nationkey, n_name FROM nation WHERE n_name NOT IN ('NATION_1', 'NATION_4', 'NATION_9')")
def p5(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return n.where(~F.col("n_name").isin("NATION_1", "NATION_4", "NATION_9"))


@query("p5_anti_join", "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def p5_anti(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_nationkey").join(big, "c_custkey", "left_anti")


@query("p6_drop_null_rows", "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL")
def p6(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").dropna(subset=["quality"])


@query("p6_null_rows", "SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL")
def p6_null(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    j = docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.where(F.col("quality").isNull()).select("doc_id", "lang")


@query("p7_strict_replace", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Building' WHEN 'MACHINERY' THEN 'Machinery' END AS segment FROM customer")
def p7(spark, d):
    lookup = spark.createDataFrame([("BUILDING", "Building"), ("MACHINERY", "Machinery")], "k string, v string")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return replace_strict(c, "c_mktsegment", lookup, "k", "v", "segment").select("c_custkey", "segment")


@query("p8_casts", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS SMALLINT) AS q16, CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS tax32, TRY_CAST(l_returnflag AS INTEGER) AS bad FROM lineitem")
def p8(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("smallint").alias("q16"),
        F.col("l_tax").cast("float").cast("double").alias("tax32"), F.col("l_returnflag").try_cast("int").alias("bad"),
    )


# ---- aggregates, sorts, limits ----
@query("a15_flag_count", "SELECT c_nationkey, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END)::BIGINT AS n_negative FROM customer GROUP BY c_nationkey")
def a15(spark, d):
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.sum((F.col("c_acctbal") < 0).cast("int")).alias("n_negative"))


@query("t1_sort", "SELECT c_nationkey, c_custkey, c_acctbal FROM customer ORDER BY c_nationkey, c_custkey")
def t1(spark, d):
    return table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal").orderBy("c_nationkey", "c_custkey")


@query(
    "t2_top_per_group",
    "SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 10",
)
def t2(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return top_n_per_key(o, ["o_orderpriority"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query("t4_limit", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 20")
def t4(spark, d):
    return table(spark, d, "events").select("event_id", "value").orderBy("event_id").limit(20)


@query("t8_union_all", "SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def t8(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    s = table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return c.unionByName(s)


# ---- curves ----
@query("w4_cumulative_sum", f"WITH {CURVE_SQL} SELECT run, step, CAST(sum(event_id % 7 + 1) OVER (PARTITION BY run ORDER BY step) AS BIGINT) AS tokens_seen FROM curve")
def w4(spark, d):
    r = running(loss_curve(spark, d), ["step"], {"tokens_seen": ("sum", F.col("event_id") % 7 + 1)}, ["run"], width=1 << 16)
    return r.select("run", "step", "tokens_seen")


@query(
    "w6_ema",
    f"""WITH RECURSIVE {CURVE_SQL}, s AS (SELECT run, step, loss, step // 50 - 1 AS k FROM curve WHERE step > 0 AND step % 50 = 0),
        e AS (SELECT run, step, k, loss AS ema FROM s WHERE k = 0
        UNION ALL SELECT c.run, c.step, c.k, 0.1::DOUBLE * c.loss + 0.9::DOUBLE * e.ema FROM e JOIN s c ON c.run = e.run AND c.k = e.k + 1)
        SELECT run, step, round(ema, 6) AS ema FROM e""",
)
def w6(spark, d):
    """The average is updated with the losses that are sampled, every 50th after the first."""
    sampled = loss_curve(spark, d).where("step > 0 AND step % 50 = 0")
    e = sm.ema(sampled, ["run"], "step", "loss", 0.1)
    return e.select("run", "step", F.round("ema", 6).alias("ema"))


@query(
    "w7_recurrence",
    f"""WITH RECURSIVE {CURVE_SQL}, x AS (SELECT run, step, 0.7::DOUBLE * (1.0::DOUBLE / 3.0::DOUBLE) + loss AS x FROM curve WHERE step = 0
        UNION ALL SELECT c.run, c.step, 0.7::DOUBLE * x.x + c.loss FROM x JOIN curve c ON c.run = x.run AND c.step = x.step + 1)
        SELECT run, step, round(x, 6) AS x FROM x""",
)
def w7(spark, d):
    """``x_t = alpha x_(t-1) + w_t`` along each run, from a given start."""
    c = loss_curve(spark, d)
    return affine_scan(c, ["run"], "step", F.lit(0.7), F.col("loss"), "x", x0=1.0 / 3.0).select("run", "step", F.round("x", 6).alias("x"))


@query(
    "w8_early_stop",
    f"""WITH {CURVE_SQL}, b AS (SELECT *, min(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bb FROM curve),
        h AS (SELECT run, step, least(loss, coalesce(bb, loss)) AS best, step - max(CASE WHEN bb IS NULL OR loss < bb THEN step END) OVER (PARTITION BY run ORDER BY step) AS wait FROM b),
        s AS (SELECT run, min(step) AS stop_step FROM h WHERE wait >= 5 GROUP BY run)
        SELECT h.run, step, best, wait, stop_step, CAST(step >= stop_step AS INTEGER) AS stopped FROM h LEFT JOIN s ON h.run = s.run""",
)
def w8(spark, d):
    from tidewell.session import cut_lineage

    c = cut_lineage(loss_curve(spark, d))
    return sm.early_stop(c, ["run"], "step", "loss", 5).select("run", "step", "best", "wait", "stop_step", "stopped")


@query(
    "w9_running_mean",
    f"WITH {CURVE_SQL} SELECT run, step, (sum(CAST(round(loss * 100) AS BIGINT)) OVER w)::DOUBLE / (count(*) OVER w)::DOUBLE AS mean_cents FROM curve WINDOW w AS (PARTITION BY run ORDER BY step)",
)
def w9(spark, d):
    """In whole hundredths, so that the sums do not depend on their order."""
    cents = F.round(F.col("loss") * 100).cast("long")
    r = running(loss_curve(spark, d), ["step"], {"s": ("sum", cents), "n": ("sum", F.lit(1))}, ["run"], width=1 << 16)
    return r.select("run", "step", (F.col("s") / F.col("n")).alias("mean_cents"))


# ---- scalar functions ----
@query(
    "f1_title_case",
    "SELECT source, lang || '_' || source AS key, upper(lang[1]) || lang[2:] || '_' || upper(source[1]) || source[2:] AS title FROM (SELECT DISTINCT lang, source FROM documents)",
)
def f1(spark, d):
    k = table(spark, d, "documents").select("lang", "source").distinct()
    key = F.concat_ws("_", "lang", "source")
    return k.select("source", key.alias("key"), title_parts(key).alias("title"))


@query(
    "f_date",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month_no, strftime(make_date(year(o_orderdate), month(o_orderdate), 1), '%Y-%m-%d') AS month_start,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') AS later, strftime(CAST(o_orderdate AS DATE) - 30, '%Y-%m-%d') AS earlier FROM orders""",
)
def f_date(spark, d):
    """Dates go through text in the two formats the inputs use."""
    o = table(spark, d, "orders").select(
        "o_orderkey", F.upper(F.date_format("o_orderdate", "MMM")).alias("name"), F.year("o_orderdate").alias("y"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("iso"),
    )
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    day = dt.iso_text_to_date(F.col("iso"))
    m = dt.month_number(F.col("name"))
    return o.select(
        "o_orderkey", m.alias("month_no"), iso(dt.month_start(F.col("y"), m)).alias("month_start"), iso(day).alias("day"),
        iso(F.date_add(day, 30)).alias("later"), iso(F.date_sub(day, 30)).alias("earlier"),
    )


@query(
    "f_math",
    """SELECT event_id, round(ln(value + 1), 6) AS l, round(exp(-value / 10), 6) AS e, round(sqrt(value), 6) AS s, round(pow(value, 0.75::DOUBLE), 6) AS p,
       round(sin(value), 6) AS si, round(cos(value), 6) AS co, round(ln(1 + value), 6) AS l1, greatest(value, 10.0::DOUBLE) AS g, abs(value - 20) AS a,
       CASE WHEN event_id % 9 > 0 THEN round(1 + log10(event_id % 9), 6) ELSE 0 END AS tf FROM events""",
)
def f_math(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select(
        "event_id", F.round(F.log(v + 1), 6).alias("l"), F.round(F.exp(-v / 10), 6).alias("e"), F.round(F.sqrt(v), 6).alias("s"),
        F.round(F.pow(v, F.lit(0.75)), 6).alias("p"), F.round(F.sin(v), 6).alias("si"), F.round(F.cos(v), 6).alias("co"),
        F.round(F.log1p(v), 6).alias("l1"), F.greatest(v, F.lit(10.0)).alias("g"), F.abs(v - 20).alias("a"),
        F.round(nm.log_tf(F.col("event_id") % 9), 6).alias("tf"),
    )


@query(
    "f15_logistic_loss",
    f"SELECT event_id, round(greatest(z, 0) - z * y + ln(1 + exp(-abs(z))), 6) AS loss FROM (SELECT event_id, value - 20 AS z, CAST({uniform_sql('event_id', seed=2)} < 0.5 AS DOUBLE) AS y FROM events)",
)
def f15(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("value") - 20).alias("z"), (uniform(F.col("event_id"), seed=2) < 0.5).cast("double").alias("y"))
    return e.select("event_id", F.round(nm.bce_with_logits(F.col("z"), F.col("y")), 6).alias("loss"))


@query("f19_to_json", """SELECT n_nationkey, '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS record FROM nation""")
def f19(spark, d):
    n = table(spark, d, "nation")
    return n.select("n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("record"))


# ---- sources and sinks: written from the given tables, then read back ----
_STATION = T.StructType([T.StructField("YEAR", T.IntegerType())] + [T.StructField(m, T.DoubleType()) for m in MONTHS])


@query("s1_keyed_csv", f"WITH {SERIES_SQL} SELECT lower(city) AS city, count(DISTINCT year(date)) AS n_years, count(*) - count(temperature) AS n_missing FROM series GROUP BY city")
def s1(spark, d):
    path = scratch_path(spark, "stations")
    w = station_table(spark, d).select(F.concat(F.lit("station_"), "city").alias("name"), "YEAR", *MONTHS)
    w.repartition("name").write.partitionBy("name").option("header", True).csv(path)
    back = files.keyed_csv(spark, path, _STATION, "city", r"name=station_([^/]+)/", "file_path")
    missing = sum((F.col(m) == 999.9).cast("int") for m in MONTHS)
    return back.groupBy("city").agg(F.countDistinct("YEAR").alias("n_years"), F.sum(missing).alias("n_missing"))


@query("s2_csv_scan", f"WITH {CURVE_SQL} SELECT run, step, loss FROM curve")
def s2(spark, d):
    path = scratch_path(spark, "curves")
    loss_curve(spark, d).select("run", "step", "loss").write.option("header", True).csv(path)
    return files.csv_table(spark, path, "run string, step long, loss double")


@query("s3_parquet_scan", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def s3(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s4_parquet_sink", "SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment")
def s4(spark, d):
    path = scratch_path(spark, "customers")
    table(spark, d, "customer").select("c_mktsegment", "c_acctbal").write.parquet(path)
    return spark.read.parquet(path).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("s5_json_dictionary", "SELECT n_name AS key, CAST(n_regionkey AS VARCHAR) AS value FROM nation")
def s5(spark, d):
    """One flat object per region, each in its own file."""
    path = scratch_path(spark, "dictionary")
    n = table(spark, d, "nation").select("n_regionkey", "n_name")
    pairs = F.map_from_entries(F.collect_list(F.struct("n_name", F.col("n_regionkey").cast("string"))))
    objects = n.groupBy("n_regionkey").agg(F.to_json(pairs).alias("value"))
    objects.repartition(5, "n_regionkey").select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.json_dictionary(spark, path)


@query("s6_json_records", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_custkey AS customer, o_totalprice AS price FROM orders")
def s6(spark, d):
    path = scratch_path(spark, "records")
    o = table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("day"), F.col("o_custkey").cast("string").alias("customer"), F.col("o_totalprice").cast("string").alias("price")
    )
    o.write.json(path)
    r = files.json_records(spark, path, ["day", "customer", "price"])
    day = dt.iso_text_to_date(F.col("day"))
    return r.select(F.date_format(day, "yyyy-MM-dd").alias("day"), F.col("customer").cast("long").alias("customer"), F.col("price").cast("double").alias("price"))


@query("s7_pushed_filter_limit", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' ORDER BY o_orderkey LIMIT 1000")
def s7(spark, d):
    o = table(spark, d, "orders")
    since = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return files.pushed_rows(o, since, ["o_orderkey"], 1000).select("o_orderkey", "o_totalprice")


@query("s8_geojson", "SELECT n_name AS name, 5 AS n_points, CAST(n_nationkey % 5 AS DOUBLE) AS x0, CAST(n_nationkey // 5 AS DOUBLE) AS y0 FROM nation")
def s8(spark, d):
    """Areas with odd numbers of letters are written as multi-polygons."""
    path = scratch_path(spark, "areas")
    ring = lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))
    rings = F.transform("geometry", ring)
    several = F.length("name") % 2 == 1
    f = polygons(spark, d).select(
        F.concat(
            F.lit('{"properties": '), F.to_json(F.struct("name")), F.lit(', "geometry": {"type": "'),
            F.when(several, "MultiPolygon").otherwise("Polygon"), F.lit('", "coordinates": '),
            F.when(several, F.to_json(F.array(rings))).otherwise(F.to_json(rings)), F.lit("}}"),
        ).alias("value")
    )
    f.write.text(path)
    g = files.geojson_polygons(spark, path, one_feature_per_line=True)
    first = F.element_at(F.col("geometry"), 1)
    return g.select("name", F.size(first).alias("n_points"), F.element_at(first, 1)["x"].alias("x0"), F.element_at(first, 1)["y"].alias("y0"))


@query("s9_arrow_folder", "SELECT doc_id, text FROM documents")
def s9(spark, d):
    from tidewell.sources.arrow_ipc import read_arrow_folder, write_arrow_folder

    path = scratch_path(spark, "shards")
    # as many shards as the input has splits, so that a task's share does not grow with the table
    write_arrow_folder(spread(table(spark, d, "documents").select("doc_id", "text")), path)
    return read_arrow_folder(spark, path)


@query(
    "s10_whole_texts",
    "SELECT lang, count(*) AS n_lines, sum(length(replace(replace(text, chr(10), ' '), chr(13), ' ')) + 1)::BIGINT AS n_chars FROM documents GROUP BY lang",
)
def s10(spark, d):
    """Documents as lines of text files, read back as whole files."""
    path = scratch_path(spark, "books")
    docs = table(spark, d, "documents").select("lang", F.translate("text", "\n\r", "  ").alias("value"))
    docs.write.partitionBy("lang").option("maxRecordsPerFile", 1000).text(path)
    w = files.whole_texts(spark, path).withColumn("lang", F.regexp_extract("path", r"lang=([^/]+)/", 1))
    lines = F.size(F.split("text", "\n")) - 1
    return w.groupBy("lang").agg(F.sum(lines).cast("long").alias("n_lines"), F.sum(F.length("text")).cast("long").alias("n_chars"))


@query(
    "s10_text_lines",
    r"""SELECT line, count(*) AS n FROM (
          SELECT regexp_replace(unnest(string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))), '^\s+|\s+$', '', 'g') AS line
          FROM documents) GROUP BY line""",
)
def s10_lines(spark, d):
    """Texts between marker lines as files, read back line by line without the markers."""
    path = scratch_path(spark, "lines")
    markers = [F.lit(f"{m} THE BOOK ***") for m in files.MARKER_LINES]
    whole = F.concat(markers[0], F.lit("\n"), F.col("text"), F.lit("\n"), markers[1])
    table(spark, d, "documents").where("text IS NOT NULL").select(whole.alias("value")).write.text(path)
    return files.book_lines(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("s12_bounded_files", "SELECT count(*) AS n_rows, 1 AS within_bound FROM lineitem")
def s12(spark, d):
    path = scratch_path(spark, "bounded")
    files.write_bounded(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), path, 1000)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 1000).cast("int").alias("within_bound"))


@query("s14_model_store", f"WITH {SERIES_SQL} SELECT city, round(avg(temperature), 4) AS y_mean, round(stddev_pop(temperature), 4) AS y_std FROM series WHERE city IN ('Nation_3', 'Nation_8') GROUP BY city")
def s14(spark, d):
    """Per-city parameters; two cities are read back from their own folders."""
    from tidewell.plans.standins import series

    store = stores.KeyedStore(scratch_path(spark, "models"), "city")
    s = series(spark, d).groupBy("city").agg(F.round(F.avg("temperature"), 4).alias("y_mean"), F.round(F.stddev_pop("temperature"), 4).alias("y_std"))
    store.save(s)
    return store.load(spark, ["Nation_3", "Nation_8"]).select("city", "y_mean", "y_std")


@query("s15_forecast_store", "SELECT n_name AS city, chain, count(*) AS n, min(draw) AS lo, max(draw) AS hi FROM nation CROSS JOIN (SELECT unnest(range(0, 4)) AS chain) CROSS JOIN (SELECT unnest(range(0, 50)) AS draw) CROSS JOIN (SELECT unnest(range(0, 12)) AS obs_id) GROUP BY n_name, chain")
def s15(spark, d):
    seq = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    x = table(spark, d, "nation").select(F.col("n_name").alias("city"), F.col("n_nationkey").alias("k"))
    x = x.withColumn("chain", seq(4)).withColumn("draw", seq(50)).withColumn("obs_id", seq(12))
    store = stores.ForecastStore(scratch_path(spark, "forecasts"))
    store.save(x.withColumn("value", uniform(F.col("k"), F.col("chain"), F.col("draw"), F.col("obs_id"))).drop("k"))
    return store.load(spark).groupBy("city", "chain").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("lo"), F.max("draw").alias("hi"))


@query(
    "s16_run_log",
    "SELECT 'run1/' || c_mktsegment AS run_id, 'run1' AS parent_run_id, c_mktsegment AS city, 'metric' AS kind, 'n' AS key, CAST(count(*) AS VARCHAR) AS value FROM customer GROUP BY c_mktsegment UNION ALL SELECT 'run1', NULL, NULL, 'parameter', 'n_ahead', '12'",
)
def s16(spark, d):
    log = stores.RunLog(scratch_path(spark, "runs"))
    m = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    log.append_parameters(spark, "run1", {"n_ahead": 12})
    log.append_metrics(m, "run1", "c_mktsegment", ["n"])
    return log.read(spark)


# ---- streams ----
def _arriving(spark, d):
    path = scratch_path(spark, "arriving")
    table(spark, d, "documents").select("doc_id", "text").repartitionByRange(6, "doc_id").write.parquet(path)
    return path


@query("v2_stream_word_counts", r"SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS token FROM documents) GROUP BY token")
def v2(spark, d):
    from tidewell.streaming import jobs

    out, mark = scratch_path(spark, "counts"), scratch_path(spark, "mark")
    stream = jobs.text_stream(spark, _arriving(spark, d), files_per_batch=2)
    jobs.drain_to_table(jobs.word_counts(stream), out, mark, "update")
    return jobs.latest_counts(spark, out)


@query("v1_stream_windows")
def v1(spark, d):
    from tidewell.plans.tokens import _word_vocab
    from tidewell.streaming import jobs

    out, mark = scratch_path(spark, "windows"), scratch_path(spark, "mark")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = jobs.text_stream(spark, _arriving(spark, d), files_per_batch=2)
        jobs.drain_to_table(jobs.token_windows(stream, _word_vocab(spark, d), 64, shards=16), out, mark)
    finally:
        # a stream takes the provider from its session; others keep theirs
        if before is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, before)
    w = spark.read.parquet(out)
    return w.groupBy("shard").agg(F.count(F.lit(1)).alias("n_windows"), F.min(F.size("inputs")).alias("shortest"), F.max(F.size("targets")).alias("longest"))


# ---- function surface ----
@query("u1_chained_nodes", f"WITH {SERIES_SQL} SELECT city, CAST(year(date) AS INTEGER) AS yr, count(temperature) AS n FROM series GROUP BY ALL")
def u1(spark, d):
    """Table functions chained with ``transform``."""
    from tidewell.operators.series import climate_long

    by_year = lambda df: df.groupBy("city", F.year("date").alias("yr")).agg(F.count("temperature").alias("n"))
    return station_table(spark, d).transform(climate_long).transform(by_year)


@query(
    "u2_per_key_tasks",
    """SELECT c_nationkey AS key, CASE WHEN c_nationkey = 13 THEN NULL ELSE count(*) END AS n, CASE WHEN c_nationkey = 13 THEN 'ValueError: no model for 13' END AS error
       FROM customer GROUP BY c_nationkey""",
)
def u2(spark, d):
    """A function per key; a key that fails gives a row with the reason."""
    from tidewell.operators.perkey import run_per_key

    def work(key: int, rows) -> dict:
        if key == 13:
            raise ValueError(f"no model for {key}")
        return {"n": int(rows["n"].sum())}

    # what a key's task receives is already aggregated: at most one row per market segment
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("key"), "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return run_per_key(c, "key", work, "n long")
