"""Readers, writers, stores and streaming jobs on small files."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewell.sources import files, stores
from tidewell.sources.arrow_ipc import PUSHDOWN, read_arrow_folder, write_arrow_folder
from tidewell.streaming import jobs


def test_key_from_file_name(spark, tmp_path):
    for city in ("sao_luiz", "brasilia"):
        (tmp_path / f"station_{city}.csv").write_text("YEAR,JAN\n2001,25.5\n2002,999.9\n")
    r = files.keyed_csv(spark, str(tmp_path), "YEAR int, JAN double", "city").collect()
    assert {(x["city"], x["YEAR"]) for x in r} == {(c, y) for c in ("sao_luiz", "brasilia") for y in (2001, 2002)}


def test_json_and_geojson_files(spark, tmp_path):
    (tmp_path / "map.json").write_text(json.dumps({"AL": "Alabama", "AK": "Alaska"}))
    got = {r["key"]: r["value"] for r in files.json_dictionary(spark, str(tmp_path / "map.json")).collect()}
    assert got == {"AL": "Alabama", "AK": "Alaska"}
    (tmp_path / "records.json").write_text(json.dumps([{"a": "1", "b": "x"}, {"a": "2"}]))
    r = files.json_records(spark, str(tmp_path / "records.json"), ["a", "b"], array_file=True).orderBy("a").collect()
    assert [(x["a"], x["b"]) for x in r] == [("1", "x"), ("2", None)]
    feature = {"type": "Feature", "properties": {"name": "S"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 1], [0, 0]]]}}
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    g = files.geojson_polygons(spark, str(tmp_path / "g.json")).first()
    assert g["name"] == "S" and [(p["x"], p["y"]) for p in g["geometry"][0]] == [(0, 0), (1, 0), (0, 1), (0, 0)]


def test_arrow_folder_round_trip(spark, tmp_path):
    d = spark.range(100).select("id", F.array("id", F.col("id") * 2).alias("v"), F.col("id").cast("string").alias("s"))
    write_arrow_folder(d.repartition(3), str(tmp_path / "shards"))
    back = read_arrow_folder(spark, str(tmp_path / "shards"))
    assert back.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, d.collect()))
    assert back.select("s").count() == 100


def test_arrow_file_is_read_in_slices_of_batches(spark, tmp_path):
    rows = pa.table({"id": list(range(5000)), "s": [f"t{i}" for i in range(5000)], "x": [float("nan") if i % 2 else 1.0 * i for i in range(5000)]})
    with pa.OSFile(str(tmp_path / "one.arrow"), "wb") as f, pa.ipc.new_file(f, rows.schema) as w:
        w.write_table(rows, max_chunksize=100)
    with pa.OSFile(str(tmp_path / "two.arrows"), "wb") as f, pa.ipc.new_stream(f, rows.schema) as w:
        w.write_table(rows, max_chunksize=100)
    size = (tmp_path / "one.arrow").stat().st_size
    d = read_arrow_folder(spark, str(tmp_path), split_bytes=size // 10)
    assert 10 <= d.rdd.getNumPartitions() - 1 <= 13
    assert d.agg(F.count("*"), F.sum("id")).first()[:] == (10_000, 2 * sum(range(5000)))
    narrow = read_arrow_folder(spark, str(tmp_path), "s string, id long")
    assert narrow.columns == ["s", "id"] and narrow.where("s = 't7'").collect()[0]["id"] == 7


def test_arrow_filters_are_spark_filters(spark, tmp_path):
    spark.createDataFrame(
        [(1, "a", 1.0), (2, None, float("nan")), (None, "c", None), (4, "é", -1.0), (5, "", 5.0)], "i int, s string, x double"
    ).coalesce(1).write.parquet(str(tmp_path / "p"))
    plain = spark.read.parquet(str(tmp_path / "p"))
    write_arrow_folder(plain, str(tmp_path / "a"))
    spark.conf.set(PUSHDOWN, "true")
    try:
        arrow = read_arrow_folder(spark, str(tmp_path / "a"))
        rules = ["i > 1", "i >= 2 AND i < 5", "i <= 4", "i = 4", "i <=> NULL", "i IN (1, 5, NULL)", "NOT (i = 4)", "i IS NULL", "s IS NOT NULL",
                 "s > 'b'", "s = ''", "s LIKE 'c%'", "x > 0", "x = double('NaN')", "i > 1 OR s = 'a'", "i = 1 AND s = 'a'"]
        for rule in rules:
            assert sorted(map(repr, arrow.where(rule).collect())) == sorted(map(repr, plain.where(rule).collect())), rule
    finally:
        spark.conf.unset(PUSHDOWN)
    assert read_arrow_folder(spark, str(tmp_path / "a")).where("i > 1").count() == 3


def test_arrow_empty_table_overwrite_and_failed_job(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id long, v array<double>, at timestamp, m struct<a:string>"
    write_arrow_folder(spark.createDataFrame([], schema), path)
    back = read_arrow_folder(spark, path)
    assert back.columns == ["id", "v", "at", "m"] and back.count() == 0 and back.collect() == []
    ids = lambda: sorted(r["id"] for r in read_arrow_folder(spark, path, "id long").collect())
    full = spark.range(20).selectExpr("id", "array(id * 1.0D) AS v", "timestamp'2020-01-01' AS at", "named_struct('a', 'b') AS m").repartition(3)
    write_arrow_folder(full, path)
    assert ids() == list(range(20))
    with pytest.raises(Exception, match="planted"):
        broken = full.where("id >= 0").selectExpr("if(id = 19, raise_error('planted'), id) AS id", "v", "at", "m")
        write_arrow_folder(broken.withColumn("id", F.col("id").cast("long")), path, "overwrite")
    assert ids() == list(range(20)) and not [f for f in os.listdir(path) if not f.endswith(".arrow")]
    write_arrow_folder(full.where("id < 5"), path, "overwrite")
    assert ids() == list(range(5))
    write_arrow_folder(full.where("id < 0"), path)
    assert ids() == list(range(5))
    write_arrow_folder(full.where("id < 0"), path, "overwrite")
    assert ids() == [] and not [f for f in os.listdir(path) if not f.endswith(".arrow")]


def test_store_replaces_only_its_keys(spark, tmp_path):
    store = stores.KeyedStore(str(tmp_path / "m"), "city")
    store.save(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "city string, y double"))
    store.save(spark.createDataFrame([("b", 3.0)], "city string, y double"))
    assert {(r["city"], r["y"]) for r in store.load(spark).collect()} == {("a", 1.0), ("b", 3.0)}
    one = store.load(spark, ["a"])
    assert "PartitionFilters: [" in one._jdf.queryExecution().toString()
    assert one.count() == 1


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id * 2 AS v", "id * 3 AS w").write.parquet(str(tmp_path / "t"))
    r = files.pushed_rows(spark.read.parquet(str(tmp_path / "t")), F.col("id") >= 10, ["id"], 5).select("id", "v")
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,10)" in plan and "w" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert [x["id"] for x in r.collect()] == [10, 11, 12, 13, 14]


def test_stream_counts_and_windows(spark, tmp_path):
    texts = [" ".join(f"t{(i * 7 + k) % 11}" for k in range(i % 9)) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.repartitionByRange(5, "doc_id").write.parquet(str(tmp_path / "in"))
    stream = jobs.text_stream(spark, str(tmp_path / "in"), files_per_batch=2)
    jobs.drain_to_table(jobs.word_counts(stream), str(tmp_path / "c"), str(tmp_path / "c_mark"), "update")
    want = {}
    for t in texts:
        for w in t.split():
            want[w] = want.get(w, 0) + 1
    assert {r["token"]: r["n"] for r in jobs.latest_counts(spark, str(tmp_path / "c")).collect()} == want

    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    ids = {f"t{i}": i + 2 for i in range(11)}
    vocab = spark.createDataFrame(list(ids.items()), "token string, id int")
    # one file per batch, in order, so that a shard's documents arrive by id
    for i in range(3):
        docs.where(f"doc_id >= {i * 20} AND doc_id < {i * 20 + 20}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in2"))
    stream = jobs.text_stream(spark, str(tmp_path / "in2"), files_per_batch=1)
    jobs.drain_to_table(jobs.token_windows(stream, vocab, 5, shards=4), str(tmp_path / "w"), str(tmp_path / "w_mark"))
    got = {(r["shard"], r["window"]): (r["inputs"], r["targets"]) for r in spark.read.parquet(str(tmp_path / "w")).collect()}
    shard = {r["doc_id"]: r["s"] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(4)).alias("s")).collect()}
    n = 0
    for s in range(4):
        toks = [ids[w] for i, t in enumerate(texts) if shard[i] == s for w in t.split()]
        for k in range(max((len(toks) - 1) // 5, 0)):
            assert got[s, k] == (toks[k * 5 : k * 5 + 5], toks[k * 5 + 1 : k * 5 + 6])
            n += 1
    assert n == len(got) > 0


def test_shards_follow_the_input_not_a_fixed_number(spark, tmp_path):
    from tidewell.plans import core

    spark.range(400).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).repartition(20).write.parquet(str(tmp_path / "documents.parquet"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "2k")
        d = core.s9(spark, str(tmp_path))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert d.rdd.getNumPartitions() >= 16 and d.count() == 400
