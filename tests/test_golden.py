"""Small worked examples with known answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidewell.functions import numeric as nm
from tidewell.functions import text as tx
from tidewell.functions.dates import month_number
from tidewell.operators import classify, cooccur, corpus, graph, summaries, terms, wordpiece, wordvec
from tidewell.operators.incidence import log_factorial

SENTENCE = "the quick brown fox jumps over the lazy dog"


def words_df(spark, text=SENTENCE):
    return spark.createDataFrame([(0, text.split())], "doc_id long, t array<string>")


def test_csr_and_product(spark):
    triples = spark.createDataFrame([(0, 2, 1), (1, 0, 4), (1, 2, 2), (2, 1, 2)], "row long, col long, value long")
    rows = terms.csr_rows(triples).orderBy("row").collect()
    assert [v for r in rows for v in r["data"]] == [1, 4, 2, 2]
    assert [v for r in rows for v in r["indices"]] == [2, 0, 2, 1]
    assert [0] + [r["end"] for r in rows] == [0, 1, 3, 4]
    w = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (3, 4)], "col long, weight long")
    assert [r["product"] for r in terms.sparse_times_dense(triples, w).orderBy("row").collect()] == [3, 10, 4]


def test_skipgram_windows(spark):
    p = cooccur.skipgram_pairs(words_df(spark), "t", 2).collect()
    assert len(p) == 20
    assert sorted(r["context"] for r in p if r["center"] == "brown") == ["fox", "jumps", "quick", "the"]
    assert len({r["center"] for r in p}) == 5
    short = words_df(spark, "a b c d")
    assert cooccur.skipgram_pairs(short, "t", 2).count() == 0


def test_cooccurrence_totals(spark):
    d = words_df(spark)
    assert cooccur.cooccurrence(d, "t", 3).agg(F.sum("n")).first()[0] == 42
    assert cooccur.cooccurrence(d, "t", 3, True).agg(F.sum("n")).first()[0] == pytest.approx(27.0)


def test_cooccurrence_over_block_edges_and_symmetry(spark):
    tokens = [f"w{i % 37}" for i in range(2500)]
    d = spark.createDataFrame([(0, tokens), (1, []), (2, ["only"])], "doc_id long, t array<string>")
    want = {}
    for i, a in enumerate(tokens):
        for j in range(max(0, i - 4), min(len(tokens), i + 5)):
            if i != j:
                want[a, tokens[j]] = want.get((a, tokens[j]), 0) + 1
    got = {(r["a"], r["b"]): r["n"] for r in cooccur.cooccurrence(d, "t", 4).collect()}
    assert got == want
    assert all(got[b, a] == n for (a, b), n in got.items())


def test_skipgram_over_block_edges(spark):
    tokens = [f"w{i}" for i in range(2100)]
    d = spark.createDataFrame([(0, tokens)], "doc_id long, t array<string>")
    got = {(r["center"], r["context"]) for r in cooccur.skipgram_pairs(d, "t", 2).collect()}
    want = {(tokens[i], tokens[i + o]) for i in range(2, 2098) for o in (-2, -1, 1, 2)}
    assert got == want


def test_merge_score(spark):
    c = spark.createDataFrame([("ab", 2), ("ac", 1)], "word string, n long")
    s = wordpiece.pair_scores(c.withColumn("pieces", wordpiece.initial_pieces(F.col("word"))), 2).collect()
    assert [(r["a"], r["b"]) for r in s] == [("a", "##b")]
    assert s[0]["score"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("n,length,stride", [(10, 4, 4), (5, 4, 4), (4, 4, 4), (23, 4, 3), (23, 4, 6), (1, 4, 4)])
def test_window_count(spark, n, length, stride):
    # three documents, one of them empty
    cut = max(n // 3, 1)
    toks = [str(i) for i in range(n)]
    d = spark.createDataFrame([(1, toks[:cut]), (2, []), (3, toks[cut:])], "doc_id long, tokens array<string>")
    w = corpus.windows(corpus.chain(d), length, stride).orderBy("window").collect()
    assert len(w) == max((n - length - 1) // stride + 1, 0)
    for i, r in enumerate(w):
        assert r["window"] == i
        assert r["inputs"] == toks[i * stride : i * stride + length]
        assert r["targets"] == toks[i * stride + 1 : i * stride + length + 1]


def test_ema(spark):
    d = spark.createDataFrame([("r", i, v) for i, v in enumerate([3.0, 2.0, 4.0, 1.0])], "run string, step long, x double")
    e = summaries.ema(d, ["run"], "step", "x", 0.1).orderBy("step").collect()
    assert e[-1]["ema"] == pytest.approx(2.809)


def test_isolated_area_has_factor_one(spark):
    nodes = spark.createDataFrame([(7,)], "node long")
    edges = spark.createDataFrame([], "src long, dst long")
    r = graph.icar_components(graph.connected_components(nodes, edges), edges).collect()
    assert [(x["n"], x["scale"], x["value"]) for x in r] == [(1, 1.0, 0.0)]


def test_text_functions(spark):
    row = spark.range(1).select(
        tx.title_parts(F.lit("sao_luiz")).alias("title"),
        tx.fold_accents(F.lit("Ça été")).alias("plain"),
        tx.tidy_joined_text(F.lit("it ' s well - known ( or not ) , he said .")).alias("tidy"),
        tx.clean_book(F.lit("x\n*** START OF THIS\n a \n\n b\n*** END OF THIS\ny")).alias("book"),
        tx.clean_book(F.lit(" no marker \n\n at all ")).alias("bare"),
        month_number(F.lit("DEC")).alias("m"),
        nm.argmax(F.array(F.lit(1.0), F.lit(5.0), F.lit(5.0))).alias("top"),
        log_factorial(F.lit(5)).alias("f5"),
        log_factorial(F.lit(150)).alias("f150"),
        nm.softmax(F.array(F.lit(1.0), F.lit(2.0))).alias("p"),
        nm.softmax(F.array(F.lit(1001.0), F.lit(1002.0))).alias("q"),
        corpus.char_ids(F.lit("aZ~é"), 6).alias("chars"),
    ).first()
    assert row["title"] == "Sao_Luiz"
    assert row["plain"] == "Ca ete"
    assert row["tidy"] == "it's well-known (or not), he said."
    assert row["book"] == "a\nb"
    assert row["bare"] == "no marker\nat all"
    assert row["m"] == 12 and row["top"] == 1
    assert row["f5"] == pytest.approx(math.log(120))
    assert row["f150"] == pytest.approx(math.lgamma(151), rel=1e-13)
    assert row["p"] == pytest.approx(row["q"])
    assert row["chars"] == [2, 53, 95, 1, 0, 0]


def test_report_and_confusion(spark):
    d = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    c = {(r["actual"], r["predicted"]): r["n"] for r in classify.confusion(d, "y", "p").collect()}
    assert len(c) == 9 and c["c", "b"] == 1 and c["c", "c"] == 0
    r = {x["label"]: x for x in classify.classification_report(d, "y", "p").collect()}
    assert r["b"]["precision"] == pytest.approx(1 / 3) and r["b"]["recall"] == 1.0
    assert r["c"]["f1"] == 0.0 and r["accuracy"]["f1"] == 0.5


def test_pair_template(spark):
    a, b = F.array(F.lit("x")), F.array(F.lit("y"), F.lit("z"))
    t, k = wordpiece.pair_template(a, b, F.lit("[CLS]"), F.lit("[SEP]"))
    r = spark.range(1).select(t.alias("t"), k.alias("k")).first()
    assert r["t"] == ["[CLS]", "x", "[SEP]", "y", "z", "[SEP]"] and r["k"] == [0, 0, 0, 1, 1, 1]


def test_ema_starts_at_the_first_row(spark):
    from tidewell.operators.summaries import ema

    df = spark.createDataFrame([("a", t, 5.0) for t in range(1, 6)], "k string, t long, v double")
    assert [r["ema"] for r in ema(df, ["k"], "t", "v").orderBy("t").collect()] == [5.0] * 5


def test_recurrence_over_gaps_and_from_a_start(spark):
    from pyspark.sql import functions as F

    from tidewell.operators.ordered import affine_scan

    steps = [*range(10), *range(1000, 1010), *range(5_000_000, 5_000_300)]
    df = spark.createDataFrame([("a", t) for t in steps], "k string, t long")
    got = [r["state"] for r in affine_scan(df, ["k"], "t", F.lit(1.0), F.lit(1.0), x0=3.0, block=4).orderBy("t").collect()]
    assert got == [4.0 + i for i in range(len(steps))]


def test_multi_polygon_keeps_its_rings(spark, tmp_path):
    from tidewell.sources.files import geojson_polygons

    lines = [
        '{"properties": {"name": "one"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 0]]]}}',
        '{"properties": {"name": "two"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [0, 0]]], [[[5, 5], [6, 5], [5, 5]]]]}}',
        '{"properties": {"name": "none"}, "geometry": null}',
    ]
    (tmp_path / "areas.json").write_text("\n".join(lines))
    got = {r["name"]: r["geometry"] for r in geojson_polygons(spark, str(tmp_path), True).collect()}
    assert len(got["one"]) == 1 and len(got["two"]) == 2 and got["none"] is None
    assert (got["two"][1][0]["x"], got["two"][1][0]["y"]) == (5.0, 5.0)
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "b.json").write_text('{"properties": {"name": "p"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}')
    import pytest

    with pytest.raises(Exception, match="geometry type Point"):
        geojson_polygons(spark, str(tmp_path / "odd"), True).collect()


def test_weeks_are_numbered_before_unnamed_areas_go(spark):
    import datetime as dt

    from tidewell.operators.incidence import expected_counts

    day = lambda n: dt.date(2020, 1, 6) + dt.timedelta(weeks=n)
    counts = spark.createDataFrame([(day(0), "a", 3), (day(1), None, 4), (day(2), "a", 5)], "week_date date, states string, cases long")
    people = spark.createDataFrame([("a", 1_000_000)], "states string, population long")
    assert sorted(r["week"] for r in expected_counts(counts, people).collect()) == [1, 3]


def test_components_of_a_path_and_lone_nodes(spark):
    from tidewell.operators.graph import connected_components

    nodes = spark.range(40).withColumnRenamed("id", "node")
    pairs = [(i, i + 1) for i in range(30)]
    edges = spark.createDataFrame(pairs + [(b, a) for a, b in pairs], "src long, dst long")
    got = dict(tuple(r) for r in connected_components(nodes, edges).select("node", "component").collect())
    assert got == {i: 0 if i <= 30 else i for i in range(40)}


def test_long_sentences_meet_in_blocks(spark):
    import itertools
    from collections import Counter

    sets = [[f"w{(i * k) % 307:03d}" for i in range(n)] for n, k in ((400, 1), (90, 3), (17, 5), (16, 7), (33, 11), (1, 1), (0, 1), (64, 0))]
    d = spark.createDataFrame([(s,) for s in [*sets, None]], "w array<string>")
    want = Counter(p for s in sets for p in itertools.combinations(sorted(set(s)), 2))
    for block in (16, 50, 512):
        got = cooccur.sentence_cooccurrence(d, "w", block=block).collect()
        assert len(got) == len(want) and {(r["a"], r["b"]): r["n"] for r in got} == want
    few = cooccur.sentence_cooccurrence(d, "w", min_count=3, block=16).collect()
    assert {(r["a"], r["b"]): r["n"] for r in few} == {p: n for p, n in want.items() if n >= 3}


def test_pairs_of_one_sentence_are_many_tasks(spark):
    words = spark.range(1).select(F.array_sort(F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda i: i.cast("string"))).alias("_w"))
    met = cooccur._meetings(words, 512)
    pairs = F.when(F.col("_same"), F.size("_l") * (F.size("_l") - 1) / 2).otherwise(F.size("_l") * F.size("_r"))
    per_task = [r["n"] for r in met.groupBy(F.spark_partition_id()).agg(F.sum(pairs).alias("n")).collect()]
    assert sum(per_task) == 100_000 * 99_999 / 2
    assert len(per_task) == 8 and max(per_task) < 1.2 * sum(per_task) / 8


def test_pairs_counted_in_small_parts(spark, monkeypatch):
    """Counts of a few pairs at a time equal the pairs themselves: repeated, null, empty and long rows."""
    import random
    from collections import Counter

    monkeypatch.setattr(cooccur, "_COUNTED", 16)
    monkeypatch.setattr(cooccur, "_HANDED", 3)
    draw = random.Random(5)
    rows = [[draw.choice("abcdé") for _ in range(n)] for n in (0, 1, 2, 4, 5, 90, 5)] + [None, ["a", "a", "b"], ["a", "a", "b"]]
    d = spark.createDataFrame([(r,) for r in rows], "t array<string>").repartition(2)
    want, near = Counter(), Counter()
    for r in rows:
        for i in range(len(r or [])):
            for j in range(max(0, i - 3), min(len(r), i + 4)):
                if i != j:
                    near[r[i], r[j], 0] += 1
                    near[r[i], r[j], 1] += 1 / abs(i - j)
                if i != j and abs(i - j) <= 2 and 2 <= i < len(r) - 2:
                    want[r[i], r[j]] += 1
    got = {(r["center"], r["context"]): r["n"] for r in cooccur.skipgram_counts(d, "t", 2).collect()}
    assert got == want
    assert want == Counter((r["center"], r["context"]) for r in cooccur.skipgram_pairs(d, "t", 2).collect())
    for weighted in (False, True):
        got = {(r["a"], r["b"]): r["n"] for r in cooccur.cooccurrence(d, "t", 3, weighted).collect()}
        assert got == pytest.approx({k[:2]: v for k, v in near.items() if k[2] == weighted})
    numbers = spark.createDataFrame([([5, 7, 5, 9, 7],)], "t array<long>")
    assert cooccur.skipgram_counts(numbers, "t", 1).agg(F.sum("n")).first()[0] == 6
    assert dict(cooccur.cooccurrence(numbers, "t", 1).dtypes) == {"a": "bigint", "b": "bigint", "n": "bigint"}


def test_counted_pairs_are_shuffled_as_pieces(spark):
    """The one shuffle deals packed cells of pairs; a task holds so many tokens at a time, however large a batch is."""
    import numpy as np
    import pyarrow as pa

    d = spark.createDataFrame([(["a", "b", None, "é", "b"],)], "t array<string>")
    for found in (cooccur.cooccurrence(d, "t", 2, True), cooccur.skipgram_counts(d, "t", 1)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(cell") == plan.count("Exchange") == 1
    lists = pa.array([["a"] * 4] * 9 + [["b"] * 30, None, [], ["c"]], pa.list_(pa.string()))
    parts = [p.to_pylist() for p in cooccur._parts(iter([pa.RecordBatch.from_arrays([lists], ["t"])]), 10)]
    assert [x for p in parts for x in p] == lists.to_pylist()
    assert max(sum(len(x or []) for x in p) for p in parts if len(p) > 1) <= 10
    words = [["a", "b", "bé"], [None, "c"], [3, 700, 1 << 40]]
    for w in words:
        w = pa.array(w)
        w = w.take(pa.compute.sort_indices(w))
        one, other = np.array([0, 0, 1], np.int32), np.array([0, 1, 0], np.int32)
        counts = cooccur._Counts(w, one, other, np.array([1, 2, 3]))
        pieces = [r for b in cooccur._by_cell(counts, 4) for r in b.to_pylist()]
        back = cooccur._add([cooccur._Counts.of(r["rows"], r["words"], r["pairs"], True) for r in pieces * 2])
        names, want = back.words.to_pylist(), w.to_pylist()
        got = {(names[i], names[j]): n for i, j, n in zip(back.one, back.other, back.n)}
        assert got == {(want[0], want[0]): 2, (want[0], want[1]): 4, (want[1], want[0]): 6}


def test_pmi_moves_pairs_once_as_pieces(spark, monkeypatch):
    """Any rows of pairs: repeated, one-sided, with null; pairs are not joined to the margins row by row."""
    import math
    from collections import Counter

    monkeypatch.setattr(cooccur, "_COUNTED", 16)
    monkeypatch.setattr(cooccur, "_HANDED", 3)
    rows = [("a", "b", 3), ("b", "a", 3), ("a", "b", 1), ("b", "é", 2), ("é", "b", 5), ("c", "only", 4), (None, "a", 7), ("a", None, 2), ("é", "é", 9)]
    found = cooccur.pmi(spark.createDataFrame(rows, "a string, b string, n long").repartition(2))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    total, margin = sum(n for *_, n in rows), Counter()
    for a, _, n in rows:
        margin[a] += n
    want = [(a, b, n, math.log(n * total / (margin[a] * margin[b]))) for a, b, n in rows if None not in (a, b) and b in margin]
    got = sorted(tuple(r) for r in found.collect())
    assert [g[:3] for g in got] == sorted(w[:3] for w in want)
    assert [g[3] for g in got] == pytest.approx([w[3] for w in sorted(want)])
    assert [g[4] for g in got] == pytest.approx([max(w[3], 0.0) for w in sorted(want)])
    assert dict(found.dtypes) == {"a": "string", "b": "string", "n": "bigint", "pmi": "double", "ppmi": "double"}
    numbers = cooccur.pmi(spark.createDataFrame([(1, 2, 1.5), (2, 1, 1.5)], "a long, b long, n double")).collect()
    assert sorted((r["a"], r["b"], r["n"]) for r in numbers) == [(1, 2, 1.5), (2, 1, 1.5)]
    assert [r["pmi"] for r in numbers] == pytest.approx([math.log(2)] * 2)


def test_classifier_sends_no_more_gradients_than_there_are_cores(spark, monkeypatch):
    """Partitions are merged before the solver's passes, and the weights come back by column."""
    seen = []
    fit = classify.LogisticRegression.fit
    monkeypatch.setattr(classify.LogisticRegression, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    triples = spark.createDataFrame([(i, i % 3, 1.0) for i in range(60)], "row long, col long, value double")
    docs = spark.range(60).selectExpr("id AS doc_id", "CAST(id % 3 AS double) AS y")
    vectors = classify.feature_vectors(triples, docs, 4).repartition(40)
    coef, intercept = classify.fit_multinomial(vectors, "y")
    assert seen[0] <= spark.sparkContext.defaultParallelism
    w = {(r["class_id"], r["col"]): r["weight"] for r in coef.collect()}
    assert len(w) == 12 and all(w[c, c] > 0 > w[c, (c + 1) % 3] for c in range(3)) and intercept.count() == 3
    assert all(abs(sum(w[c, j] for c in range(3))) < 1e-9 for j in range(4))
    test = spark.createDataFrame([(0,), (1,), (2,)], "doc_id long")
    found = classify.predict(classify.logits(triples.where("row < 3"), test, coef, intercept)).collect()
    assert {r["doc_id"]: r["predicted"] for r in found} == {0: 0, 1: 1, 2: 2}


def test_csr_reads_its_triples_once(spark):
    """Rows are collected once: a second reading would count the entries again."""
    read = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(2, 1, 5), (0, 3, 1), (2, 0, 4)], "row long, col long, value long")
    noted = F.udf(lambda v: read.add(1) or v, "long").asNondeterministic()
    got = terms.csr_rows(rows.withColumn("value", noted("value"))).orderBy("row").collect()
    assert [(r["indices"], r["data"], r["start"], r["end"]) for r in got] == [([3], [1], 0, 1), ([0, 1], [4, 5], 1, 3)]
    assert read.value == 3


def _shuffles(df):
    """Exchanges of the plan that no other one is reused for."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count(" Exchange ")


def test_counts_per_token_are_dealt_once(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "c"), (None, "a"), (None, "a"), (1, "a")]
    tokens = spark.createDataFrame(rows, "doc_id long, token string").repartition(3)
    counts = terms.counts_by_token(tokens)
    found = {(r["doc_id"], r["token"]): r["n"] for r in counts.collect()}
    assert found == {(1, "a"): 3, (1, "b"): 1, (2, "a"): 1, (2, "c"): 1, (None, "a"): 2}
    # the repartition above, the one by token, and none for the frequencies
    assert _shuffles(terms.document_frequency(counts)) == 2
    docs = spark.createDataFrame([(1,), (2,), (None,)], "doc_id long")
    vocab = spark.createDataFrame([("a",), ("b",), ("b",)], "token string")
    out = {(r["doc_id"], r["token"]): (r["n"], round(r["idf"], 6)) for r in terms.tfidf_transform(tokens, docs, vocab).collect()}
    assert out == {(1, "a"): (3, 0.0), (1, "b"): (1, 0.477121), (2, "a"): (1, 0.0), (None, "a"): (2, 0.0)}


def test_token_ids_with_sent_and_joined_vocabulary(spark, monkeypatch):
    positions = spark.createDataFrame([(1, i, t) for i, t in enumerate("a b a c a b".split())], "doc_id long, p int, token string")
    counted = positions.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    kept = wordvec.frequent_tokens(counted, 1, times="n")
    assert {r["token"] for r in kept.collect()} == {r["token"] for r in wordvec.frequent_tokens(positions, 1).collect()} == {"a", "b"}
    vocab = terms.vocabulary(kept, unknown=True)
    sent = wordvec.token_ids(positions, vocab)
    assert "Broadcast" in sent._jdf.queryExecution().executedPlan().toString()
    wanted = {(0, 0), (1, 1), (2, 0), (3, 2), (4, 0), (5, 1)}
    assert {(r["p"], r["id"]) for r in sent.collect()} == wanted
    monkeypatch.setattr(wordvec, "SENT_WORDS", 1)
    assert {(r["p"], r["id"]) for r in wordvec.token_ids(positions, vocab).collect()} == wanted


def test_neighbour_targets_are_summarised_in_tasks(spark):
    rng = random.Random(4)
    docs = [[rng.choice(["a", "b", "c", "Z", "é", "\U0001f600", "￮"]) for _ in range(rng.randrange(1, 9))] for _ in range(60)]
    frame = spark.createDataFrame([(d,) for d in docs], "t array<string>").repartition(3)
    rows = frame.select(F.inline(corpus.neighbour_targets(F.col("t"))))
    wanted = {}
    for d in docs:
        for k, token in enumerate(d):
            w = wanted.setdefault(token, ([], [], []))
            w[0].append(1)
            w[1].extend(d[k + 1 : k + 2])
            w[2].extend(d[max(k - 1, 0) : k])
    byte = lambda s: s.encode()
    wanted = {t: (len(n), len(f), len(b), min(f, key=byte, default=None), max(b, key=byte, default=None)) for t, (n, f, b) in wanted.items()}
    for most in (4, 20, 1 << 21):
        found = corpus.target_summary(rows, most)
        assert {r[0]: tuple(r)[1:] for r in found.collect()} == wanted
    assert corpus.target_summary(rows.where("false")).collect() == []


def test_sentence_pairs_shuffle_lists_of_partners(spark):
    """A pair takes a few bytes of the shuffle, and a word in all sentences is dealt to many tasks."""
    import itertools
    from collections import Counter

    sets = [["all", *(f"w{(i * 7 + j * j) % 150:03d}" for j in range(12))] for i in range(400)] + [["all", None, "é"], ["é", "é"], []]
    d = spark.createDataFrame([(s,) for s in sets], "w array<string>").repartition(4)
    key = lambda w: (w is None, (w or "").encode())
    want = Counter(p for s in sets for p in itertools.combinations(sorted(set(s), key=key), 2))
    for counted, block in ((1 << 23, 512), (50, 512), (50, 5)):
        before, cooccur._COUNTED = cooccur._COUNTED, counted
        try:
            got = cooccur.sentence_cooccurrence(d, "w", block=block).collect()
        finally:
            cooccur._COUNTED = before
        assert len(got) == len(want) and {(r["a"], r["b"]): r["n"] for r in got} == want
    met = d.select(F.array_sort(F.array_distinct("w")).alias("_l"), F.lit(None).cast("array<string>").alias("_r"))
    lists = cooccur._count_meetings(met, {"all": 0}).where("a = 'all'")
    assert lists.select("salt").distinct().count() == cooccur._SALTS
    assert cooccur._count_meetings(met, {}).where("a = 'all'").select("salt").distinct().count() == 1
