"""Operators against independent NumPy / plain Python versions on small fixtures."""

from collections import Counter

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import graph, ordered, series, summaries, vectors, wordpiece, wordvec
from tidewell.operators.linear import grouped_gram
from tidewell.operators.perkey import run_per_key


def skewed(spark, n=3000, seed=1):
    """A third of all rows share one key; values repeat."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 50, n))
    x = np.round(rng.normal(size=n), 1)
    return [(int(k), int(i), float(v)) for i, (k, v) in enumerate(zip(key, x))]


def test_running_and_position(spark):
    rows = skewed(spark)
    d = spark.createDataFrame(rows, "k long, i long, x double").repartition(7)
    for extra in ({}, {"width": 100}):
        got = {
            r["i"]: (r["s"], r["lo"], r["pos"])
            for r in ordered.position(
                ordered.running(d, ["i"], {"s": ("sum", F.col("x")), "lo": ("min", F.col("x"))}, ["k"], **extra), ["i"], ["k"], **extra
            ).collect()
        }
        seen = {}
        for k, i, x in rows:
            s, lo, pos = seen.get(k, (0.0, np.inf, -1))
            seen[k] = (s + x, min(lo, x), pos + 1)
            assert got[i][0] == pytest.approx(seen[k][0], abs=1e-9) and got[i][1:] == seen[k][1:]


def test_ranked_with_scattered_ids_and_a_hot_value(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, "a", "b"]), rng.getrandbits(63) - 2**62 if i % 2 else 5, i) for i in range(600)] + [(None, None, 600)] * 3
    frame = spark.createDataFrame(rows, "k string, v long, i int").repartition(7)
    got = ordered.ranked(frame, ["v", "i"], ["k"], "pos", "n").collect()
    key = lambda r: (r[1] is not None, r[1] or 0, r[2])
    want = []
    for k in (None, "a", "b"):
        own = sorted((r for r in rows if r[0] == k), key=key)
        want += [(*r, p, len(own)) for p, r in enumerate(own)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert ordered.ranked(frame.where("false"), ["v"]).count() == 0


def test_running_exclusive_starts_empty(spark):
    d = spark.createDataFrame([(i, 1.0) for i in range(20)], "i long, x double")
    r = ordered.running(d, ["i"], {"s": ("sum", F.col("x")), "m": ("max", F.col("i"))}, inclusive=False).orderBy("i").collect()
    assert [x["s"] for x in r] == list(map(float, range(20)))
    assert [x["m"] for x in r] == [None, *range(19)]


def test_sorted_index(spark):
    words = [f"w{i * 7919 % 1000}" for i in range(1000)]
    d = spark.createDataFrame([(w,) for w in words], "token string").distinct()
    got = {r["token"]: r["idx"] for r in ordered.sorted_index(d, "token").collect()}
    assert got == {w: i for i, w in enumerate(sorted(set(words)))}


def test_affine_scan_is_exact_over_many_blocks(spark):
    n = 3000
    rng = np.random.default_rng(3)
    a, b = rng.uniform(-0.9, 0.9, n), rng.normal(size=n)
    d = spark.createDataFrame([(0, i, float(a[i]), float(b[i])) for i in range(n)], "k long, t long, a double, b double")
    got = ordered.affine_scan(d, ["k"], "t", F.col("a"), F.col("b"), "x", block=16).orderBy("t").collect()
    x, want = 0.0, []
    for i in range(n):
        x = a[i] * x + b[i]
        want.append(x)
    assert np.allclose([r["x"] for r in got], want)


def test_hdi_with_ties(spark):
    rows = skewed(spark) + [(0, 10_000 + i, 0.3) for i in range(1500)]
    d = spark.createDataFrame(rows, "k long, i long, x double")
    got = {r["k"]: (r["hdi_low"], r["hdi_high"]) for r in summaries.hdi(d, ["k"], "x", 0.8).collect()}
    for k in {r[0] for r in rows}:
        x = np.sort([r[2] for r in rows if r[0] == k])
        m = int(np.floor(0.8 * len(x)))
        width = x[m:] - x[: len(x) - m]
        i = int(np.argmin(width))
        assert got[k] == (x[i], x[i + m])


def test_early_stop(spark):
    losses = [5, 4, 4, 3, 3, 3, 2, 2, 2, 2, 1]
    d = spark.createDataFrame([("r", i, float(v)) for i, v in enumerate(losses)], "run string, step long, loss double")
    r = summaries.early_stop(d, ["run"], "step", "loss", 2).orderBy("step").collect()
    assert [x["wait"] for x in r] == [0, 0, 1, 0, 1, 2, 0, 1, 2, 3, 0]
    assert [x["stopped"] for x in r] == [0] * 5 + [1] * 6


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(150)]
    pairs = chain + star
    e = spark.createDataFrame(pairs + [(b, a) for a, b in pairs], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in [*range(201), *range(1000, 1151), 5000]], "node long")
    got = {r["node"]: r["component"] for r in graph.connected_components(nodes, e).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1151)}, 5000: 5000}


def test_icar_scaling(spark):
    pairs = [(0, 1), (1, 2), (2, 3), (3, 0), (10, 11)]
    e = spark.createDataFrame(pairs + [(b, a) for a, b in pairs], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in [0, 1, 2, 3, 10, 11, 20]], "node long")
    rows = graph.icar_components(graph.connected_components(nodes, e), e).collect()
    for comp, members in {0: [0, 1, 2, 3], 10: [10, 11]}.items():
        q = np.zeros((len(members),) * 2)
        for a, b in pairs:
            if a in members:
                i, j = members.index(a), members.index(b)
                q[i, j] = q[j, i] = -1
                q[i, i] += 1
                q[j, j] += 1
        inv = np.linalg.pinv(q)
        scale = np.exp(np.mean(np.log(np.diag(inv))))
        for r in rows:
            if r["component"] == comp:
                assert r["scale"] == pytest.approx(scale, rel=1e-5)
                assert r["value"] == pytest.approx(inv[members.index(r["i"]), members.index(r["j"])] / scale, rel=1e-5, abs=1e-9)
    mixed = {(r["i"], r["j"]): r["value"] for r in graph.mixed_covariance(spark.createDataFrame(rows), 0.2).collect()}
    assert mixed[20, 20] == pytest.approx(0.8)


def test_components_are_inverted_side_by_side(spark):
    """Components cut by batches, of equal and other sizes and with text keys, give one inverse each."""
    import pyarrow as pa

    rows = [(f"c{c:03d}", f"{c:03d}-{i}", f"{c:03d}-{j}", (n - 1.0) if i == j else -1.0)
            for c, n in enumerate([1, 3, 2, 3, 1, 4, 2] * 30) for i in range(n) for j in range(n)]
    whole = pa.RecordBatch.from_pylist([dict(zip(("component", "i", "j", "value"), r)) for r in rows])
    got = {}
    for part in graph._whole_components(iter([whole.slice(lo, 7) for lo in range(0, len(rows), 7)])):
        for batch in graph._inverses(part, 5000):
            got |= {(r["i"], r["j"]): (r["component"], r["n"], r["scale"], r["value"]) for r in batch.to_pylist()}
    assert set(got) == {r[1:3] for r in rows}
    for c, n in enumerate([1, 3, 2, 3, 1, 4, 2] * 30):
        q = n * np.eye(n) - np.ones((n, n))
        inv = np.linalg.pinv(q)
        scale = np.exp(np.mean(np.log(np.diag(inv)))) if n > 1 else 1.0
        for i, j in itertools.product(range(n), repeat=2):
            name, size, factor, value = got[f"{c:03d}-{i}", f"{c:03d}-{j}"]
            assert (name, size) == (f"c{c:03d}", n) and factor == pytest.approx(scale, rel=1e-5)
            assert value == pytest.approx(inv[i, j] / scale, rel=1e-5, abs=1e-9)
    # a matrix that is no graph's has no scale: null, beside components that have one
    odd = pa.RecordBatch.from_pylist([
        dict(zip(("component", "i", "j", "value"), r))
        for r in [(0, 0, 0, 2.0), (0, 0, 1, -2.0), (0, 1, 1, 1.0), (0, 1, 0, -1.0), (2, 2, 2, 1.0), (2, 2, 3, -1.0), (2, 3, 3, 1.0), (2, 3, 2, -1.0),
                  (4, 4, 4, 1.0), (4, 4, 5, -3.0), (4, 5, 5, 1.0), (4, 5, 4, -1.0)]
    ])
    scales = {r["component"]: r["scale"] for b in graph._inverses(pa.Table.from_batches([odd]), 9) for r in b.to_pylist()}
    assert scales[4] is None and scales[2] == pytest.approx(0.25)
    with pytest.raises(ValueError, match="c005 has 4 areas"):
        list(graph._inverses(pa.Table.from_batches([whole]), 3))


def test_grouped_gram_flat_and_grouped(spark):
    rng = np.random.default_rng(0)
    data = [(int(k), rng.normal(size=3).tolist(), float(rng.normal()), float(rng.random())) for k in np.r_[np.zeros(400), rng.integers(1, 300, 600)]]
    d = spark.createDataFrame(data, "k long, x array<double>, y double, w double").repartition(5)
    got = {r["k"]: (r["xtx"], r["xty"]) for r in grouped_gram(d, ["k"], 3, weighted=True).collect()}
    for k in {r[0] for r in data}:
        x = np.array([r[1] for r in data if r[0] == k])
        y = np.array([r[2] for r in data if r[0] == k])
        w = np.array([r[3] for r in data if r[0] == k])
        assert np.allclose(got[k][0], (x.T @ (x * w[:, None])).ravel())
        assert np.allclose(got[k][1], x.T @ (w * y))


def test_fit_and_forecast(spark):
    import datetime

    spec = series.TrendSpec()
    rng = np.random.default_rng(5)
    rows, truth = [], {}
    for city, n in [("A", 60), ("B", 40)]:
        y = 20 + 3 * np.sin(2 * np.pi * np.arange(n) / 12) + rng.normal(size=n) * 0.1
        truth[city] = y
        rows += [(city, datetime.date(2000 + i // 12, i % 12 + 1, 1), None if i == 7 else float(y[i])) for i in range(n)]
    rows += [("C", datetime.date(2000, 1, 1), None)]
    d = spark.createDataFrame(rows, "city string, date date, temperature double")
    models = {r["city"]: r for r in series.fit_models(d, ["city"], "date", "temperature").collect()}
    assert models["C"]["mean"] is None and models["C"]["error"]
    for city, y in truth.items():
        keep = np.arange(len(y)) != 7
        t = np.arange(len(y)).astype(float)
        z = (y - y[keep].mean()) / y[keep].std()
        half = (len(y) - 1) / 2
        length = 5.0 * half
        j = np.arange(1, 11)
        phi = np.sqrt(1 / length) * np.sin(np.pi * j * (t[:, None] - half + length) / (2 * length))
        w = np.pi * j / (2 * length)
        var = spec.amplitude * np.sqrt(2 * np.pi) * 24.0 * np.exp(-0.5 * (24.0 * w) ** 2)
        k = np.arange(1, 11)
        ang = 2 * np.pi * t[:, None] / 12 * k
        x = np.concatenate([phi, np.stack([np.sin(ang), np.cos(ang)], axis=2).reshape(len(y), -1)], axis=1)
        s = np.diag(np.r_[var, np.full(20, 0.25)])
        # the same posterior in covariance form
        g = s @ x[keep].T @ np.linalg.inv(x[keep] @ s @ x[keep].T + spec.error**2 * np.eye(keep.sum()))
        assert np.allclose(models[city]["mean"], g @ z[keep], atol=1e-6)
        f = np.array(models[city]["factor"]).reshape(30, 30)
        assert np.allclose(f @ f.T, s - g @ x[keep] @ s, atol=1e-6)
    m = series.fit_models(d, ["city"], "date", "temperature")
    draws = series.forecast_draws(m, ["city"], 12, 1500)
    f = {(r["city"], r["obs_id"]): r["forecast"] for r in series.back_transform(draws, ["city"]).collect()}
    assert len(f) == 24 and draws.count() == 2 * 12 * 1500
    # the first forecast index is the last training index
    assert abs(f["A", 0] - (20 + 3 * np.sin(2 * np.pi * 59 / 12))) < 0.5
    shifted = series.forecast_draws(m, ["city"], 12, 1500, start_after_last=True)
    g = {(r["city"], r["obs_id"]): r["forecast"] for r in series.back_transform(shifted, ["city"]).collect()}
    assert abs(g["A", 0] - f["A", 1]) < 0.2


def test_split_is_disjoint_and_complete(spark):
    rows = skewed(spark)
    d = spark.createDataFrame(rows, "k long, i long, x double")
    s = series.holdout_split(d, ["k"], ["i"], 5)
    assert s.count() == len(rows)
    for k in {r[0] for r in rows}:
        last = sorted(r[1] for r in rows if r[0] == k)[-5:]
        assert sorted(r["i"] for r in s.where((F.col("k") == k) & (F.col("split") == "test")).collect()) == last
        if k > 2:
            break
    # hot keys are limited before the shuffle
    assert "WindowGroupLimit" in s._jdf.queryExecution().executedPlan().toString()


def reference_merges(counts, rounds):
    words = {w: [c if i == 0 else "##" + c for i, c in enumerate(w)] for w in counts}
    out = []
    for _ in range(rounds):
        tok, pair = Counter(), Counter()
        for w, p in words.items():
            for t in p:
                tok[t] += counts[w]
            for a, b in zip(p, p[1:]):
                pair[a, b] += counts[w]
        scored = [(-n / (tok[a] * tok[b]), a, b) for (a, b), n in pair.items() if n >= 2]
        if not scored:
            break
        _, a, b = min(scored)
        out.append((a, b, a + b[2:]))
        for w, p in words.items():
            q, i = [], 0
            while i < len(p):
                if i + 1 < len(p) and p[i] == a and p[i + 1] == b:
                    q.append(a + b[2:])
                    i += 2
                else:
                    q.append(p[i])
                    i += 1
            words[w] = q
    return out


def test_subword_training_encoding_and_decoding(spark):
    texts = ["Hello World! aaaa aaa hello", "low lower lowest, low-key (really) new newer", "wide wider; Hello again"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = {r["word"]: r["n"] for r in wordpiece.word_counts(docs).collect()}
    start = len(wordpiece.SPECIALS) + len({p for w in counts for p in [w[0], *("##" + c for c in w[1:])]})
    model = wordpiece.SubwordTokenizer(start + 10).fit(docs)
    assert [m[:3] for m in model.merges] == reference_merges(counts, len(model.merges))
    assert len(model.vocab) == len(set(model.vocab)) == start + 10

    vocab = model.vocab_df(spark)
    odd = spark.createDataFrame([(0, texts[0]), (1, "hello Ω wide Ωlow"), (2, ""), (3, "...")], "doc_id long, text string")
    enc = {r["doc_id"]: r for r in wordpiece.encode(odd, vocab).collect()}
    ids = {t: i for i, t in enumerate(model.vocab)}
    for r in enc.values():
        low = r["text"].lower()
        assert [ids[t] for t in r["tokens"]] == r["ids"]
        for t, s, e in zip(r["tokens"], r["starts"], r["ends"]):
            assert t == "[UNK]" or low[s:e] == t.removeprefix("##")
    assert enc[1]["tokens"].count("[UNK]") == 2
    # the join path gives the same encoding
    from tidewell.functions.text import WORD_OR_MARK, words_and_marks

    low = F.lower("text")
    cut = odd.withColumns({"_words": words_and_marks(F.col("text")), "_gaps": F.transform(F.split(low, WORD_OR_MARK, -1), F.length)})
    joined = {r["doc_id"]: r for r in wordpiece._encode_by_join(cut, vocab, odd.columns, "[UNK]").collect()}
    for k, r in enc.items():
        assert [joined[k][c] for c in ("ids", "tokens", "starts", "ends")] == [r[c] for c in ("ids", "tokens", "starts", "ends")]

    full = model.transform(docs)
    first = full.where("doc_id = 0").first()
    assert first["tokens"][0] == "[CLS]" and first["tokens"][-1] == "[SEP]"
    assert first["special_tokens_mask"] == [1] + [0] * (len(first["ids"]) - 2) + [1]
    back = {r["doc_id"]: r["decoded"] for r in model.decode(full).collect()}
    assert back[0] == "hello world! aaaa aaa hello"
    assert back[1] == "low lower lowest, low-key (really) new newer"
    by_join = wordpiece.decode(full, "ids", vocab, "id", max_sent=0)
    assert {r["doc_id"]: r["decoded"] for r in by_join.collect()} == back
    kept = wordpiece.decode(spark.createDataFrame([([2, 4, 1, 3],)], "ids array<int>"), "ids", vocab, "name").first()
    assert kept["decoded"].strip() == "[MASK]"


def test_neighbours_three_ways(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(120, 8))
    v = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(m)], "id long, vec array<double>")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    sim = unit @ unit.T
    want = {}
    for q in range(120):
        want[q] = [int(i) for i in np.lexsort((np.arange(120), -sim[q]))[1:4]]
    graph_rows = vectors.neighbour_graph(v, 3, 8).collect()
    got = {}
    for r in sorted(graph_rows, key=lambda r: r["rank"]):
        got.setdefault(r["query"], []).append(r["neighbour"])
    assert got == want
    hits = vectors._rank(vectors._blocked(v, v, 4, 8, block_bytes=1000), 3, True).collect()
    assert {(r["query"], r["neighbour"], r["rank"]) for r in hits} == {(r["query"], r["neighbour"], r["rank"]) for r in graph_rows}
    few = vectors.cosine_neighbours(v, v.where("id < 3"), 3, 8).orderBy("query", "rank").collect()
    assert [r["neighbour"] for r in few] == want[0] + want[1] + want[2]
    w = vectors.fuzzy_weights(spark.createDataFrame(graph_rows))
    sums = w.groupBy("src").agg(F.sum("weight").alias("s"), F.max("weight").alias("m")).collect()
    assert all(r["s"] == pytest.approx(np.log2(3), abs=1e-6) and r["m"] == pytest.approx(1.0) for r in sums)
    u = {(r["src"], r["dst"]): r["weight"] for r in vectors.fuzzy_union(w).collect()}
    assert all(u[b, a] == pytest.approx(x) for (a, b), x in u.items())


def test_noise_follows_counts(spark):
    counts = spark.createDataFrame([(0, 1000), (1, 10), (2, 1)], "id long, n long")
    noise = wordvec.noise_distribution(counts)
    p = {r["id"]: r["p"] for r in noise.collect()}
    z = np.array([1000, 10, 1]) ** 0.75
    assert np.allclose([p[i] for i in range(3)], z / z.sum())
    pairs = spark.range(2000).select(F.col("id").alias("center"), (F.col("id") * 3 % 7).alias("context"))
    drawn = Counter(r["noise"] for r in wordvec.sample_noise(pairs, noise, 5).collect())
    assert sum(drawn.values()) == 10_000
    for i in range(3):
        assert drawn[i] / 10_000 == pytest.approx(p[i], abs=0.01)


def test_glove_solves_lower_the_loss(spark):
    rng = np.random.default_rng(4)
    tri = [(i, j, float(np.exp(rng.normal()) * 5)) for i in range(20) for j in range(20) if rng.random() < 0.5]
    d = spark.createDataFrame(tri, "i long, j long, x double")
    v = wordvec.train_glove(d, dim=3, rounds=1, ridge=0.1).collect()
    assert len(v) == 20 and all(len(r["vec"]) == 3 for r in v)

    def init(seed):
        ids = spark.range(20).select("id")
        got = {r["id"]: r["vec"] for r in wordvec.initial_vectors(ids, 3, 0.5 / np.sqrt(3), seed).collect()}
        return np.array([got[i] for i in range(20)])

    def solve(fixed, bias, side):
        out = np.zeros((20, 4))
        for k in range(20):
            a, b = 0.1 * np.eye(4), np.zeros(4)
            for i, j, x in tri:
                me, other = (i, j) if side == 0 else (j, i)
                if me == k:
                    f = min((x / 100) ** 0.75, 1.0)
                    r = np.r_[fixed[other], 1.0]
                    a += f * np.outer(r, r)
                    b += f * r * (np.log(x) - bias[other])
            out[k] = np.linalg.solve(a, b)
        return out[:, :3], out[:, 3]

    left, lb = solve(init(43), np.zeros(20), 0)
    right, _ = solve(left, lb, 1)
    got = {r["id"]: r["vec"] for r in v}
    assert np.allclose([got[i] for i in range(20)], left + right, atol=1e-8)


def test_per_key_errors_are_rows(spark):
    d = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 1.0)], "k long, x double")

    def work(key, rows):
        if key == 2:
            raise RuntimeError("bad key")
        return {"total": rows["x"].sum()}

    r = {x["k"]: x for x in run_per_key(d, "k", work, "total double").collect()}
    assert r[1]["total"] == 5.0 and r[1]["error"] is None
    assert r[2]["total"] is None and r[2]["error"] == "RuntimeError: bad key"
