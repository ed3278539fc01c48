"""The training-data operators against plain Python on small inputs."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import components, decontaminate, fixity, language, licenses, neardup, packing, pii, quality, sharding, vectorcopies
from tidewell.llm.common import materialize


def rows(df):
    return [tuple(r) for r in df.collect()]


# -- components -------------------------------------------------------------------------------


def roots_of(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in up}


@pytest.mark.parametrize("kind", ["path", "random", "star", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(50)],
        "star": [(100, i) for i in range(50)] + [(7, 7), (3, 3), (200, 200)],
        "none": [],
    }[kind]
    frame = spark.createDataFrame([*edges, (None, 1)], "a long, b long")
    assert set(rows(components.connected(frame))) == roots_of(edges)


# -- 1 quality --------------------------------------------------------------------------------


def kneser_ney(texts, order):
    """A model from the definition: gram -> probability."""
    counts = Counter()
    for t in texts:
        b = b"\0" * (order - 1) + t
        counts.update(b[i : i + order] for i in range(len(b) - order + 1))
    tables = {order: counts}
    for j in range(order - 1, 0, -1):
        tables[j] = Counter(g[1:] for g in tables[j + 1])
    cuts, contexts = {}, {j: defaultdict(lambda: [0, 0.0]) for j in tables}
    for j, table in tables.items():
        n1, n2, n3, n4 = (sum(1 for v in table.values() if v == i) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        raw = [i - (i + 1) * y * b / a if a and b else 0.5 * i for i, (a, b) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1)]
        cuts[j] = [min(max(d, 0.05 * i), i - 0.05) for i, d in enumerate(raw, 1)]
        for g, v in table.items():
            contexts[j][g[:-1]][0] += v
            contexts[j][g[:-1]][1] += cuts[j][min(v, 3) - 1]

    def p(g):
        j = len(g)
        if not j:
            return 1 / 256
        v, own, rest = tables[j].get(g, 0), 0.0, 1.0
        if g[:-1] in contexts[j]:
            total, free = contexts[j][g[:-1]]
            own, rest = (v - cuts[j][min(v, 3) - 1]) / total if v else 0.0, free / total
        return own + rest * p(g[1:])

    return p


def test_quality_scores_match_the_definition(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab cdé") for _ in range(rng.randrange(1, 120))) for _ in range(30)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    blocks, _ = quality._in_blocks(docs)
    learned = materialize(blocks.where("doc_id < 20").select("row", "block"), "test")
    grams = materialize(quality.block_grams(blocks, learned, 3), "test")
    counts = grams.groupBy("k", "gram").agg(F.sum("n").alias("c")).where("c > 0")
    p = quality.probabilities(counts, grams, 3)
    got = {r["doc_id"]: r["bits"] for r in quality.block_scores(blocks, grams.join(p, ["k", "gram"]), 3).collect()}
    model = kneser_ney([t.encode() for t in texts[:20]], 3)
    assert sum(model(b"ab" + bytes([x])) for x in range(256)) == pytest.approx(1)
    for i, t in enumerate(texts):
        b = b"\0\0" + t.encode()
        assert got[i] == pytest.approx(-sum(math.log2(model(b[j : j + 3])) for j in range(len(b) - 2)))


def test_quality_rejects_junk(spark):
    rng = random.Random(5)
    words = ["the", "cat", "dog", "sat", "on", "mat", "and", "ran", "to", "house"]
    texts = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(300)]
    junk = ["%%$ &&* QX7 ### zzq@@ " * 10 for _ in range(5)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts + junk)], "doc_id long, text string, lang string")
    trusted = spark.range(0, 200).select(F.col("id").alias("doc_id"))
    got = {r["doc_id"]: r for r in quality.quality(docs, trusted).collect()}
    assert not any(got[i]["kept"] for i in range(300, 305))
    assert sum(got[i]["kept"] for i in range(300)) > 285


def test_quality_odd_rows(spark, odd_docs, no_docs):
    trusted = spark.createDataFrame([(1,), (2,), (9,), (None,)], "doc_id long")
    got = quality.quality(odd_docs, trusted).collect()
    assert len(got) == odd_docs.count()
    assert all(r["perplexity"] is None and not r["kept"] for r in got if r["n_bytes"] == 0)
    assert all(r["kept"] for r in got if r["n_bytes"] and r["threshold"] is None)
    assert rows(quality.quality(no_docs, trusted)) == []
    assert len(quality.quality(odd_docs, trusted.where("false")).collect()) == odd_docs.count()


# -- 2 sharding -------------------------------------------------------------------------------


def check_shards(placed, n, shards):
    by = defaultdict(list)
    for r in placed:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by[s]) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(by[s]) == list(range(len(by[s]))) for s in by)


def test_sharding(spark, odd_docs, no_docs):
    docs = spark.range(1003).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    ring = sharding.bounded_ring(sharding.digests(docs), "doc_id", shards=8)
    check_shards(ring.collect(), 1003, 8)
    odd = sharding.bounded_ring(sharding.digests(odd_docs), "doc_id", shards=5).collect()
    check_shards(odd, odd_docs.count(), 5)
    assert Counter(r["doc_id"] for r in odd) == Counter(r["doc_id"] for r in odd_docs.collect())
    hot = spark.range(500).select(F.lit(7).alias("doc_id"), F.lit("same").alias("text"))
    check_shards(sharding.bounded_ring(sharding.digests(hot), "doc_id", shards=8).collect(), 500, 8)
    assert rows(sharding.bounded_ring(sharding.digests(no_docs), "doc_id", shards=8)) == []


def test_ring_moves_only_the_excess():
    owners = [s for _, s in sharding.ring(4, 16)]
    rng = random.Random(2)
    counts = {(a, 0): rng.randrange(50) for a in range(len(owners))}
    moves = sharding.plan_moves(counts, owners, 4)
    total = sum(counts.values())
    caps = [total // 4 + (s < total % 4) for s in range(4)]
    home = Counter()
    for (a, _), n in counts.items():
        home[owners[a]] += n
    moved = sum(hi - lo for a, _, lo, hi, s, _ in moves if s != owners[a])
    assert moved == sum(max(0, home[s] - caps[s]) for s in range(4))


# -- 3 packing --------------------------------------------------------------------------------


def check_packed(got, docs, codec, capacity):
    parts, used = defaultdict(list), defaultdict(list)
    for r in got:
        parts[r["doc_id"]].append((r["start"], r["ids"], r["length"], r["doc_tokens"]))
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in docs:
        ids = [*codec.encode(text or "", add_special_tokens=False).ids, 2]
        found = sorted(parts[doc_id])
        assert b"".join(x[1] for x in found) == np.array(ids, "<u4").tobytes()
        assert all(x[2] * 4 == len(x[1]) and x[3] == len(ids) for x in found)
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(n for s in used.values() for _, n in s) / (len(used) * capacity)


def plain_codec():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary())


def test_packing(spark, odd_docs, no_docs):
    rng = random.Random(4)
    words = ["Hello,", "world", "naïve", "Straße!!", "x1y2", "don't", "%%%", "日本語", "<|endoftext|>", "áb", "İx", "q\x1cz"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(300)))) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    fill = check_packed(packing.pack(frame, packing.vocabulary(), capacity=512, group_pieces=100).collect(), docs, plain_codec(), 512)
    assert fill > 0.9
    odd = odd_docs.where("doc_id IN (3, 4, 5, 6, 9, 11)")
    check_packed(packing.pack(odd, packing.vocabulary()).collect(), [(r["doc_id"], r["text"]) for r in odd.collect()], plain_codec(), 4096)
    assert packing.pack(odd_docs, packing.vocabulary()).where("start = 0").count() == odd_docs.count()
    assert rows(packing.pack(no_docs, packing.vocabulary())) == []


def test_packing_takes_the_tokenizers_ids():
    codec = packing.WordCachedTokenizer(packing.vocabulary(), 2, most=4)
    assert np.frombuffer(codec.encode("end <|endoftext|> of it"), "<u4").tolist() == [806, 49407, 539, 585, 2]
    rng = random.Random(8)
    letters = "aB É'ſŉ.,\n\t 9 ×İ\r!ß\u0301\x1c\x0b"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(70))) for _ in range(4000)]
    texts += ["I'LL don't 's''t", "x<|startoftext|>y", "", "日本語 ²½ªº", "ǅ Σίσυφος ﬁ Å"]
    for text, got in zip(texts, codec.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == [*got.ids, 2], text


def test_packing_groups(spark):
    """Groups are bounded by pieces, for long texts and for repeated rows, and don't follow the partitions."""
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["one", "two", "three"]) for _ in range(2000))) for i in range(60)]
    docs += [(500, "one row that half of the table repeats")] * 900 + [(500, None)] * 3 + [(None, "no id")] * 2
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    one, other = (packing.pack(frame.repartition(n), packing.vocabulary(), capacity=64, group_pieces=100).collect() for n in (2, 5))
    check_packed(one, [d for d in docs if d[0] is not None and d[0] < 500], plain_codec(), 64)
    assert sorted(map(repr, one)) == sorted(map(repr, other))
    assert sum(r["start"] == 0 for r in one) == len(docs)
    sizes = Counter(r["sequence_id"] >> 32 for r in one)
    assert max(sizes.values()) <= 150


def test_first_fit_decreasing():
    rng = random.Random(6)
    for _ in range(50):
        lengths = [rng.randrange(1, 101) for _ in range(rng.randrange(1, 60))]
        sequence, offset = packing.first_fit_decreasing(lengths, 100)
        free = []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            at = next((j for j, f in enumerate(free) if f >= lengths[i]), len(free))
            if at == len(free):
                free.append(100)
            assert (sequence[i], offset[i]) == (at, 100 - free[at])
            free[at] -= lengths[i]


# -- 4 fixity ---------------------------------------------------------------------------------


def test_fixity(spark):
    made = spark.range(5000).select(
        F.col("id").alias("record_id"), (F.col("id") % 900 + 100).alias("length"), F.sha2(F.col("id").cast("string"), 256).alias("digest")
    )
    made = made.unionByName(made.where("record_id = 7")).unionByName(made.limit(1).select(F.lit(None).cast("long").alias("record_id"), "length", "digest"))
    placed = materialize(fixity.lay_out(made, file_bytes=300_000), "test")
    for f, own in itertools.groupby(sorted(placed.collect(), key=lambda r: (r["file"], r["offset"])), lambda r: r["file"]):
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
    left = placed.select("file", "offset", "length", "digest")
    assert rows(fixity.audit(left, left, leaf_bytes=4096, fanout=4)) == []
    bad = F.when(placed["record_id"] % 1000 == 3, "x").otherwise(F.col("digest"))
    right = placed.where("record_id % 1000 <> 5 OR record_id IS NULL").select("file", "offset", "length", bad.alias("digest"))
    got = {(r["file"], r["offset"]): r["status"] for r in fixity.audit(left, right, leaf_bytes=4096, fanout=4).collect()}
    want = {(r["file"], r["offset"]): {3: "altered", 5: "missing"}[r["record_id"] % 1000] for r in placed.where("record_id % 1000 IN (3, 5)").collect()}
    assert got == want and len(want) == 10
    back = fixity.audit(right, left, leaf_bytes=4096, fanout=4).where("status = 'extra'").count()
    assert back == 5
    none = left.where("false")
    assert rows(fixity.audit(none, none)) == [] and fixity.audit(none, left).count() == placed.count()


# -- 5 vectors --------------------------------------------------------------------------------


def brute_vectors(data, threshold):
    usable = {}
    for k, (i, v, label) in enumerate(data):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[k] = np.array(v, dtype=np.float64)
    links = defaultdict(set)
    for a, b in itertools.combinations(usable, 2):
        x, y = usable[a], usable[b]
        if data[a][2] == data[b][2] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
            links[a].add(b)
            links[b].add(a)
    roots = dict(roots_of([(a, b) for a in links for b in links[a]]))
    least = {}
    for k in roots:
        least[roots[k]] = min(least.get(roots[k], 10**9), data[k][0])
    return sorted((data[k][0], len(links[k]), least.get(roots.get(k), data[k][0])) for k in range(len(data)))


def test_vectors(spark):
    rng = np.random.default_rng(8)
    data = []
    for c in range(60):
        centre = rng.normal(size=32)
        for _ in range(rng.integers(1, 8)):
            data.append((len(data), (centre + 0.15 * rng.normal(size=32)).tolist(), int(c % 3)))
    data += [(len(data) + i, data[5][1], data[5][2]) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    n = len(data)
    data += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 32, 1), (n + 3, [nan] * 32, 1), (n + 4, [inf] + [1.0] * 31, 1),
             (n + 5, [None] + [1.0] * 31, 1), (n + 6, data[0][1], None), (n + 7, [1.0, 2.0], 1), (n + 8, [2.0, 4.0], 1), (n + 9, [3.0], 2)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1)).repartition(4)
    got = vectorcopies.vector_copies(frame, 0.93, block=16).collect()
    want = brute_vectors(data, 0.93)
    found = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    total = sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(found, want)) and sum(f[1] for f in found) >= 0.99 * total
    assert found[n:] == want[n:]
    assert rows(vectorcopies.vector_copies(frame.where("false"))) == []


def test_rotation_balances_bits():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(3000, 16)) * np.linspace(3, 0.1, 16) + 1
    centre, turn = vectorcopies.learn_rotation(sample, 32)
    share = ((sample - centre) @ turn > 0).mean(axis=0)
    assert turn.shape == (16, 32) and np.abs(share - 0.5).max() < 0.1
    assert np.allclose(turn[:, :16].T @ turn[:, :16], np.eye(16))


# -- 6 language -------------------------------------------------------------------------------


def test_gradients():
    rng = np.random.default_rng(0)
    net = language.start_network(["a", "b", "c"], 3, 1)
    steps, target = rng.integers(97, 110, (9, 4)), np.array([0, 1, 2, 1])
    found = language.gradients(net, steps, target)

    def loss():
        p = language.probabilities(net, steps).astype(np.float64)
        return -np.log(p[:, target, np.arange(4)]).mean()

    for name, w in net.weights.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w.shape)
            at = (at[0], int(steps[2, 1])) if name[0] == "x" else at
            w[at] += 1e-2
            high = loss()
            w[at] -= 2e-2
            low = loss()
            w[at] += 1e-2
            assert found[name][at] == pytest.approx((high - low) / 2e-2, abs=2e-3)


def test_language(spark, odd_docs, no_docs):
    rng = random.Random(2)
    sounds = {"x": ["ba", "bo", "la"], "y": ["çik", "ğu", "şe"]}
    docs = [
        (i, " ".join("".join(rng.choice(sounds[lang]) for _ in range(3)) for _ in range(60)), lang)
        for i, lang in enumerate(rng.choice("xy") for _ in range(300))
    ]
    docs.append((1000, "12 34 !!", "x"))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    net = language.train(frame, per_language=40)
    got = {r["doc_id"]: r for r in language.predict(frame.select("doc_id", "text"), net).collect()}
    assert got[1000]["lang_pred"] == "und" and got[1000]["score"] == 0
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in docs[:300]) > 290
    assert all(0 <= r["score"] <= 1 for r in got.values())
    # copies of a held-out row's label never reach the network
    assert language.train(frame.where(language.held_out())) is None
    odd = language.predict(odd_docs, net).collect()
    assert len(odd) == odd_docs.count()
    assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["text"] or "")) for r in odd)
    assert rows(language.predict(no_docs, net)) == [] and language.train(no_docs) is None
    assert {r["lang_pred"] for r in language.predict(odd_docs, None).collect()} == {"und"}
    # a text goes to the task once, and rows come back in small parts as they were
    out = language.predict(odd_docs, net, part_bytes=16)
    assert out.columns == [c for c in odd_docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    before = odd_docs.select(*out.columns[:-2])
    assert sorted(map(str, out.select(*before.columns).collect())) == sorted(map(str, before.collect()))
    assert sorted((str(r["doc_id"]), r["lang_pred"]) for r in out.collect()) == sorted((str(r["doc_id"]), r["lang_pred"]) for r in odd)
    only = language.predict(odd_docs.select("text"), net)
    assert only.columns == ["text", "lang_pred", "score"] and only.count() == odd_docs.count()


# -- 7 personal data --------------------------------------------------------------------------


def luhn(digits):
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(digits)))) % 10 == 0


def plain_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = {
        "email": [m for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) < 256 for x in m[0].split("."))],
        "card": [m for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15],
    }
    return [f"{k}:{m.start()}:{m.end()}" for k, ms in found.items() for m in ms]


def pii_rows(df):
    found = pii.candidates(df)
    base = F.filter("candidates", lambda s: s["base"])
    model = pii.fit(found)
    return {r[0]: (r[1], r[2]) for r in found.select("doc_id", pii.listing(base), pii.listing(pii.spans(model))).collect()}, model


def test_pii_base_spans(spark):
    rng = random.Random(9)
    pieces = ["a.b@c.d", "@", "x@y", "_d@e.f", "1.2.3.4", "300.1.1.1", "0001.2.3.255", "1.2.3", "4111111111111111", "4111-1111 1111-1111",
              "4111111111111112", "+1 (743) 555-3824", "+12", "+123456789", "é", "\U0001f600", " ", " ", "-", ".", "call ", "card: ", "5", "\n", "user (at) host (dot) com", "(212) 555-1234"]
    docs = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(30)))) for i in range(600)]
    docs += [(600, "1" * 20_000), (601, "a" * 20_000 + "@b.cd"), (602, "1.2.3.4 " * 3000), (603, "@a.b" * 2000), (604, None), (605, "")]
    got, model = pii_rows(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    for i, text in docs:
        want = plain_base(text or "")
        assert got[i][0] == ",".join(want), text
        assert set(filter(None, got[i][0].split(","))) <= set(got[i][1].split(","))
    assert model is not None and any(b != a for a, b in got.values())


def test_pii_redact(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(1, "né a.b@c.de or 10.0.0.1!"), (2, "nothing"), (3, None), (4, "+1 (743) 555-3824 4111111111111111")], "doc_id long, text string")
    model = pii.fit(pii.candidates(docs))
    got = dict(rows(pii.redact(docs, model).select("doc_id", "text")))
    assert got[1] == "né [EMAIL] or [IP]!" and got[2] == "nothing" and got[3] is None
    assert "743" not in got[4] and "4111" not in got[4]
    assert pii.redact(odd_docs, None).count() == odd_docs.count()
    assert pii.fit(pii.candidates(no_docs)) is None and rows(pii.redact(no_docs, None)) == []


def test_reliabilities():
    rng = random.Random(1)
    seen = Counter()
    for _ in range(4000):
        truth = rng.random() < 0.6
        seen[tuple(int(truth if rng.random() < q else not truth) for q in (0.95, 0.8, 0.7, 0.6))] += 1
    rates, true = pii.reliabilities(sorted(seen.items()))
    assert rates["prior"] == pytest.approx(0.6, abs=0.08)
    assert rates["rate"][1, 0, 1] == pytest.approx(0.95, abs=0.08) and rates["rate"][1, 2, 1] == pytest.approx(0.7, abs=0.08)
    assert true[1, 1, 1, 1] > 0.95 and true[0, 0, 0, 0] < 0.05


# -- 8 decontamination ------------------------------------------------------------------------


def plain_matches(text, items, window):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, met = cut(text), set(), set()
    for item, other in items:
        w = cut(other)
        n = min(window, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                met |= set() if item is None else {item}
    return len(words), hit, met


@pytest.mark.parametrize("shard_words", [10_000, 12])
def test_decontamination(spark, odd_docs, no_docs, shard_words):
    rng = random.Random(7)
    word = lambda: rng.choice(["a", "B", "c", "é", "d1"])
    items = [(i, " ".join(word() for _ in range(rng.randrange(0, 9)))) for i in range(12)] + [(None, "a a a b b b"), (40, None), (3, "c c c c c")]
    docs = [(i, "".join(word() + rng.choice([" ", "-", ".\n"]) for _ in range(rng.randrange(40)))) for i in range(150)] + [(500, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    given = spark.createDataFrame(items, "item_id long, text string")
    for r in decontaminate.matches(frame, given, 4, shard_words).collect():
        n, hit, met = plain_matches(r["text"], items, 4)
        f = r["found"]
        assert f["n_words"] == n and set(f["items"]) == met
        assert {p for s in f["spans"] for p in range(s["start"], s["end"])} == hit, r["text"]
    left = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(frame, given, 4, 0.5, shard_words).collect()}
    for i, text in docs:
        n, hit, _ = plain_matches(text, items, 4)
        assert (i in left) == (len(hit) <= 0.5 * n)
        if i in left and not hit:
            assert left[i] == text
        elif i in left:
            assert len(plain_matches(left[i], [], 4)[0:1]) and plain_matches(left[i], [], 4)[0] == n - len(hit)
    assert decontaminate.matches(odd_docs, given, 4).count() == odd_docs.count()
    assert decontaminate.decontaminate(odd_docs, given.where("false"), 4).count() == odd_docs.count()
    assert rows(decontaminate.decontaminate(no_docs, given, 4)) == []


# -- 9 near-duplicates ------------------------------------------------------------------------


def shingle_set(text, words=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates(spark, block):
    rng = random.Random(5)
    texts = []
    for _ in range(40):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(3, 200))]
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"W{rng.randrange(500)}"
            texts.append(rng.choice([" ", "\n"]).join(own))
    texts += texts[:20] + [None, "", " \t", " ", "one", "ONE"]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    sets = {i: shingle_set(t) for i, t in docs}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    roots = dict(roots_of(links))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(frame, block=block).collect()}
    for i in sets:
        assert (got[i]["n_shingles"], got[i]["component_id"]) == (len(sets[i]), roots.get(i, i))
        assert got[i]["kept"] == (roots.get(i, i) == i)


def test_rows_of_one_hash_are_told_apart(spark, monkeypatch):
    """Were the first hash of all rows the same, no row would be lost and none joined to another."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(30)) for _ in range(12)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(20, texts[0]), (21, texts[1] + " x"), (22, None), (None, texts[2])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = sorted(map(repr, neardup.near_duplicates(frame).drop("row", "row2").collect()))
    kept = sorted(map(repr, neardup.without_copies(frame).collect()))
    whole = neardup._names
    monkeypatch.setattr(neardup, "_names", lambda d, t: whole(d, t) | {"row": F.lit(7).cast("long")})
    assert sorted(map(repr, neardup.near_duplicates(frame).drop("row", "row2").collect())) == want
    assert sorted(map(repr, neardup.without_copies(frame).collect())) == kept and len(kept) == 13


def test_wide_arrow_offsets(spark, odd_docs):
    """The operators on buffers take 64-bit offsets as well."""
    def found():
        near = neardup.near_duplicates(odd_docs).drop("row", "row2").collect()
        named = language.predict(odd_docs.select("doc_id", "text"), language.train(odd_docs)).collect()
        return sorted(map(repr, near)), sorted(map(repr, named))

    want = found()
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        assert found() == want
        assert packing.pack(odd_docs, packing.vocabulary()).count() >= odd_docs.count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "false")


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    got = neardup.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    cat = [r for r in got if r["component_id"] == 1]
    assert sorted((r["doc_id"] or 0) for r in cat) == [0, 1, 2, 2] and sum(r["kept"] for r in cat) == 1
    assert all(r["component_id"] == r["doc_id"] for r in got if not r["n_shingles"])
    left = neardup.without_copies(odd_docs)
    assert left.columns == odd_docs.columns
    ids = Counter(r["doc_id"] for r in left.collect())
    assert ids[1] == 1 and ids[2] == 1 and ids[9] == 1 and ids[10] == 0 and ids[7] == 1 and ids[8] == 0
    assert rows(neardup.near_duplicates(no_docs)) == [] and rows(neardup.without_copies(no_docs)) == []


# -- 10 licences ------------------------------------------------------------------------------


def test_licenses(spark):
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
    files = [
        (1, "r/LICENSE", "Released under the MIT License.\nCopyright someone"), (2, "r/a.c", "int x;"), (3, "r/s/b.c", f"// {apache}\nint y;"),
        (4, "r/s/t/c.c", "code"), (5, "r/s/t/COPYING", "This work is licensed under the GNU General Public License, version 3."), (6, "q/d.c", "code"),
        (12, "q/z.py", "# This program is free software; you can redistribute it and/or modify it\n# under the terms of the GNU General Public License as published by the\n# Free Software Foundation; either version 2 of the License, or\n# (at your option) any later version.\nprint('mit')"),
        (7, None, "Licensed under CC BY-NC 4.0."), (8, "r/e.c", None), (9, "r/f.c", ""), (10, "r/s/t/u/v/g.c", "the license of this is unclear to me and to all of us"),
        (2, "r/a.c", "int x;"), (11, "LICENSE-top", "nothing about it"), (None, None, None),
    ]
    frame = spark.createDataFrame(files, "file_id long, path string, text string").withColumn("given", F.lit(1)).withColumn("above", F.lit(2))
    got = {r["file_id"]: (r["license"], r["origin"], r["inherited_from"]) for r in licenses.scan(frame).collect()}
    assert got[1] == ("MIT", "licence file", None)
    assert got[2] == ("MIT", "inherited", "r") and got[8] == got[2] and got[9] == got[2]
    assert got[3] == ("Apache-2.0", "header", None)
    assert got[4] == ("GPL-3.0", "inherited", "r/s/t") and got[5] == ("GPL-3.0", "licence file", None)
    assert got[12] == ("GPL-2.0", "header", None)
    assert got[6] == (None, None, None) and got[7] == ("CC-BY-NC-4.0", "header", None)
    assert got[10] == ("GPL-3.0", "inherited", "r/s/t") and got[11] == (None, None, None) and got[None] == (None, None, None)
    assert licenses.scan(frame).count() == len(files)
    assert rows(licenses.scan(frame.where("false"))) == []


def test_license_cosines_match_plain_tf_idf(spark):
    texts = ["Released under the MIT License.", "Released under the MIT License, see below.", "This is licensed under the GNU General Public License, version 2", "free software, license"]
    frame = spark.createDataFrame([(i, f"d/{i}", t) for i, t in enumerate(texts)], "file_id long, path string, text string")
    got = {r["file_id"]: r["cosine"] for r in licenses.scan(frame, threshold=0.0).collect()}
    cut = lambda t: Counter(re.findall(r"[a-z]+|[0-9]+(?:\.[0-9]+)*", t.lower()))
    bags, patterns = [cut(t) for t in texts], [cut(t) for _, t in licenses.TEMPLATES]
    df = Counter(w for b in bags + patterns for w in b)
    n = len(bags) + len(patterns)

    def vector(b):
        v = {w: c * (math.log((n + 1) / (df[w] + 1)) + 1) for w, c in b.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    for i, b in enumerate(bags):
        own = vector(b)
        assert got[i] == pytest.approx(max(sum(own.get(w, 0) * x for w, x in vector(p).items()) for p in patterns), abs=1e-8)


def test_candidates_of_a_contact_list(spark):
    """Thousands of spans in one text: base and looser ones, and the text put together again, as in plain Python."""
    rng = random.Random(12)
    parts = ["mail a.b@c.de", "10.0.0.1", "+1 (743) 555-3824", "4111 1111 1111 1111", "call 555-123-4567", "joe [at] x [dot] org", "é", "x", "1.2.3.4.5"]
    text = "; ".join(rng.choice(parts) for _ in range(6000))
    frame = spark.createDataFrame([(1, text), (2, "é" * 50 + " a@b.c " + "ü" * 700 + " 555-123-4567")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.candidates(frame).collect()}
    for doc in found.values():
        whole = doc["text"]
        strict = [s for s in doc["candidates"] if s["base"]]
        assert [f"{pii.KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in strict] == plain_base(whole)
        assert all(whole.encode()[s["from"] : s["to"]].decode() == whole[s["start"] : s["end"]] for s in doc["candidates"])
        loose = []
        for kind in pii.LOOSE:
            for m in re.finditer(pii.LOOSE[kind], whole):
                if not any(s["start"] < m.end() and m.start() < s["end"] for s in strict):
                    loose.append((kind, m.start(), m.end()))
        assert [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in doc["candidates"] if not s["base"]] == loose
    clean = {r["doc_id"]: r["text"] for r in pii.replace_spans(pii.candidates(frame), None).collect()}
    for doc_id, doc in found.items():
        spans, out, at = [], [], 0
        for s in sorted((s["start"], s["end"], s["kind"]) for s in doc["candidates"] if s["base"]):
            if spans and s[0] < spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], s[1]), spans[-1][2])
            else:
                spans.append(s)
        for start, end, kind in spans:
            out += [doc["text"][at:start], f"[{pii.KINDS[kind].upper()}]"]
            at = end
        assert clean[doc_id] == "".join(out) + doc["text"][at:]
