"""Periodic runs, token files and the manifest against plain Python."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import manifest, periodic, tokenstore

PATH = public_tokenizers.path("byte_bpe_50k.json")


def rows(df):
    return [tuple(r) for r in df.collect()]


# -- 11 periodic runs -------------------------------------------------------------------------


def plain_runs(words):
    """Every lag against every word."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if j > i and length >= max(6, 4 * q):
                found.setdefault((start, length), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def searched(texts):
    return list(periodic._searched([t.encode() for t in texts], 6, 4))


def test_runs_of_random_texts():
    rng = random.Random(5)
    texts = []
    for _ in range(1500):
        k = rng.choice([1, 2, 2, 3, 9])
        words = [str(rng.randrange(k)) for _ in range(rng.choice([0, 5, 6, 20, 80]))]
        for _ in range(rng.randrange(3)):
            part = [str(rng.randrange(k)) for _ in range(rng.randrange(1, 18))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (part * rng.randrange(3, 9))[: rng.randrange(4, 130)]
        texts.append(" ".join(words))
    for text, (n, runs, collapsed) in zip(texts, searched(texts)):
        assert n == len(text.split()) and runs == plain_runs(text.split())
        assert collapsed.decode() == plain_collapsed(text.split(), runs)


@pytest.mark.parametrize("kind", ["fibonacci", "one word", "nested", "thue-morse", "counter"])
def test_runs_of_structured_texts(kind):
    words = ["a", "b"]
    if kind == "fibonacci":
        a, b = ["a"], ["a", "b"]
        while len(b) < 1500:
            a, b = b, b + a
        words = b
    elif kind == "one word":
        words = ["x"] * 2500
    elif kind == "nested":
        words = ((["a"] * 8 + ["b"]) * 9 + ["c"]) * 7
    elif kind == "thue-morse":
        words = [str(bin(i).count("1") % 2) for i in range(1024)]
    else:
        words = [str(i % 300) for i in range(1300)]
    assert searched([" ".join(words)])[0][1] == plain_runs(words)


def test_long_text_of_one_word():
    n = 300_000
    assert searched(["x " * n])[0][1] == [(0, n, 1)]


def test_runs_of_odd_rows(odd_docs, no_docs):
    got = periodic.periodic_runs(odd_docs.withColumn("runs", F.lit("clash")), ["doc_id"])
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    want = []
    for doc_id, text in odd_docs.select("doc_id", "text").collect():
        words = [w for w in (text or "").encode().split()]
        runs = plain_runs(words) if len(words) < 1000 else None
        want.append((doc_id, len(words), runs))
    found = [(r[0], r[1], [tuple(x) for x in r[2]]) for r in got.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for a, b in zip(sorted(found, key=key), sorted(want, key=key)):
        assert a[:2] == b[:2] and (b[2] is None or a[2] == b[2])
    assert rows(periodic.periodic_runs(no_docs)) == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(odd_docs, periods=2)


def plain_planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return [w.decode() for w in words]


def test_op11_query(spark, tmp_path):
    rng = random.Random(2)
    docs = [(i, "\t".join(rng.choice("abcdefg") for _ in range(rng.randrange(90)))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, " \n "), (1003, "né " * 9)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for doc_id, text in docs:
        words = plain_planted(doc_id, text)
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((
            doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
        ))
    assert sorted(rows(periodic.op11_periodic(spark, str(tmp_path)))) == want
    assert sum(w[1] > 0 for w in want) > 10


# -- 12 token files ---------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["random", "small", "empty", "wide", "long"])
def test_codes_round_trip(kind):
    rng = np.random.default_rng(3)
    ids = {
        "random": rng.integers(0, 50_257, 5000), "small": np.arange(200), "empty": np.zeros(0, np.int64),
        "wide": rng.integers(0, 1 << 32, 3000, dtype=np.uint64), "long": rng.choice([3, 300, 70_000], 40_000),
    }[kind].astype(np.uint32)
    data = tokenstore.file_bytes([7, 9], np.array([0, len(ids) // 2, len(ids)]), ids)
    asked = []

    def read(at, size):
        asked.append(size)
        return data[at : at + size]

    opened = tokenstore.TokenFile(read)
    assert (opened.tokens(0, len(ids)) == ids).all()
    assert opened.doc_ids(0, 2).tolist() == [7, 9] and opened.firsts(0, 3).tolist() == [0, len(ids) // 2, len(ids)]
    asked.clear()
    for at in rng.integers(0, max(1, len(ids)), 200 if len(ids) else 0):
        assert opened.tokens(at, at + 1).tolist() == [ids[at]]
        end = min(len(ids), at + int(rng.integers(0, 900)))
        assert (opened.tokens(at, end) == ids[at:end]).all()
    # a look-up reads its own bytes and part of one stride of each bitmap
    assert max(asked, default=0) <= 900
    with pytest.raises(ValueError):
        tokenstore.TokenFile(lambda at, size: b"0" * size)


TEXTS = [
    None, "", " ", "  two  spaces ", "tail \n", "\n\n\nfoo\n bar\tbaz  \t qux", "don't we'll I'M it's 'tis ''", "a<|endoftext|>b  <|endoftext|> c",
    "naïve Größe ſtraße × ÷ ² ½ µ", "space nbsp thin", "ctrl \x1c\x1d x\x00y \x85 z", "Привет мир, 你好 😀 é", "x" * 5000,
    "3.14 1,000,000 abc123def 4807614710343232", "a.b@c.de, (+1) -- ...!? \"q\"", "<|endoftext|>", "  <|endoftext|>", "\r\n\r\nnext",
]


def plain_ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def test_words_give_the_tokenizers_ids():
    codec = tokenstore.WordTokenizer(PATH, 0, most=3)
    rng = random.Random(4)
    alphabet = "ab É'ſ.,\n\t 9  \r!"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for text in texts:
        assert codec.encode(text) == struct.pack(f"<{len(plain_ids(text))}I", *plain_ids(text)) if text in TEXTS else True
    for text, got in zip(texts, codec.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert codec.encode(text) == struct.pack(f"<{len(got.ids) + 1}I", *got.ids, 0), text


def test_token_files(spark, tmp_path, odd_docs, no_docs):
    odd = odd_docs.select("doc_id", "text", F.lit("p").alias("part"), F.lit(1).alias("ids"), F.lit("q").alias("path"))
    docs = odd.unionByName(spark.createDataFrame(list(enumerate(TEXTS, 100)), "doc_id long, text string")
                           .select("doc_id", "text", F.lit("p").alias("part"), F.lit(1).alias("ids"), F.lit("q").alias("path")))
    listed = tokenstore.write(docs, str(tmp_path / "store"), PATH, file_ids=2000)
    assert listed.count() == 3
    got = sorted(rows(tokenstore.read(listed, portion=3, token_limit=50)), key=lambda r: r[1])
    want = sorted(((r[0], r[1]) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r[0] for r in got] == [w[0] for w in want]
    start = 0
    for r in got:
        assert r[1] == start and r[2] == len(r[3]) // 4
        start += r[2]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    ids = [(w[0], struct.pack(f"<{len(plain_ids(w[1]))}I", *plain_ids(w[1]))) for w in want]
    assert sorted(((r[0], bytes(r[3])) for r in got), key=key) == sorted(ids, key=key)
    everything = b"".join(bytes(r[3]) for r in got)
    places = [0, 5, start - 1, start, -1, None, 5, *range(1990, 2010)]
    met = tokenstore.tokens_at(listed, spark.createDataFrame([(p,) for p in places], "place long"), width=512).collect()
    assert len(met) == len(places)
    for place, value in met:
        inside = place is not None and 0 <= place < start
        assert value == (struct.unpack_from("<I", everything, 4 * place)[0] if inside else None)
    none = tokenstore.write(no_docs, str(tmp_path / "none"), PATH)
    assert rows(none) == [] and rows(tokenstore.read(none)) == []


# -- 13 manifest ------------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_of(leaves, fanout):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path_of(levels, i, fanout):
    out = []
    for nodes in levels[:-1]:
        a = i - i % fanout
        out.append((nodes[a:i], nodes[i + 1 : a + fanout]))
        i //= fanout
    return out


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest(spark, fanout):
    rng = random.Random(fanout)
    docs = [(i, s) for s, n in [(None, 4), ("", 1), ("a", 28), ("é", 9), ("z", 3), ("=", 2)] for i in range(n)]
    docs += [(None, "a"), (None, "a"), (3, "a"), (3, "a")]
    docs = [(d, s, f"text {k // 2}\nof {s}", f"lo{k}") for k, (d, s) in enumerate(docs)]
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string, lo string").withColumn("n", F.lit(1)).repartition(5)
    leaves = frame.withColumn("leaf", manifest.leaf_digest([F.col("doc_id"), F.col("source"), F.col("text")]))
    found = manifest.manifest(leaves.withColumn("root", F.lit("clash")), "source", ["doc_id"], "leaf", fanout)
    found = found.select(
        "doc_id", "source", "text", "lo", F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
        F.lower(F.hex("root")).alias("root"), manifest.proof().alias("proof"), manifest.folded("leaf").alias("folded"),
    ).collect()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    trees = {}
    for d, s, t, _ in docs:
        trees.setdefault(s, []).append((d is not None, d or 0, digest(field(d), field(s), field(t))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: tree_of([x[2] for x in sorted(trees[s])], fanout) for s in names}
    top = tree_of([built[s][-1][0] for s in names], fanout)
    want = []
    for s in names:
        for i, leaf in enumerate(built[s][0]):
            path = path_of(built[s], i, fanout) + path_of(top, names.index(s), fanout)
            want.append((s or "~", leaf, built[s][-1][0], top[-1][0], digest(*[x for a, b in path for x in a + b]), top[-1][0]))
    assert sorted((r["source"] or "~", r["leaf"], r["subroot"], r["root"], r["proof"], r["folded"]) for r in found) == sorted(want)
    assert sorted(r["lo"] for r in found) == sorted(d[3] for d in docs)


def test_manifest_of_nothing_and_of_one(spark, no_docs, odd_docs):
    def of(docs):
        leaves = docs.select("doc_id", "source", manifest.leaf_digest([F.col("text")]).alias("leaf"))
        return manifest.manifest(leaves, "source", ["doc_id"], "leaf").select(
            "doc_id", manifest.proof().alias("proof"), manifest.folded("leaf").alias("folded"), F.lower(F.hex("root")).alias("root")
        ).collect()

    assert of(no_docs) == []
    one = of(odd_docs.where("doc_id = 3"))
    assert [(r["proof"], r["folded"]) for r in one] == [(digest(), digest("-"))] and one[0]["root"] == digest("-")
    odd = of(odd_docs)
    assert len(odd) == odd_docs.count() and all(r["folded"] == r["root"] for r in odd)
