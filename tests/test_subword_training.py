"""Subword training in windows against counting everything after every merge; the tokenizer as an estimator."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tidewell.operators import subword_train, wordpiece


def counted_merges(counts, rounds, least=2):
    """(a, b) of every merge: all pairs are counted again whenever something changed."""
    words = {w: [c if i == 0 else "##" + c for i, c in enumerate(w)] for w in counts}
    piece, pair, where = Counter(), Counter(), defaultdict(set)
    for w, p in words.items():
        for t in p:
            piece[t] += counts[w]
        for x in zip(p, p[1:]):
            pair[x] += counts[w]
            where[x].add(w)
    out = []
    for _ in range(rounds):
        scored = [(-n / (piece[a] * piece[b]), a, b) for (a, b), n in pair.items() if n >= least]
        if not scored:
            break
        _, a, b = min(scored)
        out.append((a, b))
        for w in list(where[a, b]):
            p, q = words[w], subword_train.merge_once(words[w], a, b, a + b[2:])
            for t in p:
                piece[t] -= counts[w]
            for x in zip(p, p[1:]):
                pair[x] -= counts[w]
            for t in q:
                piece[t] += counts[w]
            for x in zip(q, q[1:]):
                pair[x] += counts[w]
                where[x].add(w)
            words[w] = q
    return out


def invented(n, seed, letters="abcdefgh"):
    rng = random.Random(seed)
    parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 4))) for _ in range(30)]
    return {"".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))): rng.choice([1, 2, 3, 10, 500]) for _ in range(n)}


@pytest.mark.parametrize("window", [0, 3, 40, 100_000])
def test_windows_give_the_merges_of_one_by_one(spark, window):
    counts = invented(120, 3) | {"aaaaaa": 7, "aaaa": 5, "x": 2, "qz": 1}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    start = len(wordpiece.SPECIALS) + len({p for w in counts for p in [w[0], *("##" + c for c in w[1:])]})
    rounds = 6 if window == 0 else 40
    vocab, merges = wordpiece.train(frame, start + rounds, window=window)
    assert [m[:2] for m in merges] == counted_merges(counts, len(merges))
    assert len(vocab) == len(set(vocab)) == start + rounds


def test_four_thousand_tokens(spark):
    rng = random.Random(8)
    counts = {"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(4, 9))): rng.randrange(2, 40) for _ in range(1300)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    vocab, merges = wordpiece.train(frame, 4000)
    assert len(vocab) == len(set(vocab)) == 4000
    assert [m[:2] for m in merges] == counted_merges(counts, len(merges))


def test_training_ends_without_pairs(spark):
    frame = spark.createDataFrame([("a", 5), ("bc", 1)], "word string, n long")
    vocab, merges = wordpiece.train(frame, 50)
    assert merges == [] and vocab == [*wordpiece.SPECIALS, "##c", "a", "b"]
    none = spark.createDataFrame([], "word string, n long")
    assert wordpiece.train(none, 50) == (wordpiece.SPECIALS, [])


def test_both_vocabulary_rules(spark):
    counts = {"low": 5, "lower": 2, "newest": 6, "widest": 3}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    alphabet = {p for w in counts for p in [w[0], *("##" + c for c in w[1:])]}
    vocab, merges = wordpiece.train(frame, len(alphabet) + 3, rule="sorted")
    assert len(merges) == 3
    everything = sorted(alphabet | {m[2] for m in merges})
    assert vocab == ["[PAD]", "[UNK]", "[CLS]", "[SEP]", *everything[: len(alphabet) + 3 - 4]]
    with pytest.raises(ValueError):
        wordpiece.train(frame, 20, rule="other")


def test_estimator_saves_and_loads(spark, tmp_path):
    texts = ["Hello world, hello there!", "low lower lowest", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    estimator = wordpiece.SubwordTokenizer(vocab_size=60, minFrequency=1)
    estimator.write().save(str(tmp_path / "estimator"))
    assert wordpiece.SubwordTokenizer.load(str(tmp_path / "estimator")).getOrDefault("vocabSize") == 60
    model = estimator.fit(docs)
    model.write().save(str(tmp_path / "model"))
    again = wordpiece.SubwordModel.load(str(tmp_path / "model"))
    assert again.get_vocab() == model.get_vocab() and again.merges == model.merges
    assert again.encode("Hello lower") == model.encode("Hello lower")
    assert model.decode_ids(model.encode("Hello lower")["ids"]) == "hello lower"
    whole = Pipeline(stages=[wordpiece.SubwordTokenizer(60, 1)]).fit(docs)
    whole.write().save(str(tmp_path / "pipeline"))
    rows = [sorted(map(tuple, m.transform(docs).select("doc_id", "ids", "starts").collect()), key=repr) for m in
            (model, again, whole, PipelineModel.load(str(tmp_path / "pipeline")))]
    assert all(r == rows[0] for r in rows) and len(rows[0]) == len(texts)
    # one text is cut as a table of texts is
    for r in model.transform(docs.where(F.col("text").isNotNull())).collect():
        assert model.encode(r["text"])["ids"] == r["ids"]


def test_encoding_and_decoding_in_small_slices(spark, monkeypatch):
    """Slices of a few words and a memo of a few words give what whole batches give, nulls and empty texts included."""
    monkeypatch.setattr(wordpiece, "_SLICE_WORDS", 3)
    monkeypatch.setattr(wordpiece, "_MEMO_WORDS", 2)
    texts = ["low lower, lowest low", None, "", "  low\tΩ low ", "low " * 40, "lower"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    vocab = wordpiece.vocab_table(spark, [*wordpiece.SPECIALS, "low", "##er", ","])
    rows = {r["doc_id"]: r for r in wordpiece.encode(docs, vocab).collect()}
    assert rows[0]["tokens"] == ["low", "low", "##er", ",", "[UNK]", "low"]
    assert (rows[0]["starts"], rows[0]["ends"]) == ([0, 4, 7, 9, 11, 18], [3, 7, 9, 10, 17, 21])
    assert rows[1]["ids"] == rows[2]["ids"] == [] and rows[2]["tokens"] == []
    assert (rows[3]["ids"], rows[3]["starts"]) == ([5, 1, 5], [2, 6, 8])
    assert rows[4]["starts"] == list(range(0, 160, 4)) and rows[5]["ids"] == [5, 6]
    ids = spark.createDataFrame([(0, [5, 6, 99, None, -1]), (1, None), (2, []), (3, [2, 5, 7])], "doc_id long, ids array<int>").coalesce(1)
    back = {r["doc_id"]: r["decoded"] for r in wordpiece.decode(ids, "ids", vocab).collect()}
    assert back == {0: "lower[UNK][UNK][UNK]", 1: None, 2: "", 3: "[CLS]low,"}


def test_words_of_a_task_are_cut_into_bounded_slices():
    import pyarrow as pa

    lists = pa.array([["a"] * 4, None, [], ["b"] * 9, ["c"], ["d"]])
    assert [*wordpiece._slices(lists, 4)] == [(0, 3), (3, 4), (4, 6)]


def test_words_beyond_the_window_need_few_rounds(spark, monkeypatch):
    """Many words over a small alphabet: most words hold only frequent pieces, yet a round makes many merges."""
    counts = invented(3000, 5, "abcdefghijklmnopqrstuvwxyz")
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    rounds = []
    count_pairs = subword_train.count_pairs
    monkeypatch.setattr(subword_train, "count_pairs", lambda words: rounds.append(1) or count_pairs(words))
    start = len(wordpiece.SPECIALS) + len({p for w in counts for p in [w[0], *("##" + c for c in w[1:])]})
    _, merges = wordpiece.train(frame, start + 60, window=len(counts) // 3)
    assert [m[:2] for m in merges] == counted_merges(counts, len(merges)) and len(merges) >= 60
    assert len(rounds) <= 12


def test_no_rows_wait_for_encoding_or_decoding(spark):
    """Rows with their texts and words are not queued beside the Python workers; other columns come through."""
    vocab = wordpiece.vocab_table(spark, [*wordpiece.SPECIALS, "a", "b", "##b"])
    rows = [(1, "ab a", [1.5]), (2, None, None), (3, "zz b", [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other array<double>")
    encoded = wordpiece.encode(docs, vocab)
    decoded = wordpiece.decode(encoded, "ids", vocab, skip="id")
    assert "EvalPython" not in decoded._jdf.queryExecution().executedPlan().toString()
    got = {r["doc_id"]: r for r in decoded.collect()}
    assert {k: (r["text"], r["other"]) for k, r in got.items()} == {r[0]: r[1:] for r in rows}
    assert {k: r["tokens"] for k, r in got.items()} == {1: ["a", "##b", "a"], 2: [], 3: ["[UNK]", "b"]}
    assert {k: r["starts"] for k, r in got.items()} == {1: [0, 1, 3], 2: [], 3: [0, 3]}
    assert {k: r["decoded"] for k, r in got.items()} == {1: "ab a", 2: "", 3: "b"}
