"""Subword vocabulary: training on word counts, and applying it to a corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.text import WORD_OR_MARK, tidy_joined_text, words_and_marks
from tidewell.operators.subword_train import WINDOW, train_merges

# Special tokens, in id order.
SPECIALS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
SKIPPED_BY_NAME = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"]

# Larger vocabularies are not sent to the tasks; words are segmented by joins instead.
MAX_SENT_TOKENS = 1_000_000

# A task encodes so many words at a time and remembers so many segmented ones.
_SLICE_WORDS = 1 << 15
_MEMO_WORDS = 1 << 17


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.explode(words_and_marks(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def initial_pieces(word: Column) -> Column:
    """First character plain, later ones with ``##``."""
    chars = F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0))
    return F.transform(chars, lambda c, i: F.when(i == 0, c).otherwise(F.concat(F.lit("##"), c)))


def pair_scores(words: DataFrame, min_frequency: int = 2) -> DataFrame:
    """(a, b, freq, score) of neighbouring pieces; ``score = freq / (freq(a) * freq(b))``."""
    token = words.select(F.explode("pieces").alias("t"), "n").groupBy("t").agg(F.sum("n").alias("f"))
    k = F.greatest(F.size("pieces") - 1, F.lit(0))
    zipped = F.arrays_zip(F.slice("pieces", F.lit(1), k).alias("a"), F.slice("pieces", F.lit(2), k).alias("b"))
    pairs = words.select("n", F.inline(zipped)).groupBy("a", "b").agg(F.sum("n").alias("freq"))
    pairs = pairs.where(F.col("freq") >= min_frequency)
    j = pairs.join(token.select(F.col("t").alias("a"), F.col("f").alias("fa")), "a")
    j = j.join(token.select(F.col("t").alias("b"), F.col("f").alias("fb")), "b")
    score = F.col("freq").cast("double") / (F.col("fa").cast("double") * F.col("fb").cast("double"))
    return j.select("a", "b", "freq", score.alias("score"))


def best_pair(words: DataFrame, min_frequency: int = 2) -> tuple[str, str, float] | None:
    """The pair of the highest score over all words; of equal ones the first in order."""
    best = pair_scores(words, min_frequency).orderBy(F.col("score").desc(), "a", "b").limit(1).collect()
    return (best[0]["a"], best[0]["b"], best[0]["score"]) if best else None


def train(
    counts: DataFrame, vocab_size: int, min_frequency: int = 2, window: int = WINDOW, rule: str = "appended"
) -> tuple[list[str], list[tuple]]:
    """Vocabulary in id order and the merges (a, b, merged, score).

    Merges go on until the vocabulary has ``vocab_size`` entries; ties go to the pair that sorts
    first (``subword_train`` says how many are made per pass).  With the rule ``appended`` the five special tokens count towards the
    size and come first, then the alphabet, then merges as they are made.  With ``sorted`` the
    alphabet and the merges count, and the vocabulary is the four special tokens without the mask and
    the first entries of the sorted rest, cut to the size.
    """
    if rule not in ("appended", "sorted"):
        raise ValueError(f"unknown rule {rule}")
    words = counts.select("word", "n", initial_pieces(F.col("word")).alias("pieces"))
    alphabet = [r["t"] for r in words.select(F.explode("pieces").alias("t")).distinct().orderBy("t").collect()]
    held = len(alphabet) + (len(SPECIALS) if rule == "appended" else 0)
    merges = train_merges(words, {*alphabet, *SPECIALS}, vocab_size - held, min_frequency, window)
    # a merge can spell an entry that is there already
    made = [t for t in dict.fromkeys(m[2] for m in merges) if t not in {*alphabet, *SPECIALS}]
    if rule == "appended":
        return [*SPECIALS, *alphabet, *made], merges
    return [*SKIPPED_BY_NAME, *sorted([*alphabet, *made])[: max(0, vocab_size - len(SKIPPED_BY_NAME))]], merges


def vocab_table(spark, vocab: list[str]) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(vocab)], "token string, id int")


def segment_words(words: DataFrame, vocab: DataFrame, unknown: str = "[UNK]") -> DataFrame:
    """(word, pieces): longest match from the left by joins, for vocabularies of any size.

    Every substring no longer than the longest token is looked up once; the longest
    hit at each place is kept, and the word is walked from hit to hit.  A word with
    a place that has no hit is one unknown token.
    """
    plain = F.regexp_replace("token", "^##", "")
    longest = vocab.agg(F.max(F.length(plain)).alias("m")).scalar()
    w = words.select("word").distinct().withColumn("_m", longest)
    starts = w.select("word", "_m", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("i"))
    subs = starts.select(
        "word", "i", F.explode(F.sequence(F.col("i") + 1, F.least(F.length("word"), F.col("i") + F.col("_m")))).alias("e")
    )
    text = F.substr(F.col("word"), F.col("i") + 1, F.col("e") - F.col("i"))
    subs = subs.withColumn("token", F.when(F.col("i") == 0, text).otherwise(F.concat(F.lit("##"), text)))
    hits = subs.join(vocab, "token").groupBy("word", "i").agg(F.max(F.struct("e", "token", "id")).alias("h"))
    maps = hits.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("i", "h"))).alias("m"))
    piece = "array<struct<s:int,e:int,token:string,id:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(piece).alias("out"))

    def walk(acc: Column, _: Column) -> Column:
        h = F.try_element_at(F.col("m"), acc["at"])
        one = F.array(F.struct(acc["at"].alias("s"), h["e"].alias("e"), h["token"].alias("token"), h["id"].alias("id")))
        moved = F.struct(h["e"].alias("at"), F.concat(acc["out"], one).alias("out"))
        return F.when(h.isNull() | (acc["at"] < 0), F.struct(
            F.when(acc["at"] >= F.length("word"), acc["at"]).otherwise(F.lit(-1)).alias("at"), acc["out"].alias("out")
        )).otherwise(moved)

    unk = vocab.where(F.col("token") == unknown).select("id").scalar()
    whole = F.array(F.struct(F.lit(0).alias("s"), F.length("word").alias("e"), F.lit(unknown).alias("token"), unk.alias("id")))
    walked = words.select("word").distinct().join(maps, "word", "left").withColumn(
        "_r", F.aggregate(F.sequence(F.lit(1), F.length("word")), start, walk)
    )
    done = F.col("m").isNotNull() & (F.col("_r.at") == F.length("word"))
    return walked.select("word", F.when(done, F.col("_r.out")).otherwise(whole.cast(piece)).alias("pieces"))


_ENCODING = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("tokens", T.ArrayType(T.StringType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
    ]
)


def _slices(lists: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``size`` entries; a longer row is a range of its own."""
    upto = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo, done = 0, 0
    while lo < len(lists):
        hi = max(lo + 1, int(np.searchsorted(upto, done + size, side="right")))
        yield lo, hi
        lo, done = hi, int(upto[hi - 1])


class _Segmenter:
    """Longest matches from the left, with the latest words remembered."""

    def __init__(self, ids_of: dict[str, int], unknown: str):
        self.ids_of, self.unknown, self.memo = ids_of, unknown, {}

    def pieces(self, word: str) -> list[tuple[int, str, int, int]]:
        """(id, token, start, end) of each piece; one unknown token if a place has no match."""
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= _MEMO_WORDS:
                self.memo.clear()
            found = self.memo[word] = self._walk(word)
        return found

    def _walk(self, word: str) -> list[tuple[int, str, int, int]]:
        out, i = [], 0
        while i < len(word):
            for end in range(len(word), i, -1):
                token = word[i:end] if i == 0 else "##" + word[i:end]
                if token in self.ids_of:
                    out.append((self.ids_of[token], token, i, end))
                    i = end
                    break
            else:
                return [(self.ids_of[self.unknown], self.unknown, 0, len(word))]
        return out

    def encode(self, words: pa.Array, gaps: pa.Array) -> pa.Array:
        """Rows of ``_ENCODING``; every distinct word is looked up once, the rest is arithmetic on arrays."""
        n = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(words.flatten())
        code, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        segments = [self.pieces(w) for w in distinct]
        count = np.array([len(x) for x in segments], np.int64)
        flat = [x for segment in segments for x in segment]
        token = pa.array([x[1] for x in flat], pa.string())
        ident, start, end = (np.array([x[k] for x in flat], np.int32) for k in (0, 2, 3))

        # where each word starts: the gaps up to its own and the words before it
        row = np.repeat(np.arange(len(n)), n)
        rank = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n)
        m = pc.list_value_length(gaps).to_numpy(zero_copy_only=False).astype(np.int64)
        gap = gaps.flatten().to_numpy(zero_copy_only=False)[(np.cumsum(m) - m)[row] + rank].astype(np.int64)
        size = np.array([len(w) for w in distinct], np.int64)[code]
        upto = np.cumsum(gap + size)
        before = np.concatenate([[0], upto])[np.cumsum(n) - n]
        at = upto - size - before[row]

        each = count[code]
        place = np.repeat((np.cumsum(count) - count)[code] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, weights=each, minlength=len(n)).astype(np.int64))])
        rows = pa.array(offsets, pa.int32())
        at = np.repeat(at, each)
        values = [ident[place], token.take(pa.array(place)), (at + start[place]).astype(np.int32), (at + end[place]).astype(np.int32)]
        columns = [pa.ListArray.from_arrays(rows, v if isinstance(v, pa.Array) else pa.array(v)) for v in values]
        return pa.StructArray.from_arrays(columns, _ENCODING.names)


def encode(docs: DataFrame, vocab: DataFrame, text: str = "text", unknown: str = "[UNK]") -> DataFrame:
    """Add ``ids, tokens, starts, ends`` (character offsets in the lower-case text); a null text counts as empty.

    Words are cut in generated code.  With a vocabulary of bounded size the pieces
    are looked up in place: whole documents, no shuffle, a task holds the pieces of
    ``_SLICE_WORDS`` words or one document.  A larger vocabulary goes through ``segment_words``.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    gaps = F.transform(F.split(F.lower(whole), WORD_OR_MARK, -1), F.length)
    cut = docs.withColumns({"_words": words_and_marks(whole), "_gaps": gaps})
    if vocab.limit(MAX_SENT_TOKENS + 1).count() > MAX_SENT_TOKENS:
        return _encode_by_join(cut, vocab, docs.columns, unknown)
    known = vocab.select("token", "id").toArrow()
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(known["token"].to_pylist(), known["id"].to_pylist())))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Segmenter(table.value, unknown)
        for batch in batches:
            *_, words, gaps = batch.columns
            for lo, hi in _slices(words, _SLICE_WORDS):
                found = own.encode(words.slice(lo, hi - lo), gaps.slice(lo, hi - lo)).flatten()
                kept = [c.slice(lo, hi - lo) for c in batch.columns[:-2]]
                yield pa.RecordBatch.from_arrays([*kept, *found], [*batch.schema.names[:-2], *_ENCODING.names])

    # all columns go through the task: rows that wait for a function's result would be queued on disk
    return cut.select(*docs.columns, "_words", "_gaps").mapInArrow(pieces, T.StructType([*docs.schema.fields, *_ENCODING.fields]))


def _encode_by_join(cut: DataFrame, vocab: DataFrame, columns: list[str], unknown: str) -> DataFrame:
    """The same encoding with the words joined to their pieces; needs ``doc_id``."""
    rows = cut.select("doc_id", F.posexplode(F.arrays_zip(F.col("_words").alias("w"), F.col("_gaps").alias("g"))).alias("p", "z"))
    rows = rows.select("doc_id", "p", F.col("z.w").alias("word"), F.col("z.g").alias("gap")).where(F.col("word").isNotNull())
    rows = rows.withColumn("len", F.length("word"))
    from tidewell.operators.ordered import running

    # one key is one document here, so its rows are bounded by its own text
    at = running(rows, ["p"], {"_end": ("sum", (F.col("gap") + F.col("len")).cast("long"))}, ["doc_id"], width=1 << 16)
    seg = segment_words(cut.select(F.explode("_words").alias("word")).distinct(), vocab, unknown)
    j = at.withColumn("at", (F.col("_end") - F.col("len")).cast("int")).join(seg, "word")
    g = j.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("p", "at", "pieces"))).alias("r"))
    flat = F.flatten(
        F.transform(
            "r",
            lambda r: F.transform(
                r["pieces"], lambda x: F.struct(x["id"].alias("id"), x["token"].alias("token"), (r["at"] + x["s"]).alias("s"), (r["at"] + x["e"]).alias("e"))
            ),
        )
    )
    g = g.select("doc_id", flat.alias("f")).select("doc_id", F.col("f.id").alias("ids"), F.col("f.token").alias("tokens"), F.col("f.s").alias("starts"), F.col("f.e").alias("ends"))
    return cut.select(*columns).join(g, "doc_id", "left").select(
        *columns,
        *[F.coalesce(c, F.array().cast(t)).alias(c) for c, t in [("ids", "array<int>"), ("tokens", "array<string>"), ("starts", "array<int>"), ("ends", "array<int>")]],
    )


def add_specials(encoded: DataFrame, cls_id: int = 2, sep_id: int = 3) -> DataFrame:
    """``[CLS] x [SEP]`` with offsets (0, 0), attention mask and special-token mask."""
    around = lambda a, c, b: F.concat(F.array(F.lit(a)), F.col(c), F.array(F.lit(b)))
    n = F.size("ids")
    return encoded.select(
        *[c for c in encoded.columns if c not in ("ids", "tokens", "starts", "ends")],
        around(cls_id, "ids", sep_id).alias("ids"),
        around("[CLS]", "tokens", "[SEP]").alias("tokens"),
        around(0, "starts", 0).alias("starts"),
        around(0, "ends", 0).alias("ends"),
        F.array_repeat(F.lit(1), n + 2).alias("attention_mask"),
        F.concat(F.array(F.lit(1)), F.array_repeat(F.lit(0), n), F.array(F.lit(1))).alias("special_tokens_mask"),
    )


def pair_template(a: Column, b: Column, cls: Column, sep: Column) -> tuple[Column, Column]:
    """``[CLS] A [SEP] B [SEP]`` and its type ids (1 for B and its separator)."""
    joined = F.concat(F.array(cls), a, F.array(sep), b, F.array(sep))
    types = F.concat(F.array_repeat(F.lit(0), F.size(a) + 2), F.array_repeat(F.lit(1), F.size(b) + 1))
    return joined, types


def decode(
    df: DataFrame, ids: str, vocab: DataFrame, skip: str | None = None, key: str = "doc_id", max_sent: int = MAX_SENT_TOKENS
) -> DataFrame:
    """Add ``decoded``: pieces glued, gaps around punctuation closed.

    ``skip='id'`` leaves out ids up to 4, ``skip='name'`` the four special names
    (so ``[MASK]`` stays).  An id that is not in the vocabulary reads ``[UNK]``.
    A vocabulary of more than ``max_sent`` entries is joined to the single ids
    instead of being sent along; rows are then told apart by ``key``.
    """
    kept = F.filter(ids, lambda i: i > 4) if skip == "id" else F.col(ids)
    if vocab.limit(max_sent + 1).count() <= max_sent:
        known = vocab.where(F.col("id") >= 0).select(F.col("id").cast("long").alias("id"), "token").toArrow().sort_by("id")
        table = df.sparkSession.sparkContext.broadcast((known["id"].to_numpy(), known["token"].to_pylist()))

        def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, tokens = table.value
            # the last entry stands for ids that are not in the vocabulary
            token = pa.array([*tokens, "[UNK]"], pa.string())
            for batch in batches:
                lists = batch.columns[-1]
                for lo, hi in _slices(lists, _SLICE_WORDS):
                    part = lists.slice(lo, hi - lo)
                    wanted = pc.fill_null(part.flatten().cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
                    place = np.searchsorted(ids, wanted)
                    hit = place < len(ids)
                    hit[hit] = ids[place[hit]] == wanted[hit]
                    named = pc.fill_null(token.take(pa.array(np.where(hit, place, len(ids)))), "[UNK]")
                    upto = np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False).astype(np.int64))
                    empty = pc.is_null(part) if part.null_count else None
                    found = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], upto]), pa.int32()), named, mask=empty)
                    yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[:-1]), found], batch.schema.names)

        # as in ``encode``, rows go through the task as a whole
        out = T.StructType([*df.schema.fields, T.StructField("_tokens", T.ArrayType(T.StringType()))])
        named = df.select(*df.columns, kept.alias("_tokens")).mapInArrow(names, out)
    else:
        single = df.select(key, F.posexplode(kept).alias("_p", "_i"))
        names = vocab.select(F.col("id").alias("_i"), "token")
        found = single.join(names, "_i", "left").select(key, F.struct("_p", F.coalesce("token", F.lit("[UNK]")).alias("t")).alias("_s"))
        rows = found.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("_s")), lambda x: x["t"]).alias("_tokens"))
        named = df.join(rows, key, "left").withColumn("_tokens", F.coalesce("_tokens", F.array().cast("array<string>")))
    tokens = F.col("_tokens")
    if skip == "name":
        tokens = F.filter(tokens, lambda t: ~t.isin(*SKIPPED_BY_NAME))
    glued = F.array_join(
        F.transform(
            tokens,
            lambda t, i: F.when(t.startswith("##"), F.substr(t, F.lit(3))).when(i > 0, F.concat(F.lit(" "), t)).otherwise(t),
        ),
        "",
    )
    return named.withColumn("decoded", tidy_joined_text(glued)).drop("_tokens")


class _SubwordParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "column of texts", TypeConverters.toString)
    vocabSize = Param(Params._dummy(), "vocabSize", "entries of the vocabulary", TypeConverters.toInt)
    minFrequency = Param(Params._dummy(), "minFrequency", "least count of a merged pair", TypeConverters.toInt)
    rule = Param(Params._dummy(), "rule", "appended or sorted", TypeConverters.toString)


class SubwordTokenizer(Estimator, _SubwordParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator of a subword vocabulary: ``fit`` on a table of texts, alone or as a stage of a ``Pipeline``."""

    def __init__(self, vocab_size: int = 4000, min_frequency: int = 2, text: str = "text", rule: str = "appended", **params):
        super().__init__()
        self._setDefault(inputCol="text", vocabSize=4000, minFrequency=2, rule="appended")
        self._set(**({"inputCol": text, "vocabSize": vocab_size, "minFrequency": min_frequency, "rule": rule} | params))

    def _fit(self, dataset: DataFrame) -> "SubwordModel":
        counts = word_counts(dataset, self.getOrDefault("inputCol"))
        size, least = self.getOrDefault("vocabSize"), self.getOrDefault("minFrequency")
        vocab, merges = train(counts, size, least, rule=self.getOrDefault("rule"))
        return self._copyValues(SubwordModel(vocab, merges))


class SubwordModel(Model, _SubwordParams, MLReadable, MLWritable):
    """A fitted vocabulary: ``transform`` tables of texts, ``encode`` and ``decode`` single ones."""

    def __init__(self, vocab: list[str], merges: list[tuple]):
        super().__init__()
        self._setDefault(inputCol="text", vocabSize=4000, minFrequency=2, rule="appended")
        self.vocab = list(vocab)
        self.merges = [tuple(m) for m in merges]

    def vocab_df(self, spark) -> DataFrame:
        return vocab_table(spark, self.vocab)

    def get_vocab(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.vocab)}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_specials(encode(dataset, self.vocab_df(dataset.sparkSession), self.getOrDefault("inputCol")))

    def encode(self, text: str) -> dict:
        """Ids, tokens, character offsets and masks of one text, by a job of one row."""
        spark = SparkSession.active()
        one = self._transform(spark.createDataFrame([(text,)], f"`{self.getOrDefault('inputCol')}` string"))
        return one.drop(self.getOrDefault("inputCol")).first().asDict()

    def decode(self, df: DataFrame, ids: str = "ids", skip: str | None = "id") -> DataFrame:
        return decode(df, ids, self.vocab_df(df.sparkSession), skip)

    def decode_ids(self, ids: list[int], skip: str | None = "id") -> str:
        """The text of one list of ids."""
        return self.decode(SparkSession.active().createDataFrame([(ids,)], "ids array<int>"), "ids", skip).first()["decoded"]

    def write(self) -> MLWriter:
        return _SubwordWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SubwordReader()


class _SubwordWriter(MLWriter):
    def __init__(self, model: SubwordModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.vocab_df(self.sparkSession).write.parquet(f"{path}/vocab")
        merges = [(i, *m) for i, m in enumerate(self.model.merges)]
        frame = self.sparkSession.createDataFrame(merges, "rank int, a string, b string, merged string, score double")
        frame.write.parquet(f"{path}/merges")


class _SubwordReader(MLReader):
    def load(self, path: str) -> SubwordModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        vocab = self.sparkSession.read.parquet(f"{path}/vocab").orderBy("id").collect()
        merges = self.sparkSession.read.parquet(f"{path}/merges").orderBy("rank").collect()
        model = SubwordModel([r["token"] for r in vocab], [tuple(r)[1:] for r in merges])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
