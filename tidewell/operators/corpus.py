"""Token streams: vocabularies, windows over chained documents, batches, padding and masking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.hashing import mix, uniform
from tidewell.functions.numeric import pad_to
from tidewell.operators.ordered import position, running

# Ids 0 and 1, and the characters that have an id of their own, in id order from 2.
PAD, UNK = "<pad>", "<unk>"
ALPHABET = (
    "abcdefghijklmnopqrstuvwxyz"
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    "0123456789"
    "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
)
SEPARATOR = "<|endoftext|>"

# ids of documents and rows are dense, so buckets of this width stay small
WIDTH = 1 << 16


def word_vocabulary(tokens: DataFrame, min_freq: int = 20, cap: int = 100_000) -> DataFrame:
    """(token, id): ``<pad>`` 0, ``<unk>`` 1, then by falling count, word order on ties.

    The cap is taken before the floor.  Numbering is a window over at most ``cap`` rows.
    """
    top = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "token").limit(cap)
    kept = top.where(F.col("n") >= min_freq)
    ranked = kept.select("token", (F.row_number().over(Window.orderBy(F.col("n").desc(), "token")) + 1).alias("id"))
    heads = tokens.sparkSession.createDataFrame([(PAD, 0), (UNK, 1)], "token string, id int")
    return heads.unionByName(ranked)


def char_ids(word: Column, word_len: int) -> Column:
    """Ids of the first ``word_len`` characters, filled up with 0; unknown characters are 1."""
    chars = F.slice(F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0)), 1, word_len)
    ids = F.transform(chars, lambda c: F.when(F.instr(F.lit(ALPHABET), c) > 0, F.instr(F.lit(ALPHABET), c) + 1).otherwise(1))
    return pad_to(ids, word_len, F.lit(0))


def content_mask(chars: Column) -> Column:
    """Per word 1 if any character id is not 0, else 0."""
    return F.transform(chars, lambda w: F.exists(w, lambda c: c != 0).cast("int"))


def chain(docs: DataFrame, tokens: str = "tokens", separator: str | None = None) -> DataFrame:
    """(doc_id, tokens, start): place of each document in the stream of all tokens, by doc_id.

    ``separator`` is put between documents.  Only one row per document is ordered;
    tokens stay where they are.
    """
    d = docs.select("doc_id", F.col(tokens).alias("tokens"))
    if separator is not None:
        last = docs.agg(F.max("doc_id").alias("m")).scalar()
        d = d.withColumn(
            "tokens", F.when(F.col("doc_id") == last, F.col("tokens")).otherwise(F.concat("tokens", F.array(F.lit(separator))))
        )
    sizes = d.select("doc_id", F.size("tokens").alias("_n"))
    starts = running(sizes, ["doc_id"], {"start": ("sum", F.col("_n").cast("long"))}, inclusive=False, width=WIDTH)
    return d.join(starts.select("doc_id", "start"), "doc_id")


def windows(stream: DataFrame, length: int, stride: int | None = None) -> DataFrame:
    """(window, inputs, targets): ``length`` tokens and the same tokens one place on.

    Window w starts at ``w * stride``; it needs ``length + 1`` tokens.  A document
    sends each window only the slice that belongs to it, so a window is put
    together from a few short arrays.
    """
    stride = stride or length
    size = F.size("tokens")
    first = F.greatest(F.ceil((F.col("start") - length) / F.lit(stride)), F.lit(0)).cast("long")
    last = F.floor((F.col("start") + size - 1) / F.lit(stride)).cast("long")
    ids = F.when((size > 0) & (first <= last), F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    def part(w: Column) -> Column:
        begin = F.greatest(w * stride, F.col("start"))
        end = F.least(w * stride + length + 1, F.col("start") + size)
        piece = F.slice("tokens", (begin - F.col("start") + 1).cast("int"), F.greatest(end - begin, F.lit(0)).cast("int"))
        return F.struct(w.alias("window"), begin.alias("at"), piece.alias("piece"))

    parts = stream.select(F.inline(F.transform(ids, part)))
    whole = parts.where(F.size("piece") > 0).groupBy("window").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("p")
    )
    joined = whole.select("window", F.flatten(F.transform("p", lambda x: x["piece"])).alias("t")).where(F.size("t") == length + 1)
    return joined.select("window", F.slice("t", 1, length).alias("inputs"), F.slice("t", 2, length).alias("targets"))


def batches(df: DataFrame, order: str, size: int, drop_last: bool = True) -> DataFrame:
    """Add ``batch``: consecutive rows in ``order``; an incomplete last batch is dropped."""
    p = position(df, [order], name="_pos", width=WIDTH).withColumn("batch", F.floor(F.col("_pos") / size))
    if drop_last:
        full = F.floor(df.agg(F.count(F.lit(1)).alias("n")).scalar() / size)
        p = p.where(F.col("batch") < full)
    return p.drop("_pos")


def pad_batches(df: DataFrame, ids: str, max_len: int) -> DataFrame:
    """Cut ``ids`` to ``max_len`` and fill with 0 up to the longest row of the batch; add the mask.

    The longest row is an aggregate joined back, so batches are not gathered.
    """
    cut = df.withColumn(ids, F.slice(ids, 1, max_len))
    longest = cut.groupBy("batch").agg(F.max(F.size(ids)).alias("padded_len"))
    j = cut.join(longest, "batch").withColumn("_n", F.size(ids))
    mask = F.concat(F.array_repeat(F.lit(1), F.col("_n")), F.array_repeat(F.lit(0), F.col("padded_len") - F.col("_n")))
    return j.withColumn("mask", mask).withColumn(ids, pad_to(F.col(ids), F.col("padded_len"), F.lit(0))).drop("_n")


def mask_tokens(rows: DataFrame, vocab_size: int, mask_id: int, prob: float = 0.15, seed: int = 42) -> DataFrame:
    """Masked-token corruption of (doc_id, pos, id) rows: adds ``selected`` and ``masked_id``.

    Of the selected tokens 80 % become ``mask_id``, 10 % a random id and 10 % stay.
    The three draws are hashed from document and position, so any task repeats them.
    """
    key = (F.col("doc_id"), F.col("pos"))
    selected = uniform(*key, seed=seed) < prob
    how = uniform(*key, seed=seed + 1)
    other = mix(*key, seed=seed + 2) % vocab_size
    masked = F.when(how < 0.8, F.lit(mask_id)).when(how < 0.9, other).otherwise(F.col("id"))
    return rows.withColumn("selected", selected.cast("int")).withColumn(
        "masked_id", F.when(selected, masked).otherwise(F.col("id"))
    )


def masked_mean(loss: Column, mask: Column, eps: float = 1e-8) -> Column:
    """Aggregate: ``sum(loss * mask) / (sum(mask) + eps)``."""
    return F.sum(loss * mask) / (F.sum(mask) + F.lit(eps))


def batch_accuracy(df: DataFrame, batch: str, truth: str, predicted: str) -> DataFrame:
    """Mean over batches of each batch's accuracy, all batches counting the same."""
    per = df.groupBy(batch).agg(F.avg(F.when(F.col(truth) == F.col(predicted), 1.0).otherwise(0.0)).alias("a"))
    return per.agg(F.avg("a").alias("accuracy"), F.count(F.lit(1)).alias("n_batches"))


def neighbour_targets(tokens: Column) -> Column:
    """Array of (token, forward, backward): the next and the previous token, NULL at the ends."""
    none = F.array(F.lit(None).cast("string"))
    size = F.size(tokens)
    forward = F.concat(F.slice(tokens, F.lit(2), F.greatest(size, F.lit(1))), none)
    backward = F.concat(none, F.slice(tokens, F.lit(1), F.greatest(size - 1, F.lit(0))))
    return F.arrays_zip(tokens.alias("token"), forward.alias("forward"), backward.alias("backward"))


def target_summary(rows: DataFrame, most: int = 1 << 21) -> DataFrame:
    """Per ``token``: ``n`` rows, ``n_forward`` and ``n_backward`` of them with a neighbour, ``first_forward`` and
    ``last_backward`` in order.

    Tasks summarise their rows first, about ``most`` of them at a time, so that a task's summaries
    move and no rows are sorted.
    """
    kinds = {f.name: f.dataType for f in rows.select("token", "forward", "backward").schema.fields}
    long = T.LongType()
    schema = T.StructType(
        [T.StructField("token", kinds["token"]), *[T.StructField(c, long) for c in ("n", "n_forward", "n_backward")],
         T.StructField("first_forward", kinds["forward"]), T.StructField("last_backward", kinds["backward"])]
    )
    sums = [("n", "sum"), ("n_forward", "sum"), ("n_backward", "sum"), ("first_forward", "min"), ("last_backward", "max")]

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def merged() -> pa.Table:
            found = pa.concat_tables(held).group_by("token", use_threads=False).aggregate(sums)
            return found.select(["token", *[f"{c}_{how}" for c, how in sums]]).rename_columns(schema.names)

        for batch in batches:
            token, forward, backward = (batch.column(c) for c in ("token", "forward", "backward"))
            ones = [pa.array(np.ones(len(token), np.int64)), *[pc.is_valid(c).cast(pa.int64()) for c in (forward, backward)]]
            held.append(pa.Table.from_arrays([token, *ones, forward, backward], names=schema.names))
            size += len(token)
            if size > most:
                held = [merged()]
                size = held[0].num_rows
                if 2 * size > most:  # mostly different: handed on, else every merge would gain little
                    yield from held[0].to_batches(1 << 16)
                    held, size = [], 0
        if held:
            yield from merged().to_batches(1 << 16)

    parts = rows.select("token", "forward", "backward").mapInArrow(summarise, schema)
    return parts.groupBy("token").agg(
        *[F.sum(c).alias(c) for c in ("n", "n_forward", "n_backward")],
        F.min("first_forward").alias("first_forward"), F.max("last_backward").alias("last_backward"),
    )


def shuffled_position(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Add ``place``: the row's place in a seeded permutation that no partitioning can change.

    Hashes are uniform, so ranges of equal width hold equal numbers of rows.
    """
    h = df.withColumn("_h", mix(F.col(key), seed=seed))
    return position(h, ["_h", key], name="place", width=(1 << 31) // 4096).drop("_h")


def buffered_shuffle(df: DataFrame, order: str, buffer: int = 2048, seed: int = 0) -> DataFrame:
    """Add ``buffer_no`` and ``place``: rows are shuffled only inside consecutive buffers."""
    p = position(df, [order], name="_pos", width=WIDTH).withColumn("buffer_no", F.floor(F.col("_pos") / buffer))
    w = Window.partitionBy("buffer_no").orderBy(mix(F.col(order), seed=seed), order)
    return p.withColumn("place", F.row_number().over(w) - 1).drop("_pos")


def sample_with_replacement(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """(draw, key): ``n`` hashed picks among the rows; a row may be picked twice."""
    total = df.agg(F.count(F.lit(1)).alias("n"))
    draws = total.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw"), "n")
    picks = draws.select("draw", (mix(F.col("draw"), seed=seed) % F.col("n")).alias("_pos"))
    return position(df.select(key), [key], name="_pos", width=WIDTH).join(picks, "_pos").select("draw", key)
