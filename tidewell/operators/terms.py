"""Sparse text features in long form: the dense matrix never exists."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.numeric import idf, log_tf
from tidewell.operators.ordered import running, sorted_index
from tidewell.session import rewrite

UNKNOWN = "<unk>"


def term_counts(tokens: DataFrame) -> DataFrame:
    """(doc_id, token, n).  A document lies in one task, so its counts are complete before the shuffle."""
    return tokens.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


def counts_by_token(tokens: DataFrame) -> DataFrame:
    """``term_counts``, counted where the texts are and dealt by token once.

    What follows per token (frequencies, joins with a vocabulary) moves these rows no more; a
    word that many documents have is one row for each of them.
    """
    rows = tokens.select("doc_id", "token")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(["doc_id", "token"], use_threads=False).aggregate([([], "count_all")])
            yield from found.select(["doc_id", "token", "count_all"]).rename_columns(["doc_id", "token", "n"]).to_batches()

    part = rows.mapInArrow(count, T.StructType([*rows.schema.fields, T.StructField("n", T.LongType())]))
    return part.repartition("token").groupBy("doc_id", "token").agg(F.sum("n").alias("n"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """(token, df) from per-document counts: one row per document and token already."""
    return counts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def vocabulary(tokens: DataFrame, unknown: bool = False) -> DataFrame:
    """(token, idx): sorted distinct tokens from 0; ``<unk>`` takes the index after the last."""
    v = sorted_index(tokens.select("token").distinct(), "token")
    if not unknown:
        return v
    last = v.agg((F.coalesce(F.max("idx"), F.lit(-1)) + 1).alias("idx")).select(F.lit(UNKNOWN).alias("token"), "idx")
    return v.unionByName(last)


def tfidf(tokens: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, token, n, tf, idf, tfidf) with ``1 + log10(n)`` and ``log10(N / df)``."""
    return _weighted(counts_by_token(tokens), docs)


def _weighted(counts: DataFrame, docs: DataFrame) -> DataFrame:
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return _products(counts, document_frequency(counts).select("token", idf(n_docs, F.col("df")).alias("idf")))


def _products(counts: DataFrame, weights: DataFrame) -> DataFrame:
    return (
        counts.join(weights, "token")
        .withColumn("tf", log_tf(F.col("n")))
        .withColumn("tfidf", F.col("tf") * F.col("idf"))
    )


def tfidf_transform(tokens: DataFrame, docs: DataFrame, vocab: DataFrame, fitted_idf: DataFrame | None = None) -> DataFrame:
    """TF-IDF of new documents over a training vocabulary.

    By default the document frequencies are those of the *new* documents; give
    ``fitted_idf`` (token, idf) to reuse the training ones.
    """
    # words are counted before they are looked up: a row per document and word moves, not one per place;
    # a task's vocabulary is small beside them, so it is hashed and they are not sorted
    known = counts_by_token(tokens).join(vocab.select("token").hint("shuffle_hash"), "token", "left_semi")
    if fitted_idf is None:
        return _weighted(known, docs)
    return _products(known, fitted_idf.select("token", "idf"))


def one_hot(vocab: DataFrame, words: Sequence[str] | None = None) -> DataFrame:
    """(word, idx, value): the single non-zero entry of each word's indicator row, all words by default."""
    asked = vocab if words is None else vocab.where(F.col("token").isin(*words))
    return asked.select(F.col("token").alias("word"), "idx", F.lit(1).alias("value"))


def csr_rows(triples: DataFrame, row: str = "row", col: str = "col", value: str = "value") -> DataFrame:
    """(row, indices, data, start, end): the compressed rows and their place in the flat arrays.

    ``start``/``end`` are the running totals of the row sizes.  Rows without
    entries take no space; their start equals their end.
    """
    # entries of a row come from many tasks: they are dealt out before they are collected, and written once
    dealt = triples.select(row, col, value).repartition(row)
    rows = dealt.groupBy(row).agg(F.array_sort(F.collect_list(F.struct(col, value))).alias("_e"))
    rows, _ = rewrite(rows, "csr")
    sized = rows.select(row, F.size("_e").cast("long").alias("_n"))
    ends = running(sized, [row], {"end": ("sum", F.col("_n"))}, width=1 << 16)
    placed = rows.join(ends, row)
    return placed.select(
        row,
        F.transform("_e", lambda e: e[col]).alias("indices"),
        F.transform("_e", lambda e: e[value]).alias("data"),
        (F.col("end") - F.col("_n")).alias("start"),
        "end",
    )


def sparse_times_dense(triples: DataFrame, weights: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``sum over col of value * weight`` per row (and per ``by``, e.g. class)."""
    return triples.join(weights, "col").groupBy("row", *by).agg(F.sum(F.col("value") * F.col("weight")).alias("product"))
