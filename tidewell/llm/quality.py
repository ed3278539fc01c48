"""Quality by an interpolated modified Kneser-Ney model over bytes.

Each language has a model of ``order``-grams of bytes, counted on all trusted texts but a
held-out tenth.  Documents are written once in blocks as they are read.  A block gives the set of
its grams, one row each; these rows, not the texts, are joined by gram with the counts
of every order, and the resulting probabilities return to the block, where each document
is scored.  So what is shuffled grows with the number of blocks and with the grams
that differ within one, and no task holds more than a block and its grams.

A document is kept if its perplexity is at most a high quantile of that of the held-out
trusted texts of its language.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import materialize, query, table
from tidewell.session import scratch_path

BINS = 1000  # of a bit, in the histogram that quantiles are read from


def _slices(sizes: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def gram_codes(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """One gram per byte of each text (big-endian, zero bytes before the text), and bytes per text."""
    raw = [t.as_buffer() if t.is_valid else None for t in texts.cast(pa.binary())]
    sizes = np.array([0 if r is None else r.size for r in raw], dtype=np.int64)
    pad = b"\0" * (order - 1)
    joined = np.frombuffer(b"".join(x for r in raw if r is not None for x in (pad, r)), np.uint8)
    codes = np.zeros(max(0, len(joined) - order + 1), np.int64)
    for k in range(order):
        codes <<= 8
        codes |= joined[k : k + len(codes)]
    # the grams that begin in the last bytes of a text and end in the next one's padding go
    present = np.array([r is not None for r in raw], dtype=bool)
    starts = np.cumsum(np.where(present, sizes + order - 1, 0)) - np.where(present, sizes + order - 1, 0)
    keep = np.zeros(len(codes) + order, np.int8)
    np.add.at(keep, starts[sizes > 0], 1)
    np.add.at(keep, (starts + sizes)[sizes > 0], -1)
    return codes[np.cumsum(keep)[: len(codes)] > 0], sizes


def _language() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("?"))


def _in_blocks(docs: DataFrame) -> tuple[DataFrame, str]:
    """The texts as a table bucketed by block, a block being one task's part of the scan, and its name."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _language().alias("k"), F.col("text").cast("string").alias("text"),
        F.xxhash64("doc_id", "text").alias("row"), F.spark_partition_id().alias("block"),
    )
    name = f"quality_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.write.option("path", scratch_path(spark, "quality-blocks")).option("compression", "zstd")
    writer.bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name), name


def block_grams(blocks: DataFrame, trusted: DataFrame, order: int) -> DataFrame:
    """``block``, ``k`` (language), ``gram`` and ``n``, its count in the block's ``trusted`` rows (often 0)."""
    schema = pa.schema([("block", pa.int32()), ("k", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(key, docs: pa.Table, rows: pa.Table) -> pa.Table:
        if "row" not in docs.column_names or not docs.num_rows:
            return schema.empty_table()
        docs = docs.combine_chunks()
        # a side without rows of the block comes without columns
        known = rows.column("row").to_numpy() if "row" in rows.column_names else np.zeros(0, np.int64)
        learned = np.isin(docs.column("row").to_numpy(), known)
        names, which = np.unique(docs.column("k").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        texts = docs.column("text").chunk(0)
        found: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
        for lo, hi in _slices(sizes):
            codes, size = gram_codes(texts.slice(lo, hi - lo), order)
            mark = (which[lo:hi].astype(np.int64) << (8 * order + 1)) | learned[lo:hi]
            codes <<= 1
            codes |= np.repeat(mark, size)
            value, n = np.unique(codes, return_counts=True)
            found.append(value)
            counts.append(n)
            if len(found) > 8:
                value, at = np.unique(np.concatenate(found), return_inverse=True)
                found, counts = [value], [np.bincount(at, np.concatenate(counts)).astype(np.int64)]
        if not found:
            return schema.empty_table()
        codes, n = np.concatenate(found), np.concatenate(counts)
        n = np.where(codes & 1, n, 0)
        value, at = np.unique(codes >> 1, return_inverse=True)
        n = np.bincount(at, n, len(value)).astype(np.int64)
        own = pa.array(names[value >> (8 * order)].tolist(), pa.string())
        block = pa.array(np.full(len(value), key[0].as_py(), np.int32))
        return pa.table([block, own, pa.array(value & ((1 << 8 * order) - 1)), pa.array(n)], schema=schema)

    return blocks.groupBy("block").cogroup(trusted.groupBy("block")).applyInArrow(
        count, "block int, k string, gram long, n long"
    )


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three modified Kneser-Ney discounts from the numbers of grams seen one to four times."""
    n1, n2, n3, n4 = counts.agg(*[F.count(F.when(F.col("c") == i, 1)) for i in (1, 2, 3, 4)]).first()
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    raw = [i - (i + 1) * y * b / a if a and b else 0.5 * i for i, (a, b) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1)]
    return tuple(min(max(d, 0.05 * i), i - 0.05) for i, d in enumerate(raw, 1))


def _discount(d: tuple[float, float, float]) -> Column:
    return F.when(F.col("c") >= 3, d[2]).when(F.col("c") == 2, d[1]).otherwise(d[0])


def probabilities(counts: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """``k``, ``gram`` and ``p`` of all ``wanted`` grams under the models of ``counts`` (``k``, ``gram``, ``c``).

    Orders below the highest count different bytes before a gram instead of occurrences.
    Discounts are shared by all languages.  Unigrams are mixed with the uniform
    distribution, so no probability is zero.
    """
    tables, asked = {order: counts}, {order: wanted.select("k", "gram").distinct()}
    for j in range(order - 1, 0, -1):
        short = F.col("gram").bitwiseAND((1 << 8 * j) - 1).alias("gram")
        tables[j] = materialize(tables[j + 1].select("k", short).groupBy("k", "gram").agg(F.count(F.lit(1)).alias("c")), "kn-counts")
        asked[j] = asked[j + 1].select("k", short).distinct()
    lower = None
    for j in range(1, order + 1):
        d = discounts(tables[j])
        context = F.shiftright("gram", 8)
        seen = tables[j].withColumn("taken", _discount(d))
        left = seen.groupBy("k", context.alias("context")).agg(F.sum("c").alias("total"), F.sum("taken").alias("free"))
        now = (
            asked[j]
            .withColumn("context", context)
            .withColumn("rest", F.col("gram").bitwiseAND((1 << 8 * (j - 1)) - 1))
            .join(seen, ["k", "gram"], "left")
            .join(left, ["k", "context"], "left")
        )
        if lower is not None:
            now = now.join(lower.withColumnsRenamed({"gram": "rest", "p": "below"}), ["k", "rest"])
        else:
            now = now.withColumn("below", F.lit(1 / 256))
        own = F.coalesce((F.col("c") - F.col("taken")) / F.col("total"), F.lit(0.0))
        weight = F.coalesce(F.col("free") / F.col("total"), F.lit(1.0))
        lower = materialize(now.select("k", "gram", (own + weight * F.col("below")).alias("p")), "kn-probabilities")
    return lower


def block_scores(blocks: DataFrame, priced: DataFrame, order: int) -> DataFrame:
    """``doc_id``, ``k``, ``row``, ``n_bytes`` and ``bits`` (of the whole text) per document."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("k", pa.string()), ("row", pa.int64()), ("n_bytes", pa.int64()), ("bits", pa.float64())]
    )

    def score(key, docs: pa.Table, grams: pa.Table) -> pa.Table:
        if "row" not in docs.column_names or not docs.num_rows:
            return schema.empty_table()
        docs = docs.combine_chunks()
        names, which = np.unique(docs.column("k").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        codes, cost = np.zeros(0, np.int64), np.zeros(0)
        if "gram" in grams.column_names and grams.num_rows:
            own = np.searchsorted(names, grams.column("k").to_numpy(zero_copy_only=False).astype(str))
            codes = (own.astype(np.int64) << (8 * order)) | grams.column("gram").to_numpy()
            by = np.argsort(codes)
            codes, cost = codes[by], -np.log2(grams.column("p").to_numpy()[by])
        texts = docs.column("text").chunk(0)
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
        bits = np.zeros(docs.num_rows)
        for lo, hi in _slices(sizes):
            found, size = gram_codes(texts.slice(lo, hi - lo), order)
            found |= np.repeat(which[lo:hi].astype(np.int64) << (8 * order), size)
            if len(found):
                each = cost[np.searchsorted(codes, found)]
                full = np.flatnonzero(size)
                bits[lo + full] = np.add.reduceat(each, (np.cumsum(size) - size)[full])
        columns = [docs.column("doc_id"), docs.column("k"), docs.column("row"), pa.array(sizes), pa.array(bits)]
        return pa.table(columns, schema=schema)

    return blocks.groupBy("block").cogroup(priced.groupBy("block")).applyInArrow(
        score, "doc_id long, k string, row long, n_bytes long, bits double"
    )


def quality(
    docs: DataFrame, trusted_ids: DataFrame, order: int = 4, quantile: float = 0.99, held_out: int = 10
) -> DataFrame:
    """Per row: ``doc_id``, ``lang``, ``n_bytes``, ``perplexity`` (per byte), ``threshold`` and ``kept``.

    ``trusted_ids`` has the ``doc_id`` of trusted texts.  A tenth of these (by a hash of id and text,
    1 of ``held_out``) is not learned from; their ``quantile`` is the threshold of their
    language.  A language without held-out trusted texts has no threshold and all its texts
    are kept; an empty or null text has no perplexity and is not kept.  A null language
    is a language of its own.  Rows may repeat.
    """
    blocks, name = _in_blocks(docs)
    known = blocks.select("doc_id", "row", "block", "text").where("length(text) > 0").select("doc_id", "row", "block")
    trusted = materialize(
        known.join(trusted_ids.select("doc_id").distinct(), "doc_id").select("row", "block").distinct(), "kn-trusted"
    )
    tested = F.pmod("row", F.lit(held_out)) == 0
    grams = materialize(block_grams(blocks, trusted.where(~tested), order), "kn-grams")
    counts = materialize(grams.groupBy("k", "gram").agg(F.sum("n").alias("c")).where("c > 0"), "kn-counts")
    p = probabilities(counts, grams, order)
    scored = materialize(block_scores(blocks, grams.select("block", "k", "gram").join(p, ["k", "gram"]), order), "kn-scores")
    docs.sparkSession.sql(f"DROP TABLE {name}")  # from here on only the scores are read
    each = F.floor(F.col("bits") / F.col("n_bytes") * BINS).alias("bin")
    measured = scored.where("n_bytes > 0").join(trusted.where(tested).select("row").distinct(), "row", "left_semi")
    bins = measured.groupBy("k", each).agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy("k").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    below = bins.withColumn("below", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy("k")))
    limits = below.where(F.col("below") >= F.lit(quantile) * F.col("all")).groupBy("k").agg(F.min("bin").alias("limit"))
    limited = scored.join(limits, "k", "left")
    return limited.select(
        "doc_id",
        F.when(F.col("k") != "?", F.substr("k", F.lit(2))).alias("lang"),
        "n_bytes",
        F.when(F.col("n_bytes") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n_bytes"))).alias("perplexity"),
        F.pow(F.lit(2.0), (F.col("limit") + 1) / BINS).alias("threshold"),
        (
            (F.col("n_bytes") > 0)
            & (F.col("limit").isNull() | (F.floor(F.col("bits") / F.col("n_bytes") * BINS) <= F.col("limit")))
        ).alias("kept"),
    )


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality(table(spark, sf_dir, "documents"), trusted)
