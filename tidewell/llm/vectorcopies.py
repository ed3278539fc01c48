"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation learned on a bounded sample turns unit vectors into binary codes whose bits are
balanced.  Codes are cut into ``CHUNK``-bit parts, one Hamming table each.  A vector is posted
under its own part and under every part with one more bit set, so two vectors whose parts
differ in at most one bit meet exactly once per table.  Pairs that meet are compared
by their original vectors, in the first table only; a table's bucket gives link counts and a
spanning forest of its links, never the links themselves.  Large buckets are split
into blocks that meet pairwise.  Equal vectors are one class throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import materialize, query, table
from tidewell.llm.components import connected
from tidewell.llm.neardup import _groups, spanning

CHUNK = 16
TABLES = 8


def learn_rotation(sample: np.ndarray, bits: int, rounds: int = 30, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Centre (d) and projection (d x ``bits``) for codes ``(x - centre) @ projection > 0``.

    Principal axes are rotated so that signs are as close to the projections as possible;
    where the vectors have fewer axes than bits are asked for, several rotations with
    different starts follow each other.
    """
    width = sample.shape[1]
    centre = sample.mean(axis=0) if len(sample) else np.zeros(width)
    axes = np.eye(width)
    if len(sample) > 1:
        axes = np.linalg.eigh(np.cov(sample - centre, rowvar=False).reshape(width, width))[1][:, ::-1]
    axes = axes[:, : min(width, bits)]
    flat = (sample - centre) @ axes
    parts = []
    rng = np.random.default_rng(seed)
    while sum(p.shape[1] for p in parts) < bits:
        turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(rounds if len(sample) else 0):
            signs = np.where(flat @ turn > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(flat.T @ signs)
            turn = left @ right
        parts.append(axes @ turn)
    return centre, np.concatenate(parts, axis=1)[:, :bits]


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _rows_of(column: pa.Array) -> list[np.ndarray]:
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _classes(vectors: DataFrame, sample_rows: int) -> DataFrame:
    """One row per different comparable vector: ``node``, ``least``, ``n``, ``label``, ``dim``, ``vector``, ``codes``."""
    grouped = materialize(
        vectors.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"),
            F.first("embedding").alias("vector"),
        )
        .withColumn("dim", F.size("vector")),
        "vector-classes",
    )
    drawn: dict[int, list] = {}
    # a share of the hashes first, so that each task hands over its share of the sample only
    draw = F.xxhash64("node", F.lit(1))
    share = math.ceil((1 << 30) * min(1.0, 1.2 * (sample_rows + 1000) / max(1, grouped.count())))
    sample = grouped.where(F.pmod(draw, F.lit(1 << 30)) < share).orderBy(draw).limit(sample_rows)
    for r in sample.select("dim", "vector").collect():
        drawn.setdefault(r["dim"], []).append(r["vector"])
    bits = CHUNK * TABLES
    rotations = {d: learn_rotation(_unit(np.array(v, dtype=np.float64)), bits) for d, v in drawn.items()}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows_of(batch.column("vector"))
            codes = np.zeros((len(rows), TABLES), np.int32)
            dims = np.array([len(r) for r in rows], dtype=np.int64)
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                if d not in rotations:
                    rotations[d] = learn_rotation(np.zeros((0, d)), bits)
                centre, turn = rotations[d]
                signs = (_unit(np.stack([rows[i] for i in own])) - centre) @ turn > 0
                codes[own] = np.packbits(signs, axis=1).view(">u2").astype(np.int32)
            listed = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, TABLES, dtype=np.int32), codes.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*batch.schema.names, "codes"])

    schema = grouped.withColumn("codes", F.array(F.lit(0))).schema
    return materialize(grouped.mapInArrow(code, schema), "vector-codes")


def _block_pairs(rows: DataFrame, size: str, block: int) -> DataFrame:
    """Deal each group's rows to blocks; a row is in every pair of blocks (lo <= hi) with its own, ``own``."""
    parts = F.ceil(F.col(size) / F.lit(block)).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    pair = F.explode(F.transform(others, lambda o: F.struct(F.least(o, F.col("own")).alias("lo"), F.greatest(o, F.col("own")).alias("hi"))))
    return dealt.withColumn("pair", pair).select("*", "pair.lo", "pair.hi").drop("pair", "parts")


def _met(classes: DataFrame, threshold: float, block: int) -> DataFrame:
    """Per bucket and pair of blocks: link counts (``a``, ``links``) and forest edges (``a``, ``b``)."""
    own = classes.select("node", "label", "dim", F.posexplode("codes").alias("place", "part"))
    more = F.filter(
        F.transform(F.array(*[F.lit(1 << b) for b in range(CHUNK)]), lambda bit: F.col("part").bitwiseOR(bit)),
        lambda p: p != F.col("part"),
    )
    posts = own.select(
        "node", "place", "part", "label", "dim", F.explode(F.concat(F.array("part"), more)).alias("under")
    ).select("node", "place", F.xxhash64("label", "dim", "place", "under").alias("key"), (F.col("part") == F.col("under")).alias("home"))
    lists = posts.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.max("home").alias("any")).where("members > 1 AND any")
    live = _block_pairs(posts.join(lists.drop("any"), "key"), "members", block).drop("members")
    full = live.join(classes.select("node", "n", "vector", "codes"), "node")
    dealt = full.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])
    ones = np.array([bin(i).count("1") for i in range(1 << CHUNK)], dtype=np.uint8)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int | None] = []
        links: list[int] = []
        for group in _groups(batches, ["key", "lo", "hi"]):
            ids = group.column("node").to_numpy()
            home = group.column("home").to_numpy(zero_copy_only=False)
            weight = group.column("n").to_numpy()
            codes = np.array(group.column("codes").to_pylist(), dtype=np.int32)
            vectors = _unit(np.array(group.column("vector").to_pylist(), dtype=np.float64))
            place, lo, hi = (group.column(c)[0].as_py() for c in ("place", "lo", "hi"))
            near = vectors @ vectors.T >= threshold
            near &= home[:, None] | home[None, :]
            if lo != hi:
                block_of = group.column("own").to_numpy()
                near &= block_of[:, None] != block_of[None, :]
            np.fill_diagonal(near, False)
            i, j = np.nonzero(near)
            apart = ones[codes[i] ^ codes[j]]  # bits that differ, per table
            first = (apart[:, place] <= 1) & ~(apart[:, :place] <= 1).any(axis=1)
            near[i[~first], j[~first]] = False
            counts = near @ weight
            for k in np.flatnonzero(counts):
                a.append(ids[k])
                b.append(None)
                links.append(counts[k])
            for x, y in spanning(len(ids), lambda i, rest: near[i, rest]):
                a.append(ids[x])
                b.append(ids[y])
                links.append(0)
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, links)], schema=schema)
                a, b, links = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, links)], schema=schema)

    return dealt.mapInArrow(merge, "a long, b long, links long")


def vector_copies(
    vectors: DataFrame, threshold: float = 0.93, sample_rows: int = 20_000, block: int = 256
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors are compared if their labels are equal and not null and they have the same length;
    null, empty and zero vectors and ones with null, infinite or not-a-number components
    link with nothing.  ``n_links`` counts the other rows linked directly, equal ones included;
    ``component_id`` is the smallest ``vec_id`` that links reach.  Rows may repeat.  The
    rotation is fitted on at most ``sample_rows`` different vectors; every vector is indexed.
    """
    x = F.col("embedding")
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    usable &= F.exists(x, lambda e: e != 0) & F.col("label").isNotNull()
    named = vectors.select("vec_id", "label", "embedding").withColumn(
        "node", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "embedding"))
    )
    classes = _classes(named, sample_rows)
    met = materialize(_met(classes, threshold, block), "vector-links")
    links = met.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = connected(met.where("b IS NOT NULL").select("a", "b"))
    rooted = (
        classes.select("node", "least", "n")
        .join(links, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(least, "root").select(
        "node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    return named.select("vec_id", "node").join(found, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
c AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""


@query("op5_vector_copies", OP5_SQL)
def op5_vector_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_copies(table(spark, sf_dir, "embeddings"))
