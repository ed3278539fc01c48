"""Adjacency, components and intrinsic autoregressive (ICAR) quantities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import cut_lineage


def shared_vertex_edges(areas: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """Ordered pairs of areas that share any ring vertex (queen contiguity).

    An equi-join on the vertex: only areas that meet are ever paired.  The vertex
    list is made distinct first, since rings repeat their first vertex.
    """
    points = areas.select(F.col(key).alias("area"), F.explode(F.flatten(geometry)).alias("p")).distinct()
    a = points.select(F.col("area").alias("src"), "p.x", "p.y")
    b = points.select(F.col("area").alias("dst"), "p.x", "p.y")
    return a.join(b, ["x", "y"]).where("src <> dst").select("src", "dst").distinct()


def degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))


def precision_triples(edges: DataFrame) -> DataFrame:
    """``Q = D - W`` as (i, j, value); nodes without edges have no entry."""
    diagonal = degrees(edges).select(F.col("src").alias("i"), F.col("src").alias("j"), F.col("degree").cast("double").alias("value"))
    return diagonal.unionByName(edges.select(F.col("src").alias("i"), F.col("dst").alias("j"), F.lit(-1.0).alias("value")))


def neighbour_mean(edges: DataFrame, values: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Mean of the neighbours' values per node (and per ``by``), with the neighbour count."""
    by = by or []
    v = values.select(F.col("area").alias("dst"), *by, F.col(value).alias("_v"))
    return edges.join(v, "dst").groupBy(F.col("src").alias("area"), *by).agg(
        F.avg("_v").alias("near_mean"), F.count("_v").alias("degree")
    )


def smoothness_penalty(edges: DataFrame, values: DataFrame, value: str, by: list[str], sigma: float) -> DataFrame:
    """``sum over i ~ j of (phi_i - phi_j)^2 / sigma^2``, each edge once."""
    once = edges.where("src < dst")
    a = values.select(F.col("area").alias("src"), *by, F.col(value).alias("a"))
    b = values.select(F.col("area").alias("dst"), *by, F.col(value).alias("b"))
    j = once.join(a, "src").join(b, ["dst", *by])
    return j.groupBy(*by).agg((F.sum(F.pow(F.col("a") - F.col("b"), F.lit(2.0))) / F.lit(sigma * sigma)).alias("penalty"))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node id reachable; a node without edges is its own component.

    Every round takes the smallest label among the neighbours (a partial minimum is
    taken before the shuffle, so hubs are cheap) and then follows the label's own
    label, which shortens long chains geometrically.  Each round is written to
    reliable storage, so the plan never grows.
    """
    e = cut_lineage(edges.select("src", "dst"))
    labels = cut_lineage(nodes.select("node", F.col("node").alias("label")))
    while True:
        near = (
            e.join(labels.select(F.col("node").alias("dst"), "label"), "dst")
            .groupBy(F.col("src").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lowered = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label")
        )
        # only labels in use are followed, and a label that leads nowhere stays out: its rows,
        # a whole component in the end, then match nothing and need not meet in one task
        jump = labels.where("node <> label").select(F.col("node").alias("label"), F.col("label").alias("next"))
        used = jump.join(lowered.select("label").distinct(), "label", "left_semi")
        labels_next = cut_lineage(
            lowered.join(used, "label", "left").select("node", "old", F.coalesce("next", "label").alias("label"))
        )
        moved = labels_next.where("label <> old").limit(1).count()
        labels = labels_next.select("node", "label")
        if moved == 0:
            return labels.select("node", F.col("label").alias("component"))


def icar_components(components: DataFrame, edges: DataFrame, max_dense: int = 5000) -> DataFrame:
    """Per component: size, scaling factor and the scaled generalised inverse in long form.

    Returns (component, n, scale, i, j, value): ``value`` is the entry of the
    Moore-Penrose inverse of ``Q = D - W`` divided by the scaling factor.  The
    scaling factor is the geometric mean of the variances under a sum-to-zero
    constraint; a component of one area has factor 1 and a zero inverse.

    Components spread over the cluster.  One dense inverse has n^2 entries, so a
    component above ``max_dense`` areas fails the job with its name rather than
    being skipped.
    """
    entries = precision_triples(edges).select("i", "j", "value")
    lone = components.select(F.col("node").alias("i"), F.col("node").alias("j"), F.lit(0.0).alias("value"))
    q = entries.unionByName(lone).join(components.select(F.col("node").alias("i"), "component"), "i")
    node_type = components.schema["node"].dataType
    schema = T.StructType(
        [
            T.StructField("component", components.schema["component"].dataType),
            T.StructField("n", T.IntegerType()),
            T.StructField("scale", T.DoubleType()),
            T.StructField("i", node_type),
            T.StructField("j", node_type),
            T.StructField("value", T.DoubleType()),
        ]
    )

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_components(batches):
            yield from _inverses(whole, max_dense)

    # a task inverts its components as they come, those of one size side by side
    dealt = q.select("component", "i", "j", "value").repartition("component").sortWithinPartitions("component")
    return dealt.mapInArrow(invert, schema)


#: Entries of the matrices that a task inverts at a time, and rows of a batch that it hands back.
_ENTRIES = 1 << 20
_HANDED = 1 << 16


def _whole_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by ``component`` in tables that cut no component."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("component").dictionary_encode(null_encoding="encode").indices.to_numpy()
        changes = np.flatnonzero(key[1:] != key[:-1]) + 1
        if held and held[-1].column("component")[-1].as_py() != batch.column("component")[0].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if len(changes):
            last = int(changes[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held, batch = [], batch.slice(last)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _inverses(q: pa.Table, max_dense: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``icar_components`` for the whole components in ``q``; what is not a number is null."""
    coded = q["component"].combine_chunks().dictionary_encode(null_encoding="encode")
    owner = coded.indices.to_numpy().astype(np.int64)
    # ids are numbered in their order; with the component in front, places in it are differences
    named = pc.unique(q["i"])
    named = named.take(pc.sort_indices(named))
    i, j = (np.searchsorted(named.to_numpy(zero_copy_only=False), q[c].to_numpy()) for c in "ij")
    base = len(named) + 1
    areas = np.unique(owner * base + i)
    first = np.searchsorted(areas, np.arange(len(coded.dictionary) + 1) * base)
    sizes = np.diff(first)
    if sizes.max() > max_dense:
        k = int(sizes.argmax())
        raise ValueError(f"component {coded.dictionary[k].as_py()} has {sizes[k]} areas, more than {max_dense}")
    at_i, at_j = (np.searchsorted(areas, owner * base + at) - first[owner] for at in (i, j))
    value = q["value"].to_numpy()
    by_size = np.argsort(sizes[owner], kind="stable")
    row_sizes = sizes[owner][by_size]
    for n in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == n)
        rows = by_size[np.searchsorted(row_sizes, n) : np.searchsorted(row_sizes, n, "right")]
        rows = rows[np.argsort(owner[rows], kind="stable")]
        for lo in range(0, len(own), max(1, _ENTRIES // (n * n))):
            group = own[lo : lo + max(1, _ENTRIES // (n * n))]
            mine = rows[np.searchsorted(owner[rows], group[0]) : np.searchsorted(owner[rows], group[-1], "right")]
            m = np.zeros((len(group), n, n))
            np.add.at(m, (np.searchsorted(group, owner[mine]), at_i[mine], at_j[mine]), value[mine])
            scale, inverse = _scaled_inverses(m)
            ids = areas[first[group][:, None] + np.arange(n)] % base
            places = [np.repeat(group, n * n), np.repeat(ids, n, axis=1).ravel(), np.tile(ids, (1, n)).ravel()]
            for at in range(0, len(places[0]), _HANDED):
                c, a, b = (pa.array(x[at : at + _HANDED]) for x in places)
                yield pa.RecordBatch.from_arrays(
                    [
                        coded.dictionary.take(c), pa.array(np.full(len(c), n, np.int32)),
                        pa.array(np.repeat(scale, n * n)[at : at + _HANDED], from_pandas=True),
                        named.take(a), named.take(b), pa.array(inverse.ravel()[at : at + _HANDED], from_pandas=True),
                    ],
                    ["component", "n", "scale", "i", "j", "value"],
                )


def _scaled_inverses(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaling factors and scaled generalised inverses of matrices ``Q`` of one size (k x n x n)."""
    k, n, _ = m.shape
    if n == 1:
        return np.ones(k), np.zeros_like(m)
    jitter = np.diagonal(m, axis1=1, axis2=2).max(axis=1) * np.sqrt(np.finfo(float).eps)
    cov = np.linalg.inv(m + jitter[:, None, None] * np.eye(n))
    row = cov.sum(axis=2)
    constrained = cov - row[:, :, None] * row[:, None, :] / row.sum(axis=1)[:, None, None]
    scale = np.exp(np.mean(np.log(np.diagonal(constrained, axis1=1, axis2=2)), axis=1))
    return scale, np.linalg.pinv(m, hermitian=True) / scale[:, None, None]


def mixed_covariance(scaled: DataFrame, rho: float) -> DataFrame:
    """``(1 - rho) * I + rho * scaled`` as (i, j, value)."""
    eye = scaled.where("i = j").select("i", "j", F.lit(1.0 - rho).alias("value"))
    part = scaled.select("i", "j", (F.lit(rho) * F.col("value")).alias("value"))
    return eye.unionByName(part).groupBy("i", "j").agg(F.sum("value").alias("value"))
