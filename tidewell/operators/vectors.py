"""Dense vectors: cosine neighbours, neighbour graphs, analogies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.ordered import top_n_per_key

# A query list is sent to every task; beyond this many bytes the blocked join takes over.
MAX_QUERY_BYTES = 64 << 20


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _best(q: np.ndarray, q_ids: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int, strip_bytes: int = 32 << 20) -> pd.DataFrame:
    """The k most similar rows of ``v`` for each row of ``q``, smaller id first on ties.

    Similarities are made for a strip of queries at a time, of at most ``strip_bytes``, and
    only those that reach a query's k-th largest are sorted.
    """
    strip = max(1, strip_bytes // (8 * max(1, len(ids))))
    found = []
    for lo in range(0, len(q), strip):
        sim = q[lo : lo + strip] @ v.T
        if k < len(ids):
            row, col = np.nonzero(sim >= np.partition(sim, len(ids) - k, axis=1)[:, -k, None])
        else:
            row, col = np.nonzero(np.ones_like(sim, dtype=bool))
        value = sim[row, col]
        order = np.lexsort((ids[col], -value, row))
        row, col, value = row[order], col[order], value[order]
        first = np.searchsorted(row, np.arange(len(sim)))
        kept = np.arange(len(row)) - first[row] < k
        found.append(pd.DataFrame({"query": q_ids[lo + row[kept]], "neighbour": ids[col[kept]], "similarity": value[kept]}))
    return pd.concat(found) if found else pd.DataFrame({"query": [], "neighbour": [], "similarity": []})


def cosine_neighbours(vectors: DataFrame, queries: DataFrame, k: int, dim: int, drop_first: bool = True) -> DataFrame:
    """(query, neighbour, similarity, rank): the k most similar vectors of each query.

    ``vectors`` and ``queries`` are (id, vec).  As in a sorted list whose head is
    the query itself, the first hit is dropped.  A short query list goes to every
    task, each task keeps k + 1 per query of the vectors it reads, and only those
    are shuffled.  A long list takes the blocked join of ``neighbour_graph``.
    """
    keep = k + 1 if drop_first else k
    size = queries.count() * dim * 8
    if size > MAX_QUERY_BYTES:
        hits = _blocked(vectors, queries, keep, dim)
    else:
        rows = queries.orderBy("id").collect()
        q_ids = np.array([r["id"] for r in rows])
        q = _unit(np.array([r["vec"] for r in rows], dtype=float))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if b.empty or not len(q_ids):
                    continue
                yield _best(q, q_ids, _unit(np.stack(b["vec"].to_numpy()).astype(float)), b["id"].to_numpy(), keep)

        hits = vectors.mapInPandas(scan, "query long, neighbour long, similarity double")
    return _rank(hits, k, drop_first)


def _rank(hits: DataFrame, k: int, drop_first: bool) -> DataFrame:
    order = [F.col("similarity").desc(), F.col("neighbour")]
    top = top_n_per_key(hits, ["query"], order, k + 1 if drop_first else k)
    if not drop_first:
        return top
    return top.where("rank > 1").withColumn("rank", F.col("rank") - 1)


def _blocked(vectors: DataFrame, queries: DataFrame, keep: int, dim: int, block_bytes: int = 8 << 20) -> DataFrame:
    """Exact search by blocks: every (query block, vector block) is one matrix product in one task.

    Blocks are cut by hashed id, so their sizes do not follow the data.  Each
    product returns ``keep`` hits per query; the full list of pairs never exists.
    """
    n_q = max(1, -(-queries.count() * dim * 8 // block_bytes))
    n_v = max(8, -(-vectors.count() * dim * 8 // block_bytes))
    q = queries.select(
        F.pmod(F.xxhash64("id"), F.lit(n_q)).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(n_v - 1))).alias("vb"), "id", "vec"
    )
    v = vectors.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"), F.pmod(F.xxhash64("id"), F.lit(n_v)).cast("int").alias("vb"), "id", "vec"
    )

    def product(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query": [], "neighbour": [], "similarity": []})
        left, right = (_unit(np.stack(x["vec"].to_numpy()).astype(float)) for x in (a, b))
        return _best(left, a["id"].to_numpy(), right, b["id"].to_numpy(), keep)

    return (
        q.groupBy("qb", "vb").cogroup(v.groupBy("qb", "vb")).applyInPandas(product, "query long, neighbour long, similarity double")
    )


def neighbour_graph(vectors: DataFrame, k: int, dim: int) -> DataFrame:
    """Each vector's k nearest others by cosine, exact."""
    return _rank(_blocked(vectors, vectors, k + 1, dim), k, drop_first=True)


def fuzzy_weights(graph: DataFrame, iterations: int = 64) -> DataFrame:
    """(src, dst, weight): ``exp(-(d - rho) / sigma)`` with cosine distance ``d``.

    ``rho`` is the smallest distance of the row; ``sigma`` solves
    ``sum(weights) = log2(k)`` by bisection on the row's own k distances.
    """
    d = F.lit(1.0) - F.col("similarity")
    rows = graph.groupBy("query").agg(F.array_sort(F.collect_list(F.struct(d.alias("d"), "neighbour"))).alias("e"))

    @F.pandas_udf(T.DoubleType())
    def solve(dist: pd.Series) -> pd.Series:
        out = []
        for row in dist:
            x = np.asarray(row) - row[0]
            target, lo, hi, sigma = np.log2(len(row)), 0.0, np.inf, 1.0
            for _ in range(iterations):
                total = np.exp(-x / sigma).sum()
                if abs(total - target) < 1e-12:
                    break
                if total > target:
                    hi = sigma
                    sigma = (lo + hi) / 2
                else:
                    lo = sigma
                    sigma = sigma * 2 if np.isinf(hi) else (lo + hi) / 2
            out.append(sigma)
        return pd.Series(out, dtype=float)

    solved = rows.withColumn("sigma", solve(F.transform("e", lambda s: s["d"])))
    w = F.exp(-(F.col("x.d") - F.col("rho")) / F.col("sigma"))
    flat = solved.select("query", "sigma", F.element_at("e", 1)["d"].alias("rho"), F.explode("e").alias("x"))
    return flat.select(F.col("query").alias("src"), F.col("x.neighbour").alias("dst"), w.alias("weight"))


def fuzzy_union(weights: DataFrame) -> DataFrame:
    """Symmetric ``w + w' - w * w'``; a missing direction counts as 0."""
    back = weights.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("weight").alias("back"))
    j = weights.join(back, ["src", "dst"], "full")
    a, b = F.coalesce("weight", F.lit(0.0)), F.coalesce("back", F.lit(0.0))
    return j.select("src", "dst", (a + b - a * b).alias("weight"))


def analogy(vectors: DataFrame, plus: Sequence[int], minus: Sequence[int], k: int, dim: int) -> DataFrame:
    """Neighbours of ``sum(plus) - sum(minus)``, leaving out the words of the question."""
    named = [*plus, *minus]
    sign = F.when(F.col("id").isin(*minus), F.lit(-1.0)).otherwise(F.lit(1.0))
    parts = vectors.where(F.col("id").isin(*named)).select(F.posexplode("vec").alias("i", "v"), sign.alias("s"))
    target = (
        parts.groupBy("i").agg(F.sum(F.col("v") * F.col("s")).alias("v"))
        .agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("e"))
        .select(F.lit(-1).cast("long").alias("id"), F.transform("e", lambda x: x["v"]).alias("vec"))
    )
    others = vectors.where(~F.col("id").isin(*named))
    return cosine_neighbours(others, target, k, dim, drop_first=False)
