"""Many small Gaussian linear models at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PORTIONS = 32


def grouped_gram(rows: DataFrame, keys: Sequence[str], p: int, weighted: bool = False) -> DataFrame:
    """Sums of ``x x'`` and ``x y`` per key, from columns ``x`` (array), ``y`` and optionally ``w``.

    Each task adds up the rows it holds and emits one partial sum per key it saw;
    partial sums are then added in two steps, first in 32 portions per key.  The
    rows of a key are never gathered, so one key may hold most of the table.  A task
    that meets very many keys flushes its sums early to bound its memory.
    """
    keys = list(keys)
    key_fields = [rows.schema[k] for k in keys]
    schema = T.StructType(
        [
            *key_fields,
            T.StructField("portion", T.IntegerType()),
            T.StructField("s", T.ArrayType(T.DoubleType())),
        ]
    )
    max_keys = max(1, 32_000_000 // (p * p))

    chunk = max(1, 4_000_000 // (p * p))

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        portion = np.int32(TaskContext.get().partitionId() % PORTIONS)

        def flush() -> pd.DataFrame:
            out = pd.DataFrame(list(sums), columns=keys)
            out["portion"] = portion
            out["s"] = list(sums.values())
            sums.clear()
            return out

        for batch in batches:
            batch = batch.sort_values(keys, kind="stable")
            for lo in range(0, len(batch), chunk):
                part = batch.iloc[lo : lo + chunk]
                x = np.stack(part["x"].to_numpy()).astype(float)
                y = part["y"].to_numpy(dtype=float)
                xw = x * part["w"].to_numpy(dtype=float)[:, None] if weighted else x
                starts = _run_starts(part, keys)
                names = part[keys].iloc[starts].itertuples(index=False, name=None)
                if len(part) >= 32 * len(starts):
                    ends = np.append(starts[1:], len(part))
                    added = [
                        np.concatenate([(xw[i:j].T @ x[i:j]).ravel(), xw[i:j].T @ y[i:j]]) for i, j in zip(starts, ends)
                    ]
                else:
                    outer = (xw[:, :, None] * x[:, None, :]).reshape(len(part), p * p)
                    added = np.add.reduceat(np.concatenate([outer, xw * y[:, None]], axis=1), starts, axis=0)
                for key, row in zip(names, added):
                    have = sums.get(key)
                    sums[key] = np.array(row) if have is None else have + row
            if len(sums) >= max_keys:
                yield flush()
        if sums:
            yield flush()

    cols = [*keys, "x", "y", *(["w"] if weighted else [])]
    partial = rows.select(*cols).mapInPandas(partial_sums, schema)

    def add_runs(by: list[str]):
        """Sum neighbouring rows of equal keys; input is sorted, so one pending key is held at a time."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pending: pd.DataFrame | None = None
            for batch in batches:
                if batch.empty:
                    continue
                if pending is not None:
                    batch = pd.concat([pending, batch], ignore_index=True)
                starts = _run_starts(batch, by)
                out = batch.iloc[starts].copy()
                out["s"] = list(np.add.reduceat(np.stack(batch["s"].to_numpy()), starts, axis=0))
                pending = out.iloc[-1:]
                if len(out) > 1:
                    yield out.iloc[:-1]
            if pending is not None:
                yield pending

        return run

    first = [*keys, "portion"]
    portions = partial.repartition(*first).sortWithinPartitions(*first).mapInPandas(add_runs(first), schema)
    whole = portions.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(add_runs(keys), schema)
    return whole.select(*keys, F.slice("s", 1, p * p).alias("xtx"), F.slice("s", p * p + 1, p).alias("xty"))


def _run_starts(df: pd.DataFrame, by: list[str]) -> np.ndarray:
    """Positions where a run of equal keys begins."""
    change = np.zeros(len(df), dtype=bool)
    change[0] = True
    for c in by:
        v = df[c].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def solve_normal_equations(
    rows: DataFrame, keys: Sequence[str], p: int, prior: DataFrame, noise_var: float
) -> DataFrame:
    """Posterior of ``y = x'w + noise`` with independent zero-mean priors, per key.

    Returns ``mean`` (p), ``factor`` (p*p, row by row, with ``factor factor' = covariance``)
    and ``error`` (NULL unless the key could not be solved).
    """
    keys = list(keys)
    joined = grouped_gram(rows, keys, p).join(prior, keys)
    schema = T.StructType(
        [
            *[rows.schema[k] for k in keys],
            T.StructField("mean", T.ArrayType(T.DoubleType())),
            T.StructField("factor", T.ArrayType(T.DoubleType())),
            T.StructField("error", T.StringType()),
        ]
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            means, factors, errors = [], [], []
            for xtx, xty, var in zip(batch["xtx"], batch["xty"], batch["prior_var"]):
                try:
                    s = np.sqrt(np.asarray(var, dtype=float))
                    # whiten by the prior scale: basis weights may have vanishing variance
                    a = s[:, None] * np.asarray(xtx).reshape(p, p) * s[None, :] / noise_var + np.eye(p)
                    low = np.linalg.cholesky(a)
                    half = np.linalg.solve(low, s * np.asarray(xty) / noise_var)
                    mean = s * np.linalg.solve(low.T, half)
                    factor = s[:, None] * np.linalg.inv(low).T
                    means.append(mean.tolist())
                    factors.append(factor.ravel().tolist())
                    errors.append(None)
                except (np.linalg.LinAlgError, ValueError) as e:
                    means.append(None)
                    factors.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            out = batch[keys].copy()
            out["mean"], out["factor"], out["error"] = means, factors, errors
            yield out

    return joined.mapInPandas(solve, schema)
