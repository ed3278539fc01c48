"""Order-dependent operators that do not put one key into one task.

A plain window over ``partition by key`` sorts a whole key in a single task.  When
one key holds a large share of the table that task never ends.  Everything here
works in two levels instead: rows go to range buckets of the order column, each
bucket is aggregated, a running total over the (small) bucket table gives every
bucket its starting value, and only then are rows ordered inside their bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import cut_lineage, scratch_path

_BUCKET = "_bucket"


def default_buckets(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_bucket(df: DataFrame, col: str, n: int | None = None, width: int | None = None) -> DataFrame:
    """Add ``_bucket``: ascending ranges of a numeric column.

    ``width`` suits dense integers that are unique per key (ids, steps, day
    numbers): a bucket can then hold no more than ``width`` rows of a key, and no
    extra pass is needed.  Without it the ranges come from approximate quantiles
    and hold about equal row counts; only the ``n`` bounds reach the driver, and
    they are literals afterwards, so a recomputed task sees the same buckets.
    """
    if width is not None:
        return df.withColumn(_BUCKET, F.floor(F.col(col) / F.lit(width)))
    n = n or default_buckets(df)
    probs = [i / n for i in range(1, n)]
    bounds = sorted(set(df.approxQuantile(col, probs, min(0.01, 0.25 / n)))) if probs else []
    splits = [float("-inf"), *bounds, float("inf")]
    if len(splits) < 3:
        return df.withColumn(_BUCKET, F.lit(0.0))
    # adding 0.0 makes -0.0 and 0.0 one value, as grouping does
    probe = df.withColumn("_order_value", F.col(col).cast("double") + F.lit(0.0))
    model = Bucketizer(splits=splits, inputCol="_order_value", outputCol=_BUCKET, handleInvalid="keep")
    return model.transform(probe).drop("_order_value")


# how a row's running value and the value carried into its bucket combine
_COMBINE = {
    "sum": lambda local, carry: F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0)),
    "min": lambda local, carry: F.least(local, carry),
    "max": lambda local, carry: F.greatest(local, carry),
}
_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def running(
    df: DataFrame,
    order: Sequence[str],
    aggs: dict[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    inclusive: bool = True,
    buckets: int | None = None,
    width: int | None = None,
) -> DataFrame:
    """Running ``sum``, ``min`` or ``max`` per key in a total order.

    ``order[0]`` must be numeric and is cut into range buckets; the rest breaks
    ties.  ``aggs`` maps an output name to ``(kind, column)``.  With
    ``inclusive=False`` the row itself is left out (sums start from 0, extremes
    from NULL).
    """
    keys = list(keys)
    b = range_bucket(df, order[0], buckets, width)
    values = {name: f"_v_{name}" for name in aggs}
    b = b.withColumns({values[name]: col for name, (_, col) in aggs.items()})

    totals = b.groupBy(*keys, _BUCKET).agg(*[_AGG[kind](values[n]).alias(f"_t_{n}") for n, (kind, _) in aggs.items()])
    before = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(
        *keys, _BUCKET, *[_AGG[kind](f"_t_{n}").over(before).alias(f"_c_{n}") for n, (kind, _) in aggs.items()]
    )

    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    local = b.withColumns({f"_l_{n}": _AGG[kind](values[n]).over(inside) for n, (kind, _) in aggs.items()})
    joined = local.join(carries, [*keys, _BUCKET])
    out = [_COMBINE[kind](F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) for n, (kind, _) in aggs.items()]
    return joined.select(*df.columns, *out)


def position(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "pos",
    buckets: int | None = None,
    width: int | None = None,
) -> DataFrame:
    """0-based row position per key in a total order."""
    return running(df, order, {name: ("sum", F.lit(1).cast("long"))}, keys, False, buckets, width)


def sorted_index(df: DataFrame, col: str, name: str = "idx") -> DataFrame:
    """0-based index of each row of a table of distinct values, in sorted order of any type.

    Range-partitions and sorts, so no task sees more than its range.  The numbered
    table is written once: partition numbers must not move between passes.
    """
    part_bits = 33
    ranged = (
        df.repartitionByRange(F.col(col))
        .sortWithinPartitions(col)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright(F.col("_id"), part_bits))
        .withColumn("_local", F.col("_id").bitwiseAND(F.lit((1 << part_bits) - 1)))
        .drop("_id")
    )
    ranged = cut_lineage(ranged)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return ranged.join(starts, "_part").select(*df.columns, (F.col("_start") + F.col("_local")).alias(name))


#: ``monotonically_increasing_id`` is the task's number above this bit and the row's number in it below.
_PART_BITS = 33


def ranked(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), name: str = "pos", size: str | None = None
) -> DataFrame:
    """0-based position per key in the order of columns of any type, nulls first.

    Nothing is assumed about the values: sampled splitters deal the rows to ranges of
    (keys, order), and equal rows are told apart by the place they were read from, so neither
    a key nor a value that half of the rows hold is one task's work.  The sorted rows are written once
    to the shared folder; what is scanned is a count per range and key.  Which of several
    equal rows comes first is not defined.  ``size`` adds the number of rows of the key.
    """
    keys, order, spark = list(keys), list(order), df.sparkSession
    path = scratch_path(spark, "ranked")
    (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, *order, "_tie")
        .sortWithinPartitions(*keys, *order, "_tie")
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    placed = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())])).parquet(path)
    placed = placed.withColumn("_part", F.shiftright("_at", _PART_BITS))
    own = Window.partitionBy(*keys)
    counts = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        F.col("_part").alias("_p"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(own).alias("_size"),
    )
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    out = [(F.col("_at") + F.col("_shift")).alias(name), *([F.col("_size").alias(size)] if size else [])]
    return placed.join(starts, same).select(*df.columns, *out)


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows per key.  Spark limits each group before the shuffle, so hot keys stay small."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def affine_scan(
    df: DataFrame,
    keys: Sequence[str],
    step: str,
    a: Column,
    b: Column,
    name: str = "state",
    block: int = 128,
    levels: int = 2,
    x0: float = 0.0,
    dense: bool = False,
) -> DataFrame:
    """First-order recurrence ``x_t = a_t * x_(t-1) + b_t`` from ``x0``, per key.

    Rows follow each other in the order of the integer ``step``, whatever its first value
    and gaps; ``dense`` says that steps are 0, 1, 2, ... already.  Affine maps compose, so blocks of steps are
    reduced to one map each, the (far shorter) series of blocks is scanned, and
    its result is the starting value of each block.
    """
    keys = list(keys)
    if not dense:
        numbered = position(df.withColumns({"_ra": a, "_rb": b}), [step], keys, "_row")
        scanned = affine_scan(numbered, keys, "_row", F.col("_ra"), F.col("_rb"), name, block, levels, x0, True)
        return scanned.select(*df.columns, name)
    s = df.withColumns({"_a": a.cast("double"), "_b": b.cast("double")})
    if levels <= 0:
        return _scan_arrays(s, keys, step, None, name, x0)
    blk = f"_blk{levels}"
    s = s.withColumn(blk, F.floor(F.col(step) / F.lit(block)))
    arr = s.groupBy(*keys, blk).agg(F.array_sort(F.collect_list(F.struct(step, "_a", "_b"))).alias("_rows"))
    whole = F.aggregate(
        "_rows",
        F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")),
        lambda acc, r: F.struct((acc["a"] * r["_a"]).alias("a"), (r["_a"] * acc["b"] + r["_b"]).alias("b")),
    )
    blocks = arr.select(*keys, blk, whole.alias("_m"))
    inner = blocks.select(*keys, blk, F.col("_m.a").alias("_ma"), F.col("_m.b").alias("_mb"))
    ends = affine_scan(inner, keys, blk, F.col("_ma"), F.col("_mb"), "_end", block, levels - 1, x0, True)
    ends = ends.select(*keys, (F.col(blk) + 1).alias(blk), F.col("_end").alias("_start"))
    return _scan_arrays(s, [*keys, blk], step, ends, name, x0).drop(blk)


def _scan_arrays(s: DataFrame, keys: list[str], step: str, starts: DataFrame | None, name: str, x0: float) -> DataFrame:
    """Scan each short group in place; ``starts`` gives the state before its first row."""
    payload = [c for c in s.columns if c not in keys]
    g = s.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(step, *[c for c in payload if c != step]))).alias("_rows"))
    g = g.withColumn("_start", F.lit(None).cast("double")) if starts is None else g.join(starts, keys, "left")
    first = F.coalesce(F.col("_start"), F.lit(float(x0)))
    states = F.aggregate(
        "_rows",
        F.array(first),
        lambda acc, r: F.concat(acc, F.array(r["_a"] * F.element_at(acc, -1) + r["_b"])),
    )
    g = g.select(*keys, "_rows", F.slice(states, F.lit(2), F.size("_rows")).alias("_states"))
    rows = g.select(*keys, F.inline(F.arrays_zip(F.col("_rows").alias("r"), F.col("_states").alias("s"))))
    keep = [c for c in payload if c not in ("_a", "_b")]
    return rows.select(*keys, *[F.col(f"r.{c}").alias(c) for c in keep], F.col("s").alias(name))
