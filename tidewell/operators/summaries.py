"""Summaries of draws and curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordered import affine_scan, position, running

_BLOCK = 64


def hdi(df: DataFrame, keys: Sequence[str], value: str, prob: float) -> DataFrame:
    """Narrowest interval holding a share ``prob`` of the draws of each key.

    With n sorted draws and ``k = floor(prob * n)``, the interval starting at
    position i is ``[x_i, x_(i+k)]``; the first of the narrowest wins.  Equal draws
    are counted once, so only the first position of each distinct value can win.
    The end value is found by an equi-join on blocks of 64 positions: a heavy
    value covers many blocks but stays one short row in each.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    runs = running(counts, ["_x"], {"_s": ("sum", F.col("_c"))}, keys, inclusive=False)
    sizes = counts.groupBy(*keys).agg(F.sum("_c").alias("_n")).withColumn("_k", F.floor(F.lit(prob) * F.col("_n")))
    runs = runs.join(sizes, keys).withColumn("_e", F.col("_s") + F.col("_c"))
    blocks = runs.select(
        *keys,
        F.col("_x").alias("_hi"),
        F.col("_s").alias("_hs"),
        F.col("_e").alias("_he"),
        F.explode(F.sequence(F.floor(F.col("_s") / _BLOCK), F.floor((F.col("_e") - 1) / _BLOCK))).alias("_blk"),
    )
    target = F.col("_s") + F.col("_k")
    starts = runs.where(target < F.col("_n")).select(
        *keys, F.col("_x").alias("_lo"), "_s", target.alias("_target"), F.floor(target / _BLOCK).alias("_blk")
    )
    found = starts.join(blocks, [*keys, "_blk"])
    found = found.where((F.col("_hs") <= F.col("_target")) & (F.col("_target") < F.col("_he")))
    width = (F.col("_hi") - F.col("_lo")).alias("width")
    best = found.groupBy(*keys).agg(F.min(F.struct(width, F.col("_s"), F.col("_lo"), F.col("_hi"))).alias("_best"))
    return best.select(*keys, F.col("_best._lo").alias("hdi_low"), F.col("_best._hi").alias("hdi_high"))


def posterior_summary(df: DataFrame, keys: Sequence[str], value: str, prob: float = 0.94) -> DataFrame:
    """Mean, sample deviation and highest-density interval per key."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    return stats.join(hdi(df, keys, value, prob), list(keys))


def geometric_mean(x: Column) -> Column:
    return F.exp(F.avg(F.log(x)))


def mode_smallest(df: DataFrame, keys: Sequence[str], value: str, name: str = "mode") -> DataFrame:
    """Most frequent value per key, the smallest on ties.

    Counts first, so a key's rows are never gathered.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_b"))
    return best.select(*keys, F.col("_b.v").alias(name))


def ema(df: DataFrame, keys: Sequence[str], step: str, value: str, a: float = 0.1, name: str = "ema") -> DataFrame:
    """``a * x + (1 - a) * previous``; the first row in the order of ``step`` seeds the average."""
    numbered = position(df, [step], keys, "_row")
    first = F.col("_row") == 0
    scanned = affine_scan(
        numbered,
        keys,
        "_row",
        F.when(first, F.lit(0.0)).otherwise(F.lit(1.0 - a)),
        F.when(first, F.col(value)).otherwise(F.lit(a) * F.col(value)),
        name,
        dense=True,
    )
    return scanned.select(*df.columns, name)


def early_stop(df: DataFrame, keys: Sequence[str], step: str, loss: str, patience: int) -> DataFrame:
    """Best loss so far, evaluations without improvement, and whether training would have stopped.

    ``wait`` counts evaluations since the last strict improvement.
    """
    before = running(df, [step], {"best_before": ("min", F.col(loss))}, keys, inclusive=False)
    marked = before.withColumn("improved", F.col("best_before").isNull() | (F.col(loss) < F.col("best_before")))
    hits = running(marked, [step], {"last_hit": ("max", F.when(F.col("improved"), F.col(step)))}, keys)
    counted = hits.select(
        *df.columns,
        F.least(F.col("best_before"), F.col(loss)).alias("best"),
        (F.col(step) - F.col("last_hit")).cast("long").alias("wait"),
    )
    stops = counted.where(F.col("wait") >= patience).groupBy(*keys).agg(F.min(step).alias("stop_step"))
    return counted.join(stops, list(keys), "left").withColumn(
        "stopped", F.coalesce((F.col(step) >= F.col("stop_step")).cast("int"), F.lit(0))
    )
