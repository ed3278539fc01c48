"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points on a ring; a key belongs to the next point
clockwise.  Capacities are the fair shares ``rows // shards`` (one more for the
first ``rows % shards`` shards), so full shards differ by at most one row.  A key
first goes to its own shard; what exceeds a capacity is taken from the shard's
last arcs and walks clockwise to the next point whose shard has room.  Only that
excess moves, the least that any placement within the capacities can move.

The walk needs row counts per piece of arc, never the rows: their number depends
on ``shards``, ``vnodes`` and ``pieces`` alone.  Rows are then matched to the plan by
their rank inside a piece.  Equal rows are counted before anything is shuffled, and
the pieces of an arc are cut by a hash of the whole row, so that a key with many
different rows is ranked by several tasks.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import materialize, query, table, utf8_crc32, utf8_size


def ring(shards: int, vnodes: int = 128) -> list[tuple[float, int]]:
    """Points of all virtual nodes in (0, 1) and their shards, clockwise."""
    points = []
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{shard}/{v}".encode(), digest_size=8).digest()
            points.append(((int.from_bytes(digest, "big") + 0.5) / 2.0**64, shard))
    return sorted(points)


def plan_moves(
    counts: dict[tuple[int, int], int], owners: list[int], shards: int
) -> list[tuple[int, int, int, int, int, int]]:
    """Place the counted rows of each ``(arc, piece)``.

    Returns ``(arc, piece, lo, hi, shard, slot)``: rows with rank ``lo <= rank < hi`` of
    the piece go to ``shard`` at slots ``slot``, ``slot + 1``, ...
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    placed: list[tuple[int, int, int, int, int]] = []
    spilled: list[tuple[int, int, int, int]] = []
    for (arc, piece), n in sorted(counts.items()):
        shard = owners[arc]
        stay = min(n, room[shard])
        room[shard] -= stay
        if stay:
            placed.append((arc, piece, 0, stay, shard))
        if stay < n:
            spilled.append((arc, piece, stay, n))
    for arc, piece, lo, hi in spilled:
        at = arc
        while lo < hi:
            at = (at + 1) % len(owners)
            shard = owners[at]
            take = min(hi - lo, room[shard])
            if take:
                room[shard] -= take
                placed.append((arc, piece, lo, lo + take, shard))
                lo += take
    filled = [0] * shards
    moves = []
    for arc, piece, lo, hi, shard in placed:
        moves.append((arc, piece, lo, hi, shard, filled[shard]))
        filled[shard] += hi - lo
    return moves


def bounded_ring(
    rows: DataFrame, key: str, shards: int = 8, vnodes: int = 128, pieces: int = 16
) -> DataFrame:
    """All ``rows`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``key`` names the column that is hashed; all columns must be hashable and are kept,
    so pass digests rather than texts.  A null key is a key like any other, repeated
    rows get slots of their own, an empty table gives an empty result.  Columns named
    like the working columns are not touched: the result has ``rows``' columns first.
    """
    spark = rows.sparkSession
    names = rows.columns
    points = ring(shards, vnodes)
    owners = [s for _, s in points] + [points[0][1]]
    owners[-1] = points[0][1]  # past the last point the ring starts again

    at = (F.shiftrightunsigned(F.xxhash64("row.`%s`" % key), 11) + F.lit(0.5)) / F.lit(2.0**53)
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    counted = whole.groupBy("row").agg(F.count(F.lit(1)).alias("n"))
    placed = counted.select(
        "row", "n", at.alias("at"), F.xxhash64(F.col("row")).alias("tie")
    )
    splits = [float("-inf"), *[p for p, _ in points], float("inf")]
    arcs = Bucketizer(splits=splits, inputCol="at", outputCol="arc").transform(placed)
    cells = materialize(
        arcs.select(
            "row", "n", "tie",
            F.col("arc").cast("int").alias("arc"),
            F.pmod("tie", F.lit(pieces)).cast("int").alias("piece"),
        ),
        "ring-cells",
    )
    counts = {
        (r["arc"], r["piece"]): r["n"]
        for r in cells.groupBy("arc", "piece").agg(F.sum("n").alias("n")).collect()
    }
    moves = spark.createDataFrame(
        plan_moves(counts, owners, shards),
        "arc int, piece int, lo long, hi long, shard int, slot long",
    )
    rank = Window.partitionBy("arc", "piece").orderBy("tie", "row")
    ranked = cells.withColumn("end", F.sum("n").over(rank)).withColumn("start", F.col("end") - F.col("n"))
    # the plan has at most shards * vnodes * pieces + shards^2 rows, whatever the input
    met = ranked.join(F.broadcast(moves), ["arc", "piece"]).where("start < hi AND end > lo")
    ranks = F.explode(F.sequence(F.greatest("start", "lo"), F.least("end", "hi") - 1))
    return met.select("row", "shard", "slot", "lo", ranks.alias("rank")).select(
        *[F.col(f"row.`{c}`").alias(c) for c in names],
        F.col("shard"),
        (F.col("slot") + F.col("rank") - F.col("lo")).alias("slot"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes plus 1) and ``text_crc32`` of every document."""
    return docs.select(
        "doc_id", (utf8_size(F.col("text")) + 1).alias("size"), utf8_crc32(F.col("text")).alias("text_crc32")
    )


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = bounded_ring(digests(table(spark, sf_dir, "documents")), "doc_id", shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
