"""Merkle fixity audit of WARC replicas.

A record's leaf is the hash of its place and its content digest.  Leaves are hashed together
by ordered offset ranges of ``leaf_bytes``, those by ``fanout`` neighbouring ranges, and so on
up to one root per replica.  An audit compares the roots and then only the children of
nodes that differ, down to the records.  Only digests are shuffled, never contents,
and every group that is hashed together is bounded by the size of its range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import materialize, query, table

#: Offsets of one file; files follow each other in the address space of a replica.
FILE_SPAN = 1 << 40


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """A page as a WARC resource record; nulls count as empty."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def lay_out(records: DataFrame, file_bytes: int = 64 << 20) -> DataFrame:
    """Deal records (``record_id``, ``length``, ``digest``, more) to files of about ``file_bytes``.

    Adds ``copy`` (equal rows are numbered), ``file`` and ``offset``.  Records are dealt by
    a hash of id, digest and copy and stand in the order of these three, so files are as
    large as each other whatever repeats.
    """
    names = records.columns
    equal = records.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    single = materialize(equal.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")), "warc-records")
    total = single.agg(F.sum("length")).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    key = F.sha2(F.concat_ws("/", F.coalesce(F.col("record_id").cast("string"), F.lit("")), "digest", F.col("copy").cast("string")), 256)
    dealt = single.withColumn("file", F.pmod(F.conv(F.substring(key, 1, 12), 16, 10).cast("long"), F.lit(files)))
    before = Window.partitionBy("file").orderBy("record_id", "digest", "copy").rowsBetween(Window.unboundedPreceding, 0)
    return dealt.withColumn("offset", F.sum("length").over(before) - F.col("length"))


def merkle_tree(records: DataFrame, leaf_bytes: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """Nodes (``level``, ``node``, ``hash``) over records (``file``, ``offset``, ``length``, ``digest``).

    Level 1 has the offset ranges, the highest level the root as its only node; no records, no
    nodes.  A record belongs to the range it begins in.
    """
    leaf = F.sha2(F.concat_ws(":", "file", "offset", "length", "digest"), 256)
    at = F.col("file") * FILE_SPAN + F.col("offset")
    level, now = 1, records.select(F.floor(at / leaf_bytes).alias("node"), at.alias("at"), leaf.alias("hash"))
    levels = []
    while True:
        listed = F.array_sort(F.collect_list(F.struct("at", "hash")))
        hashed = now.groupBy("node").agg(F.sha2(F.array_join(F.transform(listed, lambda x: x["hash"]), ""), 256).alias("hash"))
        nodes = materialize(hashed.select(F.lit(level).alias("level"), "node", "hash"), "merkle-level")
        levels.append(nodes)
        if (nodes.agg(F.max("node")).first()[0] or 0) == 0:
            break
        level += 1
        now = nodes.select(F.floor(F.col("node") / fanout).alias("node"), F.col("node").alias("at"), "hash")
    tree = levels[0]
    for nodes in levels[1:]:
        tree = tree.unionByName(nodes)
    return tree


def _compared(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose values differ or that one side lacks, with both values."""
    both = left.select(*keys, F.col(value).alias("left_value")).join(right.select(*keys, F.col(value).alias("right_value")), keys, "full")
    return both.where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def audit(left: DataFrame, right: DataFrame, leaf_bytes: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """Records that differ between two replicas (``file``, ``offset``, ``length``, ``digest`` each).

    Returns ``file``, ``offset``, ``status`` (``altered``, ``missing`` on the right, ``extra`` on the right),
    ``left_digest`` and ``right_digest``.  Places are unique within a replica.  Equal replicas,
    empty ones too, give no rows.
    """
    trees = [materialize(merkle_tree(r, leaf_bytes, fanout), "merkle-tree") for r in (left, right)]
    top = max(t.agg(F.max("level")).first()[0] or 1 for t in trees)

    def level(n: int) -> list[DataFrame]:
        return [t.where(F.col("level") == n).select("node", "hash") for t in trees]

    # a smaller tree has its root further down: above it the other side has no partner
    suspects = _compared(*level(top), ["node"], "hash").select("node")
    for n in range(top - 1, 0, -1):
        below = [
            t.join(suspects.select(F.col("node").alias("up")), F.floor(t["node"] / fanout) == F.col("up"), "left_semi")
            for t in level(n)
        ]
        suspects = materialize(_compared(*below, ["node"], "hash").select("node"), "merkle-suspects")
    node = F.floor((F.col("file") * FILE_SPAN + F.col("offset")) / leaf_bytes)
    records = [
        r.select("file", "offset", node.alias("node"), F.concat_ws(":", "length", "digest").alias("content"))
        .join(suspects, "node", "left_semi")
        for r in (left, right)
    ]
    found = _compared(*records, ["file", "offset"], "content")
    return found.select(
        "file",
        "offset",
        F.when(F.col("right_value").isNull(), "missing").when(F.col("left_value").isNull(), "extra").otherwise("altered").alias("status"),
        F.substring_index("left_value", ":", -1).alias("left_digest"),
        F.substring_index("right_value", ":", -1).alias("right_digest"),
    )


#: The second copy of the archive: one page in 53 has rotted, one in 211 is cut short, one in 307 is lost.
ROTTED, SHORT, LOST = 53, 211, 307

OP4_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS a, h,
    CASE WHEN h % {ROTTED} = 1 THEN concat('#', substr(html, 2)) WHEN h % {SHORT} = 2 THEN left(html, length(html) // 2) ELSE html END AS b
  FROM (SELECT *, page_id * 2654435761 % 4294967296 AS h FROM pages)
),
r AS (
  SELECT page_id, h, octet_length(encode(ra)) AS length, sha256(ra) AS left_digest, sha256(rb) AS right_digest
  FROM (
    SELECT page_id, h, {{a}} AS ra, {{b}} AS rb FROM p
  )
),
c AS (SELECT *, row_number() OVER (PARTITION BY page_id, h, length, left_digest, right_digest) AS copy FROM r),
f AS (
  SELECT *, CAST(concat('0x', substr(sha256(concat(page_id, '/', left_digest, '/', copy)), 1, 12)) AS BIGINT)
    % greatest(1, CAST(ceil((SELECT sum(length) FROM c) / {64 << 20}) AS BIGINT)) AS file
  FROM c
),
o AS (
  SELECT *, sum(length) OVER (PARTITION BY file ORDER BY page_id, left_digest, copy ROWS UNBOUNDED PRECEDING) - length AS pos FROM f
)
SELECT page_id, file, CAST(pos AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
  CASE WHEN h % {LOST} = 3 THEN 'missing' ELSE 'altered' END AS status, left_digest,
  CASE WHEN h % {LOST} = 3 THEN NULL ELSE right_digest END AS right_digest
FROM o WHERE h % {LOST} = 3 OR left_digest <> right_digest
"""


def _record_sql(body: str) -> str:
    return (
        "concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>', "
        "chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10), "
        f"'Content-Length: ', octet_length(encode({body})), chr(13), chr(10), chr(13), chr(10), {body}, chr(13), chr(10), chr(13), chr(10))"
    )


@query("op4_fixity", OP4_SQL.format(a=_record_sql("a"), b=_record_sql("b")))
def op4_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in two replicas, the second with damage that follows from the ids."""
    pages = table(spark, sf_dir, "pages")
    draw = F.pmod(F.col("page_id") * 2654435761, F.lit(4294967296))
    half = F.substr("html", F.lit(1), F.floor(F.length("html") / 2).cast("int"))
    rotted = F.concat(F.lit("#"), F.substr("html", F.lit(2)))
    copy = F.when(draw % ROTTED == 1, rotted).when(draw % SHORT == 2, half).otherwise(F.col("html"))
    ids = [F.col("page_id"), F.col("url")]
    record, second = warc_record(*ids, F.col("html")), warc_record(*ids, copy)
    placed = materialize(
        lay_out(
            pages.select(
                F.col("page_id").alias("record_id"),
                F.octet_length(record).cast("long").alias("length"),
                F.sha2(record.cast("binary"), 256).alias("digest"),
                F.octet_length(second).cast("long").alias("second_length"),
                F.sha2(second.cast("binary"), 256).alias("second_digest"),
                F.coalesce(draw % LOST == 3, F.lit(False)).alias("lost"),
            )
        ),
        "warc-layout",
    )
    left = placed.select("file", "offset", "length", "digest")
    right = placed.where(~F.col("lost")).select(
        "file", "offset", F.col("second_length").alias("length"), F.col("second_digest").alias("digest")
    )
    found = audit(left, right)
    names = placed.select("file", "offset", F.col("record_id").alias("page_id"), "length")
    return names.join(found, ["file", "offset"]).select(
        "page_id", "file", "offset", "length", "status", "left_digest", "right_digest"
    )
