"""Merkle manifest of a dataset by nested-interval labels.

Leaves are ranked within their tree (one tree per source) and every node carries the
interval of leaf ranks that it covers.  Going up, the nodes of a level that fall into one
parent's interval are hashed into that parent.  Going down, each level's nodes join the
level above on the bucket that both intervals lie in, with containment as the condition;
the parts of the parent's interval outside the node's own are its siblings.  A node's proof
is its siblings followed by its parent's proof, so every join is between a node and its
one parent and no key is hot, however many leaves a tree has.  The roots of all trees are
the leaves of one more tree, whose proofs the roots start from.

Only digests are shuffled, never texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import materialize, query, table
from tidewell.operators.ordered import ranked

_PART = "struct<lo:bigint,hi:bigint,digest:binary>"
_STEP = "struct<left:binary,right:binary>"


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 over the fields of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(v) for v in values]), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(parts: str) -> str:
    """SQL for the digests of an array of parts, one after another."""
    return f"aggregate({parts}, cast('' AS binary), (acc, p) -> concat(acc, p.digest))"


def _height(n: str, fanout: int) -> Column:
    """Levels over the leaves of a tree of ``n`` leaves."""
    powers = [fanout**i for i in range(64) if fanout**i < 1 << 62]
    return F.expr(f"size(filter(array({', '.join(f'{p}L' for p in powers)}), p -> p < {n}))")


def _climb(leaves: DataFrame, height: int, fanout: int) -> list[DataFrame]:
    """Nodes per level: ``tree``, ``n`` (the tree's leaves), ``lo``, ``hi``, ``digest``, ``parts`` (children by rank)."""
    floor = leaves.withColumn("hi", F.col("lo") + 1).withColumn("parts", F.array().cast(f"array<{_PART}>"))
    levels = [floor.select("tree", "n", "lo", "hi", "digest", "parts")]
    for level in range(height):
        below = levels[-1].where(F.col("n") > fanout**level)
        parents = (
            below.groupBy("tree", "n", F.floor(F.col("lo") / F.lit(fanout ** (level + 1))).alias("bucket"))
            .agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("parts"))
            .select(
                "tree", "n", F.col("parts")[0]["lo"].alias("lo"), F.element_at("parts", -1)["hi"].alias("hi"),
                F.expr(f"unhex(sha2(lower(hex({_joined('parts')})), 256)) AS digest"), "parts",
            )
        )
        levels.append(materialize(parents, "manifest-level"))
    return levels


def _bucket(column: Column, fanout: int, level: int) -> Column:
    return F.floor(column / F.lit(fanout**level)).cast("long")


def _descend(leaves: DataFrame, levels: list[DataFrame], heights: set[int], tops: DataFrame, fanout: int) -> DataFrame:
    """``leaves`` with ``path``, the steps from the leaf to the last root, and the columns of ``tops``.

    ``tops`` has a row per tree: ``tree``, the ``path`` of its root and further columns, which
    are handed down with it.
    """
    more = [c for c in tops.columns if c not in ("tree", "path")]
    parents = None
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level] if level else leaves.withColumn("hi", F.col("lo") + 1)
        own = nodes.columns
        found = None
        if level in heights:
            roots = nodes.where(F.col("n") <= fanout**level)
            found = roots.join(tops, "tree").select(*own, "path", *more)
        if parents is not None:
            inner = nodes.where(F.col("n") > fanout**level).withColumn("bucket", _bucket(F.col("lo"), fanout, level + 1))
            above = parents.select(
                F.col("tree").alias("of_tree"), _bucket(F.col("lo"), fanout, level + 1).alias("of_bucket"),
                F.col("lo").alias("from"), F.col("hi").alias("to"), F.col("parts").alias("family"),
                F.col("path").alias("rest"), *more,
            )
            contained = (
                (F.col("tree") == F.col("of_tree")) & (F.col("bucket") == F.col("of_bucket"))
                & (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
            )
            left, right = _joined("filter(family, f -> f.hi <= lo)"), _joined("filter(family, f -> f.lo >= hi)")
            step = f"concat(array(named_struct('left', {left}, 'right', {right})), rest) AS path"
            handed = inner.join(above, contained).select(*own, F.expr(step), *more)
            found = handed if found is None else handed.unionByName(found)
        # a plan of a few joins at a time
        parents = materialize(found, "manifest-paths") if level and level % 4 == 0 else found
    return parents.drop("hi")


def _with_paths(leaves: DataFrame, fanout: int, tops) -> DataFrame:
    sizes = leaves.where("lo = 0").select(_height("n", fanout).alias("h")).distinct().collect()
    heights = {r["h"] for r in sizes} or {0}
    levels = _climb(leaves, max(heights), fanout)
    ends = [levels[h].where(F.col("n") <= fanout**h) for h in sorted(heights)]
    roots = reduce(DataFrame.unionByName, ends).select("tree", F.col("digest").alias("subroot"))
    return _descend(leaves, levels, heights, tops(roots), fanout)


def manifest(rows: DataFrame, tree: str, order: Sequence[str], digest: str, fanout: int = 3) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` (32 bytes each) and ``path``.

    The rows of one value of ``tree`` (nulls are one value) are the leaves of one tree, in the order
    of ``order`` (nulls first) and then ``digest``; rows that repeat all of these are
    leaves of their own, next to each other.  Every ``fanout`` consecutive nodes become their hash,
    a shorter last run too, until one is left.  The subroots, ordered by ``tree`` (null first),
    give the root in the same way.  ``path`` lists, level by level from the leaf to the root, the
    siblings' digests left and right of the node.  No rows give no rows.

    The driver gets the different heights of trees, some sixty numbers at most.
    """
    kept = rows.columns
    # null and text keys as one text that is never null; order is that of the values
    key = F.when(F.col(tree).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(tree).cast("string")))
    inner = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), key.alias("tree"),
                        *[F.col(f"`{c}`").alias(f"by{i}") for i, c in enumerate(order)], F.col(f"`{digest}`").alias("digest"))
    leaves = ranked(inner, [*[f"by{i}" for i in range(len(order))], "digest"], ["tree"], "lo", "n")
    leaves = materialize(leaves.select("row", "tree", "lo", "n", "digest"), "manifest-leaves")

    def tops(subroots: DataFrame) -> DataFrame:
        upper = ranked(subroots.withColumnRenamed("tree", "name"), ["name"], [], "lo", "n")
        upper = materialize(
            upper.select("name", "lo", "n", F.lit("").alias("tree"), F.col("subroot").alias("digest")), "manifest-trees"
        )

        def last(root: DataFrame) -> DataFrame:
            return root.select("tree", F.array().cast(f"array<{_STEP}>").alias("path"), F.col("subroot").alias("root"))

        return materialize(
            _with_paths(upper, fanout, last).select(
                F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
            ),
            "manifest-tops",
        )

    return _with_paths(leaves, fanout, tops).select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept if c not in ("subroot", "root", "path")], "subroot", "root", "path"
    )


def proof(path: str = "path") -> Column:
    """SHA-256 (hex) of all siblings of a path, in hex text."""
    return F.expr(f"sha2(array_join(transform({path}, s -> lower(hex(concat(s.left, s.right)))), ''), 256)")


def folded(leaf: str, path: str = "path") -> Column:
    """The root (hex) that a leaf's digest gives with the siblings of a path."""
    one = "sha2(concat(lower(hex(s.left)), acc, lower(hex(s.right))), 256)"
    return F.expr(f"aggregate({path}, lower(hex({leaf})), (acc, s) -> {one})")


#: The fields of a document that its leaf covers.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, even, array_to_string([
      CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END FOR v IN f], '') AS whole,
    array_to_string([CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END
      FOR v IN [f[1], f[2], f[3], f[4], CASE WHEN even THEN replace(f[5], chr(10), '') ELSE f[5] END]], '') AS changed
  FROM (
    SELECT doc_id, source, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS f,
      xor(list_reduce(list_prepend(4294967295, flatten([
          [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 2 = 0 AS even
    FROM documents
  )
),
leaves AS (
  SELECT doc_id, source, sha256(whole) AS leaf, sha256(changed) AS other,
    CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id, sha256(whole)) - 1 AS BIGINT) AS lo
  FROM d
),
up AS (
  SELECT source, 0 AS level, list(leaf ORDER BY lo) AS nodes FROM leaves GROUP BY source
  UNION ALL
  SELECT source, level + 1,
    [sha256(array_to_string(nodes[i + 1:i + 3], '')) FOR i IN range(0, len(nodes), 3)]
  FROM up WHERE len(nodes) > 1
),
subroots AS (
  SELECT source, nodes[1] AS subroot, CAST(row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS BIGINT) AS lo
  FROM up WHERE len(nodes) = 1
),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY lo) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, [sha256(array_to_string(nodes[i + 1:i + 3], '')) FOR i IN range(0, len(nodes), 3)]
  FROM top WHERE len(nodes) > 1
),
steps AS (
  SELECT l.doc_id, l.source, l.lo, 0 AS part, u.level, l.lo // CAST(3 ** u.level AS BIGINT) AS spot, u.nodes
  FROM leaves l JOIN up u ON u.source IS NOT DISTINCT FROM l.source WHERE len(u.nodes) > 1
  UNION ALL
  SELECT l.doc_id, l.source, l.lo, 1, t.level, s.lo // CAST(3 ** t.level AS BIGINT), t.nodes
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source, top t WHERE len(t.nodes) > 1
),
sides AS (
  SELECT doc_id, source, lo, row_number() OVER (PARTITION BY source, lo ORDER BY part, level) AS k,
    array_to_string(nodes[spot - spot % 3 + 1:spot], '') AS a, array_to_string(nodes[spot + 2:spot - spot % 3 + 3], '') AS b
  FROM steps
),
fold AS (
  SELECT source, lo, CAST(0 AS BIGINT) AS k, other AS now FROM leaves
  UNION ALL
  SELECT f.source, f.lo, s.k, sha256(s.a || f.now || s.b)
  FROM fold f JOIN sides s ON s.source IS NOT DISTINCT FROM f.source AND s.lo = f.lo AND s.k = f.k + 1
),
last AS (SELECT source, lo, max_by(now, k) AS folded FROM fold GROUP BY ALL),
proofs AS (SELECT source, lo, sha256(string_agg(a || b, '' ORDER BY k)) AS proof FROM sides GROUP BY ALL)
SELECT l.doc_id, l.leaf, s.subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
  coalesce(p.proof, sha256('')) AS proof_sha256, f.folded AS folded_root,
  f.folded = (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
JOIN last f ON f.source IS NOT DISTINCT FROM l.source AND f.lo = l.lo
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.lo = l.lo
"""


@query("op13_manifest", OP13_SQL)
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))
    ).otherwise(F.col("text"))
    fields = [F.col(c) for c in FIELDS]
    rows = docs.select(
        "doc_id", "source", leaf_digest(fields).alias("leaf"), leaf_digest([*fields[:-1], changed]).alias("tampered")
    )
    found = manifest(rows, "source", ["doc_id"], "leaf")
    return found.select(
        "doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"), proof().alias("proof_sha256"), folded("tampered").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
