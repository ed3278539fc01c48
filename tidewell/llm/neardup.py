"""MinHash near-duplicates by an inverted join of signature coordinates.

1. Every text's set of word shingles gets ``coordinates`` minima and an exact
   fingerprint; rows with equal sets are one class from here on.
2. Classes are posted under their coordinate-value pairs, of which only the
   ``coordinates - matches + 1`` rarest are kept (the prefix rule: two signatures that agree in
   ``matches`` places share one of these).  Pairs that nothing else has come first, so a text
   that shares fewer than ``matches`` pairs with others has no postings left, and
   the long lists of a passage that many texts hold are the last to be used.
3. Posting lists are merged: collisions are counted over the whole signatures, members
   that are already tied to the list's walk are skipped, and a list yields a spanning
   forest of its pairs with enough collisions, never the pairs themselves.  Lists above
   ``block`` members are split into blocks, and every two blocks meet in a task of their own.
4. Within each candidate component the links are confirmed on the full shingle sets,
   again in blocks, and the components of the confirmed links are the result.

Every pair that passes the collision count is either compared exactly or already known to be
connected, so components equal those of all confirmed pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import materialize, query, table
from tidewell.llm.components import connected
from tidewell.llm.shingles import mix, shingle_sets

_SIGNATURE = "doc_id long, row long, row2 long, n_shingles long, h1 long, h2 long, coords array<long>, marks binary"


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and ``row`` and ``row2``, two hashes of both that together name the row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.withColumns(_names(F.col("doc_id"), F.col("text")))


def _names(doc_id: Column, text: Column) -> dict[str, Column]:
    # nulls leave a hash as it was, so each is marked
    marks = [F.lit(1), doc_id.isNull(), text.isNull()]
    return {"row": F.xxhash64(doc_id, text, *marks), "row2": F.xxhash64(*marks, text, doc_id)}


def signatures(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """Per row: set size, set fingerprint, the minima and a byte of each."""
    factors = mix(np.arange(1, coordinates + 1, dtype=np.uint64)) | np.uint64(1)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row", pa.int64()), ("row2", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
         ("coords", pa.list_(pa.int64())), ("marks", pa.binary())]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, h1, h2, coords, marks = [], [], [], [], []
            for found in shingle_sets(batch.column("text"), words):
                sizes.append(len(found))
                h1.append(found.sum(dtype=np.uint64).astype(np.int64))
                h2.append(mix(found + np.uint64(1)).sum(dtype=np.uint64).astype(np.int64))
                if not len(found):
                    coords.append(None)
                    marks.append(None)
                    continue
                least = np.array([(found * f).min() for f in factors])
                coords.append(least.astype(np.int64))
                marks.append((mix(least) & np.uint64(255)).astype(np.uint8).tobytes())
            columns = [batch.column("doc_id"), batch.column("row"), batch.column("row2"), sizes, h1, h2, coords, marks]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema
            )

    return _texts(docs).mapInArrow(sign, _SIGNATURE)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, two or more; rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            key = tuple(values[lo])
            if key != last:
                if held and (len(held) > 1 or held[0].num_rows > 1):
                    yield pa.Table.from_batches(held)
                held, last = [], key
            held.append(batch.slice(lo, hi - lo))
    if held and (len(held) > 1 or held[0].num_rows > 1):
        yield pa.Table.from_batches(held)


def spanning(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """A star from the first node of each component of a graph on 0..n-1; ``linked(i, rest)`` picks
    i's neighbours in ``rest``.

    Nodes already reached are skipped, so copies of one text cost one comparison each.
    """
    forest, rest, queue, first = [], np.arange(n), [], 0
    while len(rest):
        if queue:
            i = queue.pop()
        else:
            i, rest = int(rest[0]), rest[1:]
            first = i
        if not len(rest):
            break
        hit = linked(i, rest)
        if hit.any():
            found = rest[hit].tolist()
            forest += [(first, j) for j in found]
            queue += found
            rest = rest[~hit]
    return forest


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edge_batches(found: Iterator[tuple[np.ndarray, list[tuple[int, int]]]]) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for ids, forest in found:
        for i, j in forest:
            a.append(ids[i])
            b.append(ids[j])
        if len(a) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGES)
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGES)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _by_blocks(rows: DataFrame, size_column: str, block: int, member: str) -> DataFrame:
    """Add ``pair``: 0 for a group of one block, else one row per pair of blocks the row is in."""
    parts = F.ceil(F.col(size_column) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(member), F.col("parts")).cast("int")
    pairs = F.when(F.col("parts") <= 1, F.array(F.lit(0))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: o != F.col("own")),
            lambda o: F.least(o, F.col("own")) * F.col("parts") + F.greatest(o, F.col("own")),
        )
    )
    return rows.withColumn("parts", parts).withColumn("own", own).withColumn("pair", F.explode(pairs)).drop("parts", "own")


def prefix_posts(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """``rep`` and ``key`` for the rarest coordinate-value pairs of each class that others share."""
    posts = classes.select("rep", F.posexplode("coords").alias("place", "value")).select(
        "rep", F.xxhash64("place", "value").alias("key")
    )
    lists = posts.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    own = Window.partitionBy("rep")
    rank = F.row_number().over(own.orderBy("members", "key"))
    alone = F.lit(coordinates) - F.count(F.lit(1)).over(own)
    return (
        posts.join(lists, "key")
        .withColumn("rank", rank)
        .withColumn("alone", alone)
        .where(F.col("alone") + F.col("rank") <= coordinates - matches + 1)
        .select("rep", "key")
    )


def candidate_edges(classes: DataFrame, coordinates: int, matches: int, block: int) -> DataFrame:
    """Stars of the classes whose signatures agree in ``matches`` places or more."""
    posts = materialize(prefix_posts(classes, coordinates, matches), "minhash-posts")
    lists = posts.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    live = _by_blocks(posts.join(lists, "key"), "members", block, "rep").select("key", "pair", "rep")
    live = live.join(classes.select("rep", "marks"), "rep")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forests():
            for group in _groups(batches, ["key", "pair"]):
                ids = group.column("rep").to_numpy()
                marks = _matrix(group.column("marks"), coordinates)
                yield ids, spanning(
                    len(ids), lambda i, rest: (marks[rest] == marks[i]).sum(axis=1, dtype=np.int32) >= matches
                )

        yield from _edge_batches(forests())

    dealt = live.repartition("key", "pair").sortWithinPartitions("key", "pair", "rep")
    return dealt.mapInArrow(merge, "a long, b long")


def confirmed_edges(
    docs: DataFrame, classes: DataFrame, components: DataFrame, words: int, coordinates: int,
    matches: int, percent: int, block: int,
) -> DataFrame:
    """Spanning forests of the exact links within each candidate component."""
    members = components.join(classes.select(F.col("rep").alias("node"), "marks", "row", "row2"), "node")
    sizes = components.groupBy("root").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    wanted = members.join(sizes, "root")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"), words)]
            columns = [*(batch.column(c) for c in ("root", "members", "node", "marks")), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["root", "members", "node", "marks", "shingles"])

    rows = _texts(docs).select("row", "row2", "text")
    # rows of one name are equal, and any will do
    met = rows.join(wanted, ["row", "row2"]).dropDuplicates(["node"]).select("root", "members", "node", "marks", "text")
    sets = met.mapInArrow(collect, "root long, members long, node long, marks binary, shingles binary")
    dealt = _by_blocks(sets, "members", block, "node").repartition("root", "pair").sortWithinPartitions(
        "root", "pair", "node"
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forests():
            for group in _groups(batches, ["root", "pair"]):
                ids = group.column("node").to_numpy()
                marks = _matrix(group.column("marks"), coordinates)
                sets = [np.frombuffer(s, dtype=np.uint64) for s in group.column("shingles").to_pylist()]
                sizes = np.array([len(s) for s in sets])

                def linked(i: int, rest: np.ndarray) -> np.ndarray:
                    out = (marks[rest] == marks[i]).sum(axis=1, dtype=np.int32) >= matches
                    near = rest[out]
                    if len(near):
                        own, other = sets[i], np.concatenate([sets[j] for j in near])
                        place = np.minimum(np.searchsorted(own, other), len(own) - 1)
                        starts = np.cumsum(sizes[near]) - sizes[near]
                        both = np.add.reduceat((own[place] == other).astype(np.int64), starts)
                        out[out] = 100 * both >= percent * (sizes[i] + sizes[near] - both)
                    return out

                yield ids, spanning(len(ids), linked)

        yield from _edge_batches(forests())

    return dealt.mapInArrow(confirm, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 85, coordinates: int = 32, matches: int = 18, block: int = 512
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, and ``row`` and ``row2``, its name.

    Two texts are linked if 100 * shared >= ``percent`` * united shingles; ``component_id`` is
    the smallest ``doc_id`` that links reach.  A null, empty or wordless text has no
    shingles and is a component of its own.  Rows that repeat an id and a text are both
    returned.  A null id takes part through its text and is kept only if no other row of its
    component has an id.  Other columns are ignored.

    ``matches`` of ``coordinates`` equal minima make a candidate: at a similarity of exactly
    0.85 and 18 of 32, a pair is missed with a probability of about 1e-5.
    """
    signed = materialize(signatures(docs, words, coordinates), "minhash-signatures")
    equal = ["n_shingles", "h1", "h2"]
    classes = materialize(
        signed.where("n_shingles > 0")
        .groupBy(*equal)
        .agg(
            F.min(F.struct("row", "row2")).alias("name"), F.min("doc_id").alias("least"),
            F.first("coords").alias("coords"), F.first("marks").alias("marks"),
        )
        # numbers rather than hashes name the classes: no two can meet by chance
        .select(
            *equal, F.monotonically_increasing_id().alias("rep"), "name.row", "name.row2", "least", "coords", "marks"
        ),
        "minhash-classes",
    )
    rough = materialize(connected(candidate_edges(classes, coordinates, matches, block)), "minhash-rough")
    exact = confirmed_edges(docs, classes, rough, words, coordinates, matches, percent, block)
    roots = connected(exact)
    rooted = classes.join(roots, classes["rep"] == roots["node"], "left").select(
        *equal, F.coalesce("root", "rep").alias("root"), "least"
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select(*equal, "component_id")
    return (
        signed.join(named, equal, "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
        .select(
            "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            "row", "row2",
        )
    )


def without_copies(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near-duplicates, with the columns of ``docs``.

    The one with the smallest id stays; of several rows with that id, one.  Texts without
    shingles are no copies of each other.
    """
    found = near_duplicates(docs, **options).where("kept")
    first = F.min(F.struct("row", "row2")).alias("name")
    grouped = found.where("n_shingles > 0").groupBy("component_id").agg(first).select("name.*")
    keep = grouped.unionByName(found.where("n_shingles = 0").select("row", "row2").distinct())
    names = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole")
    named = _names(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = docs.select(whole, *[c.alias(n) for n, c in named.items()])
    left = rows.join(keep, ["row", "row2"], "left_semi").dropDuplicates(["row", "row2"])
    return left.select(*[F.col(f"whole.`{c}`").alias(c) for c in names])


OP9_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(least, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""


@query("op9_minhash", OP9_SQL)
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row", "row2")
