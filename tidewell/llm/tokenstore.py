"""Token ids in directly addressable codes: any token is read without decoding those before it.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first.  Level 0 holds the lowest chunk of every id
and a bitmap of those that go on; level 1 the next chunk of only these, and so on.  A rank directory
(ones before every 512th bit) says where on the next level an id goes on, so the id at any place takes one
look-up per level.  A file holds whole documents in ascending id order:

    magic, levels, ids, documents         four 64-bit integers, the magic as bytes
    where each section begins             64-bit integers: ids of documents, first tokens, then per level
                                          chunks, bitmap and rank directory, and the end
    the sections                          little-endian 64-bit integers; one byte a chunk; bits from the lowest

Documents are dealt to files by sampled ranges of their ids, encoded where they land, and a
file is written under a name of its own by each attempt.  The names that count are those in the manifest, a table that
Spark writes: a lost or repeated task leaves a file nobody reads.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import materialize, query, table
from tidewell.session import scratch_path

MAGIC = b"TWDAC001"
CHUNK_BITS = 8
#: Bits of a bitmap per entry of the rank directory.
STRIDE = 512


# -- directly addressable codes ---------------------------------------------------------------


def split_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: chunks, bitmap, rank directory."""
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        more = rest >> np.uint32(CHUNK_BITS)
        on = more > 0
        bits = np.packbits(on, bitorder="little")
        padded = np.zeros(-(-len(rest) // STRIDE) * STRIDE // 8, dtype=np.uint8)
        padded[: len(bits)] = bits
        ones = np.bitwise_count(padded).reshape(-1, STRIDE // 8).sum(axis=1, dtype=np.int64)
        levels.append(((rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8), bits, np.cumsum(ones) - ones))
        if not on.any():
            return levels
        rest = more[on]


def file_bytes(doc_ids: list[int], firsts: np.ndarray, ids: np.ndarray) -> bytes:
    """A file; ``firsts`` has the first token of every document and, at last, the number of ids."""
    levels = split_levels(ids)
    sections = [np.array(doc_ids, dtype="<i8").tobytes(), firsts.astype("<i8").tobytes()]
    for chunks, bits, ranks in levels:
        sections += [chunks.tobytes(), bits.tobytes(), ranks.astype("<i8").tobytes()]
    at = len(MAGIC) + 8 * 3 + 8 * (len(sections) + 1)
    begins = [at, *(at + np.cumsum([len(s) for s in sections])).tolist()]
    head = struct.pack(f"<{3 + len(begins)}q", len(levels), len(ids), len(doc_ids), *begins)
    return b"".join([MAGIC, head, *sections])


class TokenFile:
    """Random access to a file of ids; ``read(begin, size)`` gives bytes of it."""

    def __init__(self, read):
        self._read = read
        head = read(0, len(MAGIC) + 24)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of token ids")
        self.levels, self.n_ids, self.n_docs = struct.unpack("<3q", head[len(MAGIC) :])
        self._at = np.frombuffer(read(len(MAGIC) + 24, 8 * (3 + 3 * self.levels)), dtype="<i8").tolist()

    def _numbers(self, section: int, begin: int, end: int) -> np.ndarray:
        return np.frombuffer(self._read(self._at[section] + 8 * begin, 8 * (end - begin)), dtype="<i8")

    def doc_ids(self, begin: int, end: int) -> np.ndarray:
        return self._numbers(0, begin, end)

    def firsts(self, begin: int, end: int) -> np.ndarray:
        return self._numbers(1, begin, end)

    def _bits(self, level: int, begin: int, end: int) -> np.ndarray:
        section = 3 + 3 * level
        raw = np.frombuffer(self._read(self._at[section] + begin // 8, -(-end // 8) - begin // 8), dtype=np.uint8)
        return np.unpackbits(raw, bitorder="little")[begin % 8 : begin % 8 + end - begin].astype(bool)

    def _rank(self, level: int, place: int) -> int:
        """How many ids of a level before ``place`` go on."""
        before = place // STRIDE * STRIDE
        known = int(self._numbers(4 + 3 * level, place // STRIDE, place // STRIDE + 1)[0])
        return known + int(np.count_nonzero(self._bits(level, before, place))) if place > before else known

    def tokens(self, begin: int, end: int, level: int = 0) -> np.ndarray:
        """The ids from ``begin`` to ``end``; only their own bytes are read."""
        if end <= begin:
            return np.zeros(0, dtype=np.uint32)
        out = np.frombuffer(self._read(self._at[2 + 3 * level] + begin, end - begin), dtype=np.uint8).astype(np.uint32)
        if level + 1 < self.levels:
            on = self._bits(level, begin, end)
            if on.any():
                first = self._rank(level, begin)
                rest = self.tokens(first, first + int(np.count_nonzero(on)), level + 1)
                out[on] |= rest << np.uint32(CHUNK_BITS)
        return out


def open_file(path: str) -> TokenFile:
    """Only headers are read at once; later reads fetch what is asked for."""
    system, inner = pa.fs.FileSystem.from_uri(path)
    source = system.open_input_file(inner)
    return TokenFile(lambda begin, size: source.read_at(size, begin))


# -- tokens of whole texts --------------------------------------------------------------------

# The vocabulary's own cut into words, for texts of these characters only (ASCII and the Latin letters up
# to U+017F), where it needs no tables of Unicode.  Other texts, and those with a marker, are encoded whole.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_PLAIN = re.compile(f"[\t\n\r -~{_LETTERS}]*")
_WORDS = re.compile(
    f"'(?:[sdmt]|ll|ve|re)| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \t\n\r0-9{_LETTERS}]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
)


class WordTokenizer:
    """Ids of whole texts, the same as the tokenizer's; words are kept in a bounded memo.

    The memo has two generations: when the younger is full it becomes the older one, and what is still
    asked for moves back, so frequent words stay.
    """

    def __init__(self, path: str, end_id: int, most: int = 300_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.markers = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [c for c in range(0x180) if _PLAIN.fullmatch(chr(c))]
        self.visible = {c: letters.pre_tokenize_str(chr(c))[0][0] for c in plain}
        self.end = struct.pack("<I", end_id)
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        known = self.young.get(word) or self.old.get(word)
        if known is None:
            ids = [t.id for t in self.tokenizer.model.tokenize(word.translate(self.visible))]
            known = struct.pack(f"<{len(ids)}I", *ids)
        self.young[word] = known
        return known

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of a text (null: none) and the end id."""
        text = text or ""
        if not _PLAIN.fullmatch(text) or any(m in text for m in self.markers):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() + self.end
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        words = _WORDS.findall(text)
        ids = list(map(self.young.get, words))
        if None in ids:
            ids = [known or self._word(word) for known, word in zip(ids, words)]
        ids.append(self.end)
        return b"".join(ids)


_TOKENIZERS: dict[tuple[str, int], WordTokenizer] = {}


def _tokenizer(path: str, end_id: int) -> WordTokenizer:
    """One per worker process: its memos live from task to task."""
    if (path, end_id) not in _TOKENIZERS:
        _TOKENIZERS[path, end_id] = WordTokenizer(path, end_id)
    return _TOKENIZERS[path, end_id]


# -- files ------------------------------------------------------------------------------------

_WRITTEN = "part int, number int, path string, documents long, ids long"


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, file_ids: int = 4_000_000) -> DataFrame:
    """Write the ids of all texts and return the manifest: ``path``, ``documents``, ``ids``, ``start`` (ids in the files before).

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Documents are in ascending order of
    ``doc_id``, nulls first (written as -2^63), those of one id in the order of a hash of their text.  A null
    text counts as empty, and every document ends with ``end_id``.  A file ends with the document that brings it to
    ``file_ids`` ids, so neither a file nor a task's memory grows with the table.  No documents give no files.
    ``folder`` must be one that all executors reach: a path or a URI that Arrow knows.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _tokenizer(tokenizer_path, end_id)
        system, inner = pa.fs.FileSystem.from_uri(folder)
        part, number = TaskContext.get().partitionId(), 0
        doc_ids: list[int] = []
        held: list[bytes] = []

        def flush() -> pa.RecordBatch:
            firsts = np.cumsum([0, *(len(h) // 4 for h in held)])
            name = f"ids-{part:06d}-{number:05d}-{uuid.uuid4().hex}"
            system.create_dir(inner, recursive=True)
            with system.open_output_stream(f"{inner}/{name}") as out:
                out.write(file_bytes(doc_ids, firsts, np.frombuffer(b"".join(held), dtype="<u4")))
            columns = [[part], [number], [f"{folder}/{name}"], [len(doc_ids)], [int(firsts[-1])]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "number", "path", "documents", "ids"]
            )

        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                held.append(codec.encode(text.as_py()))
                doc_ids.append(NO_ID if doc_id is None else doc_id)
                size += len(held[-1]) // 4
                if size >= file_ids:
                    yield flush()
                    doc_ids, held, size, number = [], [], 0, number + 1
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", "by", "tie"]
    # documents of one id are dealt by their text, equal ones by where they were read
    dealt = rows.withColumn("by", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    written = materialize(dealt.mapInArrow(store, _WRITTEN), "token-files")
    # first the files of each task, then the tasks: a window of tasks, not of files
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    parts = written.groupBy("part").agg(F.sum("ids").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("first"))
    within = written.withColumn("inside", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    return within.join(starts, "part").select("path", "documents", "ids", (F.col("first") + F.col("inside")).alias("start"))


#: What a missing ``doc_id`` is in a file.
NO_ID = -(1 << 63)


def read(manifest: DataFrame, portion: int = 2_000, token_limit: int = 4_000_000) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids`` (little-endian 32-bit) of every document.

    A file's documents are read in portions of ``portion``, each a row of its own to Spark and a range of
    the file, so many tasks can read one file.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, begin, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "begin", "end"))):
                opened = open_file(path)
                names = opened.doc_ids(begin, end).tolist()
                firsts = opened.firsts(begin, end + 1).tolist()
                k = 0
                while k < len(names):
                    upto = k + 1
                    while upto < len(names) and firsts[upto + 1] - firsts[k] <= token_limit:
                        upto += 1
                    ids = opened.tokens(firsts[k], firsts[upto]).astype("<u4").tobytes()
                    cuts = [4 * (f - firsts[k]) for f in firsts[k : upto + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if n == NO_ID else n for n in names[k:upto]], pa.int64()),
                         pa.array([start + f for f in firsts[k:upto]], pa.int64()),
                         pa.array([(b - a) // 4 for a, b in zip(cuts, cuts[1:])], pa.int64()),
                         pa.array([ids[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    k = upto

    begins = F.expr(f"explode(sequence(0L, documents - 1, {portion}L)) AS begin")
    portions = manifest.select("path", "start", "documents", begins).withColumn(
        "end", F.least(F.col("begin") + portion, F.col("documents"))
    )
    # a row is a few numbers but stands for many ids: by their size Spark would deal all rows to one task
    ids = manifest.agg(F.sum("ids")).first()[0] or 0
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, -(-ids // (4 * token_limit)))
    dealt = portions.repartition(int(tasks), "path", "begin")
    return dealt.mapInArrow(fetch, "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(manifest: DataFrame, wanted: DataFrame, width: int = 1 << 20) -> DataFrame:
    """``wanted`` (a long column ``place``, counted over all files) with ``id``, read one by one without their documents.

    Places outside the files and null places get a null id; repeated places are repeated.
    """
    spans = manifest.where("ids > 0").select(
        "path", "start", "ids", F.expr(f"explode(sequence(start div {width}, (start + ids - 1) div {width})) AS bucket")
    )
    asked = wanted.select("place").withColumn("bucket", F.expr(f"place div {width}L"))
    inside = (F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("ids"))
    met = asked.join(spans, "bucket", "left").withColumn("hit", inside)
    # a bucket may hold the end of one file and the beginning of the next
    found = met.where("hit").select("place", "path", (F.col("place") - F.col("start")).alias("at"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, TokenFile] | None = None
        for batch in batches:
            ids = []
            for path, at in zip(batch.column("path").to_pylist(), batch.column("at").to_pylist()):
                if opened is None or opened[0] != path:
                    opened = path, open_file(path)
                ids.append(int(opened[1].tokens(at, at + 1)[0]))
            yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(ids, pa.int64())], ["place", "id"])

    got = found.distinct().repartition("path", F.expr(f"at div {width}L")).sortWithinPartitions("path", "at")
    got = got.mapInArrow(fetch, "place long, id long")
    return wanted.select("place").join(got, "place", "left")


@query("op12_token_store")
def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    manifest = write(docs, scratch_path(spark, "token-store"), public_tokenizers.path("byte_bpe_50k.json"))
    return read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
