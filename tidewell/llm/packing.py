"""First-fit decreasing packing of token sequences.

Documents are tokenised where they are read, cut at every ``capacity`` tokens, and
dealt to random groups of ``group_pieces`` pieces or somewhat fewer.  Each group is packed alone:
its pieces, longest first, go to the first open sequence with room, which a
tournament tree over the free space of all sequences finds in logarithmic time.
A group, and so a task's memory, has the same size for any number of documents.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import materialize, query, table

# Letters that no normal form changes and that lower-case one to one: ASCII and the Latin
# letters up to U+017F but for the dotted capital I.  Texts of these, ASCII signs and common white space
# are cut as the vocabulary does, without tables of Unicode; others, and those with a marker, are encoded whole.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_PLAIN = re.compile(f"[\t\n\r -~{_LETTERS}]*")
_WORDS = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[0-9]|[^ \t\n\r0-9{_LETTERS}]+")


class WordCachedTokenizer:
    """Token ids of whole texts as little-endian 32-bit integers, the same as the tokenizer's.

    Words go straight to the merge rules and are kept in a bounded memo of two generations: when
    the younger is full it becomes the older, from which what is still asked for moves back.
    """

    def __init__(self, path: str, end_id: int, most: int = 300_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.markers = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [c for c in range(0x21, 0x180) if _PLAIN.fullmatch(chr(c))]
        self.visible = {c: letters.pre_tokenize_str(chr(c))[0][0] for c in plain}
        self.end = np.array([end_id], dtype="<u4").tobytes()
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        known = self.young.get(word) or self.old.get(word)
        if known is None:
            shown = word if word.isascii() else word.translate(self.visible)
            ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
            known = struct.pack(f"<{len(ids)}I", *ids)
        self.young[word] = known
        return known

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if not _PLAIN.fullmatch(text) or any(m in text for m in self.markers):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() + self.end
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        words = _WORDS.findall(text.lower())
        ids = list(map(self.young.get, words))
        if None in ids:
            ids = [known or self._word(word) for known, word in zip(ids, words)]
        ids.append(self.end)
        return b"".join(ids)


_TOKENIZERS: dict[tuple[str, int], WordCachedTokenizer] = {}


def _tokenizer(path: str, end_id: int) -> WordCachedTokenizer:
    """One per worker process: its memo lives from task to task."""
    if (path, end_id) not in _TOKENIZERS:
        _TOKENIZERS[path, end_id] = WordCachedTokenizer(path, end_id)
    return _TOKENIZERS[path, end_id]


class Tournament:
    """Free space of sequences; ``place`` finds the first with enough room."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1
        while self.leaves < n:
            self.leaves *= 2
        self.free = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that takes ``length`` tokens, and its free space before."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < length:
                at += 1
        before = free[at]
        free[at] = before - length
        leaf = at
        while at > 1:
            at //= 2
            free[at] = max(free[2 * at], free[2 * at + 1])
        return leaf - self.leaves, before


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset of every piece; ties keep their order."""
    tree = Tournament(max(1, len(lengths)), capacity)
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        sequence[i], before = tree.place(lengths[i])
        offset[i] = capacity - before
    return sequence, offset


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"
_CUT = f"row long, n long, {PIECES}"


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens; ``row`` and ``n`` are carried along."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _tokenizer(tokenizer_path, end_id)
        schema = pa.schema(
            [("row", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
             ("ids", pa.binary()), ("doc_tokens", pa.int64())]
        )
        for batch in batches:
            rows: list[list] = [[] for _ in schema]
            held = 0
            for row, n, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "n", "doc_id")), batch.column("text")):
                ids = codec.encode(text.as_py())
                tokens = len(ids) // 4
                for start in range(0, tokens, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    for column, value in zip(rows, (row, n, doc_id, start, len(part) // 4, part, tokens)):
                        column.append(value)
                held += len(ids)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(rows, schema)], schema=schema)
                    rows, held = [[] for _ in schema], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(rows, schema)], schema=schema)

    return docs.select("row", "n", "doc_id", "text").mapInArrow(cut, _CUT)


def _different(docs: DataFrame) -> DataFrame:
    """``row`` (a hash of it), ``n``, ``doc_id`` and ``text`` of every different row, ``n`` of each.

    Equal rows are found by two 64-bit hashes.  Only rows that repeat are shuffled, one for
    each task that read them.
    """
    names = ["h1", "h2"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumns(
        {"h1": F.xxhash64("doc_id", "text"), "h2": F.xxhash64(F.lit(1), "text", "doc_id")}
    )
    repeats = materialize(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "packing-repeats")
    one = F.lit(1).cast("long").alias("n")
    if repeats.isEmpty():
        return rows.select(F.col("h1").alias("row"), one, "doc_id", "text")
    many = rows.join(repeats, names).groupBy(*names).agg(
        F.first("n").alias("n"), F.first("doc_id").alias("doc_id"), F.first("text").alias("text")
    )
    single = rows.join(repeats, names, "left_anti").select(F.col("h1").alias("row"), one, "doc_id", "text")
    return single.unionByName(many.select(F.col("h1").alias("row"), "n", "doc_id", "text"))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    capacity: int = 4096,
    group_pieces: int = 4096,
    seed: int = 17,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    A document's tokens are its ids and ``end_id``; a null text counts as empty, so every
    row yields at least one piece.  Returns a row per piece: ``doc_id``, ``start`` (tokens of
    the document before it), ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset`` (gapless from 0 in each sequence).  Repeated rows are packed as
    often as they occur.  Other columns are ignored.

    A piece's group is drawn by a hash of its row, the number of the copy and its start, so repeated ids and
    rows do not meet in one group and the result is the same for any partitioning.  A token has at least a byte of
    text, so the texts' sizes bound the pieces, and groups are as many as that bound needs: neither long texts nor
    many make a group larger.
    """
    bound = docs.agg(F.sum(1 + F.floor(F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) / F.lit(capacity))))
    groups = max(1, -(-(bound.first()[0] or 0) // group_pieces))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "draw"], kind="stable").reset_index(drop=True)
        sequence, offset = first_fit_decreasing(group["length"].tolist(), capacity)
        first = int(group["part"].iloc[0]) << 32
        group["sequence_id"] = first + np.array(sequence, dtype=np.int64)
        group["offset"] = np.array(offset, dtype=np.int64)
        return group.drop(columns=["part", "draw"])

    cut = pieces(_different(docs), tokenizer_path, end_id, capacity)
    copies = cut.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    draw = F.xxhash64(F.lit(seed), "row", "copy", "start")
    dealt = copies.withColumn("draw", draw).withColumn("part", F.pmod("draw", F.lit(groups).cast("long")))
    names = [f.split()[0] for f in PIECES.split(", ")]
    return dealt.select("part", "draw", *names).groupBy("part").applyInPandas(fit, PACKED)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), vocabulary())
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
