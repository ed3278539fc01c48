"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton of all items' word sequences is built once and sent to the tasks; each
document is streamed through it, tracking at every word the longest suffix that occurs in any
item.  A word is hit if it lies in an occurrence of a window: ``window`` consecutive words of
an item, or all words of a shorter item.

An automaton holds at most ``shard_words`` item words, a proven bound on what is sent.  More
items make more automata, each streamed in a pass of its own; passes add up in the row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import materialize, query, table

# Word bytes: ASCII digits and letters and every byte of a character above U+007F.
_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_PLAIN = bytes(
    (b + 32 if 65 <= b <= 90 else b) if _WORD[b] else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


class SuffixAutomaton:
    """All substrings of several word sequences, as states with suffix links.

    ``window`` consecutive words of an item, and whole items with fewer words, are the
    strings to report; ``items_at`` names the items of each.
    """

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                coded.append((item, ids))
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        self.shortest = min([window, *(len(ids) for _, ids in coded)])
        # a state is reported at the length in its range that is a window's or a short item's
        self.items_at: dict[int, dict[int, set[int]]] = {}
        for item, ids in coded:
            if len(ids) < window:
                state = self._walk_down(self._read(ids), len(ids))
                self.items_at.setdefault(state, {}).setdefault(len(ids), set()).update([] if item is None else [item])
                continue
            for state, held in self._states(ids):
                if held >= window:
                    state = self._walk_down(state, window)
                    self.items_at.setdefault(state, {}).setdefault(window, set()).update([] if item is None else [item])
        # the nearest reported state on the way down the links, the state itself included
        self.report = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=lambda s: self.length[s]):
            if state in self.items_at:
                self.report[state] = state
            elif self.link[state] >= 0:
                self.report[state] = self.report[self.link[state]]

    def _extend(self, last: int, c: int) -> int:
        """Add word ``c`` after state ``last``; sequences share states."""
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        """Give the strings of ``q`` up to ``length[p] + 1`` words a state of their own."""
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _read(self, ids: list[int]) -> int:
        state = 0
        for c in ids:
            state = self.next[state][c]
        return state

    def _walk_down(self, state: int, length: int) -> int:
        """The state of the last ``length`` words."""
        while self.link[state] >= 0 and self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _states(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """After each word: the state of the longest known suffix and its length."""
        state, held = 0, 0
        for c in ids:
            while state and c not in self.next[state]:
                state = self.link[state]
                held = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                held += 1
            yield state, held

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Hit word ranges (sorted, merged, end exclusive), items met, and the longest match."""
        known = np.array(list(map(self.vocabulary.get, words, [-1] * len(words))), dtype=np.int64)
        inside = np.concatenate([[False], known >= 0, [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        runs = turns.reshape(-1, 2)
        runs = runs[runs[:, 1] - runs[:, 0] >= self.shortest]
        spans: list[list[int]] = []
        items: set[int] = set()
        longest = 0
        for lo, hi in runs.tolist():
            for i, (state, held) in enumerate(self._states(known[lo:hi].tolist()), start=lo + 1):
                longest = max(longest, held)
                at = self.report[state]
                while at >= 0:
                    for n, found in self.items_at[at].items():
                        if n <= held:
                            items |= found
                            if spans and spans[-1][0] <= i - n <= spans[-1][1]:
                                spans[-1][1] = i
                            else:
                                spans.append([i - n, i])
                    at = self.report[self.link[at]] if self.link[at] >= 0 else -1
        return merged(spans), items, longest


def merged(spans: list) -> list[tuple[int, int]]:
    """Sorted ranges without overlaps or touching ends."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def automata(items: DataFrame, window: int, shard_words: int) -> Iterator[SuffixAutomaton]:
    """Automata of at most ``shard_words`` words (a longer item has one alone); items arrive a partition at a time."""
    held: list[tuple[int | None, list[bytes]]] = []
    size = 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct().toLocalIterator():
        words = words_of(row["text"])
        if held and size + len(words) > shard_words:
            yield SuffixAutomaton(held, window)
            held, size = [], 0
        held.append((row["item_id"], words))
        size += len(words)
    yield SuffixAutomaton(held, window)


_FOUND = "struct<n_words:long,longest:long,spans:array<struct<start:long,end:long>>,items:array<long>>"


def matches(docs: DataFrame, items: DataFrame, window: int = 10, shard_words: int = 100_000) -> DataFrame:
    """``docs`` with a struct column ``found``: ``n_words``, ``longest``, ``spans`` and ``items``.

    ``spans`` are the hit word ranges (from 0, end exclusive, merged), ``items`` the sorted ids of
    the items with a window in the text, ``longest`` the longest run of words that any
    item holds.  A null text has no words; items without words match nothing; an
    item without id hits words but is not listed.  Rows are independent of each other; a
    column that is called ``found`` already is replaced.
    """
    spark = docs.sparkSession
    if "found" in docs.columns:
        docs = docs.drop("found")
    names = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in names])
    current = docs.select(whole.alias("row"), F.lit(None).cast(_FOUND).alias("found"))
    text_at = names.index("text")
    for number, automaton in enumerate(automata(items, window, shard_words)):
        sent = spark.sparkContext.broadcast(automaton)
        if number:
            current = materialize(current, "decontamination")

        def stream(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, before = batch.column("row"), batch.column("found")
                found = []
                for text, old in zip(rows.field(text_at), before.to_pylist()):
                    words = words_of(text.as_py())
                    spans, met, longest = sent.value.stream(words)
                    if old:
                        spans = merged(spans + [(s["start"], s["end"]) for s in old["spans"]])
                        met, longest = met | set(old["items"]), max(longest, old["longest"])
                    found.append(
                        {
                            "n_words": len(words), "longest": longest,
                            "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(met),
                        }
                    )
                yield pa.RecordBatch.from_arrays([rows, pa.array(found, before.type)], ["row", "found"])

        current = current.mapInArrow(stream, current.schema)
    return current.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "found")


#: A word with what stands before it; the same word bytes as above, as characters.
_TOKEN = "([\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+)"


def hit_words(found: str = "found"):
    """Number of hit words."""
    return F.aggregate(f"{found}.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, shard_words: int = 100_000
) -> DataFrame:
    """Cut the spans that ``matches`` finds out of the texts.

    A document with more than ``max_coverage`` of its words in such spans is removed; a text
    without hits stays as it is, character for character, and so does a null.  Returns the
    columns of ``docs``.
    """
    names = [c for c in docs.columns if c != "found"]
    found = matches(docs, items, window, shard_words)
    tokens = F.regexp_extract_all("text", F.lit(_TOKEN), 1)
    left = F.filter(tokens, lambda t, i: ~F.exists("found.spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    used = F.aggregate(tokens, F.lit(0), lambda n, t: n + F.length(t))
    cut = F.concat(F.array_join(left, ""), F.substr("text", used + 1))
    hits = hit_words()
    return found.where(hits <= F.lit(max_coverage) * F.col("found.n_words")).select(
        *[
            (F.when(hits > 0, F.ltrim(cut)).otherwise(F.col("text")) if c == "text" else F.col(f"`{c}`")).alias(c)
            for c in names
        ]
    )


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[0-9a-z\\x{80}-\\x{10FFFF}]+')"
)

OP8_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_WORDS_SQL} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)
),
met AS (SELECT doc_id, item_id, n, i FROM grams JOIN win USING (n, g)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM met)) GROUP BY doc_id
),
who AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN who USING (doc_id)
"""


@query("op8_decontamination", OP8_SQL)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = matches(docs, table(spark, sf_dir, "benchmark"), window=10)
    ids = F.array_join(F.array_sort(F.transform("found.items", lambda i: i.cast("string"))), ",")
    hits = hit_words()
    return found.select(
        "doc_id", "found.n_words", hits.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (hits > 0).alias("contaminated"),
    )
