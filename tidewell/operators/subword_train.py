"""Training a subword vocabulary: many exact merges per pass over the words.

The state is the table of distinct words with their pieces.  The score of a pair is
``freq / (freq(a) * freq(b))``.  A round

1. counts the neighbouring pairs and the pieces (rows that follow from the vocabulary's size, not the words'),
2. picks pairs from the best on so that at most ``window`` words hold one of them,
3. takes these words and merges pair after pair, and
4. applies the list of merges to all words where they are.

Merges of picked pairs change the picked words only, so the counts of all pairs and pieces stay exact while
they are kept up to date, and a pair that comes up in a round lies in these words alone.  A round ends when the
best of all pairs is one of the others; so the merges are those of training one by one over all words, ties
included.  Where even the best pair's words exceed the window, a round makes that one merge.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import cut_lineage

#: Words a round may take to the driver: a bound on its memory, not on the table.
WINDOW = 100_000

def merged_name(a: str, b: str) -> str:
    return a + b[2:]


def merge_once(pieces: list[str], a: str, b: str, merged: str) -> list[str]:
    """Replace neighbouring ``a, b`` by ``merged``, left to right."""
    out, i = [], 0
    while i < len(pieces):
        if i + 1 < len(pieces) and pieces[i] == a and pieces[i + 1] == b:
            out.append(merged)
            i += 2
        else:
            out.append(pieces[i])
            i += 1
    return out


class PairIndex:
    """Counts of all pieces and pairs, kept up to date by merges, and some words: all that hold a pair of ``held``."""

    def __init__(
        self, words: list[tuple[list[str], int]], counts: dict[str, int], pairs: dict[tuple[str, str], int], held: set[tuple[str, str]], min_frequency: int
    ):
        self.words = [list(p) for p, _ in words]
        self.times = [n for _, n in words]
        self.counts, self.pairs = counts, pairs
        # pairs that other words may hold too
        self.elsewhere = pairs.keys() - held
        self.min_frequency = min_frequency
        self.holders: dict[tuple[str, str], set[int]] = defaultdict(set)
        self.of_piece: dict[str, set[tuple[str, str]]] = defaultdict(set)
        for i, pieces in enumerate(self.words):
            for pair in zip(pieces, pieces[1:]):
                self.holders[pair].add(i)
        for pair in pairs:
            self.of_piece[pair[0]].add(pair)
            self.of_piece[pair[1]].add(pair)
        self.heap: list[tuple[float, str, str]] = []
        for pair in pairs:
            self._push(pair)

    def _count(self, i: int, sign: int) -> set[tuple[str, str]]:
        seen = set()
        for pair in zip(self.words[i], self.words[i][1:]):
            self.pairs[pair] = self.pairs.get(pair, 0) + sign * self.times[i]
            seen.add(pair)
        for pair in seen:
            if sign > 0:
                self.holders[pair].add(i)
                self.of_piece[pair[0]].add(pair)
                self.of_piece[pair[1]].add(pair)
            else:
                self.holders[pair].discard(i)
        return seen

    def _score(self, pair: tuple[str, str]) -> float | None:
        n = self.pairs.get(pair, 0)
        if n < self.min_frequency:
            return None
        return float(n) / (float(self.counts[pair[0]]) * float(self.counts[pair[1]]))

    def _push(self, pair: tuple[str, str]) -> None:
        score = self._score(pair)
        if score is not None:
            heapq.heappush(self.heap, (-score, *pair))

    def best(self) -> tuple[float, str, str] | None:
        """The pair of the highest score over all words; ``merge`` takes it if it is not ``elsewhere``."""
        while self.heap:
            score, a, b = self.heap[0]
            if self._score((a, b)) == -score:
                return -score, a, b
            heapq.heappop(self.heap)
        return None

    def merge(self, a: str, b: str) -> None:
        merged, changed = merged_name(a, b), set()
        for i in list(self.holders[a, b]):
            changed |= self._count(i, -1)
            before = len(self.words[i])
            self.words[i] = merge_once(self.words[i], a, b, merged)
            times = (before - len(self.words[i])) * self.times[i]
            for piece, by in ((a, -times), (b, -times), (merged, times)):
                self.counts[piece] = self.counts.get(piece, 0) + by
            changed |= self._count(i, 1)
        for piece in (a, b, merged):
            changed |= self.of_piece[piece]
        for pair in changed:
            if self.pairs.get(pair):
                self._push(pair)
            else:
                self.pairs.pop(pair, None)
                self.holders.pop(pair, None)
                self.of_piece[pair[0]].discard(pair)
                self.of_piece[pair[1]].discard(pair)


def apply_merges(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """The words' pieces after the merges, each in its turn."""
    if not merges:
        return words
    turns: dict[tuple[str, str], list[int]] = defaultdict(list)
    for turn, pair in enumerate(merges):
        turns[pair].append(turn)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pieces in batch.column("pieces").to_pylist():
                last = -1
                while True:
                    due = []
                    for pair in zip(pieces, pieces[1:]):
                        own = turns.get(pair)
                        if own and own[-1] > last:
                            due.append((own[bisect_right(own, last)], pair))
                    if not due:
                        break
                    last, (a, b) = min(due)
                    pieces = merge_once(pieces, a, b, merged_name(a, b))
                out.append(pieces)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(out, pa.list_(pa.string()))], ["word", "n", "pieces"]
            )

    return words.select("word", "n", "pieces").mapInArrow(change, "word string, n long, pieces array<string>")


def count_pairs(words: DataFrame) -> DataFrame:
    """(a, b, freq, words): how often pieces ``a, b`` are neighbours and at how many places of distinct words.

    A piece itself is counted with a null ``b``.  Counts are made in the tasks; only they are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            coded = lists.flatten().dictionary_encode()
            code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            if not len(code):
                continue
            row, many = np.repeat(np.arange(len(size)), size), len(names) + 1
            times = batch.column("n").to_numpy()[row]
            inner = np.flatnonzero(row[1:] == row[:-1])
            keys = np.concatenate([code[inner] * many + code[inner + 1], code * many + many - 1])
            found, place = np.unique(keys, return_inverse=True)
            freq = np.zeros(len(found), np.int64)
            np.add.at(freq, place, np.concatenate([times[inner], times]))
            other = found % many
            sides = [names.take(pa.array(found // many)), names.take(pa.array(other, mask=other == many - 1))]
            yield pa.RecordBatch.from_arrays([*sides, pa.array(freq), pa.array(np.bincount(place))], ["a", "b", "freq", "words"])

    found = words.select("pieces", "n").mapInArrow(count, "a string, b string, freq long, words long")
    return found.groupBy("a", "b").agg(F.sum("freq").alias("freq"), F.sum("words").alias("words"))


def _holding(words: DataFrame, held: set[tuple[str, str]]) -> DataFrame:
    """The words with one of these pairs."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [any(pair in held for pair in zip(p, p[1:])) for p in batch.column("pieces").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return words.select("pieces", "n").mapInArrow(find, "pieces array<string>, n long")


def train_merges(
    words: DataFrame, known: set[str], room: int, min_frequency: int, window: int = WINDOW
) -> list[tuple[str, str, str, float]]:
    """Merges (a, b, merged, score) in order until ``room`` new names are found or no pair is frequent enough.

    ``words`` has ``word``, ``n`` and ``pieces``.
    """
    known, merges = set(known), []
    words = cut_lineage(words.select("word", F.col("n").cast("long").alias("n"), "pieces"))
    while room > 0:
        rows = count_pairs(words).toArrow().to_pylist()
        counts = {r["a"]: r["freq"] for r in rows if r["b"] is None}
        pairs = {(r["a"], r["b"]): r["freq"] for r in rows if r["b"] is not None}
        places = {(r["a"], r["b"]): r["words"] for r in rows if r["b"] is not None}
        score = {p: float(n) / (float(counts[p[0]]) * float(counts[p[1]])) for p, n in pairs.items()}
        held, size = set(), 0
        for pair in sorted((p for p, n in pairs.items() if n >= min_frequency), key=lambda p: (-score[p], p)):
            size += places[pair]
            if size > window:
                break
            held.add(pair)
        near = _holding(words, held).toArrow().to_pylist() if held else []
        index = PairIndex([(r["pieces"], r["n"]) for r in near], counts, pairs, held, min_frequency)
        done: list[tuple[str, str]] = []
        while room > 0 and (best := index.best()):
            own = best[1:] not in index.elsewhere
            if done and not own:
                break
            done.append(best[1:])
            merged = merged_name(*best[1:])
            merges.append((*best[1:], merged, best[0]))
            if merged not in known:
                known.add(merged)
                room -= 1
            if not own:
                break
            index.merge(*best[1:])
        if not done:
            break
        if room > 0:
            words = cut_lineage(apply_merges(words, done))
    return merges
