"""Runs: stretches of words that repeat with a short period, by a sparse diagonal DP.

A diagonal is a lag ``d``; its match length at word ``i`` says for how many words up to ``i`` each
equals the word ``d`` before it.  The words of a text are gone through once; an
earlier occurrence of what stands at ``i`` lengthens the match of its lag, and a diagonal
that no later event can lengthen is closed and yields its run at once if it is long enough.

What keeps it sparse for any text: lags are looked for at scales.  At scale ``L`` (1, 2, 4, ...) lags from
``L`` to ``2L - 1`` are found by the earlier occurrences of the ``L`` words at ``i``, and only the three
latest are needed.  In every cycle of a run of smallest period ``q`` (``L <= q < 2L``) some ``L`` words have no
period of ``L / 2`` or less, or ``q`` were not the smallest; such words recur more than ``L / 2`` apart, so
fewer than four times within ``2L``.  Matches of the cycles between are compared directly.  A text of ``n`` words has at most
``3n`` events per scale, however often one word occurs in it, and a scale goes on only with words that occurred twice at
the last one.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import query, table

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def lag_events(names: np.ndarray, ends: np.ndarray, periods: int = LEAST_PERIODS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per scale ``L``: words and lags with the ``L`` words there equal to those a lag before, by word.

    ``names`` has a number for each word of several texts, equal only for equal words of one text; ``ends`` is
    the end of each word's text.
    """
    gram = names.astype(np.int64)
    at = np.arange(len(gram))
    size = 1
    while len(at):
        order = np.argsort(gram[at], kind="stable")
        where, keys = at[order], gram[at][order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        place, lag = [], []
        for back in (1, 2, 3):
            if back >= len(keys):
                break
            apart = where[back:] - where[:-back]
            hit = (keys[back:] == keys[:-back]) & (apart >= size) & (apart < 2 * size)
            place.append(where[back:][hit])
            lag.append(apart[hit])
        if place and sum(map(len, place)):
            place, lag = np.concatenate(place), np.concatenate(lag)
            by_place = np.argsort(place, kind="stable")
            yield size, place[by_place], lag[by_place]
        # what occurs twice goes on, numbered anew
        number = np.cumsum(new) - 1
        again = np.bincount(number, minlength=1)[number] > 1
        known = np.full(len(gram), -1, dtype=np.int64)
        known[where[again]] = number[again]
        left = np.sort(where[again])
        inside = left + 2 * size <= ends[left]
        left = left[inside]
        left = left[known[left + size] >= 0]
        gram = np.full(len(gram), -1, dtype=np.int64)
        gram[left] = known[left] * (int(number[-1]) + 1) + known[left + size]
        at, size = left, 2 * size


def _equal(one: np.ndarray, other: np.ndarray) -> int:
    """How many of the first entries of two arrays are equal, looked at in growing portions."""
    n, at, step = min(len(one), len(other)), 0, 16
    while at < n:
        upto = min(n, at + step)
        differ = np.flatnonzero(one[at:upto] != other[at:upto])
        if len(differ):
            return at + int(differ[0])
        at, step = upto, 2 * step
    return n


def find_runs(
    names: np.ndarray, ends: np.ndarray, words: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of ``words`` words and ``periods`` (two or more) periods, by start and period."""
    least: dict[tuple[int, int], int] = {}

    def close(lag: int, begin: int, end: int) -> None:
        """The diagonal's match of the words from ``begin`` to ``end``; words before and after may be missing."""
        if end - begin <= (periods - 3) * lag:
            return
        begin -= _equal(names[begin - 1 :: -1], names[begin - lag - 1 :: -1]) if begin > lag else 0
        end += _equal(names[end:], names[end - lag :])
        length = end - begin + lag
        if length >= words and length >= periods * lag:
            run = (begin - lag, length)
            # a multiple of the period matches the same words
            least[run] = min(lag, least.get(run, lag))

    for size, places, lags in lag_events(names, ends):
        active: OrderedDict[int, tuple[int, int]] = OrderedDict()
        for place, lag in zip(places.tolist(), lags.tolist()):
            while active:
                oldest, (begin, end) = next(iter(active.items()))
                if end + size >= place:
                    break
                del active[oldest]
                close(oldest, begin, end)
            begin, end = active.pop(lag, (place, place))
            if end < place and not np.array_equal(names[end:place], names[end - lag : place - lag]):
                close(lag, begin, end)
                begin = place
            active[lag] = (begin, place + size)
        for lag, (begin, end) in active.items():
            close(lag, begin, end)
    return sorted((start, length, period) for (start, length), period in least.items())


def repeated(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words lie in a run after its first period."""
    steps = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _portions(texts: list[bytes | None], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes; a longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or b"")
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def _searched(texts: list[bytes | None], words: int, periods: int) -> Iterator[tuple[int, list, bytes]]:
    """Number of words, runs, and the text without repeated words, of every text."""
    split = [(t or b"").split() for t in texts]
    counts = np.array([len(s) for s in split], dtype=np.int64)
    firsts = np.cumsum(counts) - counts
    everything = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode()
    # texts too short for a run are left out of the search
    able = np.repeat(counts >= words, counts)
    ends = np.repeat(firsts + counts, counts)
    text_of = np.repeat(np.arange(len(split)), counts)
    ids = everything.indices.to_numpy().astype(np.int64) + text_of * max(1, len(everything.dictionary))
    ids[~able] = -1 - np.flatnonzero(~able)
    found: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for start, length, period in find_runs(ids, ends, words, periods):
        owner = int(text_of[start])
        found[owner].append((start - int(firsts[owner]), length, period))
    for own, runs in zip(split, found):
        if runs:
            drop = repeated(len(own), runs).tolist()
            yield len(own), runs, b" ".join(w for w, gone in zip(own, drop) if not gone)
        else:
            yield len(own), runs, b" ".join(own)


def periodic_runs(
    docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text", words: int = LEAST_WORDS,
    periods: int = LEAST_PERIODS,
) -> DataFrame:
    """``keys`` with ``n_words``, ``runs`` and ``collapsed`` of each row's text.

    Words are what stands between white space (space, U+0009 to U+000D), numbered from 0.  ``runs`` lists
    ``start``, ``length`` and smallest ``period`` of every stretch of at least ``words`` words and ``periods``
    periods (three or more) that no neighbouring word extends, by start, then period.  ``collapsed`` has the words
    that are in no run after its first period, joined by one space.  A null, empty or wordless text
    has no words, no runs, and an empty ``collapsed``.  Every row is searched where it is: rows that repeat an id or
    a text don't meet, null keys are kept, and columns that are not named are ignored.
    """
    if periods < 3:
        raise ValueError("fewer than three periods are no run")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keys]).alias("row"), F.col(f"`{text}`").cast("string").alias("text")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else t.encode() for t in batch.column("text").to_pylist()]
            for start, end in _portions(texts):
                n, runs, collapsed = [], [], []
                for count, own, left in _searched(texts[start:end], words, periods):
                    n.append(count)
                    runs.append([{"start": s, "length": m, "period": p} for s, m, p in own])
                    collapsed.append(left.decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, end - start), pa.array(n, pa.int64()),
                     pa.array(runs, pa.list_(_RUN)), pa.array(collapsed, pa.string())],
                    ["row", "n_words", "runs", "collapsed"],
                )

    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(f"n_words long, runs {RUNS}, collapsed string").fields])
    return rows.mapInArrow(search, schema).select("row.*", "n_words", "runs", "collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; one text in ten gets a repetition from its own words.

    With h the CRC-32 of the decimal id, g = h // 10 and n words: if h % 10 = 0, word i >= a = g % n is
    word a + (i - a) % p with p = 1 + (n - a) // (3 + g % 8).  A null id or text leaves the row as it is.
    """

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for k, h in enumerate(batch.column("h").to_pylist()):
                if h is None or h % 10 or texts[k] is None:
                    continue
                own = texts[k].encode().split()
                if own:
                    g, n = h // 10, len(own)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    own[a:] = (own[a : a + p] * (3 + g % 8 + 1))[: n - a]
                    texts[k] = b" ".join(own).decode()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), number.alias("h"))
    return rows.mapInArrow(plant, "doc_id long, text string")


@query("op11_periodic")
def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS back, -r.period AS less)))")
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    counted = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"), listed.alias("listed"), "collapsed"
    )
    return counted.select(
        "doc_id", "n_runs", (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.expr("(1000 * best.length) div (-best.less) AS exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
