"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in segments of ``SEGMENT`` bytes, once forwards and once
backwards, and gives every byte position a probability for each language.  A
document's probabilities are the mean over its letter positions.  Training is
back-propagation through time in numpy on a bounded sample of labelled rows; scoring is
a pass over all bytes of all texts, a few thousand segments side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewell.llm.common import materialize, query, table
from tidewell.llm.shingles import offsets as value_offsets

SEGMENT = 128
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


@dataclass
class Network:
    """Weights of both directions (suffix f and b) and of the output layer.

    ``x``: a byte's part of update gate, reset gate and candidate (3H x 256); ``u``: the
    state's part (3H x H); ``v``, ``c``: from both states (C x 2H) to the languages.
    """

    languages: list[str]
    weights: dict[str, np.ndarray]

    @property
    def hidden(self) -> int:
        return self.weights["uf"].shape[1]


def start_network(languages: list[str], hidden: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)

    def draw(rows: int, columns: int, scale: float) -> np.ndarray:
        return rng.normal(0.0, scale, (rows, columns)).astype(np.float32)

    w = {}
    for d in "fb":
        w[f"x{d}"] = draw(3 * hidden, 256, 0.3)
        w[f"u{d}"] = draw(3 * hidden, hidden, hidden**-0.5)
    w["v"] = draw(len(languages), 2 * hidden, hidden**-0.5)
    w["c"] = np.zeros((len(languages), 1), np.float32)
    return Network(languages, w)


def _gate(x: np.ndarray) -> np.ndarray:
    """The piecewise linear sigmoid, in place."""
    x *= np.float32(0.2)
    x += np.float32(0.5)
    return np.clip(x, 0, 1, out=x)


def states(x: np.ndarray, u: np.ndarray, steps: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (T x H x B) for the bytes ``steps`` (T x B); ``keep`` gets what training needs."""
    hidden, (length, width) = u.shape[1], steps.shape
    h = np.zeros((hidden, width), np.float32)
    out = np.empty((length, hidden, width), np.float32)
    for t in range(length):
        a = x[:, steps[t]]
        s = u @ h
        gates = _gate(a[: 2 * hidden] + s[: 2 * hidden])
        z, r = gates[:hidden], gates[hidden:]
        n = np.tanh(a[2 * hidden :] + r * s[2 * hidden :])
        new = h - n
        new *= z
        new += n
        if keep is not None:
            keep.append((h, z, r, n, s[2 * hidden :]))
        h = out[t] = new
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Over the second of three axes, in place."""
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def probabilities(net: Network, steps: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Language probabilities (T x C x B) of every position of the segments ``steps`` (T x B)."""
    w = net.weights
    kept: dict[str, list | None] = {"f": None, "b": None} if keep is None else {"f": [], "b": []}
    forward = states(w["xf"], w["uf"], steps, kept["f"])
    backward = states(w["xb"], w["ub"], steps[::-1], kept["b"])[::-1]
    hidden = net.hidden
    p = w["v"][:, :hidden] @ forward + w["v"][:, hidden:] @ backward + w["c"]
    if keep is not None:
        keep.update(kept, forward=forward, backward=backward)
    return _softmax(p)


def _through_time(u: np.ndarray, steps: np.ndarray, kept: list, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``x`` and ``u`` from the gradients ``out`` of all states."""
    hidden = u.shape[1]
    du, dh = np.zeros_like(u), np.zeros_like(out[0])
    parts = np.empty((len(steps), 3 * hidden, steps.shape[1]), np.float32)
    for t in range(len(steps) - 1, -1, -1):
        h, z, r, n, s = kept[t]
        dh = dh + out[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * np.float32(0.2) * ((z > 0) & (z < 1))
        dr = dn * s * np.float32(0.2) * ((r > 0) & (r < 1))
        parts[t] = np.concatenate([dz, dr, dn])
        inner = np.concatenate([dz, dr, dn * r])
        du += inner @ h.T
        dh = dh * z + u.T @ inner
    flat = steps.ravel()
    order = np.argsort(flat, kind="stable")
    used, at = np.unique(flat[order], return_index=True)
    dx = np.zeros((3 * hidden, 256), np.float32)
    dx[:, used] = np.add.reduceat(parts.transpose(1, 0, 2).reshape(3 * hidden, -1)[:, order], at, axis=1)
    return dx, du


def gradients(net: Network, steps: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy over letter positions; ``target``: a language per segment."""
    keep: dict = {}
    p = probabilities(net, steps, keep)
    weight = _LETTER[steps].astype(np.float32)
    weight /= max(1.0, float(weight.sum()))
    p[:, target, np.arange(len(target))] -= 1
    p *= weight[:, None, :]
    w, hidden = net.weights, net.hidden
    found = {
        "c": p.sum(axis=(0, 2))[:, None],
        "v": np.concatenate(
            [np.einsum("tcb,thb->ch", p, keep[k], optimize=True) for k in ("forward", "backward")], axis=1
        ),
    }
    found["xf"], found["uf"] = _through_time(w["uf"], steps, keep["f"], w["v"][:, :hidden].T @ p)
    found["xb"], found["ub"] = _through_time(w["ub"], steps[::-1], keep["b"], (w["v"][:, hidden:].T @ p)[::-1])
    return found


def fit(
    segments: np.ndarray, target: np.ndarray, languages: list[str], hidden: int = 8, epochs: int = 4,
    batch: int = 128, rate: float = 0.02, seed: int = 5,
) -> Network:
    """Train on segments (N x T bytes) with Adam; the rate falls to zero along a cosine."""
    net = start_network(languages, hidden, seed)
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    total, step = epochs * -(-len(segments) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(segments))
        for lo in range(0, len(order), batch):
            own = order[lo : lo + batch]
            found = gradients(net, np.ascontiguousarray(segments[own].T), target[own])
            step += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * step / total))
            norm = np.sqrt(sum(float((g * g).sum()) for g in found.values()))
            for k, g in found.items():
                g = g * np.float32(min(1.0, 1.0 / max(norm, 1e-12)))
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                net.weights[k] -= np.float32(now) * (mean[k] / (1 - 0.9**step)) / (
                    np.sqrt(square[k] / (1 - 0.99**step)) + np.float32(1e-8)
                )
    return net


def _segments(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts (bytes and offsets) as zero-padded segments (N x T), and the text of each."""
    sizes = np.diff(offsets)
    count = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(sizes)), count)
    first = np.cumsum(count) - count
    out = np.zeros(int(count.sum()) * SEGMENT, np.uint8)
    shift = first * SEGMENT - offsets[:-1]
    out[np.arange(len(raw)) + np.repeat(shift, sizes)] = raw
    return out.reshape(-1, SEGMENT), owner


def held_out(doc_id="doc_id"):
    """Rows that are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def train(
    docs: DataFrame, per_language: int = 400, segments_per_doc: int = 6, hidden: int = 8, epochs: int = 4, seed: int = 5
) -> Network | None:
    """Fit on at most ``per_language`` labelled rows of each language, ``segments_per_doc`` segments each.

    Reads ``text`` and ``lang`` only, of rows that are not held out and have letters.  The sample
    follows a hash of the row, so it is the same on every cluster.  None without such rows.
    """
    rows = docs.where(~held_out()).where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11).alias("draw"),
    )
    # written first, so that its size is known before the join and no text is shuffled for it
    counts = materialize(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    share = F.lit(2.0 * per_language + 20.0) / F.col("n")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(segments_per_doc - 1)),
        lambda k: F.pmod(F.xxhash64("draw", k), F.greatest(F.length("text") - SEGMENT + 1, F.lit(1))).cast("int") + 1,
    )
    cut = rows.select("lang", "draw", F.transform(starts, lambda s: F.substr("text", s, F.lit(SEGMENT))).alias("parts"))
    drawn = cut.join(counts, "lang").where(F.col("draw") < share * F.lit(2.0**53))
    sample = drawn.withColumn("rank", rank).where(F.col("rank") <= per_language).select("lang", "rank", "parts")
    got = sorted((r["lang"], r["rank"], r["parts"]) for r in sample.collect())
    if not got:
        return None
    languages = sorted({g[0] for g in got})
    segments, target = [], []
    for lang, _, parts in got:
        for part in dict.fromkeys(parts):
            raw = part.encode()[:SEGMENT]
            segments.append(np.frombuffer(raw.ljust(SEGMENT, b"\0"), np.uint8))
            target.append(languages.index(lang))
    return fit(np.stack(segments), np.array(target), languages, hidden, epochs, seed=seed)


def predict(docs: DataFrame, net: Network | None, side_by_side: int = 1024, part_bytes: int = 1 << 18) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the mean probability of that language.

    Null texts, texts without letters, and all texts without a network get ``und`` and 0.
    Only the text is read; columns with these two names are replaced.  A task holds a text once,
    and hands rows on in parts of about ``part_bytes`` of text, or one longer text.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    if net is None:
        return docs.select(*[f"`{c}`" for c in names], F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # a text that is a string goes along as what is read; any other goes along beside it
    same = isinstance(docs.select("text").schema[0].dataType, T.StringType)
    read = next(c for c in [*["text"] * ("text" in names), *names] if c.lower() == "text") if same else None
    rest = [F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(names) if c != read]
    rows = docs.select(
        F.struct(*(rest or [F.lit(0).alias("_")])).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("lettered"),
    )

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
            offsets = value_offsets(column)
            data = column.buffers()[2]
            raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            lo = 0
            while lo < len(column):
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + part_bytes, "right")) - 1)
                hi = min(hi, len(column))
                total, letters = np.zeros((hi - lo, len(net.languages))), np.zeros(hi - lo)
                segments, owner = _segments(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                own = lettered[lo:hi][owner]
                segments, owner = segments[own], owner[own]
                for at in range(0, len(segments), side_by_side):
                    steps = np.ascontiguousarray(segments[at : at + side_by_side].T)
                    weight = _LETTER[steps].astype(np.float32)
                    p = np.einsum("tcb,tb->bc", probabilities(net, steps), weight)
                    np.add.at(total, owner[at : at + side_by_side], p)
                    np.add.at(letters, owner[at : at + side_by_side], weight.sum(axis=0))
                total /= np.maximum(letters, 1)[:, None]
                found = [net.languages[b] if n else "und" for b, n in zip(total.argmax(axis=1), letters)]
                score = np.where(letters > 0, np.minimum(total.max(axis=1), 1.0), 0.0)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("text"), pa.array(found, pa.string()), pa.array(score, pa.float64())],
                    ["row", "text", "lang_pred", "score"],
                )
                lo = hi

    schema = rows.select("row", "text").withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    out = rows.mapInArrow(label, schema)
    back = [F.col("text") if c == read else F.col(f"row._{k}") for k, c in enumerate(names)]
    return out.select(*[c.alias(name) for c, name in zip(back, names)], "lang_pred", "score")


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
