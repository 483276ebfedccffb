"""Text quality by attention-based multiple-instance learning.

A document is a bag of passages (blocks of ``PASSAGE`` UTF-8 bytes). Each passage is described by its shares of kinds of
characters and by its words, encoded by a layer, and weighted by gated attention (Ilse et al. 2018):
a_i = softmax(w . (tanh(V h_i) * sigmoid(U h_i))). The document's score is a logistic function of the weighted
passage representation; all weights are learnt from document labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import letter_words, lowered, slices, span_hashes, word_spans
from .labelled import FIT_ROWS, first_rows, for_learning, in_front
from .langid import held_out

PASSAGE = 512
HIDDEN, GATE, ROUNDS, RATE, DECAY = 16, 8, 300, 0.02, 1e-4
#: Kinds of bytes: each character that junk is made of, and classes of others.
KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\r", b"\n", b".", b",",
         b"!", b"?", b"#", b"$", b"%", b"&", b"*", b"|", b"<>", b"@", b"/\\", b"_-", b"=+~^", b"()[]{}", b":;", b"'\"`"]


def kind_table() -> np.ndarray:
    table = np.full(256, len(KINDS), np.uint8)  # other ASCII
    table[128:] = len(KINDS) + 1
    for k, members in enumerate(KINDS):
        table[list(members)] = k
    return table


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, passages x features, first passage of each row and the end); a row has one passage
    at least, an empty one if need be."""
    kinds = kind_table()
    n_kinds = len(KINDS) + 2
    for i, j, data, off in slices(texts, 1_000_000):
        size = np.diff(off)
        count = np.maximum(1, -(-size // PASSAGE))
        first = np.append(0, np.cumsum(count))
        row = np.repeat(np.arange(j - i), count)
        begin = off[row] + (np.arange(len(row)) - first[row]) * PASSAGE
        end = np.minimum(begin + PASSAGE, off[row + 1])
        length = end - begin
        own = np.repeat(np.arange(len(row)), length)  # the passage of each byte
        shares = np.bincount(own * n_kinds + kinds[data], minlength=len(row) * n_kinds).reshape(-1, n_kinds)
        low = lowered(data)
        starts, ends, _ = word_spans(letter_words(low), off)
        at = own[starts] if len(starts) else starts
        words = np.bincount(at, minlength=len(row))
        hashes = span_hashes(low, starts, ends)
        order = np.lexsort((hashes, at))
        again = np.zeros(len(at))
        again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (at[order][1:] == at[order][:-1])
        repeats = np.bincount(at[order], again, len(row)) if len(at) else np.zeros(len(row))
        letters = np.bincount(at, ends - starts, len(row)) if len(at) else np.zeros(len(row))
        total = np.maximum(length, 1)[:, None]
        some = np.maximum(words, 1)
        yield i, j, np.column_stack([
            np.sqrt(shares / total), words / total[:, 0] * 8, letters / some / 8, repeats / some,
            np.log1p(length) / 6, (length == 0).astype(float)]).astype(np.float32), first


def forward(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Encodings h, gate parts t and g, attention a and bag representations z, and the scores s."""
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = (t * g) @ p["w"]
    n = np.diff(first)
    top = np.maximum.reduceat(e, first[:-1])
    a = np.exp(e - np.repeat(top, n))
    a /= np.repeat(np.add.reduceat(a, first[:-1]), n)
    z = np.add.reduceat(h * a[:, None], first[:-1], axis=0)
    s = 1 / (1 + np.exp(-np.clip(z @ p["u"] + p["c"], -30, 30)))
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "s": s}


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The weights, by Adam on the whole sample from a fixed start; the features' means and scales are among them."""
    draw = np.random.default_rng(7)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / scale
    shapes = {"W": (x.shape[1], HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "u": (HIDDEN,), "c": (1,)}
    p = {k: draw.normal(0, 0.3, s) if k not in "bc" else np.zeros(s) for k, s in shapes.items()}
    m, v = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
    n = np.diff(first)
    for step in range(1, rounds + 1):
        f = forward(p, x, first)
        ds = (f["s"] - y) / len(y)
        dz = ds[:, None] * p["u"]
        dz_of = np.repeat(dz, n, axis=0)
        da = (dz_of * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first[:-1]), n))
        dt, dg = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (dz_of * f["a"][:, None] + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        grad = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de,
                "u": f["z"].T @ ds, "c": ds.sum(keepdims=True)}
        for k in p:
            g = grad[k] + DECAY * p[k]
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-9)
    return {**p, "mean": mean, "scale": scale}


def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (id, y, text) -> (id, y, bag): the passages' features as float32 bytes."""
    for batch in batches:
        for i, j, x, first in features(batch.column(2)):
            bags = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in (0, 1)), pa.array(bags, pa.binary())], ["id", "y", "bag"])


def train(rows: DataFrame, fit_rows: int = FIT_ROWS) -> dict[str, np.ndarray] | None:
    """The model of the labelled ``rows`` (id, text, y), from the ``fit_rows`` whose hashed id comes first; None
    without rows."""
    sample = first_rows(rows, fit_rows).select("id", "y", "text")
    got = sample.mapInArrow(passages, "id long, y int, bag binary").toPandas().sort_values(["id", "bag"], kind="stable")
    if not len(got):
        return None
    width = len(KINDS) + 2 + 5
    bags = [np.frombuffer(b, np.float32).reshape(-1, width) for b in got["bag"]]
    first = np.append(0, np.cumsum([len(b) for b in bags]))
    return fit(np.concatenate(bags).astype(np.float64), first, got["y"].to_numpy(np.float64))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, n_passages, attention (the
    weight of each passage).

    Labels are learnt from ids whose crc32 modulo 5 isn't 0. Null and empty texts are one empty passage; without
    labels every score is 0.5. Null and repeated ids are passed through, other columns ignored.
    """
    total = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), 5, 0)).count()
    some = docs.where(in_front(F.col("doc_id").cast("long"), fit_rows, total))  # before their texts are dealt to the labels
    model = train(for_learning(some, labels, "quality", 5, 0), fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            for i, j, x, first in features(batch.column(1)):
                if p is None:
                    s, a = np.full(j - i, 0.5), np.repeat(1 / np.diff(first), np.diff(first))
                else:
                    f = forward(p, (x - p["mean"]) / p["scale"], first)
                    s, a = f["s"], f["a"]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(s), pa.array(np.diff(first).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(a.astype(np.float32)))],
                    ["doc_id", "score", "n_passages", "attention"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(score, "doc_id long, score double, n_passages long, attention array<float>")
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"), "n_passages", "attention")
