"""Benchmark decontamination by winnowing.

A text's fingerprints are the least k-gram hash (rightmost of equals) of every ``window`` consecutive
k-grams, so every shared span of ``k + window - 1`` words has a fingerprint in common at the same place of the
span. Fingerprints of documents and of benchmark items are equi-joined; the hits of a document are then
extended: the item's span lengths are slid over the document's words and compared word by word.

Items shorter than a span are one span themselves; for each such length (at most ``span - 1`` of them) the
documents' grams of that length are fingerprints as well (k = length, window = 1).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, letter_words, lowered, slices, small, span_hashes, word_spans, written

SPAN = 13
K = 7


def winnowed(words: np.ndarray, k: int, window: int) -> np.ndarray:
    """Positions of the fingerprints among the k-gram hashes ``words``."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = words[window - 1:].copy(), np.arange(window - 1, window - 1 + n)
    for j in range(window - 2, -1, -1):
        now = words[j:j + n]
        less = now < best
        best[less] = now[less]
        at[less] = np.arange(j, j + n)[less]
    return np.unique(at)


def fingerprints(span: int, k: int, short: tuple[int, ...], whole_short: bool):
    """Task function: (id, text) -> (id, n_words, prints). ``short``: lengths below ``span`` to give grams
    of; ``whole_short``: a text of fewer words than ``span`` gives only its one whole gram (items)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, off in slices(batch.column(1)):
                data = lowered(data)
                starts, ends, first = word_spans(letter_words(data), off)
                words = span_hashes(data, starts, ends)
                grams = gram_hashes(words, k)
                counts, prints = np.diff(first), []
                for d in range(j - i):
                    a, n = first[d], counts[d]
                    found = []
                    if n >= span:
                        own = grams[a:a + n - k + 1]
                        found.append(own[winnowed(own, k, span - k + 1)])
                    if not whole_short:
                        found += [gram_hashes(words[a:a + n], size) for size in short if size <= n]
                    elif 0 < n < span:
                        found.append(gram_hashes(words[a:a + n], int(n)))
                    prints.append(np.unique(np.concatenate(found)).view(np.int64) if found else np.zeros(0, np.int64))
                sizes = np.zeros(j - i + 1, np.int32)
                np.cumsum([len(p) for p in prints], out=sizes[1:])
                yield pa.RecordBatch.from_arrays([
                    ids.slice(i, j - i), pa.array(counts.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(prints)))],
                    ["id", "n_words", "prints"])

    return run


def words_of(text: str | None) -> list[bytes]:
    """The words of one text, as bytes."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    data = lowered(data)
    starts, ends, _ = word_spans(letter_words(data), np.array([0, len(data)]))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def hit_words(words: list[bytes], items: dict[str, list[bytes]], span: int) -> tuple[np.ndarray, list[str]]:
    """Which words lie in an occurrence of a span of an item, and the items that occur."""
    hit, seen = np.zeros(len(words) + 1, np.int64), []
    wanted: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item, own in items.items():
        size = min(span, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            wanted.setdefault(size, {}).setdefault(tuple(own[i:i + size]), []).append(item)
    for size, grams in wanted.items():
        heads = {g[0] for g in grams}
        for i in range(len(words) - size + 1):
            if words[i] in heads and (found := grams.get(tuple(words[i:i + size]))):
                hit[i] += 1
                hit[i + size] -= 1
                seen += found
    return np.cumsum(hit)[:-1] > 0, sorted(set(seen))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, fraction: int = 20,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contamination of every document by the items of ``benchmark`` (item_id, text).

    One row per row of ``docs``: id, n_words, n_hit (words in any occurrence of an item's span), n_items,
    items (sorted as strings), contaminated (some word hit, and at least one in ``fraction``).
    Null and empty texts have no words; a null id is an id like any other; rows that repeat an id are judged
    each by its own text; items without words never occur; other columns of either table are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("item_text"))
    items = items.where("item is not null")
    item_prints = written(items.mapInArrow(fingerprints(span, k, (), True), "id string, n_words long, prints array<long>"),
                          "item_prints")
    # At most span - 1 values.
    short = tuple(sorted(r[0] for r in item_prints.where((F.col("n_words") > 0) & (F.col("n_words") < span))
                         .select(F.col("n_words").cast("int")).distinct().collect()))
    prints = written(docs.mapInArrow(fingerprints(span, k, short, False), "id long, n_words long, prints array<long>"),
                     "doc_prints")
    hits = (prints.select("id", F.explode("prints").alias("print"))
            .join(item_prints.select(F.col("id").alias("item"), F.explode("prints").alias("print")).distinct(), "print")
            .select("id", "item").distinct())
    near = written(hits.join(items, "item").groupBy("id").agg(F.collect_list(F.struct("item", "item_text")).alias("near")),
                   "near_items")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out = []
            for id_, text, own in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                words, grouped = words_of(text), {}
                for x in own:
                    grouped.setdefault(x["item"], []).append(words_of(x["item_text"]))
                flat = {(item, n): w for item, all_ in grouped.items() for n, w in enumerate(all_)}
                hit, seen = hit_words(words, flat, span)
                found = sorted({s[0] for s in seen})
                out.append((id_, len(words), int(hit.sum()), found))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())))], ["id", "n_words", "n_hit", "items"])

    same = F.col("id").eqNullSafe(F.col("key"))
    keyed = near.withColumnRenamed("id", "key")
    judged = (docs.join(keyed, same).select("id", "text", "near")
              .mapInArrow(extend, "id long, n_words long, n_hit long, items array<string>"))
    clean = prints.join(keyed.select("key"), same, "left_anti").select(
        "id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    return judged.union(clean).select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (F.col("n_hit") * fraction >= F.col("n_words"))).alias("contaminated"))


def brute_force(docs: list[tuple], items: list[tuple], span: int = SPAN, fraction: int = 20) -> list[tuple]:
    """The contract said plainly, over small lists of (id, text); for tests."""
    import re
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    out = []
    for id_, text in docs:
        words, hit, seen = split(text), set(), set()
        for item, body in items:
            own = split(body)
            size = min(span, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                for j in range(len(words) - size + 1):
                    if words[j:j + size] == own[i:i + size]:
                        hit.update(range(j, j + size))
                        seen.add(str(item))
        ids = sorted(seen)
        out.append((id_, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and fraction * len(hit) >= len(words)))
    return out
