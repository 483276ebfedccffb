"""Toxicity of texts after noisy-channel deobfuscation.

A character language model (trigrams within words) is counted over all documents. A token that looks disguised is
a lattice: each of its characters may be itself, a letter that it stands for (leetspeak), a mark that says nothing,
or one more copy of the letter before it; runs of single characters are joined to one token first. Viterbi
decodes the lattice under the character model and the channel's costs, and the token counts as its most likely
restorations. Restored words are scored by a logistic model over the words that tell toxic documents from others.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, written
from .labelled import FIT_ROWS, first_rows, for_learning, in_front
from .langid import held_out, parts_of

# Characters and the letters that they are used for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "*": "aeiou",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s",
}
EDGE = " .,;:?!\"'()[]{}<>#%&*~`^=/\\-_…«»“”‘’¿¡|+"  # stripped from a token's ends
TRI, BI = 1 << 18, 1 << 16  # buckets of the character model
BEST = 8  # restorations of a disguised token
LONGEST = 40  # characters of a token that is decoded; longer ones are cut
MODEL_WORDS = 2000  # signs of the logistic model: those with the greatest evidence (G2)
EVIDENCE = 15.0
SPACED = re.compile(r"(?<!\S)[^\W_](?:[ .\-_*]{1,2}[^\W_]){2,}(?![^\s.,;:!?])|(?<!\S)[@$!|](?:[ .\-_*]{1,2}[^\W_])+(?!\S)")
TRIPLE = re.compile(r"(.)\1\1")
LETTERS = re.compile(r"[^\W\d_]+")
STEM = (5, 8)  # letters of a stem, from and to
SHARES = (0.004, 0.008, 0.012, 0.02)  # levels of a stem's share of a text's words (twice at least)


def char_model(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed letter trigrams and of their first two letters, over every word of every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tri, bi = np.zeros(TRI, np.int64), np.zeros(BI, np.int64)
        for batch in small(batches):
            texts = batch.column(0).to_pylist()
            for i, j in parts_of(texts):
                a, b, c = trigrams("\n".join((t or "").lower() for t in texts[i:j]))
                tri += np.bincount(tri_bucket(a, b, c), minlength=TRI)
                bi += np.bincount(bi_bucket(a, b), minlength=BI)
        at, at_bi = np.flatnonzero(tri), np.flatnonzero(bi)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, at_bi + TRI)), pa.array(np.append(tri[at], bi[at_bi]))], ["bucket", "n"])

    counts = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())  # TRI + BI rows at most
    out = np.zeros(TRI + BI)
    out[counts["bucket"].to_numpy(np.int64)] = counts["n"].to_numpy(np.float64)
    return out[:TRI], out[TRI:]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each letter, and the mark (32) after each word, with the two before it (32 before a word's first)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    for c in np.flatnonzero(seen).tolist():
        seen[c] = chr(c).isalpha()
    value = np.where(seen[points], points, 32).astype(np.int64)
    value = np.concatenate([[32, 32], value, [32]])
    last = np.where(value[1:-1] == 32, 32, value[:-2])  # nothing before a word but marks
    keep = (value[1:-1] != 32) | (value[2:] != 32)
    return last[keep], value[1:-1][keep], value[2:][keep]


def tri_bucket(a, b, c):
    return (((a * 1_000_003 + b) * 1_000_003 + c) * 0x9E3779B1 >> 12) % TRI


def bi_bucket(a, b):
    return ((a * 1_000_003 + b) * 0x9E3779B1 >> 12) % BI


class Decoder:
    """Restores disguised tokens; keeps what it has seen."""

    def __init__(self, tri: np.ndarray, bi: np.ndarray) -> None:
        self.tri, self.bi, self.costs, self.seen = tri, bi, {}, {}

    def cost(self, a: str, b: str, c: str) -> float:
        """-log P(c | a b), smoothed."""
        key = a + b + c
        if (found := self.costs.get(key)) is None:
            x, y, z = ord(a), ord(b), ord(c)
            found = self.costs[key] = -math.log((self.tri[tri_bucket(x, y, z)] + 0.05) / (self.bi[bi_bucket(x, y)] + 2.0))
        return found

    def decode(self, token: str) -> list[str]:
        """The most likely words behind a token, by Viterbi over (last two letters), BEST ways to each state."""
        ways: dict[str, list[tuple[float, str]]] = {"  ": [(0.0, "")]}
        for k, c in enumerate(token):
            options: list[tuple[str, float]] = []
            if c.isalpha():
                options.append((c, 0.0))
            for letter in LEET.get(c, ""):
                options.append((letter, 1.0 if c.isalpha() or c == "*" else 0.3))
            if not c.isalpha():
                options.append(("", 1.5 if c in LEET else 0.5))
            new: dict[str, list[tuple[float, str]]] = {}
            for state, own in ways.items():
                for letter, channel in options:
                    if letter:
                        step, after = channel + self.cost(state[0], state[1], letter), state[1] + letter
                    else:
                        step, after = channel, state
                    new.setdefault(after, []).extend((cost + step, word + letter) for cost, word in own)
                if k and c.isalpha() and state[1] == c and token[k - 1] == c:  # one more copy
                    new.setdefault(state, []).extend((cost + 0.5, word) for cost, word in own)
            ways = {s: sorted(set(own))[:BEST] for s, own in new.items()}
        ends = [(cost + self.cost(s[0], s[1], " "), word) for s, own in ways.items() for cost, word in own]
        return list(dict.fromkeys(word for _, word in sorted(ends)))[:BEST]

    def words(self, token: str) -> tuple[str, ...]:
        """What a token (lower case, no white space) says: its own words, and restorations if it looks disguised."""
        if (found := self.seen.get(token)) is None:
            core = token.strip(EDGE)
            found = tuple(LETTERS.findall(core))
            if disguised(core):
                whole = token.rstrip(EDGE).lstrip(EDGE.replace("|", "").replace("+", "").replace("!", "").replace("(", ""))
                for part in {core, whole}:
                    for k in range(0, len(part), LONGEST):
                        found += tuple(self.decode(part[k:k + LONGEST]))
            found = tuple(dict.fromkeys(w for w in found if len(w) > 1))
            if len(self.seen) >= 500_000:
                self.seen.clear()
            self.seen[token] = found
        return found

    def text_words(self, text: str | None) -> dict[str, int]:
        """The words of a text with their counts, disguised ones restored."""
        low = (text or "").lower()
        out: dict[str, int] = {}
        for token, n in Counter(low.split()).items():
            for word in self.seen.get(token) or self.words(token):
                out[word] = out.get(word, 0) + n
        for run in SPACED.finditer(low):
            joined = re.sub(r"[ .\-_*]", "", run.group())
            found: set[str] = set()
            for part in {joined, joined[1:], joined[:-1]}:  # a word of one letter may stand beside
                found.update(self.words(part))
                for k in range(0, len(part), LONGEST // 2):
                    for word in self.decode(part[k:k + LONGEST]) if disguised(part) else [part[k:k + LONGEST]]:
                        found.update(word[a:b] for a in range(len(word)) for b in range(a + 3, min(len(word), a + 16) + 1))
            for word in found:
                out[word] = out.get(word, 0) + 1
        return out


def signs(words: dict[str, int], heads: set[str] | None = None) -> set[str]:
    """What a text is judged by: its words, and stems (as ``stem*level``) that make up at least a level's share
    of its words. ``heads``: only stems that begin with one of these."""
    total = sum(words.values())
    stems: Counter[str] = Counter()
    for word, n in words.items():
        if len(word) >= STEM[0] and (heads is None or word[:STEM[0]] in heads):
            for k in range(STEM[0], min(len(word), STEM[1]) + 1):
                stems[word[:k]] += n
    out = set(words)
    for stem, n in stems.items():
        if n > 1:
            out.update(f"{stem}*{k}" for k, share in enumerate(SHARES) if n >= share * total)
    return out


def disguised(core: str) -> bool:
    """A letter and a character used for one, letters apart by marks, or a letter three times in a row."""
    if core.isalpha():
        return bool(TRIPLE.search(core)) or any(c in LEET for c in core)
    letters = sum(c.isalpha() for c in core)
    return letters >= 2 and 2 * sum(c.isdigit() for c in core) <= 3 * letters


def word_counts(rows: DataFrame, tri: np.ndarray, bi: np.ndarray) -> DataFrame:
    """(word, toxic, clean): documents of ``rows`` (id, text, y) that have the sign, by label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, counts = Decoder(*model.value), (Counter(), Counter())

        def rows_out() -> pa.RecordBatch:
            words = list(counts[0] | counts[1])
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([counts[y][w] for w in words], pa.int64()) for y in (1, 0))],
                                              ["word", "toxic", "clean"])

        for batch in small(batches):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[y].update(signs(decoder.text_words(text)))
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield rows_out()
                    counts = (Counter(), Counter())
        yield rows_out()

    model = rows.sparkSession.sparkContext.broadcast((tri, bi))
    return (rows.select("text", "y").mapInArrow(count, "word string, toxic long, clean long")
            .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def telling_words(counts: DataFrame, toxic: int, clean: int) -> list[str]:
    """The MODEL_WORDS signs, commoner in toxic documents, whose presence tells most (G2 of at least EVIDENCE)."""
    def part(n, whole, of):
        expected = (F.col("toxic") + F.col("clean")) * F.lit(of / whole)
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    whole = toxic + clean
    if not toxic or not clean:
        return []
    rest = lambda n, of: F.lit(float(of)) - F.col(n)
    missing = F.lit(float(whole)) - F.col("toxic") - F.col("clean")

    def absent(n, of):
        left = rest(n, of)
        return F.when(left > 0, left * F.log(left / (missing * F.lit(of / whole)))).otherwise(0.0)

    g2 = 2 * (part(F.col("toxic"), whole, toxic) + part(F.col("clean"), whole, clean) + absent("toxic", toxic) + absent("clean", clean))
    more = F.col("toxic") * F.lit(clean) > F.col("clean") * F.lit(toxic)
    best = counts.where(more).withColumn("g2", g2).where(F.col("g2") >= EVIDENCE).orderBy(F.desc("g2"), "word").limit(MODEL_WORDS)
    return [r["word"] for r in best.select("word").collect()]


def fit_logistic(hits: list[list[int]], y: np.ndarray, n: int, ridge: float = 0.05, rounds: int = 600) -> tuple[float, np.ndarray]:
    """(intercept, weights) of an L2-penalised logistic model over the presence of n features."""
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    col = np.array([k for h in hits for k in h], np.int64)
    w, bias, m, v = np.zeros(n), 0.0, np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, rounds + 1):
        z = bias + np.bincount(row, w[col], len(y)) if len(col) else np.full(len(y), bias)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.append((np.bincount(col, error[row], n) if len(col) else np.zeros(n)) + ridge * w, error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        w, bias = w - step[:n], bias - step[n]
    return float(bias), w


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Labels are learnt from ids whose crc32 modulo 3 isn't 1; the character model and the word counts cover all
    rows, the logistic model is fitted on ``fit_rows`` labelled rows. Null and empty texts get the model's base
    rate; without labels every score is 0.5. Null and repeated ids are passed through, other columns ignored.
    """
    spark = docs.sparkSession
    model = char_model(docs)
    rows = written(for_learning(docs, labels, "toxic", 3, 1), "toxic_rows")
    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    words = telling_words(word_counts(rows, *model), size.get(1, 0), size.get(0, 0))
    place = {w: k for k, w in enumerate(words)}
    heads = {w[:STEM[0]] for w in words if "*" in w}
    shared = spark.sparkContext.broadcast((model, place, heads))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (tri, bi), own, heads = shared.value
        decoder = Decoder(tri, bi)
        for batch in small(batches):
            found = [sorted(own[w] for w in signs(decoder.text_words(t), heads) if w in own) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["y", "hits"])

    sample = first_rows(rows.where(in_front(F.col("id"), fit_rows, sum(size.values()))), fit_rows)
    fitted = sample.select("text", "y").mapInArrow(hits, "y int, hits array<int>").toPandas()
    fitted = fitted.assign(hits=[tuple(h) for h in fitted["hits"]]).sort_values(["y", "hits"], kind="stable")
    weights = fit_logistic([list(h) for h in fitted["hits"]], fitted["y"].to_numpy(np.float64), len(words))
    scorer = spark.sparkContext.broadcast((model, place, heads, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (tri, bi), own, heads, (bias, w) = scorer.value
        decoder = Decoder(tri, bi)
        for batch in small(batches):
            z = [bias + float(sum(w[own[x]] for x in sorted(signs(decoder.text_words(t), heads)) if x in own)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(np.array(z, np.float64), -30, 30))))], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(score, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))
