"""Language identification as inference of a mixture of languages.

Training counts centred letter trigrams (hashed) of the documents with a known language. A document's words are
drawn from its languages in unknown proportions; expectation-maximisation estimates these from the words'
trigram likelihoods, and the set of languages is the one with the best penalised likelihood (BIC) among the
nested sets by estimated proportion. The language with the largest share is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small, word_spans

BUCKETS = 1 << 15
SMOOTHING = 0.5
PENALTY = 2.0
ROUNDS = 12
MAX_LANGUAGES = 1000  # an error beyond it: the model (BUCKETS numbers a language) goes to every executor
UNKNOWN = "und"


def held_out(id_: Column, parts: int, part: int) -> Column:
    """crc32 of the id as text, modulo ``parts``, is ``part``; false for a null id."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % parts == part, F.lit(False))


def letter_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of the trigram around each letter; first and end letter of each word; first word of each text)."""
    lows = [(t or "").lower() for t in texts]
    off = np.zeros(len(lows) + 1, np.int64)
    np.cumsum([len(t) for t in lows], out=off[1:])
    points = np.frombuffer("".join(lows).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    for c in np.flatnonzero(seen).tolist():
        seen[c] = chr(c).isalpha()
    letter = seen[points]
    starts, ends, first = word_spans(letter, off)
    value = np.where(letter, points, 32).astype(np.uint64)
    left, right = np.roll(value, 1), np.roll(value, -1)
    if len(points):
        left[starts], right[ends - 1] = 32, 32  # words don't see beyond their ends, nor into other texts
    gram = (left * np.uint64(0x9E3779B97F4A7C15) + value) * np.uint64(0xC2B2AE3D27D4EB4F) + right
    gram = (gram * np.uint64(0x165667B19E3779F9)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    before = np.cumsum(letter) - letter  # letters before each place
    return gram[letter].astype(np.int64), (before[starts] if len(starts) else starts), \
        (before[ends - 1] + 1 if len(ends) else ends), first


def parts_of(texts: list[str | None], most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Runs of texts with about ``most`` characters."""
    i = size = 0
    for j, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, bucket, n) of the partition."""
    counts: dict[str, np.ndarray] = {}
    for batch in small(batches):
        langs, texts = (batch.column(c).to_pylist() for c in range(2))
        for i, j in parts_of(texts):
            grams, _, ends, first = letter_grams(texts[i:j])
            letters = np.append(0, ends)[first]  # letters before each text
            for k in range(i, j):
                own = counts.setdefault(langs[k], np.zeros(BUCKETS, np.int64))
                a, b = letters[k - i], letters[k - i + 1]
                np.add.at(own, grams[a:b], 1)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])],
                                         ["lang", "bucket", "n"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihood of each bucket under each) from the columns lang and text of ``docs``.

    Every row with a text and a language counts, whole. The result has BUCKETS numbers a language.
    """
    known = docs.where("text is not null and lang is not null").select("lang", "text")
    counts = known.mapInArrow(count_grams, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("own")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    model = np.full((BUCKETS, len(rows)), SMOOTHING)
    for k, row in enumerate(rows):
        for bucket, n in row["own"]:
            model[bucket, k] += n
    return [r["lang"] for r in rows], np.log(model / model.sum(axis=0))


def mixture(lik: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(shares, log-likelihoods) of texts, by EM. ``lik``: words x languages, each word's largest being 1;
    ``first``: of each text (all have words), and the end; ``allowed``: texts x languages."""
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        joint = lik * share[text]
        joint /= joint.sum(axis=1, keepdims=True)
        share = np.add.reduceat(joint, first[:-1], axis=0) / n[:, None]
    total = np.log(np.maximum((lik * share[text]).sum(axis=1), 1e-300))
    return share, np.add.reduceat(total, first[:-1])


def infer(texts: list[str | None], model: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Shares (texts x languages) of the selected languages; all 0 for a text without letters."""
    out = np.zeros((len(texts), model.shape[1]))
    grams, starts, ends, first = letter_grams(texts)
    if not len(starts) or not model.shape[1]:
        return out
    logs = np.add.reduceat(model[grams], starts, axis=0)
    logs -= logs.max(axis=1, keepdims=True)
    lik = np.exp(np.maximum(logs, -600))
    counts = np.diff(first)
    rows = np.flatnonzero(counts)
    first = np.append(0, np.cumsum(counts[rows]))
    single = np.add.reduceat(np.maximum(logs, -600), first[:-1], axis=0)
    best = np.zeros((len(rows), model.shape[1]))
    best[np.arange(len(rows)), single.argmax(axis=1)] = 1
    if model.shape[1] > 1:
        step = penalty * np.log(np.maximum(counts[rows], 2)) / 2
        shares, full = mixture(lik, first, np.ones_like(best))
        value = single.max(axis=1)
        # No set does better than all languages do, so a text whose whole mixture can't pay for one more language is done.
        todo = np.flatnonzero(full - step > value)
        order = np.argsort(-shares, axis=1, kind="stable")
        for size in range(2, model.shape[1] + 1):
            if not len(todo):
                break
            own = np.concatenate([np.arange(first[k], first[k + 1]) for k in todo])
            allowed = np.zeros((len(todo), model.shape[1]))
            np.put_along_axis(allowed, order[todo, :size], 1, axis=1)
            share, found = mixture(lik[own], np.append(0, np.cumsum(np.diff(first)[todo])), allowed)
            found = found - step[todo] * (size - 1)
            better = found > value[todo]
            best[todo[better]], value[todo[better]] = share[better], found[better]
            todo = todo[full[todo] - step[todo] * size > value[todo]]
    out[rows] = best
    return out


def identify(docs: DataFrame, languages: list[str], model: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns lang_pred, score (its share) and languages (those selected, by share) added (or
    replaced).

    Null texts and texts without a letter get ``und``, 0 and no languages; equal shares go to the first language
    by name; without any trained language every text is ``und``. All other columns are passed through.
    """
    known = docs.sparkSession.sparkContext.broadcast((languages, model))
    docs = docs.drop("lang_pred", "score", "languages")
    added = T.StructType().add("lang_pred", "string").add("score", "double").add("languages", T.ArrayType(T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = known.value
        for batch in small(batches):
            texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
            for i, j in parts_of(texts):
                shares = infer(texts[i:j], table)
                top = shares.argmax(axis=1) if len(names) else np.zeros(j - i, int)
                score = shares.max(axis=1) if len(names) else np.zeros(j - i)
                chosen = [[names[k] for k in np.argsort(-row, kind="stable") if row[k] > 0] for row in shares]
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(i, j - i) for c in batch.columns),
                    pa.array([names[t] if s > 0 else UNKNOWN for t, s in zip(top, score, strict=True)], pa.string()),
                    pa.array(np.clip(score, 0, 1)), pa.array(chosen, pa.list_(pa.string()))],
                    [*batch.schema.names, "lang_pred", "score", "languages"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))


def language_id(docs: DataFrame) -> DataFrame:
    """``identify`` for every document, learnt from those whose crc32(doc_id) mod 4 is not 2; with held_out."""
    out = held_out(F.col("doc_id"), 4, 2)
    languages, model = train(docs.where(~out))
    return identify(docs, languages, model).withColumn("held_out", out)
