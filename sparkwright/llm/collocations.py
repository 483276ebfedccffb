"""Phrase collocations: frequent phrases found by Misra-Gries summaries, counted exactly, scored by their weakest cut.

First pass. Texts are packed into slices. Each slice sends the distinct n-grams of its texts, as hashes with counts, to hash partitions;
the number of partitions grows with the texts, so a partition's share stays bounded. A partition merges its blocks into
a Misra-Gries summary of ``mass // least`` counters: a merged summary undercounts by at most mass / (capacity + 1), which is below
``least``, so every n-gram that occurs ``least`` times keeps a counter. (A common n-gram arrives once a slice, already counted: no
partition is hot.) The survivors are counted over the same blocks, and each slice gets back one bit for each n-gram it sent.

Second pass. The slices are read again; n-grams whose bit is set are counted as texts, exactly (equal hashes of different
phrases only cost a few counts in vain), and summed over all slices.

A candidate cut after its first k words has score ``scale * a * a / (l * r)``, in decimals of 38 digits; the weakest cut counts. Candidates
that are mostly part of a longer one are dropped; each language keeps its best.

Rules: text is lower-cased for A-Z only; null text is empty, null language is ``und``; repeated rows count each time; empty tables give no
rows. A very long text is a slice of its own, whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gram_hashes, lowered, mixed, release, slices, span_hashes, word_spans, written

WORDS = 3  # of the longest phrase
LEAST = 10  # occurrences
SCALE = 1_000_000
WITHIN = 50  # percent of a candidate's occurrences inside a longer one that drop it
BEST = 2000  # phrases of a language
UNKNOWN = "und"
SLICE_BYTES = 6_000_000
BLOCK_BYTES = 1_000_000  # of a slice that are worked on at once
MARK_BITS = 24
PARTITION_BYTES = 32_000_000  # of text for each hash partition
STOPS = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))


# -- Misra-Gries ----------------------------------------------------------------------------------


class MisraGries:
    """At most ``capacity`` counters over whole-number keys; keys sorted. Counts fall short by at most ``mass / (capacity + 1)``."""

    def __init__(self, capacity: int, keys: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.capacity = capacity
        self.keys = np.zeros(0, np.uint32) if keys is None else keys
        self.counts = np.zeros(0, np.int64) if counts is None else counts

    def merge(self, other: MisraGries) -> MisraGries:
        return MisraGries.of(np.concatenate([self.keys, other.keys]), np.concatenate([self.counts, other.counts]), self.capacity)

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray, capacity: int) -> MisraGries:
        """The summary of counted keys, repeats allowed."""
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > capacity:
            counts = counts - np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
        return MisraGries(capacity, keys, counts)


# -- slices and their n-grams ---------------------------------------------------------------------


def packing(most: int):
    """Texts, lower-cased, to compressed slices of about ``most`` bytes, sorted by language."""
    def packed(langs: list, texts: list, k: int) -> pa.RecordBatch:
        whole = pa.table([pa.chunked_array(langs, pa.string()), pa.chunked_array(texts, pa.large_string())], ["lang", "text"])
        whole = whole.take(pc.sort_indices(whole["lang"]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(whole.combine_chunks())
        size = pc.sum(pc.binary_length(whole["text"])).as_py() or 0
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["k", "bytes", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, texts, size, k = [], [], 0, 0
        for batch in batches:
            lang, text = batch.column(0), batch.column(1).cast(pa.large_string())
            for i, j, data, _ in slices(text, most // 4):
                if size and size + len(data) > most:
                    yield packed(langs, texts, k)
                    langs, texts, size, k = [], [], 0, k + 1
                langs.append(lang.slice(i, j - i))
                texts.append(text.slice(i, j - i))
                size += len(data)
        if texts:
            yield packed(langs, texts, k)
    return run


def unpacked(body: bytes) -> Iterator[tuple[str, pa.Array]]:
    """(language, its texts) of a slice."""
    with pa.ipc.open_stream(body) as reader:
        whole = reader.read_all().combine_chunks()
    counts = pc.value_counts(whole["lang"])
    at = 0
    for c in counts:  # sorted: each language is one run
        n = c["counts"].as_py()
        yield c["values"].as_py(), whole["text"].slice(at, n).combine_chunks()
        at += n


class Grams:
    """The n-grams of texts of one language: where they start, and their keys (partition << 32 | rest of the hash)."""

    def __init__(self, lang: str, data: np.ndarray, off: np.ndarray, words: int, partitions: int):
        data = lowered(data)
        stop = STOPS[data]
        starts, ends, _ = word_spans(~(stop | (data == 32) | (data == 9)), off)
        hashes = span_hashes(data, starts, ends)
        piece = np.cumsum(stop)[starts] + np.searchsorted(off, starts, "right") if len(starts) else starts
        salt = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
        self.lang, self.n_words, self.at, self.keys = lang, len(starts), [], []
        for k in range(1, words + 1):
            n = max(0, len(starts) - k + 1)
            at = np.flatnonzero(piece[:n] == piece[k - 1:k - 1 + n])
            h = mixed((gram_hashes(hashes, k)[at] if n else hashes[:0]) ^ np.uint64((salt + k) % (1 << 64)))
            part = (h >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)
            self.keys.append(part << np.uint64(32) | h & np.uint64(0xFFFFFFFF))
            self.at.append(at.astype(np.int32))
        self.data, self.starts, self.ends, self.spaced = data, starts, ends, None

    @staticmethod
    def of(body: pa.Buffer, words: int, partitions: int) -> Iterator[Grams]:
        """The n-grams of a slice, in blocks that keep what is made on the way small."""
        for lang, texts in unpacked(body):
            for _, _, data, off in slices(texts, BLOCK_BYTES):
                yield Grams(lang, data, off, words, partitions)

    def phrases(self, k: int, chosen: np.ndarray) -> pa.Array:
        """The k-word phrases at the chosen places."""
        if not len(chosen):
            return pa.array([], pa.large_string())
        if self.spaced is None:  # words with one space between them: a phrase is a span again
            size = self.ends - self.starts + 1
            self.to = np.concatenate([[0], np.cumsum(size)])
            self.spaced = np.append(self.data, np.uint8(32))[gathered(self.starts, size)]
            self.spaced[self.to[1:] - 1] = 32
            self.data = self.starts = self.ends = None
        spaced, to, at = self.spaced, self.to, self.at[k - 1][chosen]
        start, size = to[at], to[at + k] - 1 - to[at]
        off = np.concatenate([[0], np.cumsum(size)])
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(spaced[gathered(start, size)]))


def gathered(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of spans, one after another."""
    to = np.cumsum(size)
    return np.repeat(start - (to - size), size) + np.arange(to[-1] if len(to) else 0)


def distinct(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys of a slice's n-grams, and how often each occurs."""
    keys = np.concatenate([np.zeros(0, np.uint64), *keys])
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def summing(words: int, partitions: int):
    """Per slice and hash partition: mass, sorted keys, counts of the slice's n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = [k for g in Grams.of(body.as_buffer(), words, partitions) for k in g.keys]
                yield from sent(number, *distinct(keys))
                pa.default_memory_pool().release_unused()
    return run


def sent(number: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    part = (keys >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
    rest = keys.astype(np.uint32)
    for some in np.array_split(np.arange(len(cut)), max(1, len(cut) // 1000)):
        rows = []
        for c in some:
            i, j = cut[c], cut[c + 1] if c + 1 < len(cut) else len(keys)
            own = counts[i:j]
            more = np.flatnonzero(own > 1)  # most occur once
            rows.append((number, int(part[i]), int(own.sum()), rest[i:j].tobytes(), more.astype(np.uint32).tobytes(), own[more].astype(np.uint32).tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["slice", "part", "mass", "keys", "more", "counts"])


def counted(row: dict) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(row["keys"], np.uint32)
    counts = np.ones(len(keys), np.int64)
    counts[np.frombuffer(row["more"], np.uint32)] = np.frombuffer(row["counts"], np.uint32)
    return keys, counts


def surviving(least: int):
    """The bits of one hash partition: for each slice, which of its n-grams occur ``least`` times."""
    def run(key: tuple, blocks: pa.Table) -> pa.Table:
        capacity = pc.sum(blocks["mass"]).as_py() // least
        summary, waiting, n = MisraGries(capacity), [], 0
        rows = [{c: blocks[c][i].as_py() for c in ("keys", "more", "counts")} for i in range(blocks.num_rows)]
        for i, row in enumerate(rows):
            waiting.append(counted(row))
            n += len(waiting[-1][0])
            if n > capacity or i + 1 == len(rows):
                summary = summary.merge(MisraGries.of(*(np.concatenate(x) for x in zip(*waiting)), capacity))
                waiting, n = [], 0
        if not len(summary.keys):
            return pa.table({"slice": pa.array([], pa.int64()), "part": pa.array([], pa.int64()), "bits": pa.array([], pa.binary())})
        total = np.zeros(len(summary.keys), np.int64)
        places = []
        for row in rows:
            keys, counts = counted(row)
            at = np.minimum(np.searchsorted(summary.keys, keys), len(summary.keys) - 1)
            at[summary.keys[at] != keys] = -1
            total[at[at >= 0]] += counts[at >= 0]  # a block's keys are distinct
            places.append(at)
        frequent = np.append(total >= least, False)  # the last for places of -1
        bits = [np.packbits(frequent[at]).tobytes() for at in places]
        return pa.table({"slice": blocks["slice"], "part": blocks["part"], "bits": pa.array(bits, pa.binary())})
    return run


class Marks:
    """A set of keys that may hold some more: one in thirty of the others at worst, for a slice's n-grams."""

    def __init__(self, keys: np.ndarray):
        self.marked = np.zeros(1 << MARK_BITS, bool)
        self.marked[self.place(keys)] = True

    @staticmethod
    def place(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MARK_BITS)

    def of(self, keys: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.marked[self.place(keys)])


def spelling(words: int, partitions: int):
    """A slice and its bits to (language, phrase, words, occurrences), and the language's number of words (phrase null).

    A phrase that isn't frequent may be among them, by its mark or hash; its occurrences, all or some, stay below the threshold.
    """
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "size": pa.array([], pa.int32()), "f": pa.array([], pa.int64())})]

        def add(lang: str, phrase: pa.Array, k: int, f: pa.Array) -> None:
            n = len(f)
            out.append(pa.table({"lang": pa.repeat(pa.scalar(lang, pa.string()), n), "phrase": phrase, "size": pa.repeat(pa.scalar(k, pa.int32()), n), "f": f}))

        if not left.num_rows:
            return out[0]
        grams = list(Grams.of(left["body"][0].as_buffer(), words, partitions))
        keys, _ = distinct([k for g in grams for k in g.keys])
        part = (keys >> np.uint64(32)).astype(np.int64)
        frequent = np.zeros(len(keys), bool)
        for p, bits in zip(right["part"].to_pylist(), right["bits"]):
            i, j = np.searchsorted(part, [p, p + 1])
            frequent[i:j] = np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), count=j - i)
        marks = Marks(keys[frequent])
        del keys, part, frequent
        for g in grams:
            g.keys = [marks.of(k).astype(np.int32) for k in g.keys]  # places from here on
        del marks
        for lang in dict.fromkeys(g.lang for g in grams):
            own = [g for g in grams if g.lang == lang]
            if n := sum(g.n_words for g in own):
                add(lang, pa.nulls(1, pa.string()), 0, pa.array([n], pa.int64()))
            for k in range(1, words + 1):
                counts = pc.value_counts(pa.chunked_array([g.phrases(k, g.keys[k - 1]) for g in own], pa.large_string()))
                add(lang, counts.field(0).cast(pa.string()), k, counts.field(1).cast(pa.int64()))
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(out)
    return run


def phrase_counts(docs: DataFrame, words: int = WORDS, least: int = LEAST, text_col: str = "text", lang_col: str = "lang",
                  slice_bytes: int = SLICE_BYTES, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """lang, phrase, size (words), f: every phrase of up to ``words`` words that occurs ``least`` times in its language, and
    rows without a phrase for the number of all words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    packed = rows.mapInArrow(packing(slice_bytes), "k long, bytes long, body binary")
    stored = written(packed.select(F.monotonically_increasing_id().alias("slice"), "bytes", "body"), "slices")
    total = stored.agg(F.sum("bytes")).first()[0] or 0
    partitions = max(1, -(-total // partition_bytes))
    blocks = stored.select("slice", "body").mapInArrow(summing(words, partitions), "slice long, part long, mass long, keys binary, more binary, counts binary")
    bits = written(blocks.groupBy("part").applyInArrow(surviving(least), "slice long, part long, bits binary"), "survivors")
    del blocks
    release(spark)
    spelled = stored.select("slice", "body").groupBy("slice").cogroup(bits.groupBy("slice")).applyInArrow(
        spelling(words, partitions), "lang string, phrase string, size int, f long")
    total = spelled.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | F.col("phrase").isNull())
    return written(total.select("lang", "phrase", "size", "f"), "phrases")


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, within: int = WITHIN, best: int | None = BEST,
                 scale: int = SCALE, text_col: str = "text", lang_col: str = "lang", **sizes: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``best`` phrases (None: all) of 2 to ``words`` words, by score, a, phrase."""
    counts = phrase_counts(docs, words, least, text_col, lang_col, **sizes)
    phrases = counts.where(F.col("phrase").isNotNull())
    longer = phrases.where(F.col("size") > 2).select("lang", F.col("f").alias("__f"), F.split("phrase", " ").alias("w"), "size")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    around = longer.select("lang", F.explode(spans).alias("phrase"), "__f").groupBy("lang", "phrase").agg(F.max("__f").alias("__f"))
    candidates = phrases.where(F.col("size") > 1).select("lang", "phrase", "size", F.col("f").alias("a")).join(around, ["lang", "phrase"], "left")
    candidates = candidates.where(F.col("__f").isNull() | (F.col("__f") * 100 < F.col("a") * within)).drop("__f")
    cut = candidates.withColumn("w", F.split("phrase", " ")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("__left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("__right"))
    part = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cut = cut.join(part("__left", "l"), ["lang", "__left"]).join(part("__right", "r"), ["lang", "__right"])
    score = F.expr(f"CAST({scale} AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) div (CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0)))")
    weakest = cut.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("c")).groupBy("lang", "phrase", "a").agg(F.min("c").alias("c"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = weakest.select("lang", "phrase", "a", "c.l", "c.r", "c.score").withColumn("rank", F.row_number().over(order).cast("long"))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    # One row a language, as small as the number of languages; joined by adaptive execution as it measures.
    n = counts.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute_force(docs: list[tuple], words: int = WORDS, least: int = LEAST, within: int = WITHIN, best: int = BEST, scale: int = SCALE) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) in plain Python, for tests."""
    import re
    from collections import Counter
    fold = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    f: dict[str, Counter] = {}
    for lang, text in docs:
        own = f.setdefault(UNKNOWN if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(fold)):
            w = re.findall("[^\x20\x09]+", piece)
            own.update(" ".join(w[i:i + k]) for k in range(1, words + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        n = sum(c for p, c in own.items() if " " not in p)
        can = {p: c for p, c in own.items() if " " in p and c >= least}
        rows = []
        for p, a in can.items():
            if any(f" {p} " in f" {q} " and 100 * c >= within * a for q, c in can.items() if q.count(" ") > p.count(" ")):
                continue
            w = p.split(" ")
            cuts = [(scale * a * a // (own[" ".join(w[:k])] * own[" ".join(w[k:])]), k, own[" ".join(w[:k])], own[" ".join(w[k:])]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, p.encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, n, -s) for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:best], 1)]
    return out
