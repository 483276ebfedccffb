"""Target-distribution importance resampling: documents that look like a target corpus, drawn without replacement.

Features are runs of words, hashed to buckets. A bucket's gain is the scaled log ratio of its share in the target to its share
in the documents (both smoothed by one); a document's weight is the sum of the gains over its features, read from an
array of all buckets. Gumbel noise from the hashed id makes the highest scores a draw without replacement.

The cutoff is found by bracketing: a mergeable quantile sketch of all scores gives two scores around the wanted rank,
exact counts above and inside check that the cutoff lies between (else the bracket is widened up to the whole range), and only
rows inside the bracket are sorted to find it. Ranks come from range partitions with the counts of those before, so no task
holds all rows; the drawn rows above the bracket are numbered the same way.

Rules: null text has no words; a null id is hashed as an empty one and comes last among ties; rows that tie wholly (repeated
rows) take ranks in any order; empty tables give no rows. Only the ``buckets`` counts of either corpus reach the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import letter_words, lowered, slices, small, word_spans, written

BUCKETS = 10_000
NGRAMS = 1  # features are runs of 1 to so many words
SCALE = 1000  # of gains and noise
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
ACCURACY = 10_000  # of the quantile sketch
LONG_FEATURE = 256  # bytes; longer features are hashed one by one


def crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of bytes: one step takes a byte of every span that is long enough."""
    table, size = crc_table(), ends - starts
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-size, kind="stable")
    n_long = int((size > LONG_FEATURE).sum())
    short = order[n_long:]
    crc, at, sizes = out[short], starts[short], size[short]
    for j in range(int(sizes.max(initial=0))):
        n = int(np.searchsorted(-sizes, -j, "left"))  # spans of over j bytes
        crc[:n] = table[(crc[:n] ^ data[at[:n] + j]) & 0xFF] ^ (crc[:n] >> np.uint32(8))
    out[short] = ~crc
    for i in order[:n_long]:
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes())
    return out


def feature_buckets(data: np.ndarray, off: np.ndarray, ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each feature, its bucket, words of each row) of one slice of texts."""
    data = lowered(data)
    starts, ends, first = word_spans(letter_words(data), off)
    rows = len(off) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    if ngrams > 1:  # words with one space between them, so that a run of words is a span again
        size = ends - starts + 1
        to = np.concatenate([[0], np.cumsum(size)])
        spaced = np.full(to[-1], 32, np.uint8)
        inside = np.arange(to[-1]) - np.repeat(to[:-1], size)
        keep = inside < np.repeat(size - 1, size)
        spaced[keep] = data[(np.repeat(starts, size) + inside)[keep]]
        data, starts, ends = spaced, to[:-1], to[1:] - 1
    at, bucket = [], []
    for k in range(1, ngrams + 1):
        n = max(0, len(starts) - k + 1)
        whole = row[:n] == row[k - 1:k - 1 + n]
        at.append(row[:n][whole])
        bucket.append(crc32_of(data, starts[:n][whole], ends[k - 1:k - 1 + n][whole]) % np.uint32(buckets))
    return np.concatenate(at), np.concatenate(bucket), np.diff(first)


def counting(ngrams: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in small(batches):
            for _, _, data, off in slices(batch.column(0)):
                total += np.bincount(feature_buckets(data, off, ngrams, buckets)[1], minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts."""
    per_task = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(counting(ngrams, buckets), "bucket long, n long")
    got = per_task.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def gains(own: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    buckets = len(own)
    of_own, of_target = float(own.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(scale * math.log((float(t + 1) * of_own) / (float(s + 1) * of_target))) for s, t in zip(own.tolist(), target.tolist())], np.int64)


def weighing(gain: np.ndarray, ngrams: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            text = batch.column(batch.schema.get_field_index("__text"))
            n_features, n_words, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, j, data, off in slices(text):
                row, bucket, words = feature_buckets(data, off, ngrams, len(gain))
                n_features[i:j] = np.bincount(row, minlength=j - i)
                total = np.zeros(j - i, np.int64)
                np.add.at(total, row, gain[bucket])
                weight[i:j], n_words[i:j] = total, words
            own = [c for c, name in zip(batch.columns, batch.schema.names) if name != "__text"]
            names = [name for name in batch.schema.names if name != "__text"]
            yield pa.RecordBatch.from_arrays([*own, *map(pa.array, (n_features, n_words, weight))], [*names, "__features", "__words", "__weight"])
    return run


def noise(id_col: str, seed: int = SEED, scale: int = SCALE) -> Column:
    """Scaled Gumbel noise from the hashed id, floored."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def numbered(df: DataFrame, order: list[Column], name: str, after: int = 0) -> DataFrame:
    """``df`` with its place (from ``after`` + 1) in ``order``, by range partitions and the counts of those before."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = written(ranged.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33)
    sizes = sorted(stored.groupBy(part.alias("p")).count().collect())  # a row for each partition
    before, starts = after, []
    for p, n in sizes:
        starts.append((p, before))
        before += n
    starts = spark.createDataFrame(starts, "__part long, __before long")
    placed = stored.withColumn("__part", part).join(F.broadcast(starts), "__part")
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(name, F.col("__before") + inside + 1).drop("__at", "__part", "__before")


def bracketed(scores: DataFrame, wanted: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """(low, high, rows above high): scores of ``scores`` (column __score) between which the ``wanted``-th highest lies."""
    n, least, most = scores.agg(F.count(F.lit(1)), F.min("__score"), F.max("__score")).first()
    margin = 2.0 / accuracy
    while True:
        at = 1.0 - wanted / n
        low, high = scores.agg(F.percentile_approx("__score", [max(0.0, at - margin), min(1.0, at + margin)], accuracy)).first()[0]
        if margin >= 1:
            low, high = least, most
        above, inside = scores.agg(F.count(F.when(F.col("__score") > high, 1)), F.count(F.when(F.col("__score").between(low, high), 1))).first()
        if above < wanted <= above + inside:
            return low, high, above
        margin *= 4  # the sketch was off: widen


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, ngrams: int = NGRAMS,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             accuracy: int = ACCURACY) -> DataFrame:
    """The columns of ``docs`` but the text, and n_features, n_words, weight, score, rank (null: not drawn), each as ``__`` + name.

    ``percent`` of the documents with ``least_words`` words are drawn, the highest scores first, ties to the smaller id.
    """
    gain = gains(bucket_counts(docs, text_col, ngrams, buckets), bucket_counts(target, target_col, ngrams, buckets))
    kept = [c for c in docs.columns if c != text_col]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias("__text"))
    fields = [f for f in rows.schema.fields if f.name != "__text"] + [StructField(f"__{c}", LongType()) for c in ("features", "words", "weight")]
    weighed = rows.mapInArrow(weighing(gain, ngrams), StructType(fields))
    weighed = weighed.withColumn("__score", F.col("__weight") + noise(f"`{id_col}`", seed))
    stored = written(weighed.withColumn("__place", F.monotonically_increasing_id()), "weights")
    may = F.col("__words") >= least_words
    eligible = stored.where(may)
    wanted = percent * eligible.count() // 100
    unranked = F.lit(None).cast("long")
    if not wanted:
        return stored.withColumn("__rank", unranked).drop("__place")
    low, high, above = bracketed(eligible, wanted, accuracy)
    order = [F.desc("__score"), F.asc_nulls_last(F.col(f"`{id_col}`")), F.asc("__features"), F.asc("__weight"), F.asc("__place")]
    inside = numbered(eligible.where(F.col("__score").between(low, high)), order, "__rank", above)
    inside = inside.withColumn("__rank", F.when(F.col("__rank") <= wanted, F.col("__rank")))
    first = numbered(eligible.where(F.col("__score") > high), order, "__rank")
    rest = stored.where(~may | (F.col("__score") < low)).withColumn("__rank", unranked)
    return first.unionByName(inside).unionByName(rest).drop("__place")


def brute_force(docs: list[tuple], target: list, percent: int = PERCENT, least_words: int = LEAST_WORDS, ngrams: int = NGRAMS,
                buckets: int = BUCKETS, seed: int = SEED) -> list[tuple]:
    """(id, n_features, weight, score, rank) in plain Python, for tests; ids must be unique among drawn rows."""
    import hashlib
    import re
    from collections import Counter
    fold = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(fold))

    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, ngrams + 1) for i in range(len(w) - k + 1)]

    s, t = Counter(f for _, text in docs for f in features(text)), Counter(f for text in target for f in features(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    out, can = [], []
    for i, text in docs:
        own = features(text)
        weight = sum(math.floor(SCALE * math.log((float(t[f] + 1) * (all_s + buckets)) / (float(s[f] + 1) * (all_t + buckets)))) for f in own)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(own), weight, score, None])
        if len(words(text)) >= least_words:
            can.append(out[-1])
    can.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(can[:percent * len(can) // 100], 1):
        row[4] = rank
    return [tuple(r) for r in out]
