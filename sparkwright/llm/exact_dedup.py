"""Exact dedup with counting quotient filters.

Each partition of texts builds counting quotient filters (CQF) of its fingerprints: a fingerprint's high bits
are the quotient, whose run of ascending remainders is kept behind an occupied bit and closed by a run-end
bit; a remainder seen more than once carries a count. The filters are cut by the top bits of the quotient, and the
filters of one cut from all partitions merge losslessly, as their remainders are sorted. Fingerprints whose
merged count is above one go to byte verification: whole normalised texts are grouped by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

QUOTIENT_BITS = 20
REMAINDER_BITS = 32


@dataclass
class QuotientFilter:
    """A static counting quotient filter over one cut of the quotients, without its empty slots.

    ``occupied``: a bit for each quotient; ``run_ends`` and ``counted``: a bit for each slot (last of its run;
    carries a count); ``remainders``: by slot, ascending in a run; ``counts``: of the counted slots, in order.
    """

    occupied: np.ndarray
    run_ends: np.ndarray
    counted: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, prints: np.ndarray, counts: np.ndarray, first: int, quotients: int) -> QuotientFilter:
        """Of ascending distinct fingerprints whose quotients lie in [first, first + quotients)."""
        quotient = (prints >> np.uint64(REMAINDER_BITS)).astype(np.int64) - first
        occupied = np.zeros(quotients, bool)
        occupied[quotient] = True
        ends = np.append(quotient[1:] != quotient[:-1], True)[:len(quotient)]
        return cls(occupied, ends, counts > 1, (prints & np.uint64((1 << REMAINDER_BITS) - 1)).astype(np.uint32),
                   counts[counts > 1].astype(np.int64))

    def items(self, first: int) -> tuple[np.ndarray, np.ndarray]:
        """(ascending fingerprints, counts)."""
        run = np.cumsum(self.run_ends) - self.run_ends  # runs closed before each slot
        quotient = np.flatnonzero(self.occupied)[run] + first
        counts = np.ones(len(self.remainders), np.int64)
        counts[self.counted] = self.counts
        return (quotient.astype(np.uint64) << np.uint64(REMAINDER_BITS)) | self.remainders.astype(np.uint64), counts

    def to_bytes(self) -> bytes:
        n = np.array([len(self.occupied), len(self.remainders), len(self.counts)], np.int64)
        return b"".join(x.tobytes() for x in (n, np.packbits(self.occupied), np.packbits(self.run_ends),
                                              np.packbits(self.counted), self.remainders, self.counts))

    @classmethod
    def from_bytes(cls, raw: bytes) -> QuotientFilter:
        quotients, slots, counted = np.frombuffer(raw, np.int64, 3).tolist()
        at, parts = 24, []
        for n in (quotients, slots, slots):
            size = (n + 7) // 8
            parts.append(np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=n).astype(bool))
            at += size
        return cls(*parts, np.frombuffer(raw, np.uint32, slots, at), np.frombuffer(raw, np.int64, counted, at + 4 * slots))

    @classmethod
    def merged(cls, filters: list[QuotientFilter], first: int) -> QuotientFilter:
        """The filter of all fingerprints of ``filters`` (of the same cut), counts added."""
        pairs = [f.items(first) for f in filters]
        prints, at = np.unique(np.concatenate([p for p, _ in pairs]), return_inverse=True)
        counts = np.zeros(len(prints), np.int64)
        np.add.at(counts, at, np.concatenate([c for _, c in pairs]))
        return cls.of(prints, counts, first, len(filters[0].occupied))


def partition_filters(cut_bits: int):
    """Task function: (print) -> (cut, filter), one filter for each cut that has fingerprints.

    The partition's distinct fingerprints are held, 16 bytes each.
    """
    quotients = 1 << (QUOTIENT_BITS - cut_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            new = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            prints, at = np.unique(np.concatenate([prints, new]), return_inverse=True)
            counts = np.bincount(at, np.append(counts, np.ones(len(new), np.int64)), len(prints)).astype(np.int64)
        if not len(prints):
            return
        cut = (prints >> np.uint64(REMAINDER_BITS + QUOTIENT_BITS - cut_bits)).astype(np.int64)
        heads = np.flatnonzero(np.append(True, cut[1:] != cut[:-1]))
        blobs = [QuotientFilter.of(prints[a:b], counts[a:b], int(cut[a]) * quotients, quotients).to_bytes()
                 for a, b in zip(heads, np.append(heads[1:], len(cut)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(cut[heads], pa.int64()), pa.array(blobs, pa.binary())], ["cut", "filter"])

    return run


def repeated_prints(prints: DataFrame) -> DataFrame:
    """(print, n) of the fingerprints (long) that the column ``print`` holds more than once."""
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut_bits = min(QUOTIENT_BITS, (2 * parts - 1).bit_length())
    quotients = 1 << (QUOTIENT_BITS - cut_bits)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(pdf["cut"].iloc[0]) * quotients
        found, counts = QuotientFilter.merged([QuotientFilter.from_bytes(b) for b in pdf["filter"]], first).items(first)
        return pd.DataFrame({"print": found[counts > 1].astype(np.int64), "n": counts[counts > 1]})

    return (prints.select("print").mapInArrow(partition_filters(cut_bits), "cut long, filter binary")
            .groupBy("cut").applyInPandas(merge, "print long, n long"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null equals the empty text. The largest id of a group
    stays; group_size counts rows. Null ids never win over others (keep_id is null if a group has no other);
    rows that repeat both the text and its winning id are all marked kept, being one and the same document.
    Other columns are ignored; an empty table gives an empty result.
    """
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("body"))
    low = (1 << (QUOTIENT_BITS + REMAINDER_BITS)) - 1
    rows = rows.withColumn("print", F.xxhash64("body").bitwiseAND(F.lit(low)))
    keys = written(rows.select("id", "print", F.unhex(F.sha2("body", 256)).alias("sha")), "text_keys")
    repeated = written(repeated_prints(keys), "repeated")
    # Grouped by the text alone: the copies of a text are combined before the shuffle, wherever the join left them.
    same = (rows.join(repeated, "print", "left_semi")
            .groupBy("body").agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1"))
    groups = written(same.select(F.unhex(F.sha2("body", 256)).alias("sha"), "keep", "n"), "text_groups")
    found = keys.join(groups, "sha", "left")
    return found.select(
        F.col("id").alias(id_col), F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | F.col("id").eqNullSafe(F.col("keep"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
