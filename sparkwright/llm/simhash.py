"""SimHash near-dedup over vantage-point shards.

Two fingerprints that differ in at most ``distance`` of 64 bits agree wholly on ``blocks - distance`` of
``blocks`` bit blocks at least. Each choice of such blocks is a view, in which a linked pair is at Hamming
distance 0; a view's fingerprints are dealt to shards by their distances from fixed vantage points within
the view, and by the triangle bound |d(x,v) - d(y,v)| <= d(x,y) = 0 all links of the view lie inside shards.
Inside a shard fingerprints are sorted by their full-width distance from a further vantage point; each is compared
with those of its own and of the overlapping shells, up to ``distance`` above, and the rest is pruned; what
remains is verified by its exact distance.

A tree over all 64 bits alone prunes almost nothing: distances from a vantage point gather at 32 +- 4, so a ball of
radius 4 overlaps about three quarters of the boundaries; hence the views.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import local_roots, lowered, slices, space_words, word_spans, written
from .components import components

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
BLOCKS = 6
VANTAGE = 12
ALONE = 64  # shards above this are searched point by point


def fingerprint_rows(shingle: int):
    """Task function: (id, mark, text) -> (id, mark, print): the bitwise majority of the shingles' XXH64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            for i, j, data, off in slices(batch.column(2), 300_000):
                data = lowered(data)
                starts, ends, first = word_spans(space_words(data), off)
                # Words joined by single spaces, row by row: where each word starts and ends there.
                size = ends - starts
                row = np.repeat(np.arange(j - i), np.diff(first))
                place = np.cumsum(size + 1) - size - 1
                flat = np.repeat(starts - place, size) + _within(place, size)
                joined = np.full(int(place[-1] + size[-1]) if len(size) else 0, 32, np.uint8)
                joined[_within(place, size)] = data[flat]
                raw, stop = joined.tobytes(), place + size
                last = np.minimum(np.arange(len(size)) + shingle, first[1:][row]) if len(size) else row
                whole = (np.arange(len(size)) + shingle <= first[1:][row]) if len(size) else np.zeros(0, bool)
                whole[first[:-1][(np.diff(first) > 0)]] = True  # fewer words: the whole sequence
                a, b = place[whole].tolist(), stop[last[whole] - 1].tolist()
                hashes = np.fromiter((xxh64_intdigest(raw[x:y], SEED) for x, y in zip(a, b, strict=True)), np.uint64, len(a))
                owner = row[whole]
                bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
                head = np.searchsorted(owner, np.arange(j - i))
                n = np.diff(np.append(head, len(owner)))
                prints = np.zeros((j - i, 8), np.uint8)
                if (n > 0).any():
                    ones = np.add.reduceat(bits, head[n > 0], axis=0, dtype=np.int64)
                    prints[n > 0] = np.packbits(2 * ones > n[n > 0][:, None], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), marks.slice(i, j - i), pa.array(prints.reshape(-1).view(">i8").astype(np.int64))], ["id", "mark", "print"])

    return run


def _within(place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """place[0], place[0]+1, ... for each size, one after another."""
    if not len(size):
        return np.zeros(0, np.int64)
    total = np.cumsum(size)
    return np.arange(int(total[-1])) + np.repeat(place - (total - size), size)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, print) for every row; words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; no words: print 0.
    mark is a hash of the text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(fingerprint_rows(shingle), "id long, mark long, print long")


def view_masks(blocks: int, distance: int) -> list[int]:
    """The bits of each choice of ``blocks - distance`` of the blocks that the 64 bits fall into."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    own = [sum(1 << b for b in range(lo, hi)) for lo, hi in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(own, blocks - distance)]


def shard_rows(masks: list[int], points: list[int]):
    """Task function: (print) -> (shard, print) for every view: a hash of the view and its distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for view, mask in enumerate(masks):
                shard = np.full(len(prints), view, np.int64)
                for v in points[:6]:
                    shard = shard * 67 + np.bitwise_count((prints ^ np.uint64(v)) & np.uint64(mask)).astype(np.int64)
                more = np.zeros(len(prints), np.int64)
                for v in points[6:]:
                    more = more * 67 + np.bitwise_count((prints ^ np.uint64(v)) & np.uint64(mask)).astype(np.int64)
                shard = (shard * np.int64(-7046029254386353131)) ^ (more * np.int64(0x165667B19E3779F9))
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(prints.view(np.int64))], ["shard", "print"])

    return run


def shard_links(prints: np.ndarray, shard: np.ndarray, distance: int, point: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is within ``distance`` in the same shard: all of them in small shards; in others
    those of a search that leaves out points already reached."""
    d = np.bitwise_count(prints ^ np.uint64(point)).astype(np.int64)
    order = np.lexsort((d, shard))
    prints, shard, d = prints[order], shard[order], d[order]
    heads = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, np.int64)
    size = np.diff(np.append(heads, len(shard)))
    a, b = [], []
    small = np.repeat(size <= ALONE, size)
    at = np.flatnonzero(small)
    for step in range(1, ALONE):  # neighbours in the shard's order, while some are in reach
        at = at[at + step < len(shard)]
        at = at[(shard[at + step] == shard[at]) & (d[at + step] - d[at] <= distance)]
        if not len(at):
            break
        near = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= distance]
        a.append(prints[near])
        b.append(prints[near + step])
    for head, n in zip(heads[size > ALONE], size[size > ALONE], strict=True):
        left, far = prints[head:head + n], d[head:head + n]
        todo: list[tuple[int, int]] = []
        while len(left):
            if not todo:
                todo, left, far = [(int(left[0]), int(far[0]))], left[1:], far[1:]
                continue
            p, at_p = todo.pop()
            lo, hi = np.searchsorted(far, at_p - distance), np.searchsorted(far, at_p + distance, "right")
            near = np.zeros(len(left), bool)
            near[lo:hi] = np.bitwise_count(left[lo:hi] ^ np.uint64(p)) <= distance
            if near.any():
                found = left[near]
                a.append(found)
                b.append(np.full(len(found), p, np.uint64))
                todo += zip(found.tolist(), far[near].tolist(), strict=True)
                left, far = left[~near], far[~near]
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(a), np.concatenate(b)


def link_shards(distance: int, point: int):
    """Task function over rows sorted by shard: (shard, print) -> links (a, b), as stars of local groups.

    Held at a time: some batches and the shard that is being read.
    """

    def stars(prints: np.ndarray, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = shard_links(prints, shard, distance, point)
        if len(a):
            node, root = local_roots(a.view(np.int64), b.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(node[node != root]), pa.array(root[node != root])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            shard, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(shard):
                continue
            cut = int(np.searchsorted(shard, shard[-1]))
            if rows >= 500_000 and (cut or held and held[-1][0][-1] != shard[0]):
                held.append((shard[:cut], prints[:cut]))
                yield from stars(np.concatenate([p for _, p in held]), np.concatenate([s for s, _ in held]))
                held, rows = [(shard[cut:], prints[cut:])], len(shard) - cut
            else:
                held.append((shard, prints))
                rows += len(shard)
        if held:
            yield from stars(np.concatenate([p for _, p in held]), np.concatenate([s for s, _ in held]))

    return run


def near_groups(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(print, root) for the distinct fingerprints of ``prints`` that have another within ``distance`` links;
    root is the smallest print (as a signed number) of the connected group. ``blocks``: more make shards smaller
    (about 64 * (blocks - distance) / blocks bits choose a shard) and views more (blocks choose distance)."""
    masks = view_masks(blocks, distance)
    draw = random.Random(SEED)
    points = [draw.getrandbits(64) for _ in range(VANTAGE + 1)]
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = prints.select("print").mapInArrow(shard_rows(masks, points[:-1]), "shard long, print long")
    dealt = shards.repartition(n, "shard").sortWithinPartitions("shard")
    return components(dealt.mapInArrow(link_shards(distance, points[-1]), "a long, b long"), "print_links").select(
        F.col("node").alias("print"), "root")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = DISTANCE, blocks: int = BLOCKS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id (smallest id that is reachable
    over links of at most ``distance`` differing bits, itself included).

    Null and empty texts have fingerprint 0, linked like any other. A null id is a row like any other, but never
    a component's id unless the component has no other; rows that repeat an id are each given their own
    component. Other columns are ignored; an empty table gives an empty result.
    """
    keys = written(fingerprints(docs, shingle, id_col, text_col), "prints")
    return labelled(keys, distance, blocks).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def labelled(keys: DataFrame, distance: int, blocks: int) -> DataFrame:
    """``keys`` (id, print, ...) with the column component, the smallest id of the print's connected group."""
    distinct = written(keys.groupBy("print").agg(F.min("id").alias("least")), "distinct_prints")
    rooted = distinct.join(near_groups(distinct, distance, blocks), "print", "left").withColumn(
        "root", F.coalesce("root", "print"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    labels = written(rooted.join(least, "root").select("print", "component"), "print_components")
    return keys.join(labels, "print")


def first_of_groups(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = DISTANCE, blocks: int = BLOCKS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) whose id is their component's; see ``simhash_groups``. Rows that share
    that id and the component are one document stored more than once, and stay together."""
    keys = written(fingerprints(docs, shingle, id_col, text_col), "prints")
    kept = labelled(keys, distance, blocks).where(F.col("id").eqNullSafe(F.col("component")))
    kept = written(kept.select(F.col("id").alias("__id"), F.col("mark").alias("__mark")).distinct(), "kept_documents")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__mark"))
    return docs.join(kept, same, "left_semi")


def brute_force(docs: list[tuple], shingle: int = SHINGLE_WORDS, distance: int = DISTANCE) -> list[tuple]:
    """The contract said plainly, over a small list of (id, text); for tests."""
    import re

    from xxhash import xxh64_intdigest
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    prints = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
        hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(docs)))

    def root(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                group[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (id_, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), id_), id_)
    return [(id_, f"{prints[i]:016x}", least[root(i)]) for i, (id_, _) in enumerate(docs)]
