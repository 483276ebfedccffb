"""Exact top-k search by inner product: columnar branch and bound.

Vectors become whole numbers, ``floor(scale * x)`` of every component. The candidates of a task are laid out vertically,
one array a dimension. A query takes the dimensions in blocks, those in which it has the largest components first. After
each block a candidate's score can grow by no more than |rest of query| * |rest of candidate| (Cauchy-Schwarz), the
remaining mass; candidates that cannot reach the query's k-th best score any more are left out, and the survivors are compacted
before the next block. Thresholds start at the k-th best score among a few queries (queries are candidates as
well), and rise with the k-th best that the candidates at hand are sure to reach, and from block of rows to block of rows. What a bound leaves out is below the k-th best, so the result is exact.

Queries are a stated set. They are dealt to chunks of at most ``CHUNK_BYTES``, and each chunk is broadcast and run against all
rows: the driver and a worker hold one chunk, whatever the size of the table. A task returns at most k rows a query,
and only those that reach the threshold; a window with a limit in each task merges them.

Rules: vectors that are null or hold null or non-finite components take no part; an empty vector has score 0 with
all; of vectors of different lengths the shorter one counts as ending in zeros. A query's own row is left out by its id, so
repeated rows of an id never meet one another, and a repeated query gives its ranking as often as it stands there. A null id
is never a query; as a candidate it comes after all other ids of its score. A component or score beyond 64 bits is an
error. Tables without queries or candidates give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K, SCALE = 10, 1024
CHUNK_BYTES = 32 << 20  # of a broadcast chunk of queries
ROWS = 8192  # candidates that are laid out together
DIMENSIONS = 8  # of a block
SEEDS = 1024  # queries whose scores give the first thresholds
EXACT = float(1 << 53)  # whole numbers in doubles
LEAST = -(1 << 63)


def whole_vectors(lists: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their matrix of whole numbers), shorter vectors filled up with zeros."""
    lists = lists.cast(pa.large_list(pa.float64()))
    n = len(lists)
    off = lists.offsets.to_numpy()
    flat = lists.values.slice(off[0], off[-1] - off[0])
    off = off - off[0]
    size = np.diff(off)
    value = flat.to_numpy(zero_copy_only=False)  # null components become nan
    row = np.repeat(np.arange(n), size)
    good = np.asarray(lists.is_valid().to_numpy(zero_copy_only=False), bool).copy()
    good[row[~np.isfinite(value)]] = False
    take = good[row]
    value = np.floor(value[take] * scale)
    if len(value) and np.abs(value).max() >= 2.0 ** 63:
        raise OverflowError("a component doesn't fit into 64 bits")
    out = np.zeros((n, int(size[good].max(initial=0))), np.int64)
    out[row[take], (np.arange(len(row)) - off[row])[take]] = value.astype(np.int64)
    return np.flatnonzero(good), out[good]


def long_scores(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object and len(scores) and max(abs(min(scores)), abs(max(scores))) >= 1 << 63:
        raise OverflowError("a score doesn't fit into 64 bits")
    return scores.astype(np.int64)


class Queries:
    """A chunk of queries: ids, rows and thresholds, the k-th best scores so far."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.rows, self.vectors, self.k = ids, rows, vectors, k
        self.order = np.argsort(-np.abs(vectors), axis=1, kind="stable")
        sorted_squares = np.take_along_axis(vectors.astype(np.float64) ** 2, self.order, axis=1)
        # What is left of a query's length from each place of its order on.
        self.rest = np.sqrt(np.cumsum(sorted_squares[:, ::-1], axis=1)[:, ::-1])
        self.most = np.abs(vectors).max(initial=0)
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in ids]
        self.least = self.seeded()

    def seeded(self) -> np.ndarray:
        least = np.full(len(self.ids), LEAST, np.int64)
        seeds = self.vectors[:SEEDS]
        if not exact(self.most, self.most, self.vectors.shape[1]) or len(seeds) <= self.k:
            return least
        for at in range(0, len(self.ids), SEEDS):
            scores = self.vectors[at:at + SEEDS].astype(np.float64) @ seeds.T.astype(np.float64)
            scores[self.ids[at:at + SEEDS, None] == self.ids[None, :SEEDS]] = -np.inf
            own = np.partition(scores, -self.k, axis=1)[:, -self.k]
            known = np.isfinite(own)
            least[at:at + SEEDS][known] = own[known].astype(np.int64)
        return least

    def meet(self, ids: np.ndarray, known: np.ndarray, vectors: np.ndarray) -> None:
        """Takes in candidates; ``known`` is False where the id is null."""
        d = max(vectors.shape[1], self.vectors.shape[1])
        most = np.abs(vectors).max(initial=0)
        kind = np.float64 if exact(self.most, most, d) else object
        columns = np.zeros((d, len(ids)), kind)
        columns[:vectors.shape[1]] = vectors.T  # vertical
        squares = columns.astype(np.float64) ** 2
        mass = squares.sum(axis=0)
        for q in range(len(self.ids)):
            self.search(q, ids, known, columns, squares, mass, kind)

    def search(self, q: int, ids: np.ndarray, known: np.ndarray, columns: np.ndarray, squares: np.ndarray, mass: np.ndarray, kind: type) -> None:
        own = known & (ids == self.ids[q])
        left = np.flatnonzero(~own) if own.any() else None  # None: all
        score = np.zeros(columns.shape[1] if left is None else len(left), kind)
        rest = mass if left is None else mass[left]
        order, vector, least = self.order[q], self.vectors[q], float(self.least[q])
        for at in range(0, len(order), DIMENSIONS):
            block = order[at:at + DIMENSIONS]
            part, part_squares = (columns[block], squares[block]) if left is None else (columns[np.ix_(block, left)], squares[np.ix_(block, left)])
            score = score + vector[block].astype(kind) @ part
            rest = np.maximum(rest - part_squares.sum(axis=0), 0)
            if at + DIMENSIONS < len(order):
                so_far, whole = score.astype(np.float64), mass if left is None else mass[left]
                more = self.rest[q, at + DIMENSIONS] * np.sqrt(rest + 1e-9 * whole)
                more = more + 1 + 1e-9 * (more + np.abs(so_far))  # no less than doubles can be off
                if len(so_far) >= self.k:  # k candidates will reach at least so much
                    least = max(least, float(np.partition(so_far - more, -self.k)[-self.k]))
                stay = so_far + more >= least - 1e-12 * abs(least)
                if not stay.all():
                    keep = np.flatnonzero(stay)
                    left = keep if left is None else left[keep]
                    score, rest = score[keep], rest[keep]
                    if not len(left):
                        return
        score = long_scores(score)
        stay = np.flatnonzero(score >= self.least[q])
        if len(stay):
            at = stay if left is None else left[stay]
            self.keep(q, score[stay], ids[at], known[at])

    def keep(self, q: int, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        score, ids, known = (np.concatenate(x) for x in zip(self.found[q], (score, ids, known)))
        best = np.lexsort((ids, ~known, ~score))[:self.k]
        self.found[q] = score[best], ids[best], known[best]
        if len(best) == self.k:
            self.least[q] = max(self.least[q], score[best[-1]])


def exact(a: float, b: float, d: int) -> bool:
    """Whether inner products of d components of at most a and b are whole numbers that doubles hold."""
    return float(a) * float(b) * max(d, 1) < EXACT


def packed_queries(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, vectors = whole_vectors(batch.column(1), scale)
            if len(good):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(good)), pa.array([v.tobytes() for v in vectors], pa.binary())], ["id", "vector"])
    return run


def searching(chunk, k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                own = batch.slice(at, ROWS)
                good, vectors = whole_vectors(own.column(1), scale)
                if not len(good):
                    continue
                if queries is None:
                    ids, rows, raw = chunk.value
                    d = max((len(v) // 8 for v in raw), default=0)
                    own_vectors = np.zeros((len(raw), d), np.int64)
                    for i, v in enumerate(raw):
                        own_vectors[i, :len(v) // 8] = np.frombuffer(v, np.int64)
                    queries = Queries(ids, rows, own_vectors, k)
                id_column = own.column(0).take(pa.array(good))
                queries.meet(np.asarray(id_column.fill_null(0).to_numpy(zero_copy_only=False)), np.asarray(id_column.is_valid().to_numpy(zero_copy_only=False), bool), vectors)
        if queries is not None:
            for at in range(0, len(queries.ids), 4096):  # results of so many queries in a batch
                found = queries.found[at:at + 4096]
                size = [len(s) for s, _, _ in found]
                if sum(size):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(queries.ids[at:at + 4096], size)), pa.array(np.repeat(queries.rows[at:at + 4096], size)),
                        pa.array(np.concatenate([i for _, i, _ in found]), mask=~np.concatenate([known for _, _, known in found])),
                        pa.array(np.concatenate([s for s, _, _ in found]))], ["query_id", "query_row", "candidate_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """query_id, rank (from 1), ``candidate_id``, score: the k highest inner products of each query row, ties to the smaller id.

    ``is_query`` chooses the queries among the rows of ``vectors``; ids are whole numbers. See the module for all rules.
    """
    spark = vectors.sparkSession
    pair = [F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")]
    rows = vectors.where(is_query & F.col(id_col).isNotNull()).select(*pair).mapInArrow(packed_queries(scale), "id long, vector binary")
    stored = written(rows.select("id", "vector", F.monotonically_increasing_id().alias("row")), "queries")
    total = stored.agg(F.sum(F.length("vector") + 24)).first()[0] or 0
    n_chunks = max(1, -(-total // max(1, chunk_bytes)))
    dealt = written(stored.repartition(n_chunks).withColumn("chunk", F.spark_partition_id()), "query_chunks") if n_chunks > 1 else stored.withColumn("chunk", F.lit(0))
    out = None
    for c in range(n_chunks if total else 0):
        # At most chunk_bytes, but for the evenness of a round-robin deal; its rows are packed vectors.
        own = dealt.where(F.col("chunk") == c).orderBy("row").toArrow()
        if not own.num_rows:
            continue
        chunk = spark.sparkContext.broadcast((own["id"].to_numpy(), own["row"].to_numpy(), own["vector"].to_pylist()))
        found = vectors.select(*pair).mapInArrow(searching(chunk, k, scale), "query_id long, query_row long, candidate_id long, score long")
        best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("candidate_id"))
        ranked = written(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "top_k")
        chunk.destroy()
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, candidate_id long, score long")
    return out.select("query_id", "rank", "candidate_id", "score")


def brute_force(rows: list[tuple], is_query, k: int = K, scale: int = SCALE) -> list[tuple]:
    """(query id, rank, candidate id, score) by plain inner products, for tests."""
    import math
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in whole:
        if q is not None and is_query(q):
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for i, b in whole if i != q)[:k]
            out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(scores, 1)]
    return out
