"""Top-k search, importance resampling and collocations against brute force, and on awkward rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkwright.llm import collocations, resampling, topk
from sparkwright.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_edges import ITEM, ROWS, SCHEMA
from tools.oracle_check import compare


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None, "xx"][k % 3] if t else None, "s", None if t is None else len(t), k, "k", 1, 2, 3, "s") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("name", ["op11_topk", "op12_resampling", "op13_collocations"])
def test_queries_equal_their_sql(spark, name):
    assert name in QUERIES and name in ORACLE_SQL
    assert compare(spark, SF_SMALL, [name], verbose=False)[name][0] == "OK"


# -- top k ----------------------------------------------------------------------------------------


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(draw, n, d, spread=1.0):
    return [(i, [float(np.float32(draw.gauss(0, spread))) for _ in range(d)]) for i in range(n)]


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 2000])
def test_top_k_equals_brute_force(spark, chunk_bytes):
    draw = random.Random(4)
    rows = vectors(draw, 400, 19)
    rows += [(1000 + i, [x + draw.gauss(0, 0.01) for x in rows[i % 7][1]]) for i in range(120)]  # a dense group
    rows += [(2000 + i, rows[3][1]) for i in range(40)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    stored = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, chunk_bytes=chunk_bytes)
    assert rows_of(got) == sorted(topk.brute_force(stored, lambda i: i % 10 == 0), key=repr)


def test_top_k_on_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, -1.0]), (100, []), (200, None), (300, [1.0, None]), (400, [nan, 1.0]), (500, [inf, 1.0]), (None, [1.0, 2.0]),
            (7, [1.0, 2.0, 5.0]), (-100, [-1.0]), (8, [0.0005, 0.9999]), (600, [1e6, -1e6, 3e6]), (9, [1e6, 2.0 ** 20])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("row", F.lit(1))
    expected = topk.brute_force(rows, lambda i: i % 100 == 0, k=4)
    assert rows_of(topk.top_k(df, F.col("vec_id") % 100 == 0, k=4)) == sorted(expected, key=repr)
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0 and topk.top_k(df, F.lit(False)).count() == 0
    for bad in ([1e300], [2.0 ** 52]):  # a component, a score that 64 bits can't hold
        huge = spark.createDataFrame([(0, bad), (1, bad)], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="64 bits"):
            topk.top_k(huge, F.col("vec_id") == 0).collect()


def test_bounds_leave_candidates_out():
    draw = np.random.default_rng(1)
    base = np.zeros((2000, 64), np.int64)
    base[:, :8] = draw.integers(-1000, 1000, (2000, 8))  # the first block tells most
    base[:, 8:] = draw.integers(-5, 5, (2000, 56))
    queries = topk.Queries(np.arange(20), np.arange(20), base[:20], 10)
    lengths = []
    whole = topk.long_scores
    try:
        topk.long_scores = lambda s: lengths.append(len(s)) or whole(s)
        queries.meet(np.arange(2000), np.ones(2000, bool), base)
    finally:
        topk.long_scores = whole
    assert max(lengths) < 400  # of 2,000 candidates
    exact = base[:20] @ base.T
    for q in range(20):
        exact[q, q] = -10 ** 12
        assert (queries.found[q][0] == np.sort(exact[q])[::-1][:10]).all()


# -- resampling -----------------------------------------------------------------------------------


@given(st.lists(st.binary(max_size=400), max_size=20))
@settings(max_examples=60, deadline=None)
def test_crc_of_spans(parts):
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts]).astype(np.int64)
    starts = ends - [len(p) for p in parts]
    assert resampling.crc32_of(data, starts, ends).tolist() == [zlib.crc32(p) for p in parts]


@pytest.mark.parametrize("ngrams", [1, 3])
def test_resampling_equals_brute_force(spark, docs, ngrams):
    target = spark.createDataFrame([(ITEM,), (None,), ("",), ("quiet LETTER", )], "body string")
    got = resampling.resample(docs, target, percent=40, target_col="body", ngrams=ngrams)
    assert set(docs.columns) - {"text"} < set(got.columns)
    expected = resampling.brute_force(ROWS, [ITEM, None, "", "quiet LETTER"], percent=40, ngrams=ngrams)
    assert rows_of(got.select("doc_id", "__features", "__weight", "__score", "__rank")) == sorted(expected, key=repr)
    assert resampling.resample(docs.limit(0), target, target_col="body").count() == 0
    alone = resampling.resample(docs, target.limit(0), target_col="body")
    assert alone.count() == len(ROWS)
    assert resampling.resample(docs, target, target_col="body", least_words=10 ** 9).where("__rank is not null").count() == 0


def test_the_bracket_holds_the_cutoff_whatever_the_scores(spark):
    draw = random.Random(3)
    for scores in ([draw.randrange(-10 ** 9, 10 ** 9) for _ in range(3000)], [5] * 3000, [draw.randrange(3) for _ in range(3000)], [0]):
        df = spark.createDataFrame([(s,) for s in scores], "__score long").repartition(4)
        for wanted in {1, len(scores) // 10 or 1, len(scores)}:
            low, high, above = resampling.bracketed(df, wanted, accuracy=20)  # a coarse sketch must be caught by the counts
            assert above == sum(s > high for s in scores) and low <= sorted(scores, reverse=True)[wanted - 1] <= high


def test_numbering_by_ranges_with_a_repeated_row(spark):
    rows = [(k % 7, k) for k in range(500)] + [(3, 3)] * 400
    df = spark.createDataFrame(rows, "a long, b long").repartition(6).withColumn("p", F.monotonically_increasing_id())
    got = resampling.numbered(df, [F.desc("a"), F.asc("b"), F.asc("p")], "n", after=10)
    places = sorted((r["n"], -r["a"], r["b"]) for r in got.collect())
    assert [n for n, _, _ in places] == list(range(11, 911)) and [x[1:] for x in places] == sorted((-a, b) for a, b in rows)


# -- collocations ---------------------------------------------------------------------------------


@given(st.lists(st.lists(st.integers(0, 40), max_size=60), min_size=1, max_size=6), st.integers(1, 12))
@settings(max_examples=80, deadline=None)
def test_summaries_keep_every_frequent_key(parts, capacity):
    total, summary = Counter(), collocations.MisraGries(capacity)
    for part in parts:
        total.update(part)
        keys = np.array(part, np.uint32)
        summary = summary.merge(collocations.MisraGries.of(keys, np.ones(len(keys), np.int64), capacity))
        assert len(summary.keys) <= capacity
    found = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    mass = sum(total.values())
    for key, n in total.items():
        assert n - mass / (capacity + 1) <= found.get(key, 0) <= n


AWKWARD = [("en", t) for _, t in ROWS] + [(None, "New York City! new york city; NEW\tYORK  city, x\x00y x\x00y"), ("und", "new york. city"), ("fr", "É é É é\r\né é"),
                                         ("en", None), ("zz", ""), ("en", "a a a a a a a a"), ("en", ". , ; : ! ?")] * 3


@pytest.mark.parametrize("words,least,sizes", [(3, 3, {}), (3, 2, {"slice_bytes": 500, "partition_bytes": 1000}), (5, 4, {"partition_bytes": 5000})])
def test_collocations_equal_brute_force(spark, words, least, sizes):
    df = spark.createDataFrame(AWKWARD, "lang string, text string").withColumns({"phrase": F.lit(1), "f": F.lit(2), "slice": F.lit(3)}).repartition(4)
    got = collocations.collocations(df, words=words, least=least, best=50, **sizes)
    expected = collocations.brute_force(AWKWARD, words=words, least=least, best=50)
    assert expected and rows_of(got) == sorted(expected, key=repr)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    """The products pass 64 bits, the score doesn't."""
    a, n = 5 * 10 ** 9, 7 * 10 ** 9
    score = spark.sql(f"SELECT CAST(1000000 AS DECIMAL(38,0)) * CAST({a} AS DECIMAL(38,0)) * CAST({a} AS DECIMAL(38,0)) div (CAST({n} AS DECIMAL(38,0)) * CAST({n} AS DECIMAL(38,0))) AS s").first().s
    assert score == 10 ** 6 * a * a // (n * n)
