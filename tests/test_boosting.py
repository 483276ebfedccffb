"""Fitted features and boosted trees against plain versions."""

import math
import os

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import boosting as bt
from sparkwright.operators import tuning as tn
from sparkwright.sources import fixtures as fx
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    pipeline, rows = bt.fit_features(*fx.training_events(spark, SF_SMALL))
    path = str(tmp_path_factory.mktemp("features") / "rows")
    rows.write.parquet(path)
    return pipeline, spark.read.parquet(path)


def plain_boost(rows, rates, trees, depth, bins):
    """(start, {rate: [margin of a row]}) by loops over all rows."""
    train = [r for r in rows if r["fold"] < tn.FOLDS - 1]
    width = len(train[0]["x"])
    cuts = []
    for f in range(width):
        values = sorted(r["x"][f] for r in train)
        own = {values[math.ceil(len(values) * j / bins) - 1] for j in range(1, bins)}
        cuts.append(sorted(v for v in own if v < values[-1]))
    ones = sum(r["label"] for r in train)
    start = round(math.log((ones + 1) / (len(train) - ones + 1)), 6)
    functions = {}
    for rate in rates:
        grown = []

        def margin(x):
            m = start
            for tree in grown:
                m += tree(x)
            return m

        for k in range(trees):
            state = []
            for r in train:
                p = math.floor(1e6 / (1 + math.exp(-margin(r["x"]))) + 0.5)
                state.append((r["x"], p - r["label"] * 10 ** 6, max(p * (10 ** 6 - p) // 10 ** 6, 1)))

            def grow(own, level):
                g, h = sum(s[1] for s in own), sum(s[2] for s in own)
                best = (0.0, None)
                for f in range(width) if level < depth else ():
                    for cut in cuts[f]:
                        left = [s for s in own if s[0][f] <= cut]
                        if 0 < len(left) < len(own):
                            lg, lh = sum(s[1] for s in left), sum(s[2] for s in left)
                            gain = lg ** 2 / (lh + 1e6) + (g - lg) ** 2 / (h - lh + 1e6) - g ** 2 / (h + 1e6)
                            if gain > best[0]:
                                best = (gain, (f, cut))
                if best[1] is None:
                    value = math.floor(-(1.0 if k == 0 else rate) * g / (h + 1e6) * 1e6 + 0.5) / 1e6
                    return lambda x: value
                f, cut = best[1]
                low, high = grow([s for s in own if s[0][f] <= cut], level + 1), grow([s for s in own if s[0][f] > cut], level + 1)
                return lambda x: low(x) if x[f] <= cut else high(x)

            grown.append(grow(state, 0))
        functions[rate] = (lambda all_trees: lambda x: start + sum(t(x) for t in all_trees))(list(grown))
    return start, functions


def test_trees_equal_plain_boosting_at_any_layout(spark, fitted, tmp_dir):
    rows = fitted[1]
    rates, trees, depth, bins = (0.05, 0.5), 3, 2, 8
    some = rows.withColumn("x", F.slice("x", 1, 8)).collect()
    start, functions = plain_boost(some, rates, trees, depth, bins)
    seen = []
    for partitions in (1, 16):
        few = rows.withColumn("x", F.slice("x", 1, 8)).repartition(partitions)
        cuts = bt.quantile_cuts(few.where(F.col("fold") < tn.FOLDS - 1), bins)
        bt.binned(few, cuts).write.parquet(f"{tmp_dir}/{partitions}")
        stored = spark.read.parquet(f"{tmp_dir}/{partitions}")
        got_start, models, scores = bt.boost(stored, rates, trees, depth)
        assert got_start == start
        for rate in rates:
            for r in stored.select("x", bt._margin(got_start, models[rate]).alias("m")).collect():
                assert abs(r["m"] - functions[rate](r["x"])) < 1e-9
        held = [r for r in some if r["fold"] == tn.FOLDS - 1]
        for s in scores.collect():
            right = sum((functions[s["learning_rate"]](r["x"]) >= 0) == (r["label"] == 1) for r in held)
            assert s["accuracy"] == math.floor(right * 10000 / len(held) + 0.5) / 10000
        seen.append((models, [tuple(s) for s in scores.collect()]))
    assert seen[0] == seen[1]


def test_registered_models_score_the_same_after_reload(spark, fitted, tmp_dir):
    pipeline, rows = fitted
    cuts = bt.quantile_cuts(rows.where(F.col("fold") < tn.FOLDS - 1))
    stored = bt.binned(rows, cuts)
    start, models, scores = bt.boost(stored, (0.1,), trees=2)
    best = tn.best_candidate(scores)
    first = bt.register_boosted(pipeline, cuts, start, models, best, tmp_dir, as_of="2026-01-01 00:00:00").first()
    again = bt.register_boosted(pipeline, cuts, start, models, best, tmp_dir).where("version = 2").first()
    assert (first.version, again.version) == (1, 2) and os.path.isdir(f"{tmp_dir}/{first.features_path}")
    docs = fx.table(spark, SF_SMALL, "documents")
    scored = {r.doc_id: r.margin for r in bt.score_documents(spark, tmp_dir, first, docs).collect()}
    assert len(scored) == docs.count()
    for r in stored.select("doc_id", bt._margin(start, models[0.1]).alias("m")).collect():
        assert scored[r.doc_id] == r.m


def test_what_is_fitted_comes_from_the_training_folds(spark):
    docs = spark.createDataFrame([(0, "a b 1", 10), (1, None, None), (2, "a", 30), (3, "a b c d 123456", 1000), (6, "z", 20), (9, "not labelled", 10 ** 6)],
                                 "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (3, 0), (6, None), (7, 1)], "doc_id long, quality int")
    pipeline, rows = bt.fit_features(docs, labels)
    got = {r.doc_id: r.x for r in rows.collect()}
    assert set(got) == {0, 1, 2, 3}  # 3 is held out
    assert got[0][:3] == pytest.approx([10 / 30, 1.0, 1.0]) and got[1][:3] == pytest.approx([20 / 30, 2 / 3, 0.5])  # means 20, 2, 0.5
    assert got[3][0] == pytest.approx(1000 / 30) and all(len(x) == 87 for x in got.values()) and sum(got[1][3:]) == 0
    with pytest.raises(ValueError, match="missing"):
        bt.fit_features(docs.drop("text"), labels)


def test_no_rows_and_one_class(spark):
    none = spark.createDataFrame([], "label long, fold int, b array<int>")
    start, models, scores = bt.boost(none)
    assert start == 0 and [r.accuracy for r in scores.collect()] == [None] * 3
    one = spark.createDataFrame([(1, k % 4, [k]) for k in range(8)], "label long, fold int, b array<int>")
    assert [r.accuracy for r in bt.boost(one, trees=1)[2].collect()] == [1.0] * 3


def test_two_runs_never_claim_one_version(spark, tmp_dir):
    got = [tn.claim_version(spark, tmp_dir, "m") for _ in range(3)]
    assert got == [1, 2, 3] and tn.claim_version(spark, tmp_dir, "m", after=10) == 11 and tn.claim_version(spark, tmp_dir, "other") == 1
