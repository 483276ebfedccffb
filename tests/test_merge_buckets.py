"""Keyed merges into hash buckets: what is read, what is written, and the rows."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from sparkwright.sinks import tables as sk


def files_of(path, version):
    return {os.path.basename(os.path.dirname(f)) for f in glob.glob(f"{path}/v={version:06d}/*/*.parquet")}


@pytest.mark.parametrize("broadcast_bytes", [sk.BROADCAST_BYTES, 0])
def test_one_key_rewrites_one_bucket(spark, tmp_dir, broadcast_bytes):
    path = os.path.join(tmp_dir, "t")
    sk.merge_table(spark, path, spark.range(1000).selectExpr("id AS k", "'v' AS v"), ["k"], buckets=16)
    assert len(files_of(path, 1)) == 16
    one = spark.createDataFrame([(7, "new")], "k long, v string")
    sk.merge_table(spark, path, one, ["k"], broadcast_bytes=broadcast_bytes)
    bucket = one.select(sk.bucket_of(["k"], 16)).first()[0]
    assert files_of(path, 2) == {f"key_bucket={bucket}"}
    got = {r.k: r.v for r in sk.read_table(spark, path).collect()}
    assert len(got) == 1000 and got[7] == "new" and set(got.values()) == {"v", "new"}
    assert {r.k: r.v for r in sk.read_table(spark, path, version=1).collect()}[7] == "v"
    # A key of a bucket that is empty so far, and one that is only added.
    sk.merge_table(spark, path, spark.createDataFrame([(5000, "x"), (7, "newer")], "k long, v string"), ["k"], broadcast_bytes=broadcast_bytes)
    got = {r.k: r.v for r in sk.read_table(spark, path).collect()}
    assert len(got) == 1001 and got[7] == "newer" and got[5000] == "x"


@pytest.mark.parametrize("broadcast", [True, False])
def test_the_target_is_scanned_once(spark, tmp_dir, broadcast):
    target, source = spark.range(100).selectExpr("id AS k", "'v' AS v"), spark.range(5).selectExpr("id AS k", "'w' AS v", "id AS _s_number")
    target.write.parquet(f"{tmp_dir}/t")
    source.write.parquet(f"{tmp_dir}/s")
    source = spark.read.parquet(f"{tmp_dir}/s")
    merged = sk.merge_frames(spark.read.parquet(f"{tmp_dir}/t"), source if broadcast else source.drop("_s_number"), ["k"],
                             broadcast_source=broadcast, buckets=4)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2, plan  # the target once, the source once
    physical = merged._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in physical) == broadcast and physical.count("Exchange hashpartitioning") == (0 if broadcast else 2)


@pytest.mark.parametrize("broadcast_bytes", [sk.BROADCAST_BYTES, 0])
def test_merges_equal_a_plain_merge(spark, tmp_dir, broadcast_bytes):
    draw = random.Random(5)
    path = os.path.join(tmp_dir, "t")
    plain, unkeyed = {}, []
    for version in range(3):
        rows = [(k if draw.random() > 0.1 else None, f"p{k % 3}", f"s{version}-{k}", float(k)) for k in draw.sample(range(300), 120)]
        source = spark.createDataFrame(rows, "k long, p string, a string, x double")
        sk.merge_table(spark, path, source, ["k", "p"], update_columns=["x"], set_on_match={"a": F.concat(F.col("_t_a"), F.lit("+"))},
                       broadcast_bytes=broadcast_bytes, buckets=8)
        for k, p, a, x in rows:
            if k is None:
                unkeyed.append((k, p, a, x))
            else:
                plain[k, p] = (k, p, plain[k, p][2] + "+", x) if (k, p) in plain else (k, p, a, x)
        got = sorted(map(tuple, sk.read_table(spark, path).collect()), key=str)
        assert got == sorted([*plain.values(), *unkeyed], key=str)


def test_many_bitmaps(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sk, "_BITS", 32)  # several bitmaps for few rows
    path = os.path.join(tmp_dir, "t")
    sk.merge_table(spark, path, spark.range(0, 200, 2).selectExpr("id AS k", "'t' AS v"), ["k"])
    sk.merge_table(spark, path, spark.range(0, 200).selectExpr("id AS k", "'s' AS v"), ["k"])
    got = sorted(r.k for r in sk.read_table(spark, path).collect())
    assert got == list(range(200)) and {r.v for r in sk.read_table(spark, path).collect()} == {"s"}


def test_only_rows_without_a_key(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    none = spark.createDataFrame([(None, "a")], "k long, v string")
    for _ in range(2):
        sk.merge_table(spark, path, none, ["k"])
    assert [tuple(r) for r in sk.read_table(spark, path).collect()] == [(None, "a")] * 2
    sk.merge_table(spark, path, spark.createDataFrame([(1, "b"), (None, "c")], "k long, v string"), ["k"])
    assert sorted(map(str, (tuple(r) for r in sk.read_table(spark, path).collect()))) == ["(1, 'b')", "(None, 'a')", "(None, 'a')", "(None, 'c')"]


@pytest.mark.parametrize("broadcast_bytes", [sk.BROADCAST_BYTES, 0])
def test_keys_of_another_type_find_their_buckets(spark, tmp_dir, broadcast_bytes):
    path = os.path.join(tmp_dir, "t")
    sk.merge_table(spark, path, spark.range(100).selectExpr("id AS k", "'v' AS v"), ["k"], buckets=16)
    sk.merge_table(spark, path, spark.range(90, 110).selectExpr("CAST(id AS INT) AS k", "'w' AS v"), ["k"], broadcast_bytes=broadcast_bytes)
    table = sk.read_table(spark, path)
    assert dict(table.dtypes)["k"] == "bigint" and sorted(r.k for r in table.collect()) == list(range(110)) and table.where("v = 'w'").count() == 20
