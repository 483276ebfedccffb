"""Every operator and pipeline stage on awkward rows: nulls, empty and very long texts, ties, repeated rows, clashing
column names, empty tables; and against brute force."""

import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkwright.llm import contamination, exact_dedup, langid, lines, passages, pieces, pii, quality, queries, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, print long, line int, n int, spans string"
WORDS = "the of and with river stone market quiet letter garden window bottle silver morning engine forest paper shadow".split()


def words(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7919 + k * k * 31 + k * seed) % len(WORDS)] + ("" if k % 5 else str((seed * 131 + k) % 977)) for k in range(n))


ITEM = words(5, 40)
ROWS = [
    (1, words(1, 80)), (2, words(1, 80).upper()), (3, words(1, 80)), (3, words(1, 80)),  # copies and a repeated row
    (4, words(2, 90) + "\n" + words(3, 30) + "\n\n" + words(3, 30)), (5, words(4, 70) + "\n" + words(3, 30) + " end"),
    (6, words(6, 30) + " " + ITEM + " " + words(7, 30)), (7, ITEM[:60]),
    (8, ""), (9, None), (None, None), (None, words(8, 20)), (10, " \n\t "), (11, "é漢😀 ▁x\x00\x01 ÀÀ"), (12, "12 34!"),
    (13, "x" * 150_000), (14, words(9, 12_000)), (15, "a " * 3000), (16, "mail a.b@c.example.org or +1 (234) 567-8901, 10.0.0.1, 4111 1111 1111 1111"),
    (17, words(3, 30)), (-4, words(2, 90) + " tail"), (18, "\n".join([words(3, 30)] * 4)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None, "xx"][k % 3] if t else None, "s", None if t is None else len(t), k, "k", 1, 2, 3, "s") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM, 0), (2, "", 0), (None, ITEM, 0), (3, None, 0), (4, "quiet letter no such", 0), (5, "É 1 é", 0), (10, ITEM, 0)],
                                 "item_id long, text string, id int")


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def folded(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_exact_groups(docs, none):
    groups = {}
    for i, t in ROWS:
        groups.setdefault(folded(t), []).append(i)
    expected = []
    for i, t in ROWS:
        own = groups[folded(t)]
        keep = max((x for x in own if x is not None), default=None)
        expected.append((i, keep, len(own), i == keep, hashlib.sha256(folded(t).encode()).hexdigest()))
    got = sorted_rows(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(expected, key=repr)
    assert exact_dedup.exact_groups(none).count() == 0


def test_pieces_give_back_every_text(docs, none):
    back = pieces.decode(pieces.encode(docs))
    assert sorted_rows(back, "doc_id", "decoded") == sorted_rows(docs, "doc_id", "text")
    assert back.where("pieces is null").count() == sum(t is None for _, t in ROWS)
    assert pieces.decode(pieces.encode(none)).count() == 0


def test_pii(docs, none):
    got = pii.sanitise(docs).select("doc_id", "base", "sanitised").collect()
    expected = Counter((i, tuple(pii.brute_force(t))) for i, t in ROWS)
    assert Counter((r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["base"])) for r in got) == expected
    assert [r["sanitised"] for r in got if r["doc_id"] == 16] == ["mail [EMAIL] or [PHONE], [IP], [CARD]"]
    assert pii.sanitise(none).count() == 0


def test_language(docs, none):
    found = langid.language_id(docs)
    assert found.count() == len(ROWS) and set(docs.columns) < set(found.columns)
    for r in found.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") != letters and (r["score"] > 0) == letters and 0 <= r["score"] <= 1
    assert langid.language_id(none).count() == 0
    unlabelled = langid.language_id(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_simhash(docs, none):
    found = simhash.simhash_groups(docs)
    ids = {k: v for k, v in enumerate(ROWS)}
    expected = simhash.brute_force([(10 ** 9 if i is None else i, t) for i, t in ids.values()])
    got = found.select(F.coalesce("doc_id", F.lit(10 ** 9)).alias("doc_id"), "fingerprint", F.coalesce("component_id", F.lit(10 ** 9)).alias("c"))
    assert sorted_rows(got, "doc_id", "fingerprint", "c") == sorted(expected, key=repr)
    kept = simhash.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} - {None} == {e[2] for e in expected} - {10 ** 9}
    assert simhash.simhash_groups(none).count() == 0 and simhash.first_of_groups(none).count() == 0


def test_quality_and_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(i, int(i % 2), int(i % 3 == 0), 1) for i, _ in ROWS if i is not None] + [(None, 1, 1, 1), (99, None, None, 1), (1, 0, 1, 1)],
                                   "doc_id long, quality int, toxic int, text int").drop("text")
    no_labels = labels.limit(0)
    for run in (quality.quality, toxicity.toxicity):
        for given in (labels, no_labels):
            found = run(docs, given).collect()
            assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in found)
        assert {r["score"] for r in found} == {0.5}
        assert run(none, labels).count() == 0


def test_passages(docs, none):
    found = {r["doc_id"]: r for r in passages.repeated_passages(docs, words=30).collect()}
    assert {1, 2, 3, 4, -4, 6} - set(found) <= {6} and not {8, 9, 10, 12, 13, None} & set(found)
    assert found[1]["class_id"] == found[3]["class_id"] == 1
    assert passages.repeated_passages(none).count() == 0


def test_every_document_has_a_row(docs, none):
    own = passages.repeated_passages(docs, words=30)
    every = passages.with_all(docs, own)
    assert every.columns == own.columns and every.count() == docs.count()
    rest = every.join(own.select("doc_id"), "doc_id", "left_anti").collect()
    assert None in {r["doc_id"] for r in rest} and {8, 9, 10, 12, 13} <= {r["doc_id"] for r in rest}
    assert all(r["class_id"] == r["doc_id"] and r["n_links"] == r["n_repeated"] == 0 and r["passages"] == [] for r in rest)
    assert passages.with_all(none, passages.repeated_passages(none)).count() == 0


def test_contamination(docs, none, benchmark):
    found = contamination.contamination(docs, benchmark)
    got = found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("s"), "contaminated")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect() if r["item_id"] is not None]
    assert sorted_rows(got, *got.columns) == sorted(contamination.brute_force(ROWS, items), key=repr)
    assert contamination.contamination(none, benchmark).count() == 0
    assert contamination.contamination(docs, benchmark.limit(0)).where("contaminated or n_hit > 0").count() == 0


def test_lines(docs, none):
    unique = docs.where("doc_id is not null and id <> 3")  # the repeated row is the same occurrence
    found = lines.dedup_lines(unique)
    assert found.columns == [*docs.columns, "n_lines", "n_removed"]
    rows = [(r["doc_id"], r["text"]) for r in unique.collect()]
    assert sorted_rows(found, "doc_id", "text", "n_lines", "n_removed") == sorted(lines.brute_force(rows), key=repr)
    every = lines.dedup_lines(docs)
    assert every.count() == len(ROWS)
    assert [r["n_removed"] for r in every.where("doc_id = 3").collect()] == [1, 1]
    assert lines.dedup_lines(none).count() == 0


def test_pipeline_stages(spark, docs, none, tmp_dir, benchmark):
    benchmark.select("item_id", "text").write.parquet(os.path.join(tmp_dir, "benchmark.parquet"))
    for given in (docs, none):
        now = given.select("doc_id", "text", "lang", "source", "n_chars")
        columns, count = now.columns, now.count()
        for name, stage in corpus_pipeline.STAGES:
            now = corpus_pipeline.written(stage(spark, now, tmp_dir), name)
            assert now.count() <= count
            count = now.count()
            if name != "sentencepiece":
                assert now.columns == columns
        if given is docs:
            ids = [r["doc_id"] for r in now.collect()]
            assert 1 in ids and 6 not in ids and 9 not in ids and 14 in ids and ids.count(None) <= 1
            texts = {r["doc_id"]: r["decoded"] for r in now.collect()}
            assert texts[14] == words(9, 12_000) and texts[1] == words(1, 80)
            assert sum(t == "" for t in texts.values()) <= 1  # of the texts that lost all lines, as copies, one stays
        else:
            assert count == 0


def test_stages_keep_clashing_columns(spark, tmp_dir, benchmark):
    benchmark.select("item_id", "text").write.parquet(os.path.join(tmp_dir, "benchmark.parquet"))
    names = ["score", "lang_pred", "languages", "held_out", "n_lines", "n_removed", "keep", "root", "contaminated", "fingerprint", "component_id", "n.dot"]
    rows = [(k, words(50 + k, 40), "en", "s", 1, *[f"{n}{k}" for n in names]) for k in range(6)]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long", *[f"`{n}` string" for n in names]]))
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.written(stage(spark, now, tmp_dir), name)
        assert now.columns == docs.columns
    got = {r["doc_id"]: r for r in now.collect()}
    assert len(got) >= 4 and all(got[k][n] == f"{n}{k}" for k in got for n in names)


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
