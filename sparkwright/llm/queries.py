"""The registered queries of this subpackage (``opN_<name>``) and their SQL.

Each query applies its operator, with production parameters, to its whole table and derives the contract's
columns from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations as op13
from . import contamination as op9
from . import exact_dedup as op1
from . import langid as op4
from . import lines as op10
from . import passages as op7
from . import pieces as op2
from . import pii as op3
from . import quality as op6
from . import resampling as op12
from . import simhash as op5
from . import topk as op11
from . import toxicity as op8
from .common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.exact_groups(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = op2.encode(table(spark, sf_dir, "documents"))
    return op2.decode(encoded).select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "decoded")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op3.sanitise(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(kind) for kind in op3.PATTERNS], F.sha2(op3.spelled("base"), 256).alias("base_sha256"),
                        op3.spelled("spans").alias("spans"), "sanitised")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return op4.language_id(docs).select(
        "doc_id", "held_out", "lang_pred", "score", F.array_join("languages", ",").alias("languages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.simhash_groups(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("attention")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = op7.with_all(docs, op7.repeated_passages(docs))
    spans = F.array_join(F.transform("passages", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", "class_id", "n_links", "n_repeated", spans.alias("passages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op9.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op11.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select("query_id", "rank", F.col("candidate_id").alias("vec_id"), "score")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op12.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("__features").alias("n_features"), F.col("__weight").alias("weight"),
                        F.col("__score").alias("score"), F.col("__rank").alias("rank"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_pii": op3_pii,
    "op4_language_id": op4_language_id,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_contamination": op9_contamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_topk": op11_topk,
    "op12_resampling": op12_resampling,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY body)""",
    "op9_contamination": """
WITH RECURSIVE lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
own AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
grams AS (
  SELECT item, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM own, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS r(i) WHERE len(w) > 0),
places AS (
  SELECT l.doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM lowered l, (SELECT DISTINCT size FROM grams) s, unnest(range(1, len(w) - size + 2)) AS r(i)),
hits AS (SELECT p.doc_id, p.i, p.size, grams.item FROM places p JOIN grams USING (size, g)),
words AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hits, unnest(range(0, size)) AS u(o) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM lowered LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op11_topk": """
WITH whole AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id ASC NULLS LAST) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op12_resampling": """
WITH crc AS (
  SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
words AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
own AS (SELECT place, f, count(*) AS n FROM (SELECT place, unnest(w) AS f FROM words) GROUP BY ALL),
wanted AS (
  SELECT f, count(*) AS n FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS f FROM benchmark) GROUP BY f),
spelled AS (
  SELECT f, list_transform(range(1, CAST(length(h) AS BIGINT), 2), lambda i: 16 * (instr('0123456789ABCDEF', h[i]) - 1) + instr('0123456789ABCDEF', h[i + 1]) - 1) AS b
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM own UNION SELECT f FROM wanted))),
bucket AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, b), lambda a, x: xor(t[xor(a, x) % 256 + 1], a >> 8)), 4294967295) % 10000 AS k
  FROM spelled, crc),
in_docs AS (SELECT k, sum(n) AS s FROM own JOIN bucket USING (f) GROUP BY k),
in_target AS (SELECT k, sum(n) AS t FROM wanted JOIN bucket USING (f) GROUP BY k),
mass AS (SELECT (SELECT coalesce(sum(s), 0) FROM in_docs) AS all_s, (SELECT coalesce(sum(t), 0) FROM in_target) AS all_t),
gain AS (
  SELECT k, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE))
                                 / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM in_docs LEFT JOIN in_target USING (k), mass),
weights AS (SELECT place, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight FROM own JOIN bucket USING (f) JOIN gain USING (k) GROUP BY place),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256(concat('2024:', doc_id)), 1, 8))::BIGINT AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (place)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
         count(*) FILTER (WHERE n_words >= 20) OVER () AS eligible FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank FROM placed""",
    "op13_collocations": """
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
runs AS (
  SELECT lang, w, lead(w, 1) OVER piece_order AS w2, lead(w, 2) OVER piece_order AS w3
  FROM (SELECT piece, lang, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM pieces)
  WINDOW piece_order AS (PARTITION BY piece ORDER BY i)),
f AS (
  SELECT lang, 1 AS k, w AS phrase, count(*) AS f FROM runs GROUP BY ALL
  UNION ALL SELECT lang, 2, w || ' ' || w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a FROM f WHERE k > 1 AND f >= 10),
inner_parts AS (
  SELECT c.lang, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates c, (VALUES (2)) AS sizes(m), unnest(range(1, c.k - m + 2)) AS r(i) WHERE c.k > m GROUP BY ALL),
left_over AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_parts USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
parts AS MATERIALIZED (
  SELECT lang, phrase, a, i, array_to_string(string_split(phrase, ' ')[1:i], ' ') AS head, array_to_string(string_split(phrase, ' ')[i + 1:], ' ') AS tail
  FROM left_over c, unnest(range(1, c.k)) AS r(i)),
headed AS MATERIALIZED (SELECT c.*, x.f AS l FROM parts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head),
cuts AS (
  SELECT c.lang, c.phrase, c.a, i, l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (l::HUGEINT * y.f) AS score
  FROM headed c JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
}
