"""Labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .langid import held_out

#: Rows that a classifier is fitted on: those whose hashed id comes first. All other counts cover all rows.
FIT_ROWS = 20_000
TOP = (1 << 62) - 1


def with_label(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(id, text, y) of the rows of ``docs`` (doc_id, text) that have a label 0 or 1; if an id has several, the
    largest. Null ids have no label."""
    own = (labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
           .withColumnRenamed("doc_id", "label_id"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    # Texts and labels are dealt by id at every size: labels have no bound that would allow a broadcast.
    return rows.join(own.hint("merge"), F.col("id") == F.col("label_id")).select("id", "text", "y")


def for_learning(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int) -> DataFrame:
    """``with_label`` of the documents whose crc32(doc_id) modulo ``parts`` isn't ``part``."""
    return with_label(docs.where(~held_out(F.col("doc_id"), parts, part)),
                      labels.where(~held_out(F.col("doc_id"), parts, part)), label)


def in_front(id_: Column, n: int, total: int) -> Column:
    """Whether a row's hashed id lies in twice the share that ``n`` rows are of ``total``: what a sort of the first ``n`` then
    gathers follows ``n``, not the rows."""
    return hashed(id_) < int(TOP * min(1.0, 2 * n / max(1, total)))


def hashed(id_: Column) -> Column:
    return F.xxhash64(id_).bitwiseAND(TOP)


def first_rows(rows: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows of (id, text, y), those whose hashed id comes first, dealt out again: the sort leaves them in
    one task."""
    return rows.orderBy(hashed(F.col("id")), "id", F.xxhash64("text")).limit(n).repartition(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
