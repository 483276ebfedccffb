"""Connected groups of links, by alternating large-star and small-star steps (Kiveris et al. 2014).

Every step is a grouped minimum and a join, so a node with many links is combined before the shuffle and its
join partition can be split; after each round the links are written to the shared folder, which cuts the
lineage. Nothing but two numbers a round (row count, checksum) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import local_roots, written


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition, in blocks, replaced by links to the smallest node of each block's groups."""
    held: list[pa.RecordBatch] = []

    def stars() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        node, root = local_roots(t.column("a").to_numpy(), t.column("b").to_numpy())
        own = node != root
        return pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(root[own])], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 1_000_000:
            yield stars()
            held = []
    if held:
        yield stars()


def star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a > b) after one star step."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    near = both.join(least, F.col("a") == F.col("u"))
    if large:  # neighbours above u hang on the least of all
        out = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # u and its neighbours below it hang on the least of them
        out = near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b: long), root being the smallest node that can be
    reached; a root is no row of its own. Links with a null end are dropped, an empty table gives an empty one."""
    schema = "a long, b long"
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        "a <> b and a is not null and b is not null").mapInArrow(contract, schema)
    now = written(now.distinct(), name)

    def summary(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = summary(now)
    while before[0]:
        now = written(star(star(now, True), False), name)
        after = summary(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
