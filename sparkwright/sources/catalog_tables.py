"""Inputs kept as bucketed catalog tables.

A table bucketed and sorted by a key is stored as that key's shuffle would leave it: aggregates, windows and joins by the
key read it without an exchange. It pays for tables that are read by the same key again and again. One bucket is one
task, so a key with a large share of all rows makes its bucket long: there the plain aggregates, which
combine in the tasks before they shuffle, are the better choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.sources.readers import RAW_CLICKSTREAM_SCHEMA


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Stores ``df`` as the catalog table ``name``, a sorted file for each bucket of ``key``, and returns a read of it."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def read_clickstream_table(spark: SparkSession, name: str, schema: dict[str, str] = RAW_CLICKSTREAM_SCHEMA) -> DataFrame:
    """A raw clickstream catalog table, projected to the declared columns and types; missing columns fail."""
    return spark.table(name).select(*[F.col(c).cast(t).alias(c) for c, t in schema.items()])
