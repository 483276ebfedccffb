"""Measured sizes, for broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A join side up to this many bytes (measured) is broadcast.
BROADCAST_BYTES = 32 * 1024 ** 2

# In-memory bytes per value of fixed-width types; strings and binaries add their length.
_FIXED_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4,
                "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def row_bytes(df: DataFrame) -> Column:
    """Per-row size: 8 bytes of row overhead, fixed widths, string / binary lengths."""
    total = F.lit(8)
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if dtype in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif dtype.startswith("decimal"):
            total = total + 16
        else:
            total = total + _FIXED_WIDTH.get(dtype, 16)
    return total


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if one aggregate over it measures at most ``most`` bytes; otherwise as it is."""
    size = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return F.broadcast(df) if size <= most else df
