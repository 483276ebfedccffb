"""Aggregate building blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def most_common(col: str, labels: tuple[str, ...] | None = None) -> Column:
    """Most frequent non-NULL value of ``col`` in the group; ties go to the smallest value.

    With ``labels`` (the complete set of values ``col`` can take, as for a rule-table
    classification) this is one count per label and an argmax, all fixed-width
    buffers in a code-generated hash aggregate. Without it, ``mode`` is used; its
    per-group value map lives in an object hash aggregate, which falls back to
    sort-based aggregation when a task sees many groups.
    """
    if labels is None:
        return F.mode(col, deterministic=True)
    ordered = sorted(labels)
    candidates = [
        F.struct(F.count(F.when(F.col(col) == F.lit(label), F.lit(1))).alias("n"),
                 F.lit(len(ordered) - i).alias("pref"),   # smaller label wins a tie
                 F.lit(label).alias("v"))
        for i, label in enumerate(ordered)
    ]
    best = F.array_max(F.array(*candidates))
    return F.when(best["n"] > 0, best["v"])
