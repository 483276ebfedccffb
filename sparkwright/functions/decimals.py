"""Money and rounding helpers that stay exact.

Sums are taken over decimals (never doubles), so they do not depend on the order in
which partial aggregates are merged. Rounded means are computed from the exact sum
and count with integral division and HALF_UP rounding: a decimal ``avg`` rounds
twice (first to its own scale, then to the target) and a double ``avg`` is inexact,
and both can move a value that sits next to a ``.xx5`` boundary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"  # of sums


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return col_of(c).cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """Exact sum of a decimal (or integer) column as decimal(38,2)."""
    return F.sum(col_of(c).cast(TOTAL)).cast(TOTAL)


def rounded_mean(sql_expr: str, source_scale: int = 0, target_scale: int = 2) -> Column:
    """HALF_UP(mean(expr), target_scale), exact; NULL when the group has no value.

    ``sql_expr`` is a SQL expression over the input row; ``source_scale`` is the
    number of decimal places its values carry (0 for integers, 2 for money).
    Result type: ``decimal(18, target_scale)``.
    """
    if target_scale < source_scale:
        raise ValueError("target_scale must be >= source_scale")
    unscaled = f"CAST(({sql_expr}) * {10 ** source_scale} AS DECIMAL(38,0))"
    p = f"SUM({unscaled})"
    q = f"CAST(COUNT({sql_expr}) AS DECIMAL(38,0))"
    m = 10 ** (target_scale - source_scale)
    units = (f"CASE WHEN {p} >= 0 THEN (2 * {p} * {m} + {q}) div (2 * {q}) "
             f"ELSE -((-2 * {p} * {m} + {q}) div (2 * {q})) END")
    step = "0." + "0" * (target_scale - 1) + "1" if target_scale else "1"
    return F.expr(f"CASE WHEN COUNT({sql_expr}) > 0 THEN "
                  f"CAST(CAST({units} AS DECIMAL(38,0)) * {step}BD AS DECIMAL(18,{target_scale})) END")
