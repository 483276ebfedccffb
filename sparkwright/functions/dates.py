"""Date-as-text predicates and conversions.

Dates in the feed arrive as text in mixed formats. A value is "good" when it parses
as ISO ``yyyy-MM-dd``; the only repair the feed knows is re-reading a value as US
``MM/dd/yyyy`` and printing it as ISO. An explicit pattern is always passed: a
pattern-less parse also accepts forms such as ``2024`` (read as 2024-01-01).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted ISO form and the one repairable form of the feed.
ISO_PATTERN = "yyyy-MM-dd"
US_PATTERN = "MM/dd/yyyy"

# Cheap shape tests that accept a superset of what each pattern can parse. A failed
# parse costs a JVM exception per value, so text that cannot match (junk, the other
# format) is rejected by the regex and only plausible values reach the parser.
_ISO_SHAPE = r"^\s*[+-]?[0-9]+-[0-9]+-[0-9]+\s*$"
_US_SHAPE = r"^\s*[0-9]+/[0-9]+/[+-]?[0-9]+\s*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_iso_date(c: Column | str) -> Column:
    """True when the text parses as ``yyyy-MM-dd``; False for NULL and junk."""
    c = _c(c)
    return F.coalesce(c.rlike(_ISO_SHAPE) & F.try_to_date(c, ISO_PATTERN).isNotNull(), F.lit(False))


def us_to_iso(c: Column | str) -> Column:
    """``MM/dd/yyyy`` text -> ``yyyy-MM-dd`` text; NULL when it does not parse."""
    c = _c(c)
    return F.date_format(F.when(c.rlike(_US_SHAPE), F.try_to_date(c, US_PATTERN)), ISO_PATTERN)


def any_bad(cols: list[str]) -> Column:
    """True when at least one of the date columns is not ISO."""
    pred = None
    for c in cols:
        term = ~is_iso_date(c)
        pred = term if pred is None else (pred | term)
    return pred
