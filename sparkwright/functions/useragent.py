"""User-agent classification as ordered, case-insensitive substring rules.

A rule table is evaluated top to bottom and the first matching rule wins, which is
why the order of the tables below is part of their meaning (an Edge agent also
carries ``Chrome/`` and ``Safari/``; an Android agent also carries ``Linux``).
Everything compiles to one chained ``CASE WHEN`` over ``lower(user_agent)``, so
it stays inside whole-stage codegen; a NULL agent matches nothing and falls to
``Other``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    label: str
    any_of: tuple[str, ...]
    none_of: tuple[str, ...] = ()


# ---------------------------------------------------------------------------
# These labels, tokens and their order must equal the
# classification of the source pipelines exactly.
# ---------------------------------------------------------------------------
OTHER = "Other"

BROWSER_RULES = {
    "A": (
        Rule("Edge", ("Edg/",)),
        Rule("Chrome", ("Chrome/",), ("Chromium",)),
        Rule("Firefox", ("Firefox/",)),
        Rule("Safari", ("Safari/",), ("Chrome",)),
        Rule("Opera", ("Opera", "OPR/")),
    ),
    "B": (
        Rule("Edge", ("Edg/",)),
        Rule("Chrome", ("Chrome/",)),
        Rule("Firefox", ("Firefox/",)),
        Rule("Safari", ("Safari/",)),
        Rule("Opera", ("Opera", "OPR/")),
    ),
}

OS_RULES = {
    "A": (
        Rule("Windows", ("Windows NT",)),
        Rule("macOS", ("Macintosh", "Mac OS X")),
        Rule("Android", ("Android",)),
        Rule("iOS", ("iPhone", "iPad")),
        Rule("Linux", ("Linux",)),
    ),
    "B": (
        Rule("Windows", ("Windows NT",)),
        Rule("macOS", ("Macintosh",)),
        Rule("Android", ("Android",)),
        Rule("iOS", ("iPhone", "iPad")),
        Rule("Linux", ("Linux",)),
    ),
}

# Fixed values.
BROWSER_VALUES = ("Chrome", "Safari", "Firefox", "Edge", "Opera", "Other")
# Fixed values.
OS_VALUES = ("Windows", "macOS", "Android", "iOS", "Linux", "Other")


def _rule_predicate(lowered: Column, rule: Rule) -> Column:
    hit = None
    for token in rule.any_of:
        term = lowered.contains(token.lower())
        hit = term if hit is None else (hit | term)
    for token in rule.none_of:
        hit = hit & ~lowered.contains(token.lower())
    return hit


def classify(col: Column | str, rules: tuple[Rule, ...], default: str = OTHER) -> Column:
    """First matching rule's label, else ``default`` (NULL input -> ``default``)."""
    c = F.col(col) if isinstance(col, str) else col
    lowered = F.lower(c)
    expr = None
    for rule in rules:
        pred = F.coalesce(_rule_predicate(lowered, rule), F.lit(False))
        expr = F.when(pred, F.lit(rule.label)) if expr is None else expr.when(pred, F.lit(rule.label))
    return expr.otherwise(F.lit(default))


def parse_browser(col: Column | str, variant: str = "A") -> Column:
    return classify(col, BROWSER_RULES[variant.upper()])


def parse_os(col: Column | str, variant: str = "A") -> Column:
    return classify(col, OS_RULES[variant.upper()])

