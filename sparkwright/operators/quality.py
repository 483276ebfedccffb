"""Declarative data-quality checks as DataFrames of violations.

Row-level checks (``not_null``, ``accepted_values``) of one table are folded into a
single aggregate, i.e. one scan; each ``unique`` check is one grouped count
(partial aggregation keeps a hot key cheap). The report is long-format:
(table_name, column_name, test_name, violations).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sparkwright.functions.useragent import BROWSER_VALUES, OS_VALUES

REPORT_COLUMNS = ("table_name", "column_name", "test_name", "violations")


@dataclass(frozen=True)
class Check:
    column: str
    test: str  # not_null | unique | accepted_values
    values: tuple[str, ...] = ()


def _violation_count(check: Check) -> Column:
    c = F.col(check.column)
    if check.test == "not_null":
        return F.count(F.when(c.isNull(), F.lit(1)))
    if check.test == "accepted_values":
        # Distinct non-NULL values outside the list.
        return F.count_distinct(F.when(~c.isin(*check.values), c))
    raise ValueError(f"not a row-level test: {check.test}")


def not_null(df: DataFrame, col: str, table: str = "") -> DataFrame:
    return dq_report(df, table, [Check(col, "not_null")])


def unique(df: DataFrame, col: str, table: str = "") -> DataFrame:
    return dq_report(df, table, [Check(col, "unique")])


def accepted_values(df: DataFrame, col: str, values, table: str = "") -> DataFrame:
    return dq_report(df, table, [Check(col, "accepted_values", tuple(values))])


def _unique_violations(df: DataFrame, table: str, col: str) -> DataFrame:
    dup_keys = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > 1))
    return dup_keys.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
        F.lit("unique").alias("test_name"), "violations")


def dq_report(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """All checks of one table -> one row per check with its violation count."""
    row_checks = [c for c in checks if c.test != "unique"]
    parts = []
    if row_checks:
        names = [f"_v{i}" for i in range(len(row_checks))]
        wide = df.agg(*[_violation_count(c).alias(n) for c, n in zip(row_checks, names)])
        stacked = F.explode(F.array(*[
            F.struct(F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test_name"),
                     F.col(n).cast("bigint").alias("violations"))
            for c, n in zip(row_checks, names)]))
        parts.append(wide.select(stacked.alias("_r")).select(
            F.lit(table).alias("table_name"), "_r.column_name", "_r.test_name", "_r.violations"))
    for c in checks:
        if c.test == "unique":
            parts.append(_unique_violations(df, table, c.column))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ObservedChecks:
    """The row checks of one table, measured by whatever job reads ``rows``: no pass of their own.

    ``rows`` is the table with the metrics attached; it must be read in full, by one branch of one job. Counts of a task that ran
    again after its output was lost would be added twice, so the number of rows is measured as well: where it isn't
    that of the table, the checks are made by ``dq_report``. That also gives the number of distinct values that break
    an ``accepted_values`` check, which a metric can't (it says whether there are any).
    """

    def __init__(self, df: DataFrame, table: str, checks: list[Check]):
        self.df, self.table, self.checks = df, table, checks
        self.row_checks = [c for c in checks if c.test != "unique"]
        self.observation = Observation()
        self.rows = df.observe(self.observation, F.count(F.lit(1)).alias("rows"), *[self._rows_breaking(c).alias(f"v{i}") for i, c in enumerate(self.row_checks)])

    @staticmethod
    def _rows_breaking(check: Check) -> Column:
        c = F.col(check.column)
        return F.count(F.when(c.isNull() if check.test == "not_null" else ~c.isin(*check.values), F.lit(1)))

    def report(self, stored: DataFrame | None = None, rows: int | None = None) -> DataFrame:
        """The report, once the job has run. ``stored``: the table as it was written, for ``unique`` and for whatever must be
        checked again (default: the table's plan). ``rows``: its number of rows, if known."""
        df = self.df if stored is None else stored
        got = self.observation.get
        again = [c for i, c in enumerate(self.row_checks) if c.test == "accepted_values" and got[f"v{i}"]]
        if got["rows"] != (df.count() if rows is None else rows):
            again = self.row_checks
        measured = [(self.table, c.column, c.test, int(got[f"v{i}"])) for i, c in enumerate(self.row_checks) if c not in again]
        out = df.sparkSession.createDataFrame(measured, "table_name string, column_name string, test_name string, violations bigint")
        again = again + [c for c in self.checks if c.test == "unique"]
        return out.unionByName(dq_report(df, self.table, again)) if again else out


# The checks declared for the staged clickstream and the customer-metrics mart.
STAGING_CHECKS = [
    *(Check(c, "not_null") for c in ("order_id", "customer_id", "order_date", "subtotal", "tax",
                                     "click_id", "session_duration_secs", "browser", "os")),
    Check("browser", "accepted_values", BROWSER_VALUES),
    Check("os", "accepted_values", OS_VALUES),
]

MART_CHECKS = [
    Check("customer_id", "not_null"),
    Check("customer_id", "unique"),
    *(Check(c, "not_null") for c in ("total_orders", "total_subtotal", "total_tax", "total_spend",
                                     "avg_session_duration_secs", "most_common_browser", "most_common_os")),
    Check("most_common_browser", "accepted_values", BROWSER_VALUES),
    Check("most_common_os", "accepted_values", OS_VALUES),
]


def assert_clean(report: DataFrame) -> None:
    """Raise when any check of a report has violations (one small action)."""
    failing = report.filter(F.col("violations") > 0).collect()
    if failing:
        raise AssertionError("data-quality checks failed: " + ", ".join(
            f"{r.table_name}.{r.column_name} {r.test_name}={r.violations}" for r in failing))
