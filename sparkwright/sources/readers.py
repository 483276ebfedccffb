"""Readers for the pipelines' inputs.

CSV inputs are read as text by header name (a user schema would bind by position)
and typed in one projection afterwards, so a malformed value raises under ANSI
casts instead of turning into NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.paths import ENCRYPTED_SUFFIX, decrypted_name

# Python's str.strip() removes Unicode whitespace and the \x1c-\x1f separators;
# Spark's trim() only removes spaces.
_STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# The tokens pandas' CSV reader treats as missing by default.
PANDAS_NA_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null")


def strip_ws(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, _STRIP, "")


def _int_or_fail(text: Column, name: str) -> Column:
    """Signed ASCII digits -> bigint; anything else (or out of its range) fails the job.

    The check does not depend on the session's ANSI setting (a non-ANSI cast would
    return NULL instead of failing).
    """
    value = text.try_cast("bigint")
    return (F.when(text.isNull(), F.raise_error(F.lit(f"missing value in column {name}")))
            .when(~text.rlike(r"^[+-]?[0-9]+$") | value.isNull(),
                  F.raise_error(F.concat(F.lit(f"malformed integer in column {name}: "), text)))
            .otherwise(value))


def read_csv_text(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Header CSV, every column as text. A file whose header isn't that of the first fails.

    ``multi_line=True`` accepts quoted fields that contain line breaks (legal CSV, and
    what the source pipelines' readers accept); such files cannot be split, so each
    file is read by one task and large inputs should land as many files. With
    ``multi_line=False`` files are split into blocks across tasks.
    """
    return (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
            .option("inferSchema", False).option("enforceSchema", False).csv(path))


def read_applications(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """application_id, customer_name (stripped text, blank accepted) and annual_income (bigint).

    Columns are taken by header name; a missing or malformed income fails the job.
    """
    raw = read_csv_text(spark, path, multi_line)
    return raw.select(
        F.coalesce(strip_ws("application_id"), F.lit("")).alias("application_id"),
        F.coalesce(strip_ws("customer_name"), F.lit("")).alias("customer_name"),
        _int_or_fail(strip_ws("annual_income"), "annual_income").alias("annual_income"),
    )


# The declared columns of the raw clickstream source.
RAW_CLICKSTREAM_SCHEMA = {
    "order_id": "bigint", "customer_id": "bigint", "order_date": "timestamp_ntz",
    "subtotal": "decimal(12,2)", "tax": "decimal(12,2)", "click_id": "string",
    "user_agent": "string", "session_duration_secs": "int",
}


def read_clickstream(spark: SparkSession, path: str, schema: dict[str, str] | None = RAW_CLICKSTREAM_SCHEMA) -> DataFrame:
    """Raw clickstream parquet, projected to the declared columns and types (by name).

    A missing column fails at analysis time; extra columns are not read.
    """
    df = spark.read.parquet(path)
    if schema is None:
        return df
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in schema.items()])


def read_feed(spark: SparkSession, path: str | list[str], types: dict[str, str] | None = None,
              na_values: tuple[str, ...] = PANDAS_NA_VALUES, multi_line: bool = True) -> DataFrame:
    """Feed CSV: NA tokens -> NULL on every column, then ``types`` casts; others stay text.

    Without ``types`` they are inferred from all values of all files (``inferred_types``); ``types={}`` keeps all text.
    """
    raw = read_csv_text(spark, path, multi_line)
    if types is None:
        types = {c: t for c, t in inferred_types(raw, na_values).items() if t != "string"}
    return raw.select(*[na_to_null(c, na_values, types.get(c)) for c in raw.columns])


# Number forms of the feed's dialect. Words for true and false as the source's reader knows them (fixed values).
_INT = r"^[ ]*[+-]?[0-9]+[ ]*$"
_DOUBLE = r"^[ ]*[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)[ ]*$"
_BOOLEAN = ("True", "TRUE", "true", "False", "FALSE", "false")


def inferred_types(raw: DataFrame, na_values: tuple[str, ...] = PANDAS_NA_VALUES) -> dict[str, str]:
    """The narrowest type of each text column, by one aggregate over all rows.

    Every value votes for the least type that holds it: bigint, double or text; the widest vote wins. A whole number beyond
    64 bits is text. A column of truth words only, none missing, is boolean; one without any value is double. Dates are text.
    The driver gets three counts a column.
    """
    counts = []
    for i, name in enumerate(raw.columns):
        c = F.col(f"`{name}`")
        known = c.isNotNull() & ~c.isin(*na_values)
        whole = known & c.rlike(_INT)
        fits = whole & F.trim(c).try_cast("bigint").isNotNull()
        counts += [F.count(F.when(known, 1)).alias(f"n{i}"), F.count(F.when(fits, 1)).alias(f"int{i}"),
                   F.count(F.when(fits | (known & ~whole & c.rlike(_DOUBLE)), 1)).alias(f"double{i}"),
                   F.count(F.when(c.isin(*_BOOLEAN), 1)).alias(f"bool{i}")]
    got = raw.agg(F.count(F.lit(1)).alias("rows"), *counts).first()
    types = {}
    for i, name in enumerate(raw.columns):
        n = got[f"n{i}"]
        types[name] = ("double" if not n else "bigint" if got[f"int{i}"] == n else "double" if got[f"double{i}"] == n
                       else "boolean" if got[f"bool{i}"] == got["rows"] else "string")
    return types


def read_drops(spark: SparkSession, paths: list[str], types: dict[str, str],
               na_values: tuple[str, ...] = PANDAS_NA_VALUES, by: str = "file") -> DataFrame:
    """The columns of ``types`` of several CSV files, by their own headers, with ``_metadata``.

    The dialect is that of ``read_feed``. A drop is a file, or (``by="directory"``) the files of one directory, which must share
    a header. Drops are grouped by header (only the first record of one of their files is read for that) and read together, so
    column order may differ from drop to drop; a missing column, a part with another header or a malformed value fails.
    """
    drops: dict[str, list[str]] = {}
    for path in paths:
        drops.setdefault(path if by == "file" else path.rpartition("/")[0], []).append(path)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for own in drops.values():
        by_header.setdefault(tuple(read_csv_text(spark, own[0]).columns), []).extend(own)
    out = None
    for header, own in sorted(by_header.items()):
        if missing := [c for c in types if c not in header]:
            raise ValueError(f"{own[0]} lacks the columns {missing}")
        part = read_csv_text(spark, own).select(*[na_to_null(c, na_values, t if t != "string" else None) for c, t in types.items()], "_metadata")
        out = part if out is None else out.unionByName(part)
    return out


def na_to_null(name: str, na_values: tuple[str, ...], cast: str | None = None) -> Column:
    c = F.col(name)
    out = F.when(c.isin(*na_values), F.lit(None).cast("string")).otherwise(c)
    if cast:
        # Fails whatever the session's ANSI setting is.
        value = (F.trim(out) if cast != "string" else out).try_cast(cast)
        out = F.when(out.isNotNull() & value.isNull(), F.raise_error(
            F.concat(F.lit(f"malformed {cast} in column {name}: "), out))).otherwise(value)
    return out.alias(name)


def with_lineage(df: DataFrame, source_key: str, as_of) -> DataFrame:
    """``_source_file`` = basename of the key without the encryption suffix; ``_ingested_at`` = as_of."""
    return df.withColumns({
        "_source_file": F.lit(decrypted_name(source_key)),
        "_ingested_at": F.lit(as_of).cast("timestamp"),
    })


def with_file_lineage(df: DataFrame, as_of=None) -> DataFrame:
    """Lineage from the file each row was read from (multi-file reads and streams)."""
    name = F.regexp_replace(F.col("_metadata.file_name"), "\\" + ENCRYPTED_SUFFIX + "$", "")
    stamp = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    return df.withColumns({"_source_file": name, "_ingested_at": stamp})


def require_non_empty(df: DataFrame, message: str = "source table is empty") -> int:
    """Row count of ``df``; raises when it is zero."""
    n = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if n == 0:
        raise ValueError(message)
    return n
