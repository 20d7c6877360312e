"""Row filters and column selections of the exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keeprule.functions.text import or_empty

# The states in which processing of a message has ended.
TERMINAL_STATES = ("Archived", "Duplicate", "Disposed", "Obsolete", "Unrecoverable", "Rejected")


def is_not(column: str, value) -> Column:
    """Not equal; a missing value counts as different."""
    return ~F.col(column).eqNullSafe(value)


def is_none_of(column: str, values) -> Column:
    """In none of the values; a missing value counts as different."""
    return F.col(column).isNull() | ~F.col(column).isin(*values)


def in_range(column: str, low, high) -> Column:
    """In the half-open range from ``low`` up to but without ``high``."""
    return (F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high))


def open_records(metrics: DataFrame) -> DataFrame:
    """Records still in processing, those without a state included."""
    return metrics.where(is_none_of("processing_state", TERMINAL_STATES))


def project(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The given fields in order; a missing field or value becomes empty text."""
    return rows.select(
        *[or_empty(F.col(f"`{f}`")).alias(f) if f in rows.columns else F.lit("").alias(f) for f in fields]
    )


def unwrap_source(hits: DataFrame, column: str = "_source") -> DataFrame:
    """The fields of the stored document of each search hit as columns."""
    return hits.select(f"{column}.*")


def rename_headers(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns that match exactly; others keep their name."""
    return rows.toDF(*[names.get(c, c) for c in rows.columns])


def tables_like(rows: DataFrame, pattern: str, column: str = "index") -> DataFrame:
    """Rows of the tables whose name begins with a match of the pattern, ``*`` being any text.

    On a partition column this selects folders, not rows.
    """
    return rows.where(F.col(column).rlike("^(?:" + pattern.replace("*", ".*") + ")"))


def page_after(rows: DataFrame, key: str, last, size: int) -> DataFrame:
    """The next ``size`` rows by key after ``last``; from the start if ``last`` is None."""
    if last is not None:
        rows = rows.where(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(size)


def sort_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Sort by the keys; rows with equal keys may be spread over several tasks and files."""
    return rows.withColumn("tie", F.monotonically_increasing_id()).orderBy(*keys, "tie").drop("tie")
