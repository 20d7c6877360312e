"""Joins of a large table with a table that has one row per key.

A broadcast is used only when the lookup table was measured and found small.
Otherwise the rows are joined as they are, and adaptive execution splits the rows of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.functions.sizes import row_bytes

BROADCAST_ROWS = 5_000_000
BROADCAST_BYTES = 128 * 1024 * 1024


def table_size(frame: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of a table, in one aggregation."""
    row = frame.agg(F.count("*").alias("n"), F.coalesce(F.sum(row_bytes(frame)), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def fits_broadcast(rows: int, size: int) -> bool:
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: str | list[str],
    how: str = "inner",
    small: bool | None = None,
) -> DataFrame:
    """Join ``facts`` with ``lookup``, which has one row per key; ``how`` is inner or left.

    ``small`` tells that the caller already knows the lookup table to fit a broadcast.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup_join does not know the join type {how!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    if small is None:
        small = fits_broadcast(*table_size(lookup))
    if small:
        return facts.join(F.broadcast(lookup), keys, how)
    return facts.join(lookup, keys, how)


def rows_in_list(rows: DataFrame, ids: DataFrame, key: str, id_column: str | None = None) -> DataFrame:
    """Rows whose key is in an id list; a repeated id gives its rows once.

    The list goes into the join as it was read: a semi join ignores repeats, and with
    both inputs shuffled directly adaptive execution can split a skewed key.
    """
    wanted = ids.select(F.col(id_column or key).alias(key))
    return rows.join(wanted, key, "left_semi")


def first_match(wanted: DataFrame, rows: DataFrame, key: str, value: str) -> DataFrame:
    """For each wanted key the smallest non-null ``value`` among the matching rows.

    Repeats in ``wanted`` and its other columns stay; keys without a match are dropped.
    """
    candidates = rows.where(F.col(value).isNotNull()).select(key, value).join(wanted.select(key), key, "left_semi")
    matches = candidates.groupBy(key).agg(F.min(value).alias(value))
    return wanted.join(matches, key)


def policy_names(policies: DataFrame) -> DataFrame:
    """``policyId, name``, one row per policy."""
    return policies.where(F.col("policyId").isNotNull()).groupBy("policyId").agg(F.min("name").alias("name"))
