"""Inserting what is absent, and setting columns by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.operators.lookups import fits_broadcast, table_size


def smallest_per_key(records: DataFrame, key: str) -> DataFrame:
    """One record per key, the smallest by all columns; records without a key are left out."""
    columns = records.columns
    return (
        records.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*columns)).alias("first"))
        .select(*[F.col(f"first.`{c}`").alias(c) for c in columns])
    )


def absent_records(records: DataFrame, target: DataFrame, key: str, small: bool | None = None) -> DataFrame:
    """The records to insert: keys the target lacks, one record per key.

    A small batch is broadcast to the scan of the target's key column, which then is not
    shuffled; only the keys found there come back to be left out.
    """
    new = smallest_per_key(records, key)
    if small is None:
        small = fits_broadcast(*table_size(records.select(key)))
    known = target.select(key)
    if small:
        known = known.join(F.broadcast(new.select(key)), key, "left_semi").distinct()
        return new.join(F.broadcast(known), key, "left_anti")
    return new.join(known, key, "left_anti")


def insert_absent(target: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """The target with the absent records added; existing rows stay as they are."""
    return target.unionByName(absent_records(records, target, key), allowMissingColumns=True)


def set_flag(table: DataFrame, flags: DataFrame, key: str, column: str) -> DataFrame:
    """Set ``column`` by key from ``flags``, adding unseen keys; other rows keep their value.

    ``table`` has one row per key.
    """
    new = (
        flags.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(column).alias("new_value"))
    )
    if column not in table.columns:
        table = table.withColumn(column, F.lit(None).cast(flags.schema[column].dataType))
    return table.join(new, key, "full").withColumn(column, F.coalesce("new_value", column)).drop("new_value")
