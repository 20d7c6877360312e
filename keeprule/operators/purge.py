"""Planning of purges: what each chunk holds, what a purge would remove, what it would keep.

Nothing here deletes from a source; the rows to keep are for writing to a new place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keeprule.functions.sizes import row_bytes
from keeprule.functions.text import megabytes
from keeprule.operators.ranges import counts_in_ranges


def chunk_inventory(rows: DataFrame, chunks: DataFrame, key: str | list[str]) -> DataFrame:
    """Each chunk ``shard, chunk_id, min_key, max_key`` with ``n_rows, n_bytes, size_text``.

    The key is of any ordered type, or a list of columns; the bounds of a compound key are structs of such columns. A
    NULL bound is open. Chunks without rows are listed with zeros.
    """
    sized = rows.withColumn("n_bytes", row_bytes(rows))
    if not isinstance(key, str):
        key = F.struct(*key)
    counts = counts_in_ranges(sized, key, chunks, ["shard", "chunk_id"], "min_key", "max_key", ["n_bytes"])
    listed = chunks.select("shard", "chunk_id", "min_key", "max_key").join(counts, ["shard", "chunk_id"], "left")
    return listed.withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_rows", "n_bytes")}
    ).withColumn("size_text", megabytes(F.col("n_bytes")))


def chunk_totals(inventory: DataFrame) -> DataFrame:
    """Chunks, rows and bytes per shard, and over all shards in a row with shard ``(all)``."""
    totals = inventory.rollup("shard").agg(
        F.grouping("shard").alias("is_total"),
        F.count("*").alias("n_chunks"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"),
    )
    shard = F.when(F.col("is_total") == 1, F.lit("(all)")).otherwise(F.col("shard"))
    return totals.select(
        shard.alias("shard"), "n_chunks", "n_rows", "n_bytes", megabytes(F.col("n_bytes")).alias("size_text")
    )


def _meets(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def purge_dry_run(rows: DataFrame, predicate: Column) -> DataFrame:
    """One row ``n_removed, n_kept``: what a purge by the predicate would do."""
    return rows.agg(
        F.count_if(_meets(predicate)).alias("n_removed"), F.count_if(~_meets(predicate)).alias("n_kept")
    )


def purge_kept(rows: DataFrame, predicate: Column) -> DataFrame:
    """The rows a purge would leave: those for which the predicate is false or unknown."""
    return rows.where(~_meets(predicate))


def write_kept(rows: DataFrame, predicate: Column, path: str) -> None:
    """Write the rows a purge would leave to a new place, which must not exist yet."""
    purge_kept(rows, predicate).write.mode("errorifexists").parquet(path)
