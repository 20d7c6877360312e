"""The place of every row in a total order, without one task that sees all rows.

Rows are range-partitioned, sorted and written to the shared folder; the files hold the ranges in order. A row's place
is its number in its file plus the rows of the files before it, of which there is one row per file. What was written
does not change when a task has to run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keeprule.session import new_folder

#: Copies of a row travel as blocks of at most so many.
BLOCK = 1_000


def positions(rows: DataFrame, order: list[str], column: str = "position", copies: str | None = None) -> DataFrame:
    """``rows`` with ``column``, their place from 0 on in the order of the columns ``order``.

    Rows that are equal in ``order`` follow each other in no given order; they meet in one task, so count them first
    if they may be very many: ``copies`` names a column with the number of times that a row counts. It is repeated as
    often, and its copies may lie in several ranges. Smallest first, NULL before all.
    """
    folder = new_folder(rows.sparkSession, "ordered")
    if copies:
        blocks = rows.withColumn("block", F.explode(F.expr(f"sequence(0L, (`{copies}` - 1) div {BLOCK})")))
        ordered = blocks.repartitionByRange(*order, "block").sortWithinPartitions(*order, "block")
        left = F.least(F.lit(BLOCK).cast("long"), F.col(copies) - F.col("block") * BLOCK)
        rows = ordered.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop("copy", "block", copies)
    else:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.parquet(folder)
    written = rows.sparkSession.read.schema(rows.schema).parquet(folder).select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long").alias("of file"),
        F.col("_metadata.row_index").alias("in file"),
    )
    sizes = written.groupBy("of file").agg(F.count("*").alias("rows"))  # one row per file
    before = Window.orderBy("of file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("of file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    placed = written.join(F.broadcast(starts), "of file")
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("start") + F.col("in file")).alias(column))
