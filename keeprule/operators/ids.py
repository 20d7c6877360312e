"""Id lists: distinct and sorted, and packed in documents of bounded length per file.

Rows that were numbered when their file was read (``readers.read_numbered_csv``) are packed
in the order of the file. For any other table, numbering the ids of a group with one window
over the group would send a large group to one task. Here groups and ids are put in one order
over ranges (``positions``), so that a large group is spread over many; the order within a
group begins with the first digits of the id's MD5 sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.functions.text import strip
from keeprule.operators.positions import positions

BATCH_SIZE = 1_000
DIGEST_DIGITS = 3


def sorted_ids(rows: DataFrame, column: str) -> DataFrame:
    """The distinct ids, trimmed, in order."""
    return rows.select(strip(F.col(column)).alias(column)).where(F.col(column).isNotNull()).distinct().orderBy(column)


def _packed(placed: DataFrame, group: list[str], size: int) -> DataFrame:
    """Ids with a ``place`` in their group, in arrays of ``size``."""
    batch = F.call_function("div", "place", F.lit(size)).alias("batch")
    in_order = F.array_sort(F.collect_list(F.struct("place", "id")))
    return placed.select(*group, "place", "id", batch).groupBy(*group, "batch").agg(in_order["id"].alias("ids")).select(
        *group, (F.col("batch") + 1).alias("batch"), F.size("ids").cast("long").alias("n_ids"), "ids"
    )


def id_batches(rows: DataFrame, group: str, id_column: str, size: int = BATCH_SIZE) -> DataFrame:
    """``group, batch, n_ids, ids``: every id of each group, in arrays of ``size``, repeats kept.

    Only the last batch of a group is shorter. Batches count from 1. The ids are ordered when this is called.
    """
    ids = rows.select(F.col(group).alias("group"), strip(F.coalesce(id_column, F.lit(""))).alias("id"))
    counted = ids.groupBy("group", "id").agg(F.count("*").alias("copies"))
    digest = F.substring(F.md5("id"), 1, DIGEST_DIGITS)
    ordered = positions(counted.withColumn("digest", digest), ["group", "digest", "id"], "position", copies="copies")
    starts = ordered.groupBy("group").agg(F.min("position").alias("start")).withColumnRenamed("group", "start of")
    placed = ordered.join(starts, F.col("group").eqNullSafe(F.col("start of"))).select(
        "group", "id", (F.col("position") - F.col("start")).alias("place")
    )
    return _packed(placed, ["group"], size).withColumnRenamed("group", group)


def id_batches_in_order(rows: DataFrame, group: str, id_column: str, size: int = BATCH_SIZE, *shown: str) -> DataFrame:
    """As ``id_batches`` for rows with a ``position`` in their group, in the order of positions.

    ``shown`` are further columns that every group has one value of.
    """
    ids = rows.select(group, *shown, F.col("position").alias("place"), strip(F.coalesce(id_column, F.lit(""))).alias("id"))
    return _packed(ids, [group, *shown], size)


def document_fragments(batches: DataFrame, group: str, field: str = "archiveMetricIds") -> DataFrame:
    """``group, batch, fragment``: one JSON document per group, in parts that give the document behind each other.

    No row holds the ids of a whole group, however many there are.
    """
    last = batches.groupBy(group).agg(F.max("batch").alias("last")).withColumnRenamed(group, "last of")
    listed = F.to_json("ids")
    inner = F.substr(listed, F.lit(2), F.length(listed) - 2)
    begin = F.when(F.col("batch") == 1, F.concat(F.lit("{"), F.to_json(F.array(F.lit(field))).substr(2, len(field) + 2), F.lit(":["))).otherwise(",")
    end = F.when(F.col("batch") == F.col("last"), "]}").otherwise("")
    met = batches.join(last, F.col(group).eqNullSafe(F.col("last of")))
    return met.select(group, "batch", F.concat(begin, inner, end).alias("fragment"))


def id_documents(rows: DataFrame, group: str, id_column: str, size: int) -> DataFrame:
    """Arrays of at most ``size`` ids per group; a group above ``size`` ids goes on in further documents."""
    return id_batches(rows, group, id_column, size)


def as_json_documents(batches: DataFrame, field: str = "archiveMetricIds") -> DataFrame:
    """Replace the ``ids`` array by a JSON document that holds it under ``field``."""
    return batches.withColumn("document", F.to_json(F.struct(F.col("ids").alias(field)))).drop("ids")
