"""Growth of a collection over time, from ids that begin with their creation second."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.functions.instants import object_id_floor, object_id_month


def growth_by_month(rows: DataFrame, start: str | datetime, end: str | datetime, key: str = "_id") -> DataFrame:
    """``month, doc_count`` for ids from ``start`` up to the first id of the second ``end``.

    The bounds are compared as id text, so the scan can skip files by their key range.
    """
    in_time = (F.col(key) >= object_id_floor(start)) & (F.col(key) <= object_id_floor(end))
    return (
        rows.where(in_time)
        .groupBy(object_id_month(F.col(key)).alias("month"))
        .agg(F.count("*").alias("doc_count"))
        .orderBy("month")
    )
