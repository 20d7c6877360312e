"""Tables that streaming jobs append to, one folder per writer and batch.

A batch that is run again after a failure overwrites its own folder and nothing else.
The writer is the id of the streaming query, which lives in its checkpoint: a job that
starts over with a new checkpoint gets new folders.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

FOLDER_COLUMNS = ("writer", "batch_id")


def batch_folder(table: str, writer: str, batch_id: int) -> str:
    return f"{table}/writer={writer}/batch_id={batch_id}"


def read_batches(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table with its folder columns; empty while nothing was written."""
    full = T.StructType(
        [*schema.fields, T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
    )
    try:
        return spark.read.schema(full).parquet(table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def read_rows(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    return read_batches(spark, table, schema).drop(*FOLDER_COLUMNS)


def write_batch(rows: DataFrame, table: str, writer: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(batch_folder(table, writer, batch_id))


def run_available(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, str, int], None]
) -> StreamingQuery:
    """Process what has arrived since the last run, then stop.

    ``handle`` gets each batch with the writer and the batch id.
    """
    started = threading.Event()
    query_ids: list[str] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        handle(batch, query_ids[0], batch_id)

    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_ids.append(query.id)
    started.set()
    query.awaitTermination()
    return query
