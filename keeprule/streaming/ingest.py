"""Files dropped in a folder, taken into a table that keeps the first record of each key."""

from __future__ import annotations

from dataclasses import dataclass, field
from time import monotonic, sleep

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keeprule.functions.text import strip
from keeprule.operators.filters import rename_headers
from keeprule.operators.upserts import absent_records
from keeprule.sources.readers import csv_options, text_schema
from keeprule.streaming.keyed import KeyedTable
from keeprule.streaming.tables import run_available, write_batch

# Headers of dropped files and the names they are stored under.
HEADER_NAMES = {"gcid": "gcId"}


@dataclass(frozen=True)
class DropFolder:
    """A folder of CSV files with the same header, and the table they go to.

    Records without a key, or with a blank one, go to ``rejects``. Taken files stay,
    are moved to ``archive``, or are deleted; the last ones by the next run.
    """

    folder: str
    headers: list[str]
    table: str
    rejects: str
    checkpoint: str
    key: str = "gcId"
    names: dict[str, str] = field(default_factory=lambda: dict(HEADER_NAMES))
    archive: str | None = None
    delete: bool = False
    max_files_per_batch: int | None = None
    #: Buckets of the table, and after how many batches they are brought up to date.
    buckets: int = 64
    fold_after: int = 8

    @property
    def schema(self) -> T.StructType:
        return text_schema([self.names.get(h, h) for h in self.headers])

    @property
    def keyed(self) -> KeyedTable:
        return KeyedTable(self.table, self.schema, self.key, self.buckets, self.fold_after)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The table as it is now."""
        return self.keyed.rows(spark)


def _dropped_files(spark: SparkSession, drop: DropFolder) -> DataFrame:
    reader = spark.readStream.schema(text_schema(drop.headers)).options(**csv_options())
    reader = reader.option("pathGlobFilter", "*.csv")
    if drop.max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", drop.max_files_per_batch)
    if drop.archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", drop.archive)
    elif drop.delete:
        reader = reader.option("cleanSource", "delete")
    return rename_headers(reader.csv(drop.folder), drop.names)


def ingest_if_absent(spark: SparkSession, drop: DropFolder) -> int:
    """Take in the files that are new since the last run: keys already stored are kept as they are.

    Within a batch the smallest record of a key is stored. A batch is compared with the buckets of its own keys.
    Returns the number of batches.
    """
    batches = []

    def take(batch: DataFrame, writer: str, batch_id: int) -> None:
        session = batch.sparkSession
        batches.append(batch_id)
        batch = batch.persist()
        try:
            keyed = F.coalesce(strip(F.col(drop.key)), F.lit("")) != ""
            write_batch(batch.where(~keyed), drop.rejects, writer, batch_id)
            drop.keyed.fold_before(session, writer, batch_id)
            stored = drop.keyed.rows_before(session, batch.where(keyed), writer, batch_id)
            write_batch(absent_records(batch.where(keyed), stored, drop.key, small=False), drop.table, writer, batch_id)
        finally:
            batch.unpersist()

    run_available(_dropped_files(spark, drop), drop.checkpoint, take)
    return len(batches)


def ingest_until_idle(spark: SparkSession, drop: DropFolder, poll_seconds: float, idle_seconds: float) -> None:
    """Look for new files again and again, until none came for ``idle_seconds``."""
    last_file = monotonic()
    while True:
        if ingest_if_absent(spark, drop):
            last_file = monotonic()
        elif monotonic() - last_file >= idle_seconds:
            return
        sleep(poll_seconds)
