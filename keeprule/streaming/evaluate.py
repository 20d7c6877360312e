"""Verdicts for message ids as they arrive, with running totals, resumable at any point."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keeprule.operators.flags import both_flags, verdict_totals
from keeprule.streaming.keyed import BucketedRows, KeyedTable
from keeprule.streaming.tables import batch_folder, read_rows, run_available, write_batch

FLAG_SCHEMA = "gcId string, ret_policies_expired string, sup_policies_expired string"
PROGRESS_SCHEMA = "verdict string, evaluated long, expired long, active long"


@dataclass(frozen=True)
class Evaluation:
    """New ids are read from ``ids`` (Parquet folders); flags are stored by key, totals are appended per batch."""

    ids: str
    flags: str
    progress: str
    checkpoint: str
    buckets: int = 64
    fold_after: int = 8

    @property
    def verdicts(self) -> KeyedTable:
        return KeyedTable(self.flags, T.StructType.fromDDL(FLAG_SCHEMA), "gcId", self.buckets, self.fold_after)

    def flag_rows(self, spark: SparkSession) -> DataFrame:
        return self.verdicts.rows(spark)

    def totals(self, spark: SparkSession) -> DataFrame:
        """``verdict, evaluated, expired, active`` over all batches so far."""
        rows = read_rows(spark, self.progress, T.StructType.fromDDL(PROGRESS_SCHEMA))
        return rows.groupBy("verdict").agg(*[F.sum(c).alias(c) for c in ("evaluated", "expired", "active")])


def _assignments_of(spark: SparkSession, assignments: DataFrame | BucketedRows, ids: DataFrame) -> DataFrame:
    """The assignments of a batch of ids; of bucketed ones only the buckets of these ids are read."""
    if isinstance(assignments, BucketedRows):
        buckets = KeyedTable("", assignments.schema, "gcId", assignments.buckets).buckets_of(ids)
        assignments = assignments.rows(spark, buckets)
    return assignments.join(ids, "gcId", "left_semi")


def evaluate_new_ids(
    spark: SparkSession,
    job: Evaluation,
    assignments: DataFrame | BucketedRows,
    policies: DataFrame,
    instant: str | datetime,
) -> None:
    """Evaluate the ids that arrived since the last run against the assignments and policies.

    An id that has a verdict already keeps it and is not counted again. A batch reads the verdicts, and of bucketed
    assignments the rows, of the buckets of its own ids.
    """

    def evaluate(batch: DataFrame, writer: str, batch_id: int) -> None:
        session = batch.sparkSession
        arrived = batch.where(F.col("gcId").isNotNull()).distinct().persist()
        try:
            job.verdicts.fold_before(session, writer, batch_id)
            known = job.verdicts.rows_before(session, arrived, writer, batch_id).select("gcId")
            ids = arrived.join(known, "gcId", "left_anti")
            own = _assignments_of(session, assignments, ids)
            write_batch(both_flags(own, policies, instant, ids), job.flags, writer, batch_id)
        finally:
            arrived.unpersist()
        written = session.read.schema(FLAG_SCHEMA).parquet(batch_folder(job.flags, writer, batch_id))
        verdicts = written.unpivot("gcId", ["ret_policies_expired", "sup_policies_expired"], "verdict", "flag")
        write_batch(verdicts.groupBy("verdict").agg(*verdict_totals("flag")), job.progress, writer, batch_id)

    arriving = spark.readStream.schema("gcId string").option("recursiveFileLookup", True).parquet(job.ids)
    run_available(arriving, job.checkpoint, evaluate)

