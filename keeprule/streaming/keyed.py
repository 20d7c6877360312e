"""Tables that streaming jobs append to by key, of which a batch reads only the buckets of its own keys.

Batches are appended to folders of their own (``tables.write_batch``). Every few batches the folders are folded into
runs: one folder per fold, split in buckets by a hash of the key. A bucket with many runs is rewritten as one. What is
current stands in a manifest, a single row that is written as the last step of a fold, in turn to one of two places, so
that there always is a whole one. A fold that was cut off left files that no manifest names.

A batch thus reads the runs of its buckets, at most ``most_runs`` for each, and the few folders not folded yet, however
many batches there were before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keeprule.streaming.tables import FOLDER_COLUMNS, batch_folder, read_batches

MANIFEST = (
    "seq long, runs array<struct<bucket: int, seqs: array<long>>>, "
    "folded array<struct<writer: string, batch_id: long>>, stale array<string>"
)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    """Remove folders that no manifest names any more; those already gone are left out."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class State:
    """What is current: the runs of each bucket, the last folded batch of each writer, and folders to remove."""

    seq: int = 0
    runs: dict[int, list[int]] = None
    folded: dict[str, int] = None
    stale: tuple[str, ...] = ()


@dataclass(frozen=True)
class KeyedTable:
    """A table with one row per key below ``path``, in ``buckets`` buckets of at most ``most_runs`` runs each.

    The number of buckets belongs to the table for good: choose it so that one bucket fits a task.
    """

    path: str
    schema: T.StructType
    key: str
    buckets: int = 64
    fold_after: int = 8
    most_runs: int = 8

    @property
    def runs_folder(self) -> str:
        return f"{self.path}.runs"

    def _slot(self, seq: int) -> str:
        return f"{self.path}.manifest/slot={seq % 2}"

    def _run(self, seq: int, bucket: int) -> str:
        return f"{self.runs_folder}/seq={seq}/bucket={bucket}"

    def state(self, spark: SparkSession) -> State:
        found = [row for slot in (0, 1) for row in _rows_or_none(spark, self._slot(slot), T.StructType.fromDDL(MANIFEST)).collect()]
        if not found:
            return State(0, {}, {})
        last = max(found, key=lambda row: row["seq"])
        return State(
            last["seq"],
            {run["bucket"]: list(run["seqs"]) for run in last["runs"]},
            {batch["writer"]: batch["batch_id"] for batch in last["folded"]},
            tuple(last["stale"]),
        )

    def _commit(self, spark: SparkSession, state: State) -> None:
        runs = [(bucket, seqs) for bucket, seqs in sorted(state.runs.items())]
        row = (state.seq, runs, sorted(state.folded.items()), list(state.stale))
        spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._slot(state.seq))

    def _in_runs(self, spark: SparkSession, state: State, buckets: list[int]) -> DataFrame:
        folders = [self._run(seq, bucket) for bucket in buckets for seq in state.runs.get(bucket, ())]
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)

    def _recent(self, spark: SparkSession, state: State) -> DataFrame:
        """The rows of the folders that are not folded, with writer and batch_id."""
        rows = read_batches(spark, self.path, self.schema)
        for writer, last in state.folded.items():
            rows = rows.where((F.col("writer") != writer) | (F.col("batch_id") > last))
        return rows

    def rows(self, spark: SparkSession) -> DataFrame:
        state = self.state(spark)
        return self._in_runs(spark, state, list(state.runs)).unionByName(self._recent(spark, state).drop(*FOLDER_COLUMNS))

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that hold the keys of ``rows``: at most as many numbers as the table has buckets."""
        return [r[0] for r in rows.select(bucket_of(self.key, self.buckets)).distinct().collect()]

    def rows_before(self, spark: SparkSession, batch: DataFrame, writer: str, batch_id: int) -> DataFrame:
        """What was stored before the given batch, of the buckets of its keys (folders not folded yet are read whole)."""
        state = self.state(spark)
        own = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
        recent = self._recent(spark, state).where(~own).drop(*FOLDER_COLUMNS)
        return self._in_runs(spark, state, self.buckets_of(batch)).unionByName(recent)

    def fold_before(self, spark: SparkSession, writer: str, batch_id: int) -> bool:
        """Fold the folders of earlier batches into runs when it is time: after ``fold_after`` batches of the writer,
        and what other writers left before the first batch of a new one. Whether that was done."""
        if batch_id % self.fold_after:
            return False
        state = self.state(spark)
        own = (F.col("writer") == writer) & (F.col("batch_id") >= batch_id)
        recent = self._recent(spark, state).where(~own)
        folders = recent.groupBy("writer").agg(F.min("batch_id").alias("first"), F.max("batch_id").alias("last")).collect()
        if not folders:
            return False
        delete_folders(spark, list(state.stale))
        seq = state.seq + 1
        new = recent.drop(*FOLDER_COLUMNS)
        touched = self.buckets_of(new)
        full = [b for b in touched if len(state.runs.get(b, ())) >= self.most_runs]
        out = new.unionByName(self._in_runs(spark, state, full)).withColumn("bucket", bucket_of(self.key, self.buckets))
        out.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.runs_folder}/seq={seq}")
        runs = {**state.runs, **{b: [*([] if b in full else state.runs.get(b, [])), seq] for b in touched}}
        stale = [self._run(s, b) for b in full for s in state.runs[b]]
        stale += [batch_folder(self.path, f["writer"], n) for f in folders for n in range(f["first"], f["last"] + 1)]
        folded = {**state.folded, **{f["writer"]: f["last"] for f in folders}}
        self._commit(spark, State(seq, runs, folded, tuple(stale)))
        return True


@dataclass(frozen=True)
class BucketedRows:
    """Any rows below ``path`` split in buckets by a hash of ``key``, for jobs that look up the keys of a batch."""

    path: str
    schema: T.StructType
    key: str
    buckets: int = 64
    files_per_bucket: int = 1

    def write(self, rows: DataFrame, mode: str = "errorifexists") -> None:
        """A bucket goes to ``files_per_bucket`` tasks by a hash of all columns, as one key may have very many rows; what
        is too much for one task is dealt on to several, and each writes a file of its own."""
        bucket, slot = bucket_of(self.key, self.buckets), F.pmod(F.xxhash64(F.lit(1), *rows.columns), F.lit(self.files_per_bucket))
        placed = rows.withColumn("bucket", bucket).withColumn("slot", slot)
        dealt = placed.hint("rebalance", F.col("bucket"), F.col("slot")).drop("slot")
        dealt.write.mode(mode).partitionBy("bucket").parquet(self.path)

    def rows(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets: other folders are not read."""
        full = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        rows = spark.read.schema(full).parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        return rows.drop("bucket")


def _rows_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
