"""Writers. Every task writes its own files below the given path, under one header each."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keeprule.operators.exports import remaining_units
from keeprule.session import new_folder

CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "emptyValue": "",
}

# Rows of one exported file.
EXPORT_FILE_ROWS = 5_000


def write_csv(
    rows: DataFrame,
    path: str,
    columns: list[str] | None = None,
    max_rows_per_file: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """CSV with the columns in the given order, else sorted by name."""
    writer = rows.select(*[F.col(f"`{c}`") for c in (columns or sorted(rows.columns))]).write.mode(mode)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.options(**CSV).csv(path)


def write_csv_by_index(
    rows: DataFrame,
    path: str,
    columns: list[str],
    index: str = "index",
    files_per_index: int | None = None,
    rows_per_file: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """A folder of CSV files per value of ``index``; overwriting replaces only the folders written.

    ``files_per_index`` gathers the slices of an index in about so many files, ``rows_per_file`` in as many as its rows
    ask for, none longer, at the price of a shuffle. Rows go to files by their place in what was read, so that equal rows spread
    too; ``rows`` should be read from files, whose order a task that runs again finds unchanged.
    """
    chosen = rows.select(*columns, index)
    if files_per_index or rows_per_file:
        placed, files = chosen.withColumn("place", F.monotonically_increasing_id()), F.lit(files_per_index)
        if rows_per_file:
            sizes = rows.groupBy(F.col(index).alias("sized")).agg(F.ceil(F.count("*") / rows_per_file).alias("files"))
            placed, files = placed.join(sizes, F.col(index).eqNullSafe(F.col("sized"))), F.col("files")
        slot = F.pmod(F.xxhash64("place"), files)
        chosen = placed.withColumn("slot", slot).repartition(index, "slot").select(*columns, index)
    writer = chosen.write.mode(mode).partitionBy(index).options(**CSV)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)  # small slots may be joined in one task
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.csv(path)


def export_remaining_indices(
    rows: DataFrame, path: str, finished: str, columns: list[str], index: str = "index", **settings
) -> None:
    """Write the indices that an earlier run did not finish, then note them as finished.

    The run settles first which indices those are, on disk; it writes and notes these and no others, whatever appears
    in the meantime. A run that was cut off left folders which are not noted; they are replaced as a whole.
    """
    spark = rows.sparkSession
    schema = T.StructType([T.StructField(index, T.StringType())])
    try:
        done = spark.read.schema(schema).parquet(finished)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        done = spark.createDataFrame([], schema)
    settled = new_folder(spark, "indices")
    remaining_units(rows, done, index).write.parquet(settled)
    units = spark.read.schema(schema).parquet(settled)
    write_csv_by_index(rows.join(units, index, "left_semi"), path, columns, index, mode="overwrite", **settings)
    units.write.mode("append").parquet(finished)


def write_json(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Records as JSON lines; NULL fields are left out."""
    rows.write.mode(mode).json(path)


def write_lines(rows: DataFrame, path: str, column: str, mode: str = "errorifexists") -> None:
    """One text column, a value per line: ids, or JSON documents."""
    rows.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def write_documents(
    documents: DataFrame, path: str, group: str, column: str = "document", mode: str = "errorifexists"
) -> None:
    """JSON documents in a folder per group, one document per line."""
    documents.select(F.col(column).alias("value"), F.col(group)).write.mode(mode).partitionBy(group).text(path)


def write_fragments(fragments: DataFrame, path: str, group: str, mode: str = "errorifexists") -> None:
    """A folder per group whose files, one behind the other by name, are one JSON document.

    The fragments of a large group are written by several tasks, each a range of them in order.
    """
    ordered = fragments.repartitionByRange(group, "batch").sortWithinPartitions(group, "batch")
    ordered.select(F.col("fragment").alias("value"), F.col(group)).write.mode(mode).partitionBy(group).text(path)
