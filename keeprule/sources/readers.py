"""Readers for the kinds of input the jobs take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keeprule.functions.text import strip


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_records(spark: SparkSession, path: str | list[str], schema=None, one_array: bool = False) -> DataFrame:
    """JSON records, one per line; ``one_array`` for small files that hold one array each.

    Without a schema all records are read once to find the union of their fields.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path, multiLine=one_array)


def csv_options(multiline: bool = False) -> dict:
    """Options for CSV with doubled quotes; ``multiline`` allows line breaks in values.

    A file whose header differs from that of the table fails instead of mixing up columns.
    """
    return {"header": True, "escape": '"', "multiLine": multiline, "enforceSchema": False}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    required: tuple[str, ...] = (),
    multiline: bool = False,
    with_file: str | None = None,
    keep_null: bool = False,
) -> DataFrame:
    """CSV with a header as text columns; a folder is read whole. Blanks are empty text, or NULL with ``keep_null``.

    ``required`` columns must be present; ``with_file`` adds the name of the file.
    """
    rows = spark.read.csv(path, pathGlobFilter="*.csv", **csv_options(multiline))
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    blank = F.lit(None).cast("string") if keep_null else F.lit("")
    columns = [F.coalesce(F.col(f"`{c}`"), blank).alias(c) for c in rows.columns]
    if with_file:
        columns.append(F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "").alias(with_file))
    return rows.select(*columns)


def read_numbered_csv(spark: SparkSession, path: str | list[str], required: tuple[str, ...] = ()) -> DataFrame:
    """CSV rows with ``path``, ``file`` and ``position``, their place in the file from 0.

    The rows stay where they are read. Only one row per split of a file is shuffled: its
    number of rows and its first row id, from which the place of every row follows.
    """
    rows = read_csv(spark, path, required)
    columns = rows.columns
    numbered = rows.select(
        *columns,
        F.col("_metadata.file_path").alias("path"),
        F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        numbered.groupBy("path", "block")
        .agg(F.count("*").alias("rows"), F.min("row").alias("first_row"))
        .select("path", "block", "first_row", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    )
    return numbered.join(splits, ["path", "block"]).select(
        *columns, "path", "file", (F.col("start") + F.col("row") - F.col("first_row")).alias("position")
    )


def read_ids(spark: SparkSession, path: str | list[str], column: str = "id") -> DataFrame:
    """Text lines as ids: trimmed, blank lines left out."""
    return spark.read.text(path).select(strip(F.col("value")).alias(column)).where(F.col(column) != "")


def read_ordered_ids(spark: SparkSession, path: str, column: str = "id") -> DataFrame:
    """As ``read_ids`` with ``position``, which grows in the order of the lines of each file."""
    lines = spark.read.text(path).select(
        strip(F.col("value")).alias(column),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("position"),
    )
    return lines.where(F.col(column) != "")


def read_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole files as one row each: ``file, value``."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")


def read_shell_objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, object``: the flat ``{...}`` objects of dump files of any size.

    The text is read in pieces that end at ``}``, so that large files are split over many
    tasks. An object begins at the first brace of its piece. A file whose last ``{`` is never
    closed ends in an unfinished object, which is left out; this is seen from pieces that begin
    at ``{``, for packed files as for plain ones.
    """

    def pieces(end: str) -> DataFrame:
        place = F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        )
        return spark.read.text(path, lineSep=end).select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias("file"),
            place.alias("piece"),
            "value",
        )

    closed = pieces("{").groupBy("path").agg(F.max_by(F.col("value").contains("}"), "piece").alias("closed"))
    unfinished = (
        pieces("}").groupBy("path").agg(F.max("piece").alias("piece")).join(closed.where(~F.col("closed")), "path", "left_semi")
    )
    body = F.regexp_extract("value", r"(?s)\{.+", 0)
    return (
        pieces("}").join(unfinished, ["path", "piece"], "left_anti")
        .select("file", body.alias("body"))
        .where(F.col("body") != "")
        .select("file", F.concat("body", F.lit("}")).alias("object"))
    )


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
