"""The objects of JSON arrays and lists in text files of any size, cut where they really begin and end.

A file is read in pieces that end before a brace, so that one large file is many splits and many tasks. Whether a piece
begins inside a string, and how deep in objects, follows from all pieces before it. Pieces are taken in short runs. Each
run reports what it does to quotes and depth for both cases of how it may begin; sums over the runs of a file give each
run's true start. Then every piece knows its depth, and an object is the pieces from depth 0 back to depth 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keeprule.functions.text import text_struct
from keeprule.session import new_folder

#: The pieces of a split are worked on in runs of at most 2 ** RUN_BITS, so that no task has to hold a whole split.
RUN_BITS = 12
RUN = ["of", "block", "run"]


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text behind each brace up to the next; the first piece of a file stands before its first brace."""
    return spark.read.text(path, lineSep="{").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def _outside_strings(text: Column, quote: str, inside: bool) -> Column:
    """``text`` without the contents of strings, if it begins outside or inside of one."""
    plain = F.regexp_replace(text, r"(?s)\\.", "")
    if inside:
        plain = F.concat(F.lit(quote), plain)
    return F.regexp_replace(plain, f"(?s){quote}[^{quote}]*(?:{quote}|$)", "")


def _count(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def _effects(pieces: DataFrame, quote: str) -> DataFrame:
    """``quotes`` of each piece, and ``turn0, turn1``: what it adds to the depth if it begins outside or inside a string.

    The brace before a piece opens an object, unless it stands in a string, or a bracket follows (arrays that were
    wrapped in braces). Its closing braces count where they stand outside of strings.
    """
    text = F.col("value")
    opens = F.when(text.rlike(r"^\s*\["), 0).otherwise(1)
    return pieces.withColumns(
        {
            "quotes": _count(F.regexp_replace(text, r"(?s)\\.", ""), quote) % 2,
            "wraps": text.rlike(r"^\s*\["),
            "turn0": opens - _count(_outside_strings(text, quote, False), "}"),
            "turn1": -_count(_outside_strings(text, quote, True), "}"),
        }
    )


def _stored_pieces(spark: SparkSession, path: str | list[str], quote: str) -> tuple[DataFrame, DataFrame]:
    """The pieces with their effects, cut in runs, and ``of, file``: the number that stands for each file in them.

    They are written to the shared folder once: all that follows sees the same rows and numbers of rows.
    """
    folder = new_folder(spark, "pieces")
    found = _effects(_pieces(spark, path), quote)
    found.write.parquet(folder)
    written = spark.read.schema(found.schema).parquet(folder)
    first = F.min(F.when(F.col("block") == 0, F.col("row"))).alias("first row")
    files = written.groupBy("path", "file").agg(first)
    files = files.withColumn("of", F.row_number().over(Window.orderBy("path")))  # one row for each file
    run = F.shiftright("row", RUN_BITS).alias("run")
    pieces = written.join(F.broadcast(files.select("path", "of", "first row")), "path").select(
        "of", "block", run, "row", "value", "quotes", "wraps", "turn0", "turn1",
        ((F.col("block") == 0) & (F.col("row") == F.col("first row"))).alias("first"),
    )
    # The first piece of a file has no brace before it.
    return pieces.withColumn("turn0", F.when(F.col("first"), 0).otherwise(F.col("turn0"))), files.select("of", "file")


def _with_state(effects: DataFrame) -> DataFrame:
    """Pieces with ``depth`` (of objects open before their brace) and ``in_string`` (whether the brace is in one).

    Windows over pieces run within a run; over the runs of a file only one row for each is added up.
    """
    before = Window.partitionBy(*RUN).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    effects = effects.withColumn("seen", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    as_begun = lambda begun: F.when((F.col("seen") + begun) % 2 == 0, F.col("turn0")).otherwise(F.col("turn1"))
    runs = effects.groupBy(*RUN).agg(
        F.sum("quotes").alias("quotes"), F.sum(as_begun(0)).alias("turn0"), F.sum(as_begun(1)).alias("turn1")
    )
    earlier = Window.partitionBy("of").orderBy("block", "run").rowsBetween(Window.unboundedPreceding, -1)
    begun = runs.withColumn("begun", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    turned = begun.withColumn("turn", F.when(F.col("begun") == 0, F.col("turn0")).otherwise(F.col("turn1")))
    starts = turned.select(*RUN, "begun", F.coalesce(F.sum("turn").over(earlier), F.lit(0)).alias("start"))

    placed = effects.join(F.broadcast(starts), RUN)  # one row for each run
    inside = (F.col("seen") + F.col("begun")) % 2 == 1
    stated = placed.withColumn("in_string", inside).withColumn("turn", F.when(inside, F.col("turn1")).otherwise(F.col("turn0")))
    return stated.withColumn("depth", F.col("start") + F.coalesce(F.sum("turn").over(before), F.lit(0)))


def read_objects(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """``file, object``: the outermost objects of each file, as text, of arrays, wrapped arrays and bare lists alike.

    ``quote`` is the sign that strings stand in. An object is followed by what separates it from the next, which JSON
    readers leave aside. What never closes is given as it is, and is no JSON. The pieces are written to the shared
    folder twice, as they are and with their state.
    """
    effects, files = _stored_pieces(spark, path, quote)
    folder = new_folder(spark, "pieces")
    stated = _with_state(effects)
    begins = ~F.col("first") & ~F.col("in_string") & ~F.col("wraps") & (F.col("depth") == 0)
    inner = ~F.col("first") & (F.col("depth") > 0)
    marked = stated.withColumn("begins", begins.cast("int")).where(begins | inner)
    marked.select(*RUN, "row", "value", "begins").write.parquet(folder)
    written = spark.read.parquet(folder)

    earlier = Window.partitionBy("of").orderBy("block", "run").rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy(*RUN).agg(F.sum("begins").alias("n"))
    starts = counts.select(*RUN, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    upto = Window.partitionBy(*RUN).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    number = F.col("start") + F.sum("begins").over(upto)
    numbered = written.join(F.broadcast(starts), RUN).withColumn("number", number)
    parts = F.array_sort(F.collect_list(F.struct("block", "row", "value")))["value"]
    whole = numbered.groupBy("of", "number").agg(F.concat(F.lit("{"), F.array_join(parts, "{")).alias("object"))
    return whole.join(F.broadcast(files), "of").select("file", "object")


def read_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of JSON arrays of any size, with the union of their fields as columns.

    They go to the shared folder as one record per line, from which the fields are found.
    """
    folder = new_folder(spark, "records")
    line = F.translate("object", "\r\n", "  ").alias("value")  # line ends do not stand in strings
    read_objects(spark, path).select(line).write.text(folder)
    return spark.read.json(folder)


def parsed_objects(objects: DataFrame, fields: list[str], column: str = "object") -> DataFrame:
    """Replace the text by the struct ``item`` of its fields as text; ``unreadable`` is the text of what is no JSON.

    One broken object leaves its neighbours as they are.
    """
    schema = T.StructType([*text_struct(fields), T.StructField("unreadable", T.StringType())])
    item = F.explode(F.array(F.from_json(column, schema, {"columnNameOfCorruptRecord": "unreadable"})))
    others = [c for c in objects.columns if c != column]
    parsed = objects.select(*others, item.alias("item"))
    return parsed.select(*others, "item", F.col("item.unreadable").alias("unreadable"))
