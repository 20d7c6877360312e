"""Removal of lines that many documents share, as keep bitmaps instead of texts.

Lines travel as hashes only. They are range-partitioned by hash and sorted by document (largest id first) and
position; one pass over the sorted rows tells the first document of every run and how many documents the run has.
Keys with very many rows would fill one range; they are counted with partial sums instead, in two steps
(distinct documents, then their number), and meet their lines by a broadcast of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keeprule.llm.common import BLANKS, row_keys, stored

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_BITS = 32
#: A key is treated apart if it has more rows than this and more than the given part of all rows.
HOT_ROWS, HOT_PART = 100_000, 100_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _identified(docs: DataFrame) -> DataFrame:
    """Id and text of every row with the pair of hashes that stands for the row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    one, two = row_keys("doc_id", "text")
    return rows.select("doc_id", "text", one.alias("r1"), two.alias("r2"))


def _line_hashes(rows: DataFrame, min_chars: int) -> DataFrame:
    """Hash, document and position of every line that is long enough."""
    lines = rows.select("doc_id", "r1", "r2", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keys = (
        lines.where(F.char_length("line") >= min_chars)
        .select("doc_id", "r1", "r2", "pos", F.btrim("line", F.lit(BLANKS)).alias("line"))
        .where(F.char_length("line") >= min_chars)
        .select("doc_id", "r1", "r2", "pos", F.translate("line", CAPITALS, CAPITALS.lower()).alias("line"))
    )
    one, two = row_keys("line")
    return keys.select(one.alias("h1"), two.alias("h2"), "doc_id", "r1", "r2", "pos")


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row (r1, r2, pos) for each line to drop."""
    lines = stored(_line_hashes(_identified(docs), min_chars), "lines")
    hot_rows = max(HOT_ROWS, lines.count() // HOT_PART)
    hot = lines.groupBy("h1", "h2").count().where(F.col("count") > hot_rows).select("h1", "h2")  # HOT_PART at most
    key = ["h1", "h2"]

    in_run = Window.partitionBy(*key)
    by_doc = in_run.orderBy(F.col("doc_id").desc_nulls_last())
    streamed = (
        lines.join(F.broadcast(hot), key, "left_anti")
        .repartitionByRange(*key)
        .withColumn("rank", F.when(F.col("doc_id").isNotNull(), F.dense_rank().over(by_doc)))
        .withColumn("first_doc", F.first("doc_id").over(by_doc))
        .withColumn("n_docs", F.max("rank").over(in_run))
    )
    hot_lines = lines.join(F.broadcast(hot), key, "left_semi")
    totals = hot_lines.groupBy(*key).agg(
        F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("first_doc")
    )
    counted = hot_lines.join(F.broadcast(totals), key)
    columns = ["r1", "r2", "pos", "doc_id", "first_doc", "n_docs"]
    return (
        streamed.select(*columns)
        .unionByName(counted.select(*columns))
        .where((F.col("n_docs") >= min_docs) & ~F.col("doc_id").eqNullSafe(F.col("first_doc")))
        .select("r1", "r2", "pos")
    )


def drop_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per row that loses lines: r1, r2 and ``words``, the words of its bitmap that are not all kept, in order."""
    bit = F.expr(f"shiftleft(1L, pos % {WORD_BITS})")
    words = (
        dropped_lines(docs, min_chars, min_docs)
        .groupBy("r1", "r2", F.expr(f"pos div {WORD_BITS}").cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    return words.groupBy("r1", "r2").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def _positions(words: Column) -> Column:
    """The positions that a bitmap's words name."""
    bits = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))
    named = lambda w: F.transform(
        F.filter(bits, lambda b: F.getbit(w["bits"], b) == 1), lambda b: w["word"] * WORD_BITS + b
    )
    return F.flatten(F.transform(words, named))


def _shortened(found: DataFrame, *keep: str) -> DataFrame:
    """``found`` (columns ``keep``, text, words) with n_lines, n_dropped and the text that is left."""
    split = found.select(*keep, "text", "words", F.size(_lines(F.col("text"))).alias("n_lines"))
    gone = split.select("*", F.when(F.col("words").isNotNull(), _positions(F.col("words"))).alias("gone"))
    kept = gone.select(
        "*",
        F.when(F.col("gone").isNotNull(), _lines(F.col("text"))).alias("lines"),
        F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("gone")).alias("left"),
    )
    shorter = F.array_join(F.transform("left", lambda i: F.get(F.col("lines"), i)), "\n")
    return kept.select(
        *keep,
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(shorter).alias("text"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The rows of ``docs`` without the lines that many documents share.

    A line's key is the line stripped of white space, A-Z in lower case. Keys of at least ``min_chars`` code points
    that at least ``min_docs`` documents hold lose their lines in all documents but the one of the largest id.
    Returns doc_id, n_lines, n_dropped and text. A null text is one empty line. Rows that repeat an id count as one
    document; rows without an id never keep a shared line and don't count as documents. Other columns of ``docs``
    are left out and may have any name.
    """
    # A hash join streams the texts past the bitmaps; a merge join would sort the texts.
    bitmaps = drop_bitmaps(docs, min_chars, min_docs).hint("shuffle_hash")
    return _shortened(_identified(docs).join(bitmaps, ["r1", "r2"], "left"), "doc_id")


def deduplicated(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with its columns and shorter texts; rows that had text and lose all their lines go."""
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*others).alias("other columns"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    one, two = row_keys("doc_id", "text")
    rows = packed.select("other columns", "text", one.alias("r1"), two.alias("r2"))
    bitmaps = drop_bitmaps(docs, min_chars, min_docs).hint("shuffle_hash")
    left = _shortened(rows.join(bitmaps, ["r1", "r2"], "left"), "other columns")
    kept = left.where(F.col("n_dropped") < F.col("n_lines"))
    columns = [F.col("text") if c == "text" else F.col("other columns")[c].alias(c) for c in docs.columns]
    return kept.select(*columns)
