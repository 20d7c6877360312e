"""From documents to token ids in five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keeprule.llm import decontaminate, jaccard_join, language_id, line_dedup, sentencepiece_codec
from keeprule.llm.common import id_remainder, stored, table
from keeprule.llm.queries import PIECES, TOKENIZERS

#: Words a coding task keeps: fewer than by default, as tasks of the stages before leave their workers' memory behind.
KNOWN_WORDS = 200_000


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; others (no letter, no text, no clear language) go."""
    return language_id.identifiable(docs, language_id.fit(docs, id_remainder(3) != 1))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many share; those of which nothing is left go."""
    return line_dedup.deduplicated(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar shingles."""
    return jaccard_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contamination(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_ids and ids of each document, and whether the ids decode to its text."""
    vocabulary = sentencepiece_codec.Vocabulary.load(f"{TOKENIZERS}/{PIECES}")
    written = docs.withColumn("written", F.xxhash64("text"))
    coded = sentencepiece_codec.round_trip(written, vocabulary, "lang", "source", "written", known_words=KNOWN_WORDS)
    same = F.xxhash64("text") == F.col("written")
    return coded.select("doc_id", "lang", "source", "n_ids", "ids", same.alias("round_trip"))


STAGES = [
    ("language_id", told_language),
    ("line_dedup", without_shared_lines),
    ("jaccard_join", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("sentencepiece", token_ids),
]

#: The first stage is a learned model; see tests/llm for the comparison with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
