"""Quality rules as a ledger of failure bits, to which policies are applied later.

Every rule is evaluated once for each text. The ledger keeps its measurements and one bit for each rule that the text
fails. A policy is a mask of the rules that count; the effect of leaving rules out is computed from the bits alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
WINDOW = 5

#: Rule by bit: name and the condition under which a text fails it.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("capitals", "2 * n_capitals > word_chars"),
    ("long_words", "word_chars > 20 * n_words"),
)
#: Policy by version: the names of the rules that reject a text.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: ("few_words", "repeated_windows", "symbols", "repeated_lines", "capitals", "long_words"),
}


def mask(rules) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in rules)


def measurements(docs: DataFrame) -> DataFrame:
    """What the rules look at, for every row: doc_id and the counts."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.select(
        "doc_id",
        F.array_remove(F.split("text", WORD_GAP, -1), "").alias("words"),
        F.char_length(F.regexp_replace("text", WORD_GAP, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        F.filter(F.split("text", "\n", -1), lambda x: F.regexp_replace(x, WORD_GAP, "") != F.lit("")).alias("lines"),
    )
    long = ["word_chars", "n_symbols", "n_capitals"]
    hashed = counted.select(
        "doc_id",
        *long,
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - WINDOW),
                lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)]),
            ),
        ).alias("hashes"),
    )
    measured = ["doc_id", *long, "n_words", "n_lines", "n_dup_lines"]
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    pairs = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = hashed.select(*measured, F.when(repeats, pairs).alias("at"))
    next_same = F.zip_with("at", F.slice("at", 2, F.size("at")), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    flagged = ordered.select(*measured, "at", next_same.alias("next_same"))
    before_same = F.slice(F.concat(F.array(F.lit(False)), "next_same"), 1, F.size("at"))
    either = F.zip_with("next_same", before_same, lambda a, b: a | b)
    starts = F.zip_with("at", either, lambda x, repeated: F.when(repeated, x["i"]))
    placed = flagged.select(*measured, F.sort_array(F.filter(starts, lambda x: x.isNotNull())).alias("starts"))
    covered = F.zip_with(
        "starts", F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)).cast("long"),
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b)
    return placed.select(*measured, F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def ledger(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the measurements and ``failed``, a bit for each rule it fails.

    A null text has no words. Repeated rows are measured each for itself. Other columns are left out.
    """
    bits = None
    for place, (_, condition) in enumerate(RULES):
        bit = F.when(F.expr(condition), F.lit(1 << place)).otherwise(F.lit(0)).cast("long")
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return measurements(docs).withColumn("failed", bits)


def apply_policy(entries: DataFrame, version: int) -> DataFrame:
    """The ledger with ``kept``: whether a row fails none of the policy's rules."""
    return entries.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version])).cast("long")) == 0)


def ablations(entries: DataFrame, version: int) -> DataFrame:
    """For each rule of a policy: rows that fail it, and rows that would be kept if it alone were left out.

    Only the distinct bit patterns (2 to the number of rules at most) are looked at after one counting pass.
    """
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version])).cast("long")).alias("failed")).count()
    rules = [F.struct(F.lit(rule).alias("rule"), F.lit(mask([rule])).cast("long").alias("bit")) for rule in POLICIES[version]]
    each = patterns.select("failed", "count", F.explode(F.array(*rules)).alias("r"))
    fails = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(fails, F.col("count")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("n_regained"),
    )
