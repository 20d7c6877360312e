"""Documents dealt to shards by a keyed permutation of their global row numbers, in DataFrame functions alone.

Rows are numbered in the order of id, size, checksum and content, so that a row's number follows from the table's
content and not from how it was partitioned. A Feistel network over pairs (left, right) with a * b just above the
number of rows permutes the numbers; a value outside is walked along its cycle until it falls inside. Shard and slot
of a position are its remainder and quotient by the number of shards: counts of shards differ by one at most (law
``rows``), and the slots of a shard have no gaps.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keeprule.llm.common import row_keys, stored

SHARDS, KEY = 24, 20240611
#: A prime below 2 ** 31, so that products of two remainders fit 64 bits.
PRIME = 2_147_483_647
ROUNDS = 6
#: So many pairs (a, b) are tried for the one with the fewest values outside.
PAIRS = 4096
#: Rows that are equal in every column travel as blocks of at most so many.
BLOCK = 1024

IDENTITY = ("doc_id", "size", "text_crc32", "h1", "h2")


def round_keys(key: int) -> list[tuple[int, int, int]]:
    """Multiplier and two offsets of each round, by a linear congruence from ``key``."""
    state, found = key % PRIME, []
    for _ in range(ROUNDS):
        drawn = []
        for _ in range(3):
            state = (state * 48_271 + 11) % PRIME
            drawn.append(state)
        found.append((max(2, drawn[0]), drawn[1], drawn[2]))
    return found


def near_square(n: int) -> tuple[int, int]:
    """a and b with a * b >= n and a from the root of n to twice as much, with the fewest values from n on."""
    first = isqrt(max(n, 1))
    tried = range(first, min(first + PAIRS, 2 * first + 1))
    return min(((a, -(-n // a)) for a in tried), key=lambda pair: pair[0] * pair[1])


def _scrambled(value: Column, multiplier: Column, offset: Column) -> Column:
    mixed = (value % PRIME * multiplier + offset) % PRIME
    return (mixed * mixed % PRIME * multiplier + offset) % PRIME


def permuted(number: Column, n: int, key: int) -> Column:
    """The position of each row number (0 to n - 1): a permutation of 0 to n - 1."""
    a, b = near_square(n)
    keys = F.array(*[F.struct(*[F.lit(k).cast("long").alias(c) for c, k in zip("muv", keys, strict=True)]) for keys in round_keys(key)])

    def one_round(pair: Column, k: Column) -> Column:
        left = (pair["left"] + _scrambled(pair["right"], k["m"], k["u"])) % a
        right = (pair["right"] + _scrambled(left, k["m"], k["v"])) % b
        return F.struct(left.alias("left"), right.alias("right"))

    def network(value: Column) -> Column:
        halves = F.struct(F.call_function("div", value, F.lit(b)).alias("left"), (value % b).alias("right"))
        return F.aggregate(keys, halves, one_round, lambda pair: pair["left"] * b + pair["right"])

    # A cycle holds a * b - n values outside at most, so as many further steps always end inside.
    walk = F.sequence(F.lit(1), F.lit(a * b - n))
    once = network(number)
    if a * b == n:
        return once
    return F.aggregate(walk, once, lambda value, _: F.when(value < n, value).otherwise(network(value)))


def _identified(docs: DataFrame) -> DataFrame:
    """Identity of each row: id, size, checksum of the text, and two hashes over all columns."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    h1, h2 = row_keys(*columns)
    return docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        h1.alias("h1"), h2.alias("h2"),
    )


def ledger(docs: DataFrame, n_shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """One row for each row of ``docs``: its identity, law, position, shard and slot.

    ``size`` is the text's UTF-8 bytes plus 8; a null text has none and the checksum 0, as an empty one. Rows without
    an id come first in the numbering. Rows that are equal in every column are told apart by position only. Other
    columns count for identity (maps aside, which have no order, and which Spark refuses to hash) and may have any name.
    No rows give no rows. Only hashes and sizes are shuffled, twice; texts stay where they are.
    """
    copies = _identified(docs).groupBy(*IDENTITY).agg(F.count("*").alias("copies"))
    block = F.explode(F.expr(f"sequence(0L, (copies - 1) div {BLOCK})")).alias("block")
    ordered = copies.select(*IDENTITY, "copies", block).repartitionByRange(*IDENTITY, "block").sortWithinPartitions(*IDENTITY, "block")
    in_block = F.least(F.lit(BLOCK).cast("long"), F.col("copies") - F.col("block") * BLOCK)
    rows = ordered.select(*IDENTITY, F.explode(F.sequence(F.lit(1).cast("long"), in_block)).alias("copy"))
    kept = stored(rows.drop("copy"), "numbered")

    # Files hold the ranges in order. What is written no longer depends on tasks that may run again.
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    placed = kept.select("*", part.alias("part"), F.col("_metadata.row_index").alias("row"))
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))  # one row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    n = kept.count()
    number = placed.join(F.broadcast(starts), "part").select(*IDENTITY, (F.col("start") + F.col("row")).alias("number"))
    dealt = number.select(*IDENTITY, permuted(F.col("number"), n, key).alias("position"))
    return dealt.select(
        *IDENTITY, F.lit("rows").alias("law"), "position",
        (F.col("position") % n_shards).cast("int").alias("shard"), F.expr(f"position div {n_shards}").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, key: int = KEY) -> None:
    """Write ``docs`` as Parquet folders ``shard=0, 1, ...``, each sorted by ``slot``, which is added.

    Equal rows travel once and are repeated where they are written. The columns lie in the struct ``row``, so that
    they may have any name.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    h1, h2 = row_keys(*columns)
    packed = docs.select(h1.alias("h1"), h2.alias("h2"), F.struct(*columns).alias("row"))
    once = packed.groupBy("h1", "h2").agg(F.first("row").alias("row"))
    slots = ledger(docs, n_shards, key).select("h1", "h2", "shard", "slot")
    dealt = once.join(slots, ["h1", "h2"]).select("shard", "slot", "row")
    dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
