"""Join of rows with half-open key ranges, without comparing every row with every range.

Whole numbers: a range belongs to the level of its width, the number of bits of the width. On its level it overlaps at
most two bins of that many bits, so range and row meet in an equi join on (level, bin), whatever the widths are and
whether or not ranges overlap. There are at most 64 levels, and a row looks up only those that occur.

Keys of any other ordered type (text, time, decimal, fractional, a struct of several columns): the distinct keys and the
bounds are sorted together in the key's own order, a bound before an equal key. Their places in that order are whole
numbers, so that a range of keys is a range of places and the first case applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keeprule.operators.lookups import fits_broadcast, table_size
from keeprule.operators.positions import positions

LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _with_level(ranges: DataFrame) -> DataFrame:
    """Bounds without gaps (an absent one is the end of all numbers) and the level of the width."""
    bounded = ranges.withColumns(
        {
            "open": F.col("high").isNull(),
            "low": F.coalesce("low", F.lit(LEAST)),
            "high": F.coalesce("high", F.lit(MOST)),
        }
    )
    width = F.try_subtract(F.col("high"), F.col("low"))
    level = F.coalesce(F.length(F.bin(width - 1)), F.lit(63))
    # An open range may hold the largest number only: its width is that of a range one wider.
    level = F.when(F.col("open"), F.greatest(level, F.lit(1))).otherwise(level)
    return bounded.where((F.col("low") < F.col("high")) | F.col("open")).withColumn("level", F.least(level, F.lit(63)))


def _counts(weighed: DataFrame, ranges: DataFrame, range_id: list[str], sums: list[str], small: bool | None) -> DataFrame:
    """Sums of ``weighed`` (key, sums) over ``ranges`` (range_id, low, high) of whole numbers."""
    leveled = _with_level(ranges)
    levels = leveled.agg(F.collect_set("level").alias("levels"))
    last = F.when(F.col("open"), F.col("high")).otherwise(F.col("high") - 1).alias("last")
    bins = leveled.select("*", last).withColumn(
        "bin", F.explode(F.expr("sequence(shiftright(low, level), shiftright(last, level))"))
    )
    if small is None:
        small = fits_broadcast(*table_size(bins))
    totals = [F.sum(c).alias(c) for c in sums]
    if not small:
        weighed = weighed.groupBy("key").agg(*totals)
    probes = weighed.withColumn("level", F.explode(levels.scalar())).withColumn("bin", F.expr("shiftright(key, level)"))

    keys = ["level", "bin"]
    met = probes.join(F.broadcast(bins) if small else bins, keys)
    inside = met.where((F.col("key") >= F.col("low")) & ((F.col("key") < F.col("high")) | F.col("open")))
    return inside.groupBy(*range_id).agg(*totals)


def _same_kind(one: T.DataType, other: T.DataType) -> bool:
    return one.simpleString() == other.simpleString()


def _by_place(weighed: DataFrame, ranges: DataFrame, sums: list[str]) -> tuple[DataFrame, DataFrame]:
    """Keys and bounds replaced by their places in the common order of distinct keys and bounds."""
    distinct = weighed.groupBy("key").agg(*[F.sum(c).alias(c) for c in sums])
    nothing = [F.lit(None).cast(weighed.schema[c].dataType).alias(c) for c in sums]
    bounds = ranges.select(F.explode(F.array("low", "high")).alias("key")).where(F.col("key").isNotNull()).distinct()
    marked = distinct.select("key", F.lit(1).alias("is_key"), *sums).unionByName(
        bounds.select("key", F.lit(0).alias("is_key"), *nothing)
    )
    placed = positions(marked, ["key", "is_key"], "place")
    keys = placed.where("is_key = 1").select(F.col("place").alias("key"), *sums)
    places = placed.where("is_key = 0").select("key", "place")
    others = [c for c in ranges.columns if c not in ("low", "high")]
    lows = places.select(F.col("key").alias("low"), F.col("place").alias("low_place"))
    highs = places.select(F.col("key").alias("high"), F.col("place").alias("high_place"))
    met = ranges.join(lows, "low", "left").join(highs, "high", "left")
    return keys, met.select(*others, F.col("low_place").alias("low"), F.col("high_place").alias("high"))


def counts_in_ranges(
    rows: DataFrame,
    key: str | Column,
    ranges: DataFrame,
    range_id: list[str],
    low: str,
    high: str,
    sums: list[str] = (),
    small: bool | None = None,
) -> DataFrame:
    """``range_id, n_rows`` and the sum of each column in ``sums``, for ranges that hold rows.

    ``key``, ``low`` and ``high`` are of integral types, or all of one other ordered type; a compound key is a struct,
    ordered by its first field, then the next. A NULL bound is open; rows with a NULL key are in no range. ``small``
    tells that the bins of ``ranges`` are known to fit a broadcast; else they are measured. Small ones are broadcast
    and rows with whole keys are only counted. Otherwise the rows are first added up per key.
    """
    weighed = rows.select(
        (F.col(key) if isinstance(key, str) else key).alias("key"), F.lit(1).cast("long").alias("n_rows"), *[F.col(c) for c in sums]
    ).where(F.col("key").isNotNull())
    bounds = ranges.select(*range_id, F.col(low).alias("low"), F.col(high).alias("high"))
    kind = weighed.schema["key"].dataType
    kinds = [kind, *(bounds.schema[c].dataType for c in ("low", "high"))]
    added = ["n_rows", *sums]
    if all(isinstance(k, T.IntegralType) for k in kinds):
        weighed = weighed.withColumn("key", F.col("key").cast("long"))
        bounds = bounds.withColumns({c: F.col(c).cast("long") for c in ("low", "high")})
    elif not all(_same_kind(kind, k) for k in kinds):
        raise TypeError(f"ranges are of whole numbers or of one type; key and bounds differ in type: {', '.join(k.simpleString() for k in kinds)}")
    elif isinstance(kind, (T.MapType, T.VariantType)):
        raise TypeError(f"{kind.simpleString()} has no order")
    else:
        weighed, bounds = _by_place(weighed, bounds, added)
    return _counts(weighed, bounds, range_id, added, small)
