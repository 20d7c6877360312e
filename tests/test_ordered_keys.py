"""Ranges of keys of any ordered type, against a comparison of every row with every range."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from keeprule.operators import purge, ranges
from keeprule.operators.positions import positions

DAY = datetime(2001, 6, 1)
MAKE = {
    "string": lambda n: "" if n == 0 else f"gc-{n}",
    "timestamp_ntz": lambda n: DAY + timedelta(hours=n),
    "date": lambda n: (DAY + timedelta(days=n)).date(),
    "decimal(12,2)": lambda n: Decimal(n) / 4,
    "double": lambda n: n / 8,
    "binary": lambda n: bytes([n % 256, n // 256]),
    "struct<a:string,b:int>": lambda n: (f"t{n % 3}", n),
}


def inside(key, low, high):
    return key is not None and (low is None or key >= low) and (high is None or key < high)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("kind", list(MAKE))
def test_rows_in_ranges_of_ordered_keys(spark, kind, small):
    random.seed(11)
    make = MAKE[kind]
    keys = [make(random.randint(0, 300)) for _ in range(300)] + [make(42)] * 300 + [None]  # a key of half the rows
    bounds = [(make(random.randint(0, 310)), make(random.randint(0, 310))) for _ in range(40)]  # some are empty, many overlap
    bounds += [(None, make(100)), (make(200), None), (None, None), (make(42), make(43)), (make(42), make(42)), bounds[0]]
    rows = spark.createDataFrame([(k, 2) for k in keys], f"k {kind}, w long").repartition(4)
    table = spark.createDataFrame([(i, *b) for i, b in enumerate(bounds)], f"id int, lo {kind}, hi {kind}")
    counted = ranges.counts_in_ranges(rows, "k", table, ["id"], "lo", "hi", ["w"], small=small).collect()
    expected = {i: n for i, b in enumerate(bounds) if (n := sum(inside(k, *b) for k in keys))}
    assert {r["id"]: r["n_rows"] for r in counted} == expected
    assert {r["id"]: r["w"] for r in counted} == {i: 2 * n for i, n in expected.items()}


def test_whole_numbers_with_open_ends(spark):
    least, most = -(1 << 63), (1 << 63) - 1
    keys = [least, -5, 0, 0, 7, most, None]
    bounds = [(None, 0), (0, None), (None, None), (most, None), (None, least), (least, most), (None, most)]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    table = spark.createDataFrame([(i, *b) for i, b in enumerate(bounds)], "id int, lo long, hi long")
    counted = ranges.counts_in_ranges(rows, "k", table, ["id"], "lo", "hi").collect()
    assert {r["id"]: r["n_rows"] for r in counted} == {i: n for i, b in enumerate(bounds) if (n := sum(inside(k, *b) for k in keys))}


def test_a_hot_key_does_not_meet_in_one_task(spark):
    """Keys are added up before they are ordered, so that the order holds each once."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"))
    table = spark.createDataFrame([(1, "hot", "hou"), (2, "a", "z")], "id int, lo string, hi string")
    weighed = rows.select(F.col("k").alias("key"), F.lit(1).cast("long").alias("n_rows"))
    keys, _ = ranges._by_place(weighed, table.select("id", F.col("lo").alias("low"), F.col("hi").alias("high")), ["n_rows"])
    assert keys.count() == rows.distinct().count()
    counted = ranges.counts_in_ranges(rows, "k", table, ["id"], "lo", "hi").collect()
    assert {r["id"]: r["n_rows"] for r in counted} == {1: 13_333, 2: 20_000}


def test_no_rows_and_no_ranges(spark):
    rows = spark.createDataFrame([], "k string")
    table = spark.createDataFrame([(1, "a", "b")], "id int, lo string, hi string")
    assert ranges.counts_in_ranges(rows, "k", table, ["id"], "lo", "hi").count() == 0
    some = spark.createDataFrame([("a",)], "k string")
    assert ranges.counts_in_ranges(some, "k", table.where("false"), ["id"], "lo", "hi").count() == 0


def test_types_must_agree(spark):
    rows = spark.sql("SELECT '5' AS k")
    table = spark.sql("SELECT 1 AS id, 5L AS lo, 6L AS hi")
    with pytest.raises(TypeError, match="differ in type"):
        ranges.counts_in_ranges(rows, "k", table, ["id"], "lo", "hi")


def test_chunks_of_a_compound_key(spark):
    rows = spark.sql("SELECT concat('t', id % 3) AS tenant, CAST(id AS INT) AS n, 'abcd' AS body FROM range(90)")
    bound = "named_struct('tenant', '{}', 'n', {})"
    table = spark.sql(
        f"""SELECT 's' AS shard, 1 AS chunk_id, NULL AS min_key, {bound.format('t1', 31)} AS max_key
        UNION ALL SELECT 's', 2, {bound.format('t1', 31)}, {bound.format('t2', 0)}
        UNION ALL SELECT 's', 3, {bound.format('t2', 0)}, NULL"""
    )
    found = {r["chunk_id"]: (r["n_rows"], r["n_bytes"]) for r in purge.chunk_inventory(rows, table, ["tenant", "n"]).collect()}
    keys = [(f"t{i % 3}", i) for i in range(90)]
    first, last = sum(k < ("t1", 31) for k in keys), sum(k >= ("t2", 0) for k in keys)
    assert found == {1: (first, 10 * first), 2: (90 - first - last, 10 * (90 - first - last)), 3: (last, 10 * last)}


def test_positions_follow_the_order_and_not_the_partitions(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n"))
    for parts in (1, 3, 7):
        placed = positions(rows.repartition(parts), ["n"])
        assert placed.where("n <> position").count() == 0 and placed.count() == 1000
    assert Counter(positions(rows.limit(0), ["n"]).collect()) == Counter()
