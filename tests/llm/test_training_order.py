"""The order of training sequences against a plain version: texts one by one, and the Feistel walk number by number."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keeprule.llm import training_order
from keeprule.llm.queries import PATTERN, RANKS, TOKENIZERS
from keeprule.llm.training_order import ROUNDS

MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def ranks():
    return training_order.load_ranks(f"{TOKENIZERS}/{RANKS}")


def mixed(x: int) -> int:
    return int(training_order.mix(np.array([x & MASK], np.uint64))[0])


def walk(number: int, n: int, key: int) -> int:
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = (1 << half) - 1
    while True:
        left, right = number >> half, number & low
        for k in range(1, ROUNDS + 1):
            round_key = mixed(key + k * 0x9E3779B97F4A7C15)
            left, right = right, left ^ (mixed(right ^ round_key) & low)
        number = (left << half) | right
        if number < n:
            return number


def plain_order(rows, ranks, key: int, length: int, per_shard: int) -> list[tuple]:
    """(slot, shard, byte_offset, doc_id, part, tokens), from (doc_id, text, h1, h2) rows."""
    tokenizer = training_order.Tokenizer(ranks, PATTERN)
    found = []
    for doc_id, text, _, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])):
        ids = [*tokenizer.encoding.encode_ordinary(text), tokenizer.end]
        for part, at in enumerate(range(0, len(ids), length)):
            own = ids[at : at + length]
            found.append((doc_id, part, np.array(own + [tokenizer.end] * (length - len(own)), "<u2").tobytes()))
    slots = [walk(number, len(found), key) for number in range(len(found))]
    return sorted((s, s // per_shard, s % per_shard * length * 2, *f) for s, f in zip(slots, found, strict=True))


ODD = [
    *[(n, f"text {n} of  some\n length " * (n % 7)) for n in range(40)],
    (3, "another text of a known id"),
    (5, "a repeated row"),
    (5, "a repeated row"),
    (None, "a text without an id"),
    (50, None),
    (51, ""),
    (52, "a long text, cut into many sequences " * 400),
    (53, "x" * 5000),
]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_order_is_that_of_a_plain_walk_however_rows_are_dealt(spark, ranks, partitions):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("file", F.lit("clash")).withColumn("ids", F.lit(1))
    order = training_order.written_order(docs.repartition(partitions), ranks, PATTERN, 11, per_shard=16, length=32)
    hashed = docs.where("text is not null").select("doc_id", "text", F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))
    want = plain_order([tuple(r) for r in hashed.collect()], ranks, 11, 32, 16)
    assert sorted((*r[:5], bytes(r[5])) for r in order.collect()) == want


def test_small_bundles_give_the_same_order(spark, ranks, monkeypatch):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    rows = lambda: sorted((*r[:5], bytes(r[5])) for r in training_order.written_order(docs, ranks, PATTERN, 1, 16, 32).collect())
    plain = rows()
    for name, value in (("AT_ONCE", 300), ("BUNDLED", 100), ("WRITTEN", 1)):
        monkeypatch.setattr(training_order, name, value)
    assert rows() == plain


def test_ids_of_any_type_and_empty_tables(spark, ranks):
    docs = spark.createDataFrame([("b", "two words"), ("a", "one"), (None, "none")], "doc_id string, text string")
    order = training_order.written_order(docs, ranks, PATTERN, 1, per_shard=2, length=8)
    assert sorted(r["slot"] for r in order.collect()) == [0, 1, 2]
    assert {r["doc_id"] for r in order.collect()} == {"a", "b", None}
    assert training_order.written_order(docs.where("false"), ranks, PATTERN, 1).count() == 0


def test_units_of_odd_texts_give_the_ids_of_whole_texts(ranks):
    tokenizer = training_order.Tokenizer(ranks, PATTERN)
    rng = np.random.default_rng(1)
    letters = ["a", "B", "7", "'s", ".", " ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", " ", "　", " ", "é", "ß", "字", "🙂", "​", "﻿", "_"]
    texts = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 40, 3000)]
    ids, counts = tokenizer.encode_texts(texts)
    want = [[*tokenizer.encoding.encode_ordinary(t), tokenizer.end] for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert tokenizer.encode_texts(pa.array([], pa.string()))[1].tolist() == []
    assert tokenizer.encode_texts(pa.array([None, ""], pa.string()))[1].tolist() == [1, 1]


@pytest.mark.parametrize("distinct", [0, 1, 5, 256, 257, 5000, 50_000, 65_536])
def test_packed_ids_come_back(distinct):
    rng = np.random.default_rng(distinct)
    ids = np.concatenate([rng.permutation(65_536)[:distinct], rng.integers(0, max(distinct, 1), 2 * distinct)]).astype(np.uint16)
    assert (training_order.unpacked(training_order.packed(ids)) == ids).all()
