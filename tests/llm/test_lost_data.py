"""Cases in which data once was lost: glued and wrapped encodings, repeated ids and rows, ids of other types."""

import base64
import gzip
import sys
import textwrap
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent.parent.parent))

from keeprule.llm import decontaminate, jaccard_join, quality_classifier, secrets

SECRET = "password = hunter2secret"


@pytest.mark.parametrize("glued", ["k", "ke", "key", "key/", "/x/", "a/long/path/to/some_", "0123456789abcdef_"])
@pytest.mark.parametrize("inner", [SECRET.encode(), gzip.compress(SECRET.encode()), b"x" * 40 + SECRET.encode()])
def test_a_secret_behind_glued_characters(glued, inner):
    run = glued + base64.b64encode(inner).decode()
    spans = secrets.all_spans(f"see {run} there")[1]
    assert (4, "assign", 4 + len(run)) in spans


def test_what_follows_an_encoded_secret_does_not_hide_it():
    run = base64.b64encode(SECRET.encode()).decode().rstrip("=") + "/and/more"
    assert [s[1] for s in secrets.all_spans(run)[1]] == ["assign"]


@pytest.mark.parametrize("width", [64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n  "])
@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress, zlib.compress])
def test_encodings_wrapped_at_line_ends(width, end, pack):
    rng = np.random.default_rng(3)
    noise = "".join(rng.choice(list("abcdefghij klmnop"), 700))
    encoded = base64.b64encode(pack(f"{noise}\n{SECRET}\n{noise}".encode())).decode()
    block = end.join(textwrap.wrap(encoded, width))
    spans = secrets.all_spans(f"begin\n{block}\nend.")[1]
    assert any(kind == "assign" and start <= 6 and stop >= 6 + len(block.rstrip("=")) for start, kind, stop in spans)


def test_ordinary_long_words_give_no_spans():
    text = "Donaudampfschifffahrtsgesellschaft/" * 50 + "\nincomprehensibilities internationalization\n" + "x" * 100_000
    assert secrets.all_spans(text)[1] == []


def test_rows_that_repeat_are_drawn_as_one(spark):
    rows = spark.range(6_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "one text that is repeated very often").otherwise(F.concat(F.lit("some words and number "), "id")).alias("text"),
    )
    collected = []
    real = quality_classifier.LabelModel.posterior

    def counted(self, patterns):
        collected.append(len(patterns))
        return real(self, patterns)

    quality_classifier.LabelModel.posterior = counted
    try:
        for n in (50, 400, 2_000):
            quality_classifier.fit(rows, sample_rows=n, rounds=2)
    finally:
        quality_classifier.LabelModel.posterior = real
    assert all(got <= 2 * n for got, n in zip(collected, (50, 400, 2_000), strict=False))


def test_every_text_of_a_kept_id_stays(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame(
        [(1, words, "b"), (1, words, "a"), (1, "another text of the same id", "c"), (2, words + " more", "d"), (None, words, "e"), (None, None, "f"), (3, None, "g")],
        "doc_id long, text string, source string",
    )
    for parts in (1, 4):
        kept = sorted((r["doc_id"] or 0, r["text"] or "", r["source"]) for r in jaccard_join.one_of_each(docs.repartition(parts)).collect())
        assert kept == sorted([(1, words, "a"), (1, "another text of the same id", "c"), (0, words, "e"), (0, "", "f"), (3, "", "g")])


@pytest.mark.parametrize("kind, ids", [("string", ["x", "y", None]), ("int", [1, 2, None]), ("decimal(5,1)", [None, None, None])])
def test_items_with_ids_of_any_type(spark, kind, ids):
    item = "What is the capital of the country that lies north of the long river?"
    benchmark = spark.createDataFrame([(i, item) for i in ids], f"item_id {kind}, text string")
    docs = spark.createDataFrame([("d", f"text. {item} text"), ("e", "nothing"), ("f", None)], "doc_id string, text string")
    found = decontaminate.contamination(docs, benchmark).collect()
    assert {r["doc_id"] for r in found} == {"d"}
    assert sorted(map(str, (r["item_id"] for r in found))) == sorted(map(str, set(ids)))
    assert [r["doc_id"] for r in decontaminate.without_contamination(docs, benchmark).collect()] == ["e", "f"]
