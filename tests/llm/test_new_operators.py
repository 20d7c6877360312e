"""Collocations, ranked search and sharding: plain versions, odd input, and what they may not depend on."""

import json
import random
import re
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from math import floor, log
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent.parent.parent))
sys.path.insert(0, str(Path(__file__).parent.parent))

from compare import connect, differences
from keeprule.llm import collocations, ranked_search, sharding
from keeprule.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id long, text string, lang string, size long, shard int, score double, row string, h1 long, words string"
ODD = [None, "", " \n\t ", "word", "É!", "a b c d e", "a b c d e", "x" * 300_000, "line " * 40_000, "▁   漢字 🙂", "A.b,c;d:e!f?g\x0bh"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names the operators use themselves."""
    rows = [(n, text, "en" if n % 2 else None, None, None, 0.5, "r", 1, "w") for n, text in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[5], rows[5], (None, "a b c d e", *[None] * 7)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op11_collocations", "op12_ranked_search", "op13_sharding"])
def test_queries_give_what_their_sql_gives(spark, name):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) is None


# --- collocations ---------------------------------------------------------------


def plain_collocations(docs, least, top):
    """docs: (text, lang). Every phrase of every piece is counted as it stands."""
    counts, totals = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, 6):
                counts[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    rows = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i : i + n]] = max(longer[p[i : i + n]], a)
        found = []
        for p, a in candidates.items():
            if 100 * longer[p] >= 100 * a:
                continue
            cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


def collocated(docs, least, top=2000):
    return sorted(tuple(r) for r in collocations.collocations(docs, least, top).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_against_a_plain_count(spark, seed, monkeypatch):
    """Small vocabularies, repeated passages, pieces that end within chunks; small slices and tasks that hand on early."""
    monkeypatch.setattr(collocations, "AT_ONCE", 3_000)
    monkeypatch.setattr(collocations, "HELD", 400)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["Ä", "漢", "x'y", "A", "a"]
    passage = " ".join(rng.choice(words) for _ in range(40))
    docs = []
    for _ in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "! "]) for _ in range(rng.randint(0, 60)))
        docs.append((text + (passage if rng.random() < 0.3 else ""), rng.choice(["en", "de", None])))
    table = spark.createDataFrame(docs, "text string, lang string").repartition(5)
    assert collocated(table, 8, 60) == plain_collocations(docs, 8, 60)


def test_collocations_of_one_word_many_times(spark):
    docs = [("a " * 5_000, "en"), ("b b", "en")]
    assert collocated(spark.createDataFrame(docs, "text string, lang string"), 3) == plain_collocations(docs, 3, 2000)


def test_collocations_of_odd_tables(spark, odd, empty):
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    assert collocated(odd, 3) == plain_collocations(rows, 3, 2000)
    assert collocated(empty, 3) == []


def test_chunks_own_every_word_once(spark):
    rng = random.Random(5)
    docs = [(" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 700))), "en") for _ in range(20)]
    chunks = collocations.chunk_dictionary(spark.createDataFrame(docs + docs[:3], "text string, lang string"))
    assert chunks.agg(F.sum(F.col("own") * F.col("freq"))).first()[0] == sum(len(t.split()) for t, _ in docs + docs[:3])
    assert chunks.agg(F.max("own")).first()[0] <= collocations.LONGEST


def test_frequent_words_and_pairs_are_handed_on_by_one_count_only(spark, monkeypatch):
    """200 frequent pairs, two of them behind each other: the last count hands on the phrases of three words and more alone."""
    rng, counts = random.Random(7), []
    pairs = [f"a{i} b{i}" for i in range(200)]
    docs = [(". ".join([*rng.sample(pairs, len(pairs)), "a1 b1 a2 b2"]), "en") for _ in range(40)]
    table = spark.createDataFrame(docs, "text string, lang string").repartition(4)
    plain = type(table).mapInArrow
    monkeypatch.setattr(type(table), "mapInArrow", lambda *args, **more: counts.append(plain(*args, **more)) or counts[-1])
    assert collocated(table, 8) == plain_collocations(docs, 8, 2000)
    handed = [{r["part"] for r in c.collect()} for c in counts if "part" in c.columns]
    assert handed[-1] == {"a1 b1 a2", "b1 a2 b2", "a1 b1 a2 b2"}
    assert set(pairs) | {w for p in pairs for w in p.split()} <= set().union(*handed)


def test_text_of_many_phrases_is_cut_out_in_little_memory():
    """Places of bytes are made for part of the phrases at a time, and give the same text."""
    words = collocations.Words(pa.array([" ".join(f"w{i}" for i in range(40_000))]))
    first = np.arange(len(words) - 4)
    tracemalloc.start()
    cut = words.slices(first, first + 4)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert cut.to_pylist() == [" ".join(f"w{j}" for j in range(i, i + 5)) for i in range(len(first))]
    assert most < 16_000_000  # 1.3 MB of text, of which places for all at once take 30 MB


def test_a_task_holds_few_bytes_of_counts_however_long_the_rows():
    """100 MB of long chunks, far fewer than HELD rows: what is held stays within a few times HELD_BYTES."""
    ones, own = pa.array([1] * 1_000, pa.int64()), pa.array([1] * 1_000, pa.int32())
    start, most, handed = pa.total_allocated_bytes(), 0, 0

    def tables():
        nonlocal most
        for n in range(100):
            chunk = pa.array([f"{n} {i} ".ljust(1_000, "x") for i in range(1_000)], pa.large_string())
            yield pa.table({"lang": pa.array(["en"] * 1_000), "chunk": chunk, "own": own, "freq": ones})
            most = max(most, pa.total_allocated_bytes() - start)

    for batch in collocations._totals(tables(), collocations.CHUNKS, "freq"):
        handed += batch.num_rows
    assert handed == 100_000
    assert most < 50_000_000


# --- ranked search --------------------------------------------------------------


def plain_search(docs, items, top=10):
    """docs: (doc_id, text); items: (item_id, text). Every document is scored for every item."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(lower))
    terms = [(i, Counter(split(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    weight = lambda t: floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1)))
    rows = []
    for item_id, text in items:
        asked = Counter(split(text))
        found = []
        for doc_id, c in terms:
            if not c:
                continue
            m = 100 - 75 + 75 * c.total() * n_docs // n_terms
            score = sum(k * weight(t) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, k in asked.items() if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, r, x[3], -x[0]) for r, x in enumerate(sorted(found)[:top], 1)]
    return Counter(rows)


def searched(docs, items, top=10):
    return Counter(tuple(r) for r in ranked_search.search(docs, items, top).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_search_against_scoring_everything(spark, seed, monkeypatch):
    """Ties, long and short documents, items in several passes, small blocks."""
    monkeypatch.setattr(ranked_search, "AT_ONCE", 4_000)
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(ranked_search, "ITEMS", 5)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["É", "été", "漢字", "A1", "a1"]
    text = lambda most: rng.choice([" ", "-", ", "]).join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.randint(0, most)))
    docs = [(i, text(rng.choice([3, 20, 300]))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(15)] + [(2000, None), (2001, "")]  # equal scores
    items = [(i, text(15)) for i in range(12)] + [(50, docs[7][1]), (51, "nowhere"), (52, ""), (53, None), (0, "w1 w1 w2")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert searched(table, asked) == plain_search(docs, items)
    assert searched(table, asked, 3) == plain_search(docs, items, 3)


def test_search_of_odd_tables(spark, odd, empty):
    items = [("x", "a e line"), ("y", "漢字 É word"), ("x", "a e line")]
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id string, text string, score int")
    assert searched(odd, asked) == plain_search([(r["doc_id"], r["text"]) for r in odd.collect()], items)
    assert searched(empty, asked) == Counter() and searched(odd, asked.limit(0)) == Counter()


def test_no_bound_is_below_its_score():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 2) for _ in range(rng.randint(1, 80))) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    blocks = list(ranked_search._blocks(batch))
    queries = ranked_search.Queries([(0, "a bb c"), (1, "p p o nn"), (2, "zz a")])
    df = dict(zip(blocks[0]["terms"], blocks[0]["df"], strict=True))
    queries.weigh(df, len(texts), sum(len(t.split()) for t in texts))
    left_out = 0
    for block in blocks[1:]:
        bounds = queries.bounds(block)
        scores = queries.scores(pa.array(block["texts"]), block["n"])
        assert (bounds >= scores).all()
        left_out += int((bounds == 0).sum())
    assert left_out  # the signatures do exclude


# --- sharding -------------------------------------------------------------------


def plain_positions(n, key):
    """A Feistel network over pairs, walked until it falls below n."""
    a, b = sharding.near_square(n)

    def scrambled(x, m, o):
        mixed = (x % sharding.PRIME * m + o) % sharding.PRIME
        return (mixed * mixed % sharding.PRIME * m + o) % sharding.PRIME

    found = []
    for number in range(n):
        value = None
        while value is None or value >= n:
            left, right = divmod(number if value is None else value, b)
            for m, u, v in sharding.round_keys(key):
                left = (left + scrambled(right, m, u)) % a
                right = (right + scrambled(left, m, v)) % b
            value = left * b + right
        found.append(value)
    return found


@pytest.mark.parametrize("n", [1, 2, 7, 24, 101, 1013])
def test_positions_are_a_walked_feistel_permutation(spark, n):
    got = [r[1] for r in spark.range(n).select("id", sharding.permuted(F.col("id"), n, 99)).orderBy("id").collect()]
    assert got == plain_positions(n, 99) and sorted(got) == list(range(n))
    a, b = sharding.near_square(n)
    assert n <= a * b < n + a


def test_the_ledger_follows_the_content_only(spark):
    rows = spark.range(500).select("id", F.concat(F.lit("text "), F.col("id") % 90).alias("text")).withColumnRenamed("id", "doc_id")
    ledgers = [Counter(tuple(r) for r in sharding.ledger(rows.repartition(p)).collect()) for p in (1, 3, 8)]
    assert ledgers[0] == ledgers[1] == ledgers[2]
    other = Counter(tuple(r) for r in sharding.ledger(rows, key=1).collect())
    assert other != ledgers[0]


def test_shards_of_odd_tables(spark, odd, empty):
    rows = sharding.ledger(odd, 4).collect()
    assert len(rows) == odd.count() and {r["law"] for r in rows} == {"rows"}
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(4)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    expected = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in odd.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    assert sharding.ledger(empty).collect() == []


def test_many_equal_rows_are_numbered(spark):
    rows = spark.range(7_000).select(F.lit(5).cast("long").alias("doc_id"), F.when(F.col("id") < 5_000, "same").otherwise(F.col("id").cast("string")).alias("text"))
    dealt = sharding.ledger(rows, 3).collect()
    assert sorted(r["position"] for r in dealt) == list(range(7_000))


def test_written_shards_hold_every_row_in_order(spark, odd, folder):
    sharding.write_shards(odd, f"{folder}/shards", 3)
    back = spark.read.parquet(f"{folder}/shards")
    whole = lambda rows: Counter(json.dumps(r.asDict(), sort_keys=True) for r in rows)
    assert whole(r["row"] for r in back.collect()) == whole(odd.collect())
    for shard in range(3):
        slots = [r["slot"] for r in spark.read.parquet(f"{folder}/shards/shard={shard}").orderBy(F.input_file_name()).collect()]
        assert sorted(slots) == list(range(len(slots)))
    plan = sharding.ledger(odd, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
