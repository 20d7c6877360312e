"""Ranked lexical search over bit-sliced Bloom signatures.

The index keeps documents in blocks. A block has a bit matrix with one row (slice) for each bit of a signature and one
column for each document: the rows of a term, ANDed, are a bitmap of the documents that may hold it. A second matrix
does so for terms that a document holds twice or more. Summing the slices of a query's terms, weighted by the most that
a term can add to a document, gives an upper bound on every document's score. Documents whose bound reaches the tenth
best score known so far are scored exactly from their text; all others are proven to rank lower.

Documents of a block have similar numbers of distinct terms, so that short and long ones get signatures of their size.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from keeprule.llm.common import pieces, stored, text_bytes
from keeprule.llm.shingles import BASE, INVERSE, mix
from keeprule.session import new_folder

#: Bytes of text that become blocks together; documents of a block, and cells of its bit matrix, at most.
AT_ONCE, BLOCK_DOCS, BLOCK_CELLS = 2_000_000, 512, 1 << 22
#: Rows of a term, and bits of a signature for each distinct term.
SLICES, BITS_PER_TERM, LEAST_BITS = 2, 8, 64
#: Items and distinct terms that one pass over the index answers, at most; a longer item is a pass of its own.
ITEMS, TERMS = 256, 8_192

#: The bytes of terms: digits, letters, and all bytes of characters beyond ASCII.
IS_TERM = np.zeros(256, bool)
IS_TERM[128:] = True
for _first, _last in ("09", "AZ", "az"):
    IS_TERM[ord(_first) : ord(_last) + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Terms:
    """The terms of several texts: the distinct ones, and for each occurrence its text and its distinct term."""

    def __init__(self, texts: pa.Array):
        empty, line_feed = (pa.scalar(v, pa.large_string()) for v in ("", "\n"))
        data, offsets = text_bytes(pc.binary_join_element_wise(texts.cast(pa.large_string()).fill_null(empty), empty, line_feed))
        inside = IS_TERM[data]
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # texts end in a line feed, so terms do not touch
        if len(data) and inside[0]:
            change = np.concatenate([[0], change])
        starts, ends = change[0::2], change[1::2]
        self.text = np.searchsorted(offsets, starts, side="right") - 1
        bounds = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=bounds[1:])
        letters = LOWER[data[inside]]
        found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
        coded = found.dictionary_encode()
        self.distinct, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, distinct term and number of occurrences of every pair that occurs, sorted by text."""
        pair, tf = np.unique(self.text * max(1, len(self.distinct)) + self.code, return_counts=True)
        return *np.divmod(pair, max(1, len(self.distinct))), tf


def hashes(terms: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(terms)
    sums = np.zeros(len(data) + 1, np.uint64)
    powers = np.cumprod(np.full(len(data), BASE, np.uint64), dtype=np.uint64)
    np.cumsum((data + np.uint64(1)) * powers, dtype=np.uint64, out=sums[1:])
    back = np.cumprod(np.full(len(data) + 1, INVERSE, np.uint64), dtype=np.uint64)
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) * back[offsets[:-1]])


def rows_of(hashed: np.ndarray, bits: int) -> np.ndarray:
    """The slices of each term in a signature of ``bits`` bits, one line for each of SLICES."""
    step = (hashed >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashed + np.uint64(j) * step) % np.uint64(bits) for j in range(SLICES)]).astype(np.int64)


def _bits_for(n_terms: int) -> int:
    return max(LEAST_BITS, 1 << max(0, int(n_terms * BITS_PER_TERM - 1)).bit_length())


def _sliced(doc: np.ndarray, hashed: np.ndarray, bits: int, n_docs: int) -> bytes:
    cells = np.zeros((bits, n_docs), bool)
    for rows in rows_of(hashed, bits):
        cells[rows, doc] = True
    return np.packbits(cells, axis=1).tobytes()


def _index_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("ids", pa.list_(id_type)), ("n", pa.list_(pa.int64())), ("most", pa.list_(pa.int64())),
            ("bits", pa.int32()), ("once", pa.binary()), ("bits_twice", pa.int32()), ("twice", pa.binary()),
            ("texts", pa.list_(pa.string())), ("terms", pa.list_(pa.string())), ("df", pa.list_(pa.int64())),
        ]
    )


def _blocks(batch: pa.RecordBatch) -> Iterator[dict]:
    """The blocks of a batch, and the terms of the batch with the number of its documents that hold each."""
    terms = Terms(batch.column("text"))
    doc, code, tf = terms.counts()
    n = np.bincount(terms.text, minlength=batch.num_rows)
    distinct = np.bincount(doc, minlength=batch.num_rows)
    most = np.zeros(batch.num_rows, np.int64)
    np.maximum.at(most, doc, tf)
    hashed = hashes(terms.distinct)
    first = np.cumsum(distinct) - distinct
    sizes = np.array([_bits_for(d) for d in distinct.tolist()])
    order = np.argsort(sizes, kind="stable")
    yield {"terms": terms.distinct.to_pylist(), "df": np.bincount(code, minlength=len(terms.distinct)).tolist()}
    start = 0
    while start < len(order):
        bits = int(sizes[order[start]])
        stop = min(start + BLOCK_DOCS, start + max(1, BLOCK_CELLS // bits), int(np.searchsorted(sizes[order], bits, side="right")))
        docs = order[start:stop]
        pairs = np.concatenate([np.arange(first[d], first[d] + distinct[d]) for d in docs])
        place = np.repeat(np.arange(len(docs)), distinct[docs])
        again = tf[pairs] > 1
        bits_twice = _bits_for(int(np.bincount(place[again], minlength=len(docs)).max()))
        rows = batch.take(pa.array(docs))
        yield {
            "ids": rows.column("doc_id").to_pylist(), "n": n[docs].tolist(), "most": most[docs].tolist(),
            "bits": bits, "once": _sliced(place, hashed[code[pairs]], bits, len(docs)),
            "bits_twice": bits_twice, "twice": _sliced(place[again], hashed[code[pairs][again]], bits_twice, len(docs)),
            "texts": rows.column("text").to_pylist(),
        }
        start = stop


def build_index(docs: DataFrame) -> DataFrame:
    """The index of all rows of ``docs``, written to the shared folder.

    A row is a block (ids, n, most, the two bit matrices, texts), or the terms of some documents with their df.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = _index_schema(to_arrow_type(docs.schema["doc_id"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", AT_ONCE):
                for block in _blocks(part):
                    yield pa.RecordBatch.from_pylist([block], schema)

    columns = f"ids array<{kind}>, n array<long>, most array<long>, bits int, once binary, bits_twice int, twice binary, texts array<string>, terms array<string>, df array<long>"
    found = docs.select("doc_id", "text").mapInArrow(run, columns)
    path = new_folder(docs.sparkSession, "signatures")
    found.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


class Queries:
    """A block of items: their distinct terms, how often each item holds each, and the terms' weights."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [n for n, _ in items]
        terms = Terms(pa.array([text for _, text in items], pa.large_string()))
        self.terms = terms.distinct
        self.hashed = hashes(self.terms)
        self.times = np.zeros((len(items), len(self.terms)))
        item, code, tf = terms.counts()
        self.times[item, code] = tf

    def weigh(self, dfs: dict[str, int], n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        weights = [floor(1000 * log((2 * n_docs + 2) / (2 * dfs.get(t, 0) + 1))) for t in self.terms.to_pylist()]
        self.weights = np.array(weights, np.int64)
        if len(weights) and float((self.times * self.weights).sum(axis=1).max()) * 1e6 >= 2**53:
            raise ValueError("the sum of an item's weights is too large for exact sums")

    def length(self, n: np.ndarray) -> np.ndarray:
        return np.array([25 + 75 * int(x) * self.n_docs // max(1, self.n_terms) for x in n], np.int64)

    def bounds(self, block: dict) -> np.ndarray:
        """An upper bound on the score of each item (row) for each document of a block (column)."""
        n_docs = len(block["ids"])
        m = self.length(block["n"])
        most = np.maximum(np.array(block["most"], np.int64), 1)

        def held(matrix: bytes, bits: int) -> np.ndarray:
            slices = np.frombuffer(matrix, np.uint8).reshape(bits, -1)
            rows = slices[rows_of(self.hashed, bits)]
            return np.unpackbits(np.bitwise_and.reduce(rows, axis=0), axis=1, count=n_docs)

        once = held(block["once"], block["bits"])
        twice = held(block["twice"], block["bits_twice"]) & once
        least, full = _gain(np.int64(1), m), _gain(most, m)
        weighted = self.times * self.weights
        # float32 products of 0 and 1 with weights would round; whole numbers below 2 ** 53 are exact in float64.
        return (weighted @ once.astype(np.float64)) * least + (weighted @ twice.astype(np.float64)) * (full - least)

    def scores(self, texts: pa.Array, n: np.ndarray) -> np.ndarray:
        """The exact score of each item (row) for each text (column)."""
        terms = Terms(texts)
        doc, code, tf = terms.counts()
        wanted = pc.fill_null(pc.index_in(terms.distinct, value_set=self.terms), -1).to_numpy()[code]
        doc, tf, term = doc[wanted >= 0], tf[wanted >= 0], wanted[wanted >= 0]
        added = np.zeros((len(self.terms), len(texts)))
        added[term, doc] = self.weights[term] * _gain(tf, self.length(n)[doc])
        return self.times @ added


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds for each unit of its weight; it grows with ``tf``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Best:
    """The best documents of each item so far, and the score that a document has to reach."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.found: list[list[tuple[int, bool, object]]] = [[] for _ in range(n_items)]
        self.reach = np.ones(n_items)  # a score of 0 is none

    def add(self, scores: np.ndarray, ids: list) -> None:
        good = scores >= self.reach[:, None]
        for item in np.flatnonzero(good.any(axis=1)).tolist():
            new = [(-int(scores[item, d]), ids[d] is None, ids[d]) for d in np.flatnonzero(good[item]).tolist()]
            kept = sorted(self.found[item] + new, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[: self.top]
            self.found[item] = kept
            if len(kept) == self.top:
                self.reach[item] = -kept[-1][0]


def _answer(index: DataFrame, queries: Queries, top: int, kind: str) -> DataFrame:
    """item (position), doc_id, score: of every task the best documents it has seen."""
    shared = index.sparkSession.sparkContext.broadcast(queries)
    id_type = to_arrow_type(index.schema["ids"].dataType.elementType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best = Best(len(asked.items), top)
        for batch in batches:
            for row in range(batch.num_rows):
                block = {c: batch.column(c)[row].as_py() for c in ("ids", "n", "most", "bits", "once", "bits_twice", "twice")}
                texts = batch.column("texts")[row].values
                n, ids = np.array(block["n"], np.int64), block["ids"]
                bounds = asked.bounds(block)
                done = np.zeros(len(ids), bool)
                # First the documents with the highest bounds, which raise what the others have to reach.
                for first in (True, False):
                    open_pairs = (bounds >= best.reach[:, None]) & ~done
                    if first and len(ids) > top:
                        high = np.partition(bounds, len(ids) - top, axis=1)[:, len(ids) - top]
                        open_pairs &= bounds >= high[:, None]
                    docs = np.flatnonzero(open_pairs.any(axis=0))
                    if len(docs):
                        best.add(asked.scores(texts.take(pa.array(docs)), n[docs]), [ids[d] for d in docs.tolist()])
                        done[docs] = True
        rows = [(asked.items[i], x[2], -x[0]) for i, found in enumerate(best.found) for x in found]
        item, ids, score = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(ids, id_type), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    blocks = index.where(F.col("bits").isNotNull()).drop("terms", "df")
    return blocks.mapInArrow(run, f"item long, doc_id {kind}, score long")


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int, object, str]]]:
    """Position, id and text of the items, in blocks of at most ITEMS items and about TERMS terms."""
    held, size = [], 0
    for position, row in enumerate(items.toLocalIterator()):
        text = row["text"] or ""
        terms = text.count(" ") + text.count("\n") + 1
        if held and (len(held) == ITEMS or size + terms > TERMS):
            yield held
            held, size = [], 0
        held.append((position, row["item_id"], text))
        size += terms
    if held:
        yield held


def _stored_in_small_batches(df: DataFrame, name: str) -> DataFrame:
    """Rows of the index are blocks of up to AT_ONCE bytes: a few at a time go to Python."""
    conf, setting = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(setting)
    conf.set(setting, "8")
    try:
        return stored(df, name)
    finally:
        conf.set(setting, before)


def search(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item with a score above 0.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, only A-Z in lower case. An item without terms,
    or of which no document holds a term, gives no row, and neither do null texts. Equal scores rank by doc_id, rows
    without an id last. Repeated documents and repeated items each count for themselves. Other columns of either table
    are not read. All documents are answered for; items go to the index in blocks of bounded size.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    index = build_index(docs)
    sizes = index.where(F.col("bits").isNotNull()).select(F.explode("n").alias("n"))
    n_docs, n_terms = sizes.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = index.where(F.col("terms").isNotNull()).select(F.explode(F.arrays_zip("terms", "df")).alias("t"))
    dfs = stored(held.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.df").alias("df")), "frequencies")

    names = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", items.schema["item_id"].dataType)])
    found = spark.createDataFrame([], f"item long, item_id {dict(items.dtypes)['item_id']}, doc_id {kind}, score long")
    for block in _item_blocks(items.select("item_id", "text")):
        queries = Queries([(position, text) for position, _, text in block])
        wanted = spark.createDataFrame([(t,) for t in queries.terms.to_pylist()], "term string")  # about TERMS
        queries.weigh({r["term"]: r["df"] for r in dfs.join(F.broadcast(wanted), "term").collect()}, n_docs, n_terms)
        answers = _stored_in_small_batches(_answer(index, queries, top, kind), "answers")
        asked = spark.createDataFrame([row[:2] for row in block], names)  # ITEMS at most
        found = found.unionByName(answers.join(F.broadcast(asked), "item"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
