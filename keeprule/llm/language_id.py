"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of variable order holds frozen counts. A byte that a context has not seen
costs that context's escape probability, and the next shorter context decides. A text's code length in a language is
the sum over its bytes; the language with the shortest code wins. Bytes are those of the text in lower case; ASCII
bytes that are no letters count as one separator.

The trees are fitted on a bounded sample of the learning documents (``sample_bytes`` of text for each language, in pieces
chosen by a hash of the document and the piece's number, so that long documents are drawn in part) and sent to every task as one table of code lengths, indexed by context node and byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keeprule.llm.common import pieces, text_bytes

ORDER = 3
#: Contexts of the longest order seen less often than this stay leaves of the next shorter one.
MIN_SEEN = 12
#: Bytes of text that are scored at once.
AT_ONCE = 500_000
#: Bytes of text that the learning sample is drawn by.
PIECE = 4096
#: The numbers that a piece's hash is drawn from.
DRAWS = 1 << 40
UNKNOWN = "und"


def _symbols() -> tuple[np.ndarray, int]:
    """Symbol of each byte: separator, the letters a to z, and every byte of a longer UTF-8 sequence."""
    of_byte = np.zeros(256, np.int64)
    of_byte[ord("a") : ord("z") + 1] = np.arange(1, 27)
    of_byte[0x80:0xF5] = np.arange(27, 27 + 0xF5 - 0x80)
    return of_byte, 27 + 0xF5 - 0x80


SYMBOL, SIZE = _symbols()


def contexts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each byte's symbol, the number of the three symbols before it (separators before the start), and the offsets."""
    data, offsets = text_bytes(pc.utf8_lower(texts.fill_null("")))
    symbol = SYMBOL[data]
    at = np.arange(len(symbol)) - np.repeat(offsets[:-1], np.diff(offsets))
    context = np.zeros(len(symbol), np.int64)
    for back in range(ORDER, 0, -1):
        before = np.zeros(len(symbol), np.int64)
        before[back:] = symbol[:-back] if len(symbol) > back else []
        before[at < back] = 0
        context = context * SIZE + before
    return symbol, context, offsets


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text", AT_ONCE):
            langs = part.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                of_lang = part.filter(pa.array([x == lang for x in langs]))
                symbol, context, _ = contexts(of_lang.column("text"))
                grams, n = np.unique(context * SIZE + symbol, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"]
                )


def _drawn_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) of the pieces of each text whose numbers are in ``drawn``, cut at whole characters."""
    for batch in batches:
        for at, (lang, drawn) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("drawn").to_pylist(), strict=True)):
            data = memoryview(batch.column("text")[at].as_buffer())
            texts = [bytes(data[p * PIECE : (p + 1) * PIECE]).decode("utf-8", "ignore") for p in drawn]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(texts), pa.string()), pa.array(texts, pa.string())], ["lang", "text"])


def sample(docs: DataFrame, learn: Column, sample_bytes: int) -> DataFrame:
    """(lang, text): pieces of the texts of each language, about ``sample_bytes`` together but one piece at least."""
    rows = docs.where(learn & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select("doc_id", "lang", "text")
    last = F.floor((F.octet_length("text") - 1) / PIECE).cast("long")
    rows = rows.select("lang", "text", F.xxhash64("doc_id", "text").alias("seed"), F.sequence(F.lit(0).cast("long"), last).alias("numbers"))
    lot = lambda p: F.pmod(F.xxhash64("seed", p), F.lit(DRAWS))
    of_lang = rows.groupBy("lang").agg(
        F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.min(F.array_min(F.transform("numbers", lot))).alias("first")
    ).collect()  # languages
    if not of_lang:
        return docs.sparkSession.createDataFrame([], "lang string, text string")
    parts = ((r, min(1.0, sample_bytes / r["bytes"])) for r in of_lang)
    below = F.create_map(*[F.lit(v) for r, part in parts for v in (r["lang"], max(int(part * DRAWS), r["first"] + 1))])
    drawn = rows.withColumn("below", below[F.col("lang")]).select(
        "lang", "text", F.filter("numbers", lambda p: lot(p) < F.col("below")).alias("drawn")
    )
    return drawn.where(F.size("drawn") > 0).mapInArrow(_drawn_pieces, "lang string, text string")


def gram_counts(docs: DataFrame, learn: Column, sample_bytes: int) -> DataFrame:
    """Counts (lang, gram, n) of byte sequences over a sample of about ``sample_bytes`` for each language."""
    counted = sample(docs, learn, sample_bytes).mapInArrow(_count_batches, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Code lengths in bits by context node and symbol, a column for each language."""

    def __init__(self, langs: list[str], node_of: np.ndarray, bits: np.ndarray):
        self.langs, self.node_of, self.bits = langs, node_of, bits

    @classmethod
    def fit(cls, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> ContextTrees:
        """From counts of sequences of ORDER + 1 symbols; ``lang`` holds positions in ``langs``."""
        node_of = np.zeros(SIZE**ORDER, np.int32)
        shorter_names, blocks, first = np.zeros(1, np.int64), [], 0
        for order in range(ORDER + 1):
            context, symbol = gram // SIZE % SIZE**order, gram % SIZE
            names, where = np.unique(context, return_inverse=True)
            seen = np.bincount(where, weights=n)
            keep = seen >= (MIN_SEEN if order else 0)
            place = np.where(keep, np.cumsum(keep) - 1, -1)
            names = names[keep]
            inside = place[where] >= 0
            counts = np.zeros((len(names), SIZE, len(langs)))
            np.add.at(counts, (place[where[inside]], symbol[inside], lang[inside]), n[inside])
            if order == 0:
                shorter = np.full(counts.shape, 1 / SIZE)  # order -1: every symbol alike
            else:
                shorter = blocks[-1][np.searchsorted(shorter_names, names % SIZE ** (order - 1))]
            total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
            escape = np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0)
            blocks.append(np.where(counts > 0, counts / np.maximum(total + kinds, 1), escape * shorter).astype(np.float32))
            if order:
                fill = node_of.reshape(-1, SIZE**order)
                fill[:, names] = first + np.arange(len(names), dtype=np.int32)
            shorter_names = names
            first += len(names)
        table = -np.log2(np.concatenate(blocks)).astype(np.float32)
        return cls(langs, node_of, table.reshape(len(table) * SIZE, len(langs)))

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of every text in every language."""
        symbol, context, offsets = contexts(texts)
        out = np.zeros((len(texts), len(self.langs)))
        filled = np.flatnonzero(np.diff(offsets) > 0)
        if len(filled):
            bits = self.bits[self.node_of[context].astype(np.int64) * SIZE + symbol]
            out[filled] = np.add.reduceat(bits, offsets[:-1][filled], axis=0, dtype=np.float64)
        return out


def fit(docs: DataFrame, learn: Column, sample_bytes: int = 1_500_000) -> ContextTrees:
    """Trees of all languages that learning rows name; the counts collected are bounded by the sample."""
    counts = gram_counts(docs, learn, sample_bytes).toPandas()
    langs = sorted(counts["lang"].unique()) if len(counts) else []
    lang = np.searchsorted(langs, counts["lang"]) if langs else np.zeros(0, int)
    gram, n = counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    order = np.lexsort((lang, gram))
    return ContextTrees.fit(langs, np.asarray(lang)[order], gram[order], n[order])


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def identify(docs: DataFrame, trees: ContextTrees, *keep: str) -> DataFrame:
    """``docs`` (doc_id and the columns ``keep``) with lang_pred and score.

    lang_pred is ``und`` for a null text, a text without a letter, or if no language was learned; its score is 0. The
    score of others is the probability of the language if all were equally likely before.
    """
    kept = list(dict.fromkeys(["doc_id", *keep]))
    shared = docs.sparkSession.sparkContext.broadcast((trees.langs, trees.node_of, trees.bits))
    rows = docs.select(*kept, F.col("text").alias("scored text"))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*kept).dtypes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ContextTrees(*shared.value)
        for batch in batches:
            for part in pieces(batch, "scored text", AT_ONCE):
                texts = part.column("scored text")
                known = np.fromiter(map(_has_letter, texts.to_pylist()), bool, len(texts))
                if model.langs:
                    bits = model.code_lengths(texts)
                    best = bits.argmin(1)
                    score = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                    names = np.array(model.langs, object)[best]
                else:
                    known[:] = False
                    score, names = np.zeros(len(texts)), np.full(len(texts), UNKNOWN, object)
                columns = [part.column(name) for name in kept]
                columns += [pa.array(np.where(known, names, UNKNOWN), pa.string()), pa.array(np.where(known, score, 0.0))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "lang_pred", "score"])

    return rows.mapInArrow(score, f"{schema}, lang_pred string, score double")


def identifiable(docs: DataFrame, trees: ContextTrees, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with their columns, whose language is told with at least ``min_score``."""
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    found = identify(packed, trees, "row")
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
