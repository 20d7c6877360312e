"""Collocations by prefix-free parsing: texts become a dictionary of chunks with the frequency of each in the parse.

A chunk begins at a word whose hash is a trigger (or at a text's start) and goes on to the next one, so that equal
passages give equal chunks wherever they stand. It overlaps the words that follow by one less than the longest phrase;
an n-gram is counted in the chunk that owns its first word, hence once. N-grams are counted in distinct chunks only,
each with its chunk's frequency.

A phrase is as frequent as asked only if its words and its word pairs are. Both are counted first, each occurrence once
and as text; bitmaps of fixed length keep the hashes of the frequent ones, whose collisions let more through to the count
of the longer phrases, never less. No task hands on a frequent word or pair a second time for that count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keeprule.llm.common import slices, stored, text_bytes
from keeprule.llm.shingles import BASE, INVERSE, mix
from keeprule.session import new_folder

MOST_WORDS = 5
#: One word in so many is a trigger; a chunk without one is cut after LONGEST own words.
TRIGGER, LONGEST = 16, 256
#: Bytes of text that are worked on at a time; rows of counts, and their bytes, that a task holds before it hands them on.
AT_ONCE, HELD, HELD_BYTES = 300_000, 300_000, 16_000_000
#: The bitmaps of frequent words and pairs have 2 ** FILTER_BITS bits.
FILTER_BITS = 26
#: The ranking of a language is prepared in so many parts.
PARTS = 32

SPACE, BREAK = ord(" "), ord("\n")
#: Each byte as it counts: A-Z in lower case, a tab as a space, the marks that end a piece as a line feed.
BYTES = np.arange(256, dtype=np.uint8)
BYTES[ord("A") : ord("Z") + 1] += 32
BYTES[ord("\t")] = SPACE
BYTES[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = BREAK
IS_WORD = ~np.isin(BYTES, [SPACE, BREAK])


POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` from the first on, kept for the next batch unless they are very many."""
    if len(POWERS.get(base, ())) >= n:
        return POWERS[base][:n]
    powers = np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)
    if n <= 2 * AT_ONCE:
        POWERS[base] = powers
    return powers


class Words:
    """The words of several texts: their text, which text each belongs to, and which are followed in the same piece."""

    def __init__(self, texts: pa.Array):
        empty, line_feed = (pa.scalar(v, pa.large_string()) for v in ("", "\n"))
        data, offsets = text_bytes(pc.binary_join_element_wise(texts.cast(pa.large_string()).fill_null(empty), empty, line_feed))
        inside = IS_WORD[data]
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # texts end in a line feed, so words do not touch
        if len(data) and inside[0]:
            change = np.concatenate([[0], change])
        starts, ends = change[0::2], change[1::2]
        data = BYTES[data]
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
        breaks = np.cumsum(data == BREAK, dtype=np.int32)
        #: Whether the next word stands in the same piece of the same text.
        self.goes_on = np.zeros(len(starts), bool)
        self.goes_on[:-1] = breaks[starts[1:]] == breaks[ends[:-1] - 1]
        self.lengths = ends - starts
        # The words behind each other with one byte between them: a space inside a piece, else a line feed.
        data[ends] = np.where(self.goes_on, SPACE, BREAK)
        inside[ends] = True
        self.line = data[inside]
        self.at = np.cumsum(self.lengths + 1) - (self.lengths + 1)

    def __len__(self) -> int:
        return len(self.at)

    def hashes(self) -> np.ndarray:
        """A hash of every word, from sums over the bytes up to its end and up to its start."""
        sums = np.zeros(len(self.line) + 1, np.uint64)
        np.cumsum((self.line + np.uint64(1)) * _powers(BASE, len(self.line)), dtype=np.uint64, out=sums[1:])
        return mix((sums[self.at + self.lengths] - sums[self.at]) * _powers(INVERSE, len(self.line) + 1)[self.at])

    def each(self) -> pa.Array:
        """The text of every word."""
        inside = np.ones(len(self.line), bool)
        inside[self.at + self.lengths] = False
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.lengths, out=offsets[1:])
        return pa.Array.from_buffers(pa.large_string(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.line[inside])])

    def slices(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The text from word ``first`` to word ``last`` of each pair."""
        begin, sizes = self.at[first], self.at[last] + self.lengths[last] - self.at[first]
        offsets = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        taken, i = np.empty(offsets[-1], np.uint8), 0
        while i < len(sizes):  # places take 8 times the bytes of the text, so they are made for AT_ONCE bytes, or a row
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + AT_ONCE, side="right")) - 1)
            places = np.arange(offsets[i], offsets[j]) + np.repeat(begin[i:j] - offsets[i:j], sizes[i:j])
            taken[offsets[i] : offsets[j]] = self.line[places]
            i = j
        return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(taken)])


def _slices_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut to about AT_ONCE bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        yield from slices(batch, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), AT_ONCE)


def _totals(tables: Iterator[pa.Table], schema: pa.Schema, count: str) -> Iterator[pa.RecordBatch]:
    """Sums of ``count`` by the other columns. What fits neither HELD nor HELD_BYTES is handed on, the smallest sums first."""
    keys = [c for c in schema.names if c != count]
    held: list[pa.Table] = []
    full = 0.0

    def share(table: pa.Table) -> float:
        return max(table.num_rows / HELD, table.nbytes / HELD_BYTES)

    def added() -> pa.Table:
        sums = pa.concat_tables(held).group_by(keys).aggregate([(count, "sum")])
        return sums.rename_columns([count if c == f"{count}_sum" else c for c in sums.column_names]).select(schema.names)

    for table in tables:
        held.append(table.select(schema.names).cast(schema))
        full += share(held[-1])
        if full > 1:
            sums = added()
            held, full = [sums], share(sums)
            if 2 * full > 1:
                order = np.argsort(sums[count].to_numpy())
                goes = len(order) - int(len(order) / (4 * full))
                held = [sums.take(order[goes:])]
                yield from sums.take(order[:goes]).cast(schema).to_batches(max_chunksize=50_000)
                full = share(held[0])
            del sums
            pa.default_memory_pool().release_unused()  # else a worker keeps the most it ever needed
    if held:
        yield from added().cast(schema).to_batches(max_chunksize=50_000)
    held.clear()
    pa.default_memory_pool().release_unused()


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, the sum of each, and the place where each occurs."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), ordered[1:] != ordered[:-1]]))
    sums = np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)
    return ordered[first], sums, order[first]


def _schema(**kinds: pa.DataType) -> pa.Schema:
    return pa.schema(list(kinds.items()))


CHUNKS = _schema(lang=pa.large_string(), chunk=pa.large_string(), own=pa.int32(), freq=pa.int64())
PHRASES = _schema(lang=pa.large_string(), part=pa.large_string(), f=pa.int64())


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with 32-bit offsets, as Spark takes them."""
    for batch in batches:
        kinds = [(f.name, pa.string() if f.type == pa.large_string() else f.type) for f in batch.schema]
        yield batch.cast(pa.schema(kinds))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for batch in _slices_of(batches, "text"):
        words = Words(batch.column("text"))
        n = len(words)
        if not n:
            continue
        triggered = words.hashes() % np.uint64(TRIGGER) == 0
        triggered[0] = True
        triggered[1:] |= words.text[1:] != words.text[:-1]
        begins = np.flatnonzero(triggered)
        since = np.arange(n) - np.repeat(begins, np.diff(begins, append=n))
        begins = np.flatnonzero(since % LONGEST == 0)
        own = np.diff(begins, append=n)
        last = begins + own - 1
        for _ in range(MOST_WORDS - 1):
            last = last + words.goes_on[last]
        lang = batch.column("lang").take(pa.array(words.text[begins]))
        ones = np.ones(len(own), np.int64)
        yield pa.table({"lang": lang, "chunk": words.slices(begins, last), "own": own.astype(np.int32), "freq": ones})


def chunk_dictionary(docs: DataFrame) -> DataFrame:
    """lang, chunk, own (words it owns) and freq: the distinct chunks of all texts, written to the shared folder."""
    texts = docs.where(F.col("text").isNotNull()).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _narrow(_totals(_parsed(batches), CHUNKS, "freq"))

    found = texts.mapInArrow(parse, "lang string, chunk string, own int, freq long")
    chunks = found.groupBy("lang", "chunk", "own").agg(F.sum("freq").alias("freq"))
    path = new_folder(docs.sparkSession, "chunks")
    chunks.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(chunks.schema).parquet(path)


class Owned:
    """The words of a batch of chunks: code and hash of each in its language, its chunk's frequency, and whether that owns it."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = Words(batch.column("chunk"))
        n, row = len(self.words), self.words.text
        per_row = np.bincount(row, minlength=batch.num_rows)
        place = np.arange(n) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        self.own = place < batch.column("own").to_numpy()[row]
        self.freq = batch.column("freq").to_numpy()[row]
        self.langs = batch.column("lang")
        langs = self.langs.dictionary_encode()
        lang = langs.indices.to_numpy()[row].astype(np.int64)
        coded = self.words.each().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        known = Words(coded.dictionary).hashes()
        seeds = [int.from_bytes(hashlib.blake2b(v.encode(), digest_size=8).digest(), "little") for v in langs.dictionary.to_pylist()]
        self.hash = known[code] ^ np.array(seeds, np.uint64)[lang] if n else np.zeros(0, np.uint64)
        #: Equal for equal words of a language, and below n_codes.
        self.code = code * max(1, len(langs.dictionary)) + lang
        self.n_codes = max(1, len(coded.dictionary) * len(langs.dictionary))

    def pairs(self) -> np.ndarray:
        """The hash of each word with the one behind it."""
        return mix(self.hash[:-1] * np.uint64(BASE) + self.hash[1:])


class Bitmap:
    """Hashes of what is frequent; others may be taken for such, none of them is missed."""

    def __init__(self, spark: SparkSession, frequent: DataFrame):
        place = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
        bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(hash, {64 - FILTER_BITS}) & 63 AS INT))")
        words = frequent.select(F.shiftrightunsigned(place, 6).alias("slot"), bit.alias("bit"))
        rows = words.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toPandas()  # 2 ** (FILTER_BITS - 6) rows at most
        bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        bits[rows["slot"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
        self.bits = spark.sparkContext.broadcast(bits.view(np.uint8))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - FILTER_BITS)
        return (self.bits.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counted(c: Owned, n: int, which: np.ndarray, keys: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """The distinct phrases of ``n`` words from the words ``which`` on, told apart by ``keys``, and the number of each phrase."""
    distinct, sums, at = _sums(keys, c.freq[which])
    first = which[at]
    lang = c.langs.take(pa.array(c.words.text[first]))
    table = pa.table({"lang": lang, "part": c.words.slices(first, first + n - 1), "f": sums})
    return table, np.searchsorted(distinct, keys)


def _summed(counted: DataFrame, least: int) -> DataFrame:
    """lang, part, n_words and f of the parts that are frequent."""
    sums = counted.groupBy("lang", "part").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return sums.select("lang", "part", F.size(F.split("part", " ")).alias("n_words"), "f")


def _frequent_words_and_pairs(chunks: DataFrame, least: int) -> DataFrame:
    """lang, part, n_words (1 or 2) and f of the frequent words and pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[pa.Table]:
            for batch in _slices_of(batches, "chunk"):
                c = Owned(batch)
                owned, paired = np.flatnonzero(c.own), np.flatnonzero(c.own & c.words.goes_on)
                yield _counted(c, 1, owned, c.code[owned])[0]
                yield _counted(c, 2, paired, c.code[paired] * c.n_codes + c.code[paired + 1])[0]

        return _narrow(_totals(found(), PHRASES, "f"))

    return _summed(chunks.mapInArrow(count, "lang string, part string, f long"), least)


def _hashes(parts: DataFrame) -> DataFrame:
    """n_words and hash of words and pairs."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices_of(batches, "chunk"):
            c = Owned(batch)
            single = batch.column("own").to_numpy()[c.words.text] == 1
            for n, hashes in ((1, c.hash[single]), (2, c.pairs()[c.words.goes_on[:-1]])):
                yield pa.record_batch({"n_words": np.full(len(hashes), n, np.int32), "hash": hashes.view(np.int64)})

    as_chunks = parts.select("lang", F.col("part").alias("chunk"), F.col("n_words").alias("own"), F.col("f").alias("freq"))
    return as_chunks.mapInArrow(code, "n_words int, hash long")


def _frequent_longer(chunks: DataFrame, words: Bitmap, pairs: Bitmap, least: int) -> DataFrame:
    """lang, part, n_words (3 or more) and f of the frequent phrases of more than two words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[pa.Table]:
            for batch in _slices_of(batches, "chunk"):
                c = Owned(batch)
                linked = c.words.goes_on.copy()
                linked[:-1] &= words.holds(c.hash[:-1]) & words.holds(c.hash[1:])
                linked[linked] = pairs.holds(c.pairs()[linked[:-1]])
                paired = c.own & linked
                paired[:-1] &= linked[1:]  # words 2 and 3 are a frequent pair too
                which = np.flatnonzero(paired)
                key = c.code * c.n_codes
                key[:-1] += c.code[1:]
                key[which] = np.unique(key[which], return_inverse=True)[1]
                for n in range(3, MOST_WORDS + 1):
                    which = which[linked[which + n - 2]]  # words n - 1 and n of the phrase are a frequent pair
                    # The key of a phrase is made of the key of all but its last word and the code of that: both exact.
                    table, key[which] = _counted(c, n, which, key[which] * c.n_codes + c.code[which + n - 1])
                    yield table

        return _narrow(_totals(found(), PHRASES, "f"))

    return _summed(chunks.mapInArrow(count, "lang string, part string, f long"), least)


def _part(first: Column, n: Column) -> Column:
    return F.array_join(F.slice("words", first, n), " ")


def _scored(parts: DataFrame, totals: DataFrame) -> DataFrame:
    """The lowest score of each phrase over its cuts; parts of a frequent phrase are frequent, so they are all known."""
    phrases = parts.where("n_words > 1")
    k = F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    cuts = phrases.select("lang", "part", "n_words", "f", F.split("part", " ").alias("words"), k)
    both = cuts.select(
        "lang", F.col("part").alias("phrase"), F.col("f").alias("a"), "k",
        _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest"),
    )
    left = parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    met = both.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "anlr"}
    above = (wide["a"] * wide["n"]).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function("div", above, wide["l"] * wide["r"])
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    best = met.groupBy("lang", "phrase", "a", "n").agg(lowest)
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _inner_phrases(parts: DataFrame) -> DataFrame:
    """Each shorter phrase inside a phrase, with the largest frequency of one that holds it."""
    longer = parts.where("n_words > 2").select("lang", "n_words", "f", F.split("part", " ").alias("words"))
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("n_words") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("n_words") - n + 1), lambda i: _part(i, n)),
        )
    )
    return longer.select("lang", "f", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of 2 to 5 words of each language by score.

    Texts are split at ``.,;:!?`` and line ends, A-Z counts as a-z, words are what stands between spaces and tabs. A
    phrase that occurs at least ``least`` times is scored by the cut that scores lowest, floor(1000 * a * n / (l * r));
    one that occurs in a longer phrase each time is left out. A null text has no words, a null lang is ``und``. Repeated
    rows count each. A language without frequent phrases gives no row. Equal scores are ranked by ``a``, then by the
    phrase's bytes. Columns other than lang and text are not read.
    """
    spark = docs.sparkSession
    chunks = chunk_dictionary(docs)
    totals = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))
    short = stored(_frequent_words_and_pairs(chunks, least), "words-and-pairs")
    hashes = _hashes(short)
    words, pairs = (Bitmap(spark, hashes.where(F.col("n_words") == n)) for n in (1, 2))
    parts = short.unionByName(stored(_frequent_longer(chunks, words, pairs, least), "phrases"))

    scored = _scored(parts, totals).join(_inner_phrases(parts), ["lang", "phrase"], "left")
    kept = scored.where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # A language's ranking is cut down in parts first, so that one task only sees the best of each part.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    in_part = kept.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = in_part.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
