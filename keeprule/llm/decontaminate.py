"""Benchmark items found in documents within an edit budget.

An item of n characters may differ from its place in a document by k = n // EDIT_PART edits. Cut into k + 1 pieces, at
least one piece is there unchanged. One pass of an Aho-Corasick automaton over a document finds all pieces of a block
of items; around each hit, the edit distance of the whole item is computed with Myers' bit-parallel algorithm.

Items and texts are compared in lower case with runs of white space as one space.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

EDIT_PART = 12
#: Items that are searched in one pass over the documents; more items take more passes.
ITEMS_AT_ONCE = 50_000


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def pieces_of(item: str) -> list[tuple[int, str]]:
    """(start, piece): the item cut into one piece more than its edit budget, of nearly equal lengths."""
    n = len(item) // EDIT_PART + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for place, char in enumerate(item):
        masks[char] = masks.get(char, 0) | 1 << place
    return masks


def least_distance(masks: dict[str, int], n: int, text: str) -> tuple[int, int]:
    """Least edit distance of an item of ``n`` characters to any stretch of ``text``, and where that stretch ends."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, end = n, 0
    for at, char in enumerate(text):
        match = masks.get(char, 0)
        across = (((match & plus) + plus) ^ plus) | match | minus
        up = (minus | ~(across | plus)) & full
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, at + 1
        up, down = (up << 1) & full, (down << 1) & full  # a stretch may begin anywhere
        turned = match | minus
        plus = (down | ~(turned | up)) & full
        minus = up & turned
    return best, end


class Searcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(item_id, text, masks_of(text)) for item_id, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(items):
            for start, piece in pieces_of(text):
                places.setdefault(piece, []).append((number, start))
        self.pieces = ahocorasick.Automaton()
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        self.pieces.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end in the plain text) for each item within its budget, at its best place."""
        text = plain(text)
        windows: dict[int, list[list[int]]] = {}
        for last, (length, where) in self.pieces.iter(text):
            for number, start in where:
                item = self.items[number][1]
                budget = len(item) // EDIT_PART
                begin = last + 1 - length - start
                low, high = max(0, begin - budget), begin + len(item) + budget
                runs = windows.setdefault(number, [])
                if runs and low <= runs[-1][1]:
                    # A piece that the item repeats gives its later starts first.
                    runs[-1] = [min(low, runs[-1][0]), max(high, runs[-1][1])]
                else:
                    runs.append([low, high])
        found = []
        for number, runs in windows.items():
            item_id, item, masks = self.items[number]
            best = None
            for low, high in runs:
                exact = text.find(item, low, high)
                distance, end = (0, exact - low + len(item)) if exact >= 0 else least_distance(masks, len(item), text[low:high])
                if distance <= len(item) // EDIT_PART and (best is None or distance < best[0]):
                    best = distance, low + end
            if best is not None:
                found.append((item_id, *best))
        return found


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, plain text) in blocks of about ITEMS_AT_ONCE; items without text are left out, those without an id
    are searched, and equal items count once."""
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text").distinct()
    n = max(1, -(-items.count() // ITEMS_AT_ONCE))
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()  # one block
        found = [(r["item_id"], plain(r["text"])) for r in rows if r["text"].split()]
        yield sorted(found, key=lambda item: (item[0] is None, item[0] if item[0] is not None else 0, item[1]))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, end_at): each item found in each row of ``docs``, at its best place.

    end_at counts characters of the text in lower case with single spaces. Items without a word are not searched; null
    and empty texts hold nothing. Other columns are left out.
    """
    found, item_type = None, to_arrow_type(benchmark.schema["item_id"].dataType)
    for items in item_blocks(benchmark):

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(items) if items else None
            for batch in batches:
                hits = [
                    (at, *hit)
                    for at, text in enumerate(batch.column("text"))
                    if searcher and text.is_valid
                    for hit in searcher.find(text.as_py())
                ]
                at, item, distance, end = zip(*hits, strict=True) if hits else ((), (), (), ())
                columns = [batch.column("doc_id").take(pa.array(at, pa.int64()))]
                columns += [pa.array(item, item_type), pa.array(distance, pa.int64()), pa.array(end, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "end_at"])

        schema = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {dict(benchmark.dtypes)['item_id']}, distance long, end_at long"
        hits = docs.select("doc_id", "text").mapInArrow(search, schema)
        found = hits if found is None else found.unionByName(hits)
    return found


def without_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text holds no benchmark item."""
    kept = docs
    for items in item_blocks(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(items) if items else None
            for batch in batches:
                texts = batch.column("text")
                good = [not (searcher and t.is_valid and searcher.find(t.as_py())) for t in texts]
                yield batch.filter(pa.array(good, pa.bool_()))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
