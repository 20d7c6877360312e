"""Documents linked by the Jaccard similarity of their word shingles, by an index over group counts.

The shingles of a document are hashed into groups; the counts of its groups are its point. Two documents share at most
the sum of the smaller counts of all groups, so documents similar enough have points close to each other: they differ in
no more shingles than a known number T. Hence of any T + 1 groups at least one holds the same shingles in both. The
index makes use of this at its root: each document is entered under its T + 1 fullest groups (a fixed order by count and
content, the same for all documents, so that a common group of two similar documents is chosen by both). Documents that
meet under an entry form a cell; inside a cell the points are searched with an R-tree, whose nodes hold the largest
count of each group, and pairs are dropped where the summed minima are too small. Pairs that are left are verified on
their whole shingle sets.

Copies of a set count as one class. Cells are first linked by stars (every member with the least one); only cells whose
members are not all connected by verified links of that round go through the R-tree.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.llm.common import pieces, stored
from keeprule.llm.components import components
from keeprule.llm.shingles import mix, overlap, shingle_sets

#: Similarity as a fraction.
NUMERATOR, DENOMINATOR = 80, 100
PERIOD = (NUMERATOR + DENOMINATOR) // math.gcd(NUMERATOR + DENOMINATOR, NUMERATOR)
#: Set sizes are dealt into bands whose limits grow by this factor; a band has a third of its upper limit as groups.
BAND_FACTOR, FIRST_LIMIT = 4, 16
BAND_MASK = 31
AT_ONCE = 1_000_000
#: Members of a cell that one task compares; larger cells are split into blocks that meet in pairs.
BLOCK = 2048
LEAF = 32


def alike(common: int, size_a: int, size_b: int) -> bool:
    return DENOMINATOR * common >= NUMERATOR * (size_a + size_b - common)


def needed(size_a, size_b):
    """The least overlap of two linked sets: the similarity solved for it."""
    return -(-NUMERATOR * (size_a + size_b) // (NUMERATOR + DENOMINATOR))


def band_number(upper: int) -> int:
    return (upper // FIRST_LIMIT).bit_length() // 2


def bands(n: int) -> list[tuple[int, int]]:
    """(upper limit, differences) of each band a set of ``n`` shingles is entered in.

    That is its own band, and the next one if a partner can be that large. Differences is the largest number of
    shingles in only one of the two sets, for any partner met in that band. As the needed overlap is rounded up, that
    number is not monotone in the partner's size; it grows by one every NUMERATOR + DENOMINATOR over their common divisor
    (nine sizes at 80 of 100), so the largest is among the last so many sizes.
    """
    limit = FIRST_LIMIT
    while n >= limit:
        limit *= BAND_FACTOR
    least, most = -(-n * NUMERATOR // DENOMINATOR), n * DENOMINATOR // NUMERATOR
    found = []
    for upper in (limit, limit * BAND_FACTOR):
        if upper == limit or most >= limit:
            last = min(most, upper - 1)
            first = max(least if upper == limit else limit, last - PERIOD + 1)
            found.append((upper, max(n + m - 2 * int(needed(n, m)) for m in range(first, last + 1))))
    return found


def index_entries(hashes: np.ndarray, upper: int, differences: int) -> tuple[np.ndarray, bytes]:
    """Entries of a set in a band, and its point.

    The low bits of an entry name the band. A point has ``upper`` groups, more than the set has members, so that the
    summed minima of two points hardly exceed the overlap; as most counts are 0 or 1 it is kept compressed.
    """
    point = zlib.compress(np.bincount((hashes >> np.uint64(20)) % np.uint64(upper), minlength=upper).astype(np.uint8), 1)
    if differences <= 0:
        return np.zeros(0, np.int64), point  # only an equal set can be linked
    groups = upper // 3
    group = ((hashes >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
    counts = np.bincount(group, minlength=groups)
    content = np.zeros(groups, np.uint64)
    order = np.argsort(group, kind="stable")
    filled = np.flatnonzero(counts)
    content[filled] = np.add.reduceat(mix(hashes[order]), (np.cumsum(counts) - counts)[filled])
    entry = mix(content ^ mix((np.arange(groups, dtype=np.uint64) << np.uint64(24)) + np.uint64(upper)))
    chosen = np.lexsort((entry, -counts))[: differences + 1]
    number = np.uint64(band_number(upper))
    return (entry[chosen] & ~np.uint64(BAND_MASK) | number).view(np.int64), point


SET_COLUMNS = "n long, h1 long, h2 long, own boolean, band long, entries array<long>, point binary"


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text", AT_ONCE):
            rows, ids = [], []
            for at, hashes in enumerate(shingle_sets(part.column("text"))):
                h1 = int(hashes.sum(dtype=np.uint64).view(np.int64))
                h2 = int(mix(hashes ^ np.uint64(0x5555555555555555)).sum(dtype=np.uint64).view(np.int64))
                for place, (upper, differences) in enumerate(bands(len(hashes))):
                    entries, point = index_entries(hashes, upper, differences)
                    rows.append((len(hashes), h1, h2, place == 0, band_number(upper), entries, point))
                    ids.append(at)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["doc_id", "n", "h1", "h2", "own", "band", "entries", "point"]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(ids)), *columns], names)


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text_b", AT_ONCE):
            one, two = shingle_sets(part.column("text_a")), shingle_sets(part.column("text_b"))
            good = [alike(overlap(x, y), len(x), len(y)) for x, y in zip(one, two, strict=True)]
            yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose texts are similar enough, by their whole shingle sets."""
    texts = docs.select("doc_id", "text")
    second = texts.join(pairs.hint("shuffle_hash"), texts["doc_id"] == pairs["b"]).select("a", "b", F.col("text").alias("text_b"))
    both = second.join(texts, second["a"] == texts["doc_id"]).select("a", "b", F.col("text").alias("text_a"), "text_b")
    return both.mapInArrow(_verify_batches, "a long, b long").distinct()


def _leaves(points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """The lowest nodes of an R-tree packed by size and counts: corners, members, least and largest sizes."""
    order = np.lexsort((*points[:, : min(4, points.shape[1])].T[::-1], sizes))
    members = [order[k : k + LEAF] for k in range(0, len(order), LEAF)]
    corners = np.array([points[m].max(0) for m in members])
    return corners, members, np.array([sizes[m].min() for m in members]), np.array([sizes[m].max() for m in members])


def close_pairs(points, sizes, ids, component, block) -> set[tuple[int, int]]:
    """Pairs of a cell (or of two blocks of it) in different components whose summed minima allow a link."""
    two_blocks = len(np.unique(block)) > 1
    corners, members, least, largest = _leaves(points, sizes)
    found = set()
    for at in range(len(ids)):
        size = sizes[at]
        fits = (DENOMINATOR * largest >= NUMERATOR * size) & (NUMERATOR * least <= DENOMINATOR * size)
        nodes = np.flatnonzero(fits)
        nodes = nodes[np.minimum(corners[nodes], points[at]).sum(1, dtype=np.int64) >= needed(size, np.minimum(least[nodes], size))]
        if not len(nodes):
            continue
        other = np.concatenate([members[node] for node in nodes])
        other = other[(ids[other] > ids[at]) & (component[other] != component[at])]
        if two_blocks:
            other = other[block[other] != block[at]]
        other = other[np.minimum(points[other], points[at]).sum(1, dtype=np.int64) >= needed(size, sizes[other])]
        found |= {(int(ids[at]), int(o)) for o in ids[other]}
    return found


def _cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Close pairs of the cells of one partition, whose rows come sorted by cell."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        pairs, rest = _whole_cells(table, last=False)
        yield pairs
    if rest is not None:
        yield _whole_cells(rest, last=True)[0]


def _whole_cells(table: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
    """Close pairs of all cells of the rows but the last one, which may go on; and the rows of that one."""
    cell = np.stack([table[name].to_numpy() for name in ("entry", "one", "two")])
    edges = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(0)) + 1
    bounds = [0, *edges.tolist(), *([table.num_rows] if last else [])]
    column = {name: table[name].to_numpy() for name in ("n", "doc", "component", "block")}
    points = table["point"].to_pylist()
    found: set[tuple[int, int]] = set()
    for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
        if stop - start > 1:
            at = np.stack([np.frombuffer(zlib.decompress(p), np.uint8) for p in points[start:stop]])
            found |= close_pairs(at, *(column[name][start:stop] for name in ("n", "doc", "component", "block")))
    a, b = zip(*found, strict=True) if found else ((), ())
    pairs = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return pairs, table.slice(bounds[-1])


def _tree_pairs(cells: DataFrame, index: DataFrame, labels: DataFrame) -> DataFrame:
    """Close pairs of the cells whose members are not all in one component yet.

    Pairs with a cell's head have been verified as stars, so only the other members are left.
    """
    labelled = cells.where("doc != head").join(labels, cells["doc"] == labels["node"], "left").select(
        "entry", "doc", F.coalesce("component", "doc").alias("component")
    )
    labelled = stored(labelled, "cells")
    open_cells = labelled.groupBy("entry").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")
    ).where(F.col("low") != F.col("high"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("long")
    placed = labelled.join(open_cells, "entry").select(
        "entry", F.col("entry").bitwiseAND(F.lit(BAND_MASK).cast("long")).alias("band"), "doc", "component", blocks.alias("blocks"), F.pmod(F.xxhash64("doc"), blocks).alias("block")
    )
    points = index.select(F.col("doc_id").alias("doc"), "band", "n", "point")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    met = points.join(placed.hint("shuffle_hash"), ["doc", "band"]).select("*", other).select(
        "entry", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        "block", "doc", "component", "n", "point",
    )
    by_cell = met.repartition("entry", "one", "two").sortWithinPartitions("entry", "one", "two")
    return by_cell.mapInArrow(_cell_batches, "a long, b long").distinct()


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` with an id.

    A document's set are its distinct 5-word shingles (words in lower case by A-Z; all words as one shingle if they are
    fewer). Two documents link if 100 times the intersection is at least 80 times the union. component_id is the
    smallest id reachable by links. A null text or one without words is linked with nothing. Rows that repeat an id
    count as one document with several texts; rows without an id are left out. Other columns are left out and may have
    any name; doc_id must be integral.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = stored(rows.mapInArrow(_index_batches, f"doc_id long, {SET_COLUMNS}"), "index")
    sets = index.where("own").select("doc_id", "n", "h1", "h2")
    classes = stored(sets.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("class")), "classes")

    # Members of a cell are classes; the entry tells band, group and content.
    of_class = index.join(classes.select(F.col("class").alias("doc_id")).distinct().hint("shuffle_hash"), "doc_id", "left_semi")
    entered = of_class.select(F.explode("entries").alias("entry"), F.col("doc_id").alias("doc"))
    heads = entered.groupBy("entry").agg(F.min("doc").alias("head"), F.max("doc").alias("tail")).where("head != tail")
    cells = stored(entered.join(heads, "entry").select("entry", "doc", "head"), "cells")

    stars = cells.where("doc != head").select(F.col("head").alias("a"), F.col("doc").alias("b")).distinct()
    links = stored(verified(stored(stars, "pairs"), rows), "links")
    labels = components(links)
    more = stored(_tree_pairs(cells, index, labels), "pairs")
    if not more.isEmpty():
        links = links.unionByName(verified(more, rows))
        labels = components(links)
    component = F.coalesce("component", "class", "doc_id")
    return (
        sets.join(classes, ["h1", "h2"], "left")
        .join(labels, F.col("class") == F.col("node"), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, of one document of each group of linked ones: that of the smallest id.

    A document is an id: if rows of the kept id differ in text, each text stays once, with the least of its other
    columns (which need an order, so they are no maps). Rows without an id belong to no group and stay as they are.
    """
    found = linked(docs)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    columns = [F.struct(*[F.col(f"`{c}`") for c in others])] if others else [F.lit(0)]
    rows = docs.join(kept.hint("shuffle_hash"), "doc_id", "left_semi").select("doc_id", "text", columns[0].alias("other columns"))
    once = rows.groupBy("doc_id", "text").agg(F.min("other columns").alias("other columns"))
    named = [F.col(c) if c in ("doc_id", "text") else F.col("other columns")[c].alias(c) for c in docs.columns]
    return once.select(*named).unionByName(docs.where(F.col("doc_id").isNull()))
