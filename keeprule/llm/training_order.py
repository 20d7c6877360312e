"""Token ids in training order: a keyed permutation deals sequences to slots of fixed-stride shards.

Texts are cut into sequences of a fixed number of token ids. Sequences are numbered in the order of their document's id
and text and of their place in it, so that the order follows from key and content alone; a Feistel network over the next
larger power of four, walked along its cycle until it lands below the number of sequences, maps each number to a slot
and no two to the same. Slots are range-partitioned; shard and offset follow from the slot alone, so that a reader
resumes anywhere by arithmetic.

``written_order`` moves the ids of a text once: tasks write them, coded, to files of the shared folder; only the counts
are ordered and summed; then tasks read the coded ids, cut them by slot and send one coded bundle for each shard to the
task that writes it. Sequences are filled up in the shard only.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from keeprule.llm.common import coded_units, pieces, run_positions, stored, text_bytes
from keeprule.llm.shingles import mix
from keeprule.operators.positions import positions
from keeprule.session import new_folder

AT_ONCE = 8_000_000
ROUNDS = 4
ID_BYTES = 2
#: Ids that a task holds before it sends them on, in bundles of one shard each.
BUNDLED = 16_000_000
#: Bytes that a task writes, in whole shards, and the number of such tasks at most.
WRITTEN, WRITERS = 32_000_000, 20_000
#: What a unit of one blank at most and no other white space or control character looks like.
PLAIN = r"^ ?[^\pZ\x00-\x20\x7f-\x{a0}]+$"


def permute(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each of ``numbers`` (0 to n - 1) under ``key``: a permutation of 0 to n - 1."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.uint64(key) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & low
        for round_key in keys:
            left, right = right, left ^ (mix(right ^ round_key) & low)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts that lie behind each other may be cut: at their starts, and at white space behind other characters.

    A character that could be white space outside ASCII counts as such, so there is no cut behind it.
    """
    dark = ((data > 0x20) & (data < 0x7F)) | (data >= 0x80)
    for first, last in (((0xC2,), 1), ((0xE1, 0xE2, 0xE3), 2)):
        doubtful = np.flatnonzero(np.isin(data, first)) + last
        dark[doubtful[doubtful < len(data)]] = False
    cut = np.zeros(len(data), bool)
    cut[1:] = dark[:-1] & ((data[1:] == 0x20) | ((data[1:] >= 0x09) & (data[1:] <= 0x0D)))
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class Tokenizer:
    """A byte-level BPE vocabulary of at most 65,536 ids; ``end`` is the id after the last one.

    Its pattern cuts no token across the start of white space, and keeps a line break in front of one word apart.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.end = max(ranks.values()) + 1
        self.line_break = ranks[b"\n"]
        self.encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units behind each other, and the number of each unit. Plain units are encoded as lines of one text."""
        plain = pc.match_substring_regex(units, PLAIN).to_numpy(zero_copy_only=False)
        lines, others = units.filter(pa.array(plain)).to_pylist(), units.filter(pa.array(~plain)).to_pylist()
        found = self.encoding.encode_to_numpy("\n".join(lines)).astype(np.uint16)
        breaks = np.flatnonzero(found == self.line_break)
        if len(breaks) != max(len(lines) - 1, 0):
            raise ValueError("the vocabulary joins line breaks with other characters")
        coded = [self.encoding.encode_ordinary(u) for u in others]
        lengths = np.zeros(len(units), np.int64)
        if lines:
            lengths[plain] = np.diff([-1, *breaks, len(found)]) - 1
        lengths[~plain] = list(map(len, coded))
        of_plain = np.repeat(plain, lengths)
        flat = np.empty(len(of_plain), np.uint16)
        flat[of_plain] = np.delete(found, breaks)
        flat[~of_plain] = np.fromiter((i for ids in coded for i in ids), np.uint16, int((~of_plain).sum()))
        return flat, lengths

    def encode_texts(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, each closed by ``end``, and the number of each text.

        Units of white space and what follows are encoded once for all texts.
        """
        data, offsets = text_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        starts = unit_starts(data, offsets)
        coded = coded_units(data, starts)
        flat, lengths = self.encode_units(coded.dictionary)
        # The end of a text is one more unit, with the last code.
        counts = np.diff(np.searchsorted(starts, offsets)) + 1
        code = np.full(int(counts.sum()), len(lengths), np.int64)
        last = np.cumsum(counts) - 1
        inside = np.ones(len(code), bool)
        inside[last] = False
        code[inside] = coded.indices.to_numpy()
        flat, lengths = np.append(flat, np.uint16(self.end)), np.append(lengths, 1)
        n = lengths[code]
        from_ = np.cumsum(lengths) - lengths
        gathered = flat[np.repeat(from_[code], n) + run_positions(n)]
        return gathered, np.diff(np.cumsum(n)[last], prepend=0) if len(counts) else np.zeros(0, np.int64)


def packed(ids: np.ndarray) -> bytes:
    """16-bit ids, compressed: the frequent ones as one byte, others as two, and zstd over both rows of bytes."""
    counts = np.bincount(ids, minlength=1 << 16)
    order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    short = min(256, ((1 << 16) - len(order)) // 255)
    code = np.zeros(1 << 16, np.int64)
    code[order] = np.arange(len(order))
    value = code[ids]
    wide = value >= short
    first = np.where(wide, short + ((value - short) >> 8), value).astype(np.uint8)
    second = ((value[wide] - short) & 255).astype(np.uint8)
    body = order.astype("<u2").tobytes() + first.tobytes() + second.tobytes()
    sizes = np.array([len(order), len(ids), len(body)], "<u8").tobytes()
    return sizes + pa.Codec("zstd", compression_level=3).compress(body, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    """The ids that ``packed`` got."""
    n_order, n, size = (int(x) for x in np.frombuffer(data, "<u8", 3))
    body = pa.decompress(data[24:], size, "zstd", asbytes=True) if size else b""
    order = np.frombuffer(body, "<u2", n_order)
    short = min(256, ((1 << 16) - n_order) // 255)
    value = np.frombuffer(body, np.uint8, n, 2 * n_order).astype(np.int64)
    wide = value >= short
    value[wide] = ((value[wide] - short) << 8) + np.frombuffer(body, np.uint8, offset=2 * n_order + n) + short
    return order[value].astype(np.uint16)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def sequences(docs: DataFrame, ranks: dict[bytes, int], pattern: str, length: int = 512) -> DataFrame:
    """(doc_id, part, tokens): the ids of each text and an end id, cut into sequences of ``length`` 16-bit ids.

    The last sequence of a text is filled up with end ids. A null text gives no sequence, an empty one a sequence of
    end ids. Repeated rows give repeated sequences; other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(*shared.value)
        for batch in batches:
            for part in pieces(batch, "text", AT_ONCE):
                ids, counts = tokenizer.encode_texts(part.column("text"))
                rows = -(-counts // length)
                grid = np.full(int(rows.sum()) * length, tokenizer.end, np.uint16)
                grid[np.repeat((np.cumsum(rows) - rows) * length, counts) + run_positions(counts)] = ids
                tokens = pa.Array.from_buffers(
                    pa.binary(length * ID_BYTES), int(rows.sum()), [None, pa.py_buffer(grid.astype("<u2").tobytes())]
                ).cast(pa.binary())
                owner = pa.array(np.repeat(np.arange(len(rows)), rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(owner), pa.array(run_positions(rows)), tokens], ["doc_id", "part", "tokens"]
                )

    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, part long, tokens binary")


def training_order(rows: DataFrame, key: int, per_shard: int = 8192) -> DataFrame:
    """The sequences with slot, shard and byte_offset, range-partitioned and sorted by slot.

    They are numbered by doc_id, part and tokens. Equal ones are counted, so that a great many of them may lie in
    several ranges; they may swap slots.
    """
    names = ["doc_id", "part", "tokens"]
    numbered = positions(rows.groupBy(*names).agg(F.count("*").alias("copies")), names, "number", copies="copies")
    n = numbered.count()
    kinds = f"slot long, doc_id {dict(rows.dtypes)['doc_id']}, part long, tokens binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = pa.array(permute(batch.column("number").to_numpy(), n, key))
            yield pa.RecordBatch.from_arrays([slot, *map(batch.column, names)], ["slot", *names])

    dealt = numbered.select("number", *names).mapInArrow(deal, kinds)
    shard = F.expr(f"slot div {per_shard}")
    offset = F.col("slot") % per_shard * F.octet_length("tokens")
    placed = dealt.select("slot", shard.alias("shard"), offset.alias("byte_offset"), *names)
    return placed.repartitionByRange("slot").sortWithinPartitions("slot")


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and the folder's path there."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


class _ShardFile:
    """A shard that is written aside and renamed when whole; a task that runs again writes the same bytes."""

    def __init__(self, folder: str, shard: int):
        self.files, path = _opened(folder)
        self.files.create_dir(path, recursive=True)
        self.path, self.aside = f"{path}/shard-{shard:08d}.bin", f"{path}/.shard-{shard:08d}-{uuid.uuid4().hex}.part"
        self.file, self.digest, self.shard, self.n = self.files.open_output_stream(self.aside), hashlib.sha256(), shard, 0

    def write(self, data, sequences: int) -> None:
        self.file.write(data)
        self.digest.update(data)
        self.n += sequences

    def close(self) -> tuple[int, int, str]:
        """Shard, n_sequences and sha256."""
        self.file.close()
        self.files.move(self.aside, self.path)
        return self.shard, self.n, self.digest.hexdigest()


def write_shards(ordered: DataFrame, folder: str) -> DataFrame:
    """Write each shard as one file of fixed stride to ``folder``, which all executors reach.

    Readers see whole shards only. Returns the manifest: shard, n_sequences and sha256 of each file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for shard, tokens in zip(batch.column("shard").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                if now is None or shard != now.shard:
                    done += [now.close()] if now else []
                    now = _ShardFile(folder, shard)
                now.write(tokens, 1)
        done += [now.close()] if now else []
        yield _manifest(done)

    whole = ordered.select("slot", "shard", "tokens").repartitionByRange("shard").sortWithinPartitions("slot")
    return stored(whole.mapInArrow(write, "shard long, n_sequences long, sha256 string"), "manifest")


def _manifest(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = zip(*done, strict=True) if done else ((), (), ())
    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["shard", "n_sequences", "sha256"])


def _staged(docs: DataFrame, ranks: dict[bytes, int], pattern: str, length: int, folder: str) -> DataFrame:
    """Write the ids of all texts, coded, to files of ``folder``; where they lie and how many, a row for each text."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    names = ["file", "at", "bytes", "place", "doc_id", "h1", "h2", "n_ids", "parts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, (files, path) = Tokenizer(*shared.value), _opened(folder)
        files.create_dir(path, recursive=True)
        name, at = uuid.uuid4().hex, 0
        with files.open_output_stream(f"{path}/{name}") as out:
            for batch in batches:
                for part in pieces(batch, "text", AT_ONCE):
                    ids, counts = tokenizer.encode_texts(part.column("text"))
                    data = packed(ids)
                    out.write(data)
                    rows = part.num_rows
                    same = [pa.array([x] * rows, t) for x, t in ((name, pa.string()), (at, pa.int64()), (len(data), pa.int64()))]
                    own = [part.column(c) for c in ("doc_id", "h1", "h2")]
                    parts = pa.array(-(-counts // length))
                    yield pa.RecordBatch.from_arrays([*same, pa.array(np.arange(rows)), *own, pa.array(counts), parts], names)
                    at += len(data)

    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    kinds = f"file string, at long, bytes long, place long, doc_id {dict(docs.dtypes)['doc_id']}, h1 long, h2 long, n_ids long, parts long"
    return stored(rows.mapInArrow(run, kinds), "texts")


def _numbered(texts: DataFrame) -> tuple[DataFrame, int]:
    """The texts with the number of their first sequence, in the order of id and text; and the number of all sequences.

    Equal rows hold the same sequences, so it does not matter which of them comes first.
    """
    order = ["doc_id", "h1", "h2", "file", "at", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_range, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            sums = total + np.cumsum(batch.column("parts").to_numpy())
            before = pa.array(sums - batch.column("parts").to_numpy())
            total = int(sums[-1]) if len(sums) else total
            arrays = [*batch.columns, pa.array([of_range] * batch.num_rows, pa.int64()), before]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "of_range", "before"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema) + ", of_range long, before long"
    summed = stored(texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, kinds), "sums")
    ranges = summed.groupBy("of_range").agg(F.sum("parts").alias("parts"))  # one row for each task that wrote
    earlier = Window.orderBy("of_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("of_range", F.coalesce(F.sum("parts").over(earlier), F.lit(0)).alias("start"))
    n = ranges.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    first = (F.col("start") + F.col("before")).alias("first")
    return summed.join(F.broadcast(starts), "of_range").select("file", "at", "bytes", "place", "doc_id", "n_ids", "parts", first), n


def _bundles(folder: str, n: int, key: int, per_shard: int, length: int, kind: pa.DataType) -> Callable:
    """From rows sorted by where their ids lie: for each shard a bundle of its sequences, with coded ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _opened(folder)
        chunk, ids, ends = None, None, None
        held, n_held = [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            slot, part, count = (np.concatenate([h[k] for h in held]) for k in (0, 1, 2))
            doc, flat = pa.concat_arrays([h[3] for h in held]), np.concatenate([h[4] for h in held])
            from_ = np.cumsum(count) - count
            order = np.argsort(slot, kind="stable")
            shard = slot[order] // per_shard
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(order)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                rows = order[low:high]
                own = flat[np.repeat(from_[rows], count[rows]) + run_positions(count[rows])]
                lists = [(pa.array(x[rows]), t) for x, t in ((slot, pa.int64()), (part, pa.int64()), (count, pa.int64()))]
                lists.append((doc.take(pa.array(rows)), kind))
                arrays = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), x.cast(t)) for x, t in lists]
                columns = [pa.array([int(shard[low])], pa.int64()), *arrays, pa.array([packed(own)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "slot", "part", "n", "doc_id", "ids"])

        for batch in batches:
            where = list(zip(batch.column("file").to_pylist(), batch.column("at").to_pylist(), strict=True))
            edges = [0, *(k for k in range(1, len(where)) if where[k] != where[k - 1]), len(where)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low == high:
                    continue
                place, n_ids, parts, first = (batch.column(c)[low:high].to_numpy() for c in ("place", "n_ids", "parts", "first"))
                if chunk != where[low]:
                    chunk, begin = where[low], 0
                    with files.open_input_file(f"{path}/{chunk[0]}") as file:
                        file.seek(chunk[1])
                        ids = unpacked(file.read(batch.column("bytes")[low].as_py()))
                # The rows of a chunk come in the order of their texts, so they follow each other in its ids.
                end = begin + int(n_ids.sum())
                part = run_positions(parts)
                slot = permute(np.repeat(first, parts) + part, n, key)
                count = np.minimum(length, np.repeat(n_ids, parts) - part * length)
                doc = batch.column("doc_id")[low:high].take(pa.array(np.repeat(np.arange(high - low), parts)))
                held.append((slot, part, count, doc, ids[begin:end]))
                begin, n_held = end, n_held + end - begin
                if n_held >= BUNDLED:
                    yield from sent()
                    held, n_held = [], 0
        if held:
            yield from sent()

    return run


def _shard_writer(folder: str, end: int, per_shard: int, length: int) -> Callable:
    """From bundles sorted by shard: the shards as files; a row for each sequence."""
    names = ["slot", "shard", "byte_offset", "doc_id", "part"]

    def whole(shard: int, bundles: list[dict]) -> pa.RecordBatch:
        slot, part, count = (np.concatenate([b[c].values.to_numpy() for b in bundles]) for c in ("slot", "part", "n"))
        doc = pa.concat_arrays([b["doc_id"].values for b in bundles])
        at = slot - shard * per_shard
        grid = np.full((int(at.max()) + 1) * length, end, "<u2")
        ids = np.concatenate([unpacked(b["ids"].as_py()) for b in bundles])
        grid[np.repeat(at * length, count) + run_positions(count)] = ids
        out = _ShardFile(folder, shard)
        out.write(grid.tobytes(), len(slot))
        out.close()
        order = pa.array(np.argsort(slot))
        arrays = [pa.array(slot), pa.array(np.full(len(slot), shard)), pa.array(at * length * ID_BYTES), doc, pa.array(part)]
        return pa.RecordBatch.from_arrays([a.take(order) for a in arrays], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bundles = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                bundle = {c: batch.column(c)[row] for c in batch.schema.names}
                if bundles and bundle["shard"].as_py() != now:
                    yield whole(now, bundles)
                    bundles = []
                now = bundle["shard"].as_py()
                bundles.append(bundle)
        if bundles:
            yield whole(now, bundles)

    return run


def written_order(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: int, per_shard: int = 8192, length: int = 512) -> DataFrame:
    """slot, shard, byte_offset, doc_id, part and tokens of each sequence, read from the shards it writes.

    The sequences are those of ``sequences``; the shards lie in the shared folder. The slot of a sequence follows from the key,
    and the ids and texts of all documents; rows that repeat id and text may swap slots. Null ids come first.
    """
    spark, id_type = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    coded, folder, stride = new_folder(spark, "ids"), new_folder(spark, "shards"), length * ID_BYTES
    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    texts, n = _numbered(_staged(docs, ranks, pattern, length, coded))
    where = texts.repartition("file", "at").sortWithinPartitions("file", "at", "place")
    bundles = where.mapInArrow(
        _bundles(coded, n, key, per_shard, length, kind),
        f"shard long, slot array<long>, part array<long>, n array<long>, doc_id array<{id_type}>, ids binary",
    )
    shards = -(-n // per_shard)
    own = max(1, WRITTEN // (per_shard * stride), -(-shards // WRITERS))
    by_range = bundles.repartitionById(max(1, -(-shards // own)), F.expr(f"cast(shard div {own} as int)"))
    end = max(ranks.values()) + 1
    kinds = f"slot long, shard long, byte_offset long, doc_id {id_type}, part long"
    written = stored(by_range.sortWithinPartitions("shard").mapInArrow(_shard_writer(folder, end, per_shard, length), kinds), "slots")
    names = ["slot", "shard", "byte_offset", "doc_id", "part"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _opened(folder)
        now, file = None, None
        for batch in batches:
            tokens = []
            for shard, offset in zip(batch.column("shard").to_pylist(), batch.column("byte_offset").to_pylist(), strict=True):
                if shard != now:
                    if file is not None:
                        file.close()
                    now, file = shard, files.open_input_file(f"{path}/shard-{shard:08d}.bin")
                    begin, data = 0, b""
                if not begin <= offset <= begin + len(data) - stride:
                    file.seek(offset)
                    begin, data = offset, file.read(1024 * stride)
                tokens.append(data[offset - begin : offset - begin + stride])
                if len(tokens[-1]) != stride:
                    raise ValueError(f"shard {shard} ends before byte {offset + stride}")
            columns = [*map(batch.column, names), pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "tokens"])
        if file is not None:
            file.close()

    return written.mapInArrow(read, f"{kinds}, tokens binary")


def read_shard(path: str, length: int, first: int = 0) -> Iterator[np.ndarray]:
    """The sequences of a shard from position ``first`` on."""
    stride = length * ID_BYTES
    with open(path, "rb") as file:
        file.seek(first * stride)
        while record := file.read(stride):
            yield np.frombuffer(record, "<u2")
