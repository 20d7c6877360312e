"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keeprule.session import new_folder

#: The characters that count as white space: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that a lost executor repeats nothing before it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_keys(*columns: Column | str) -> tuple[Column, Column]:
    """Two independent 64-bit hashes that stand for the given values together."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """The remainder of crc32 of the id as text, which sets documents aside for tests."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a batch behind each other, and the n + 1 offsets; a null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offsets.size == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, most: int):
    """``batch`` cut into slices of at most ``most`` bytes of text, or of one row."""
    yield from slices(batch, text_bytes(batch.column(column))[1], most)


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int):
    """``batch`` cut by ``sizes``, the running sums of its rows' sizes from 0 on; a slice adds up to ``most`` or is one row."""
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(sizes, sizes[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def coded_units(data: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    """UTF-8 bytes cut at ``starts``, of which the first is 0, as codes and distinct units."""
    bounds = np.append(starts, len(data)).astype(np.int64)
    units = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    return units.dictionary_encode()


def segment_ids(lengths: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(lengths)), lengths)


def run_positions(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given lengths."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)
