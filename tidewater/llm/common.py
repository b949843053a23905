"""Helpers shared by the operators of this subpackage: table access, staged
tables in the shared folder, and byte-level views of Arrow text columns."""

from __future__ import annotations

import atexit
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import fresh_path

#: Bytes of text that one numpy step handles at a time (a longer single text
#: is handled whole).  Bounds a Python worker's memory.
CHUNK_BYTES = 4 << 20
#: The same for steps whose arrays take tens of bytes for each one of text: the
#: workers of an executor must fit beside a full heap.
SLICE_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of a data folder (any path that Spark can read)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_STAGED: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage in a place that every executor sees: a lost executor
    costs a re-read, not a recomputation, and a frame that is read twice is
    computed once.  The folders go when the process ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark, f"llm-{name}")
    df.write.parquet(path)
    if not _STAGED:
        atexit.register(_remove_staged, spark)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove_staged(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)


def id_type(documents: DataFrame) -> str:
    """The type of ``doc_id``: operators that only pass it on take any."""
    return documents.schema["doc_id"].dataType.simpleString()


def fold(doc_id: Column | str) -> Column:
    """``crc32(doc_id as text) mod 5``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most ``limit`` bytes of text
    (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_bytes(batch.column(column))[1]
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi


def numbered_slices(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """:func:`text_slices` with a number that is the slice's own in the table.

    The same table read again in the same partitions gives the same slices."""
    task = TaskContext.get().partitionId() << 24
    for i, part in enumerate(text_slices(batches, limit=limit)):
        yield task | i, part


def give_back() -> None:
    """Return freed memory to the machine: a worker lives on between tasks,
    and what its allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, end to end, and the n + 1 offsets of
    its rows (a null row is empty)."""
    wide = column.fill_null("").cast(pa.large_string())
    _, offsets, data = wide.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[wide.offset: wide.offset + len(wide) + 1]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0]: ends[-1]], ends - ends[0]


def pieces(data: np.ndarray, ends: np.ndarray, is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes outside ``is_gap`` that stay within a row.

    Returns their starts, their stops and, per row, the index of its first
    run (n + 1 values).
    """
    solid = ~is_gap
    first = solid.copy()
    first[1:] &= is_gap[:-1]
    heads = ends[:-1][ends[:-1] < len(data)]
    first[heads] = solid[heads]
    starts = np.flatnonzero(first)
    last = solid
    last[:-1] &= is_gap[1:] | first[1:]
    stops = np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(starts, ends)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every row as one binary array, the
    index of each row's first word, and the words' starts and stops."""
    gap = _SPACE[data]
    starts, stops, first = pieces(data, ends, gap)
    return binary_array(data[~gap], stops - starts), first, starts, stops


def binary_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary array of consecutive pieces of ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` for all i, joined."""
    total = int(lengths.sum())
    out = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return out + np.arange(total)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
