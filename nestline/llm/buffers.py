"""Texts of an Arrow column as numpy arrays: lower-cased bytes, words, rows of results.

A word is a run of a-z, 0-9 and characters beyond ASCII, after lower-casing A-Z. In UTF-8 all bytes of
characters beyond ASCII are 0x80 or more, so words can be cut on bytes.
"""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[ord("0"):ord("9") + 1] = IS_WORD[ord("a"):ord("z") + 1] = IS_WORD[128:] = True
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 1 << 20
#: Rows in an Arrow batch, so that a batch of long texts stays small in the JVM and in Python.
BATCH_ROWS = 1000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets from 0 and the bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(len(column) + 1, np.int64), np.empty(0, np.uint8)
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, offsets from 0, bytes) of runs of whole rows with about `limit` bytes."""
    offsets, data = column_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, offsets[first:last + 1] - offsets[first], data[offsets[first]:offsets[last]]
        first = last


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty run [start, end) of bytes; the runs are in order and apart."""
    lengths = ends - starts
    if not len(starts):
        return np.empty(0, np.uint64)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    inside = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), STEP, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    values = BYTE_VALUE[data[np.repeat(starts, lengths) + inside]] * powers[inside]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each row the index of its first word (one entry more at the end)."""
    folded = FOLD[data]
    marks = np.zeros(len(data) + 1, bool)
    marks[:-1] = IS_WORD[folded]
    begins, stops = marks[:-1].copy(), marks[:-1].copy()
    begins[1:] &= ~marks[:-2]
    stops &= ~marks[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = marks[edges]
    stops[edges - 1] = marks[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return run_hashes(folded, starts, ends), np.searchsorted(starts, offsets)


def words_in_slices(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """words() of many bytes, made in slices of whole rows so that little memory is needed at a time."""
    hashes, counts, first, rows = [], [], 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        h, f = words(offsets[first:last + 1] - offsets[first], data[offsets[first]:offsets[last]])
        hashes.append(h)
        counts.append(np.diff(f))
        first = last
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(rows + 1, np.int64)
    return np.concatenate(hashes), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` consecutive words; of all words if there are fewer, none if there are none."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        out = out * STEP + hashes[k:len(hashes) - size + 1 + k]
    return mix(out)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def prepare(spark: SparkSession) -> None:
    """Sends this package to the executors once, so that tasks can import it wherever the driver has found
    it, and limits the session's Arrow batches to BATCH_ROWS rows."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    name = f"{package.name}-{context.applicationId}.zip"
    if not any(str(x).endswith(name) for x in context._python_includes):
        folder = os.path.realpath(tempfile.mkdtemp(prefix=package.name))  # the driver's own; Spark sends the file
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(f"{folder}/{name}", "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(f"{folder}/{name}")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(setting))
    spark.conf.set(setting, min(BATCH_ROWS, rows) if rows > 0 else BATCH_ROWS)


def give_back() -> None:
    """Returns the memory that a task has freed to the machine, as its worker waits for the next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def with_results(df: DataFrame, text: str, keep: list[str], result: str, fields: StructType,
                 work: Callable[[], Callable[[pa.Array], list]]) -> DataFrame:
    """The columns `keep` of df and a struct `result`, made from each row's text in Arrow batches.

    `work()` is called once in each task and returns what turns a column of texts into one array for
    each field, in the order of the rows.
    """
    prepare(df.sparkSession)
    carried = df.select(*[F.col(f"`{c}`") for c in keep],
                        F.col(f"`{text}`").cast("string").alias(free_name(df, "whole_text")))
    schema = StructType([*carried.schema.fields[:-1], StructField(result, fields, False)])

    def run(batches):
        of = work()
        for batch in batches:
            arrays = of(batch.column(batch.num_columns - 1))
            struct = pa.StructArray.from_arrays(arrays, names=fields.names)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], struct], names=[*keep, result])
        give_back()

    return carried.mapInArrow(run, schema)
