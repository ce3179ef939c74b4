"""Token sequences in training order, as binary shards of fixed stride.

Texts are cut into sequences of `LENGTH` tokens. All sequences are numbered without gaps in an order
that depends on the rows alone, and a keyed Feistel permutation of the numbers, walking its cycles until
it is inside the range, gives each a slot. Shard k holds the slots from k * PER_SHARD on, each sequence in
its own stride, so a reader finds any slot by its offset and goes on where it stopped.

The numbering splits the rows by the hash of id and text: a count for each split is all that meets on
the driver. Texts are shuffled once to be numbered and once to their shards, as narrow tokens.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from nestline.llm.buffers import prepare

LENGTH, PER_SHARD, KEY = 1024, 2048, 20240531
#: With bytes as tokens: end of a text, and what fills its last sequence.
END, FILL = 256, 257
#: Type of the ids in a shard.
NUMBER = "<u2"
STRIDE = 2 * LENGTH
#: Bytes of text that a split of the numbering holds at most on average, and the least number of splits as a power of 2.
SPLIT_BYTES, LEAST_SPLIT_BITS = 16 << 20, 9
ROUNDS = 6


def byte_tokens(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def permuted(numbers: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """The slot in [0, size) of each number in [0, size): a permutation that the key chooses."""
    half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[walking] = left << half | right
        walking = walking[out[walking] >= size]
    return out.astype(np.int64)


def slotted(docs: DataFrame, text: str = "text", doc: str = "doc_id", tokens: Callable[[str], np.ndarray] = byte_tokens,
            count: Callable[[Column], Column] = F.octet_length, key: int = KEY) -> DataFrame:
    """(slot, last, piece): every sequence of every row with its slot; the piece is its tokens in their own
    number type, `last` tells that the text ends in it.

    `count` gives the number of `tokens` of a text as a column. A null text is empty; an empty text is one
    sequence that holds the end only. The order that is permuted is that of the hash of id and text, then id;
    rows equal in both follow each other. Rows may lack an id or share one.
    """
    body = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return _slotted(body, tokens, count, F.octet_length, key)


def slotted_ids(docs: DataFrame, ids: str = "ids", doc: str = "doc_id", key: int = KEY) -> DataFrame:
    """The same for texts that are encoded: `ids` is an array of token ids, null is empty. Pieces hold ids of four
    bytes; `write` and `digests` take them with dtype np.int32."""
    body = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")).alias("text"))
    return _slotted(body, lambda found: np.array(found, np.int32), F.size, lambda column: 4 * F.size(column), key)


def _slotted(body: DataFrame, tokens: Callable, count: Callable[[Column], Column], octets: Callable[[Column], Column], key: int) -> DataFrame:
    prepare(body.sparkSession)
    body = body.withColumn("hash", F.xxhash64("doc_id", "text")).withColumn("n", F.floor(count(F.col("text")) / LENGTH).cast("long") + 1)
    total = body.agg(F.sum(octets(F.col("text")))).first()[0] or 0
    bits = max(LEAST_SPLIT_BITS, int(total // SPLIT_BYTES).bit_length())
    rows = body.withColumn("split", F.shiftrightunsigned("hash", 64 - bits).cast("int"))
    sizes = {r.split: r.n for r in rows.groupBy("split").agg(F.sum("n").alias("n")).collect()}
    starts, size = {}, 0
    for k in sorted(sizes):
        starts[k], size = size, size + sizes[k]
    sent = body.sparkSession.sparkContext.broadcast(starts)

    def number(batches):
        following: dict[int, int] = {}
        for batch in batches:
            first = np.concatenate(([0], np.cumsum(batch.column("n").to_numpy())))
            numbers, pieces, last = np.empty(first[-1], np.int64), [], []
            for k, (part, body) in enumerate(zip(batch.column("split").to_pylist(), batch.column("text"))):
                ids, n = tokens(body.as_py()), int(first[k + 1] - first[k])
                begin = following.get(part, sent.value[part])
                following[part] = begin + n
                numbers[first[k]:first[k + 1]] = np.arange(begin, begin + n)
                pieces += [ids[a * LENGTH:(a + 1) * LENGTH].tobytes() for a in range(n)]
                last += [False] * (n - 1) + [True]
            yield pa.RecordBatch.from_arrays([pa.array(permuted(numbers, size, key)), pa.array(last, pa.bool_()), pa.array(pieces, pa.binary())],
                                             names=["slot", "last", "piece"])

    ordered = rows.repartition("split").sortWithinPartitions("split", "hash", "doc_id").select("split", "n", "text")
    return ordered.mapInArrow(number, "slot long, last boolean, piece binary")


def checked(end: int, fill: int, number: str) -> None:
    """Raises an error unless `end` and `fill` differ and `number`, the type of the ids in a shard, holds both."""
    if end == fill or min(end, fill) < 0 or max(end, fill) > np.iinfo(number).max:
        raise ValueError(f"end {end} and fill {fill} must differ and fit {np.dtype(number)}")


def packed(batches, dtype: np.dtype, end: int = END, fill: int = FILL, number: str = NUMBER) -> Iterator[tuple[int, int, bytes]]:
    """(shard, sequences, bytes) of rows (shard, slot, last, piece) that come in order of slot. Ids of `dtype` that
    are not below `end` and `fill` are refused, so a reader can tell these from tokens."""
    shard, parts = None, []
    for batch in batches:
        for at, last, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
            if at != shard and parts:
                yield shard, len(parts), b"".join(parts)
                parts = []
            shard = at
            row = np.full(LENGTH, fill, number)
            ids = np.frombuffer(piece.as_buffer(), dtype)
            if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < min(end, fill):
                raise ValueError(f"token ids {ids.min()} to {ids.max()} must lie below end {end} and fill {fill}")
            row[:len(ids)] = ids
            if last:
                row[len(ids)] = end
            parts.append(row.tobytes())
    if parts:
        yield shard, len(parts), b"".join(parts)


def _by_shard(slots: DataFrame) -> DataFrame:
    rows = slots.select(F.floor(F.col("slot") / PER_SHARD).cast("long").alias("shard"), "slot", "last", "piece")
    return rows.repartition("shard").sortWithinPartitions("slot")


def digests(slots: DataFrame, dtype=np.uint8, end: int = END, fill: int = FILL, number: str = NUMBER) -> DataFrame:
    """(shard, first_slot, n_sequences, n_bytes, sha256) of the shards that `slotted` rows make."""
    checked(end, fill, number)

    def run(batches):
        for shard, n, data in packed(batches, dtype, end, fill, number):
            yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([shard * PER_SHARD]), pa.array([n]), pa.array([len(data)]),
                                              pa.array([hashlib.sha256(data).hexdigest()])],
                                             names=["shard", "first_slot", "n_sequences", "n_bytes", "sha256"])
    return _by_shard(slots).mapInArrow(run, "shard long, first_slot long, n_sequences long, n_bytes long, sha256 string")


def name_of(shard: int) -> str:
    return f"shard-{shard:010d}.bin"


def write(slots: DataFrame, uri: str, dtype=np.uint8, end: int = END, fill: int = FILL, number: str = NUMBER) -> DataFrame:
    """Writes the shards as files below `uri`, a folder that all executors share, and returns (shard, n_sequences)
    of what was written. A file gets its name when it is whole, so a repeated task replaces like by like."""
    checked(end, fill, number)

    def run(batches):
        store, folder = fs.FileSystem.from_uri(uri)
        store.create_dir(folder)
        for shard, n, data in packed(batches, dtype, end, fill, number):
            part = f"{folder}/.{name_of(shard)}.{hashlib.sha256(data).hexdigest()}"
            with store.open_output_stream(part) as out:
                out.write(data)
            store.move(part, f"{folder}/{name_of(shard)}")
            yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([n])], names=["shard", "n_sequences"])
    done = _by_shard(slots).mapInArrow(run, "shard long, n_sequences long")
    rows = done.toArrow()
    return done.sparkSession.createDataFrame(rows)


def read(uri: str, slot: int = 0, number: str = NUMBER) -> Iterator[np.ndarray]:
    """The sequences from a slot on, in order; to resume, start from the slot after the last one read."""
    stride = LENGTH * np.dtype(number).itemsize
    store, folder = fs.FileSystem.from_uri(uri)
    shard, skip = divmod(slot, PER_SHARD)
    while store.get_file_info(f"{folder}/{name_of(shard)}").type == fs.FileType.File:
        with store.open_input_file(f"{folder}/{name_of(shard)}") as data:
            data.seek(skip * stride)
            while len(row := data.read(stride)) == stride:
                yield np.frombuffer(row, number)
        shard, skip = shard + 1, 0
