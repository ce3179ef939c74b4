"""Bloom filters of 64-bit hashes, built by tasks and merged in segments.

A filter that is sent out has a size of MAX_BITS at most; what it lets through is confirmed exactly by the
caller, so a full filter costs speed and never a result. Where there are more hashes than such a filter
holds, those that come again are first found in buckets of the hashes, each with filters of its own
(`seen_twice`), so that only these go into the filter that is sent out.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from nestline.llm.buffers import give_back, prepare
from nestline.sources.scratch import written

PROBES = 5
SEGMENT_BITS = 1 << 19
#: Groups in which the parts of a segment are merged before they meet.
LANES = 32
#: Size of the largest filter: 16 MB are sent to each executor.
MAX_BITS = 1 << 27
#: Hashes of a bucket, and those in an Arrow batch.
BUCKET, SENT = 1 << 21, 1 << 16


def size_for(entries: int) -> int:
    """Bits for so many entries, 8 to 16 each, between one segment and MAX_BITS."""
    bits = SEGMENT_BITS
    while bits < 8 * entries and bits < MAX_BITS:
        bits *= 2
    return bits


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    hashes = hashes.astype(np.uint64, copy=False)
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(PROBES)]).astype(np.int64)


def contains(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter with these packed bits; never False for one that is."""
    at = places(hashes, len(packed) * 8)
    return ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)


def segments(hashes: np.ndarray, bits: int) -> dict[int, bytes]:
    at = np.unique(places(hashes, bits).ravel())
    cuts = np.flatnonzero(np.diff(at // SEGMENT_BITS)) + 1
    out = {}
    for part in np.split(at, cuts) if len(at) else []:
        marks = np.zeros(SEGMENT_BITS, bool)
        marks[part % SEGMENT_BITS] = True
        out[int(part[0]) // SEGMENT_BITS] = zlib.compress(np.packbits(marks).tobytes(), 1)
    return out


def _unpacked(data: bytes | None) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8) if data else np.zeros(SEGMENT_BITS // 8, np.uint8)


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """What two parts both have seen once has been seen twice."""
    once, twice = _unpacked(None), _unpacked(None)
    for one, two in zip(group["once"], group["twice"]):
        one = _unpacked(one)
        twice = twice | _unpacked(two) | (once & one)
        once = once | one
    return pd.DataFrame({"segment": [int(group["segment"].iloc[0])], "lane": [0],
                         "once": [zlib.compress(once.tobytes(), 1)], "twice": [zlib.compress(twice.tobytes(), 1)]})


def build(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int, twice: bool) -> np.ndarray:
    """Packed bits of the filter of all hashes, or of those that were seen twice or more.

    `hashes` gives those of an Arrow batch, each as often as it is to be counted.
    """
    prepare(df.sparkSession)
    fields = "segment int, lane int, once binary, twice binary"

    def parts(batches):
        from pyspark import TaskContext

        got = [h for h in map(hashes, batches) if len(h)]
        seen, counts = np.unique(np.concatenate(got) if got else np.empty(0, np.uint64), return_counts=True)
        once, more = segments(seen, bits), segments(seen[counts > 1], bits) if twice else {}
        lane = TaskContext.get().partitionId() % LANES
        for at, data in once.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([lane], pa.int32()), pa.array([data], pa.binary()),
                 pa.array([more.get(at)], pa.binary())], names=["segment", "lane", "once", "twice"])
        give_back()

    merged = (df.mapInArrow(parts, fields).groupBy("segment", "lane").applyInPandas(_merge, fields)
              .groupBy("segment").applyInPandas(_merge, fields))
    filled = np.zeros(bits // 8, np.uint8)
    for row in merged.select("segment", F.col("twice" if twice else "once").alias("bits")).collect():
        filled[row.segment * SEGMENT_BITS // 8:(row.segment + 1) * SEGMENT_BITS // 8] = _unpacked(row.bits)
    return filled


def seen_twice(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], entries: int) -> np.ndarray:
    """Packed bits of a filter that knows every hash seen twice or more, of `entries` or so in all."""
    if 8 * entries <= MAX_BITS:
        return build(df, hashes, size_for(entries), True)
    prepare(df.sparkSession)
    buckets = ceil(entries / BUCKET)

    def own(batches):
        """(hash, whether it came again) of a task, each hash once."""
        got = [h for h in map(hashes, batches) if len(h)]
        seen, counts = np.unique(np.concatenate(got) if got else np.empty(0, np.uint64), return_counts=True)
        for a in range(0, len(seen), SENT):
            yield pa.RecordBatch.from_arrays([pa.array(seen[a:a + SENT].view(np.int64)), pa.array(counts[a:a + SENT] > 1)], names=["hash", "again"])
        give_back()

    def suspects(batches):
        once = np.zeros(size_for(2 * BUCKET) // 8, np.uint8)
        for batch in batches:
            found = batch.column(0).to_numpy().view(np.uint64)
            seen, place, counts = np.unique(found, return_inverse=True, return_counts=True)
            more = (counts > 1) | contains(once, seen)
            more[place[batch.column(1).to_numpy(zero_copy_only=False)]] = True
            at = np.unique(places(seen, 8 * len(once)))
            np.bitwise_or.at(once, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array(seen[more].view(np.int64))], names=["hash"])
        give_back()

    dealt = df.mapInArrow(own, "hash long, again boolean").repartition(buckets, "hash")
    again = written(dealt.mapInArrow(suspects, "hash long").distinct(), "again")
    return build(again, lambda batch: batch.column(0).to_numpy().view(np.uint64), size_for(again.count()), False)


def of_longs(df: DataFrame, column: str, entries: int) -> Callable[[Column], Column]:
    """A test for columns of longs: false for what `column` of df surely doesn't hold."""
    packed = build(df.select(column), lambda batch: batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64),
                   size_for(entries), False)
    sent = df.sparkSession.sparkContext.broadcast(packed)

    @F.pandas_udf("boolean")
    def may_hold(values: pd.Series) -> pd.Series:
        return pd.Series(contains(sent.value, values.to_numpy().view(np.uint64)))

    return may_hold
