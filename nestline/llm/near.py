"""Near copies by order MinHash.

A text is the sequence of its different five-word shingles in order of first occurrence.
A sketch takes the two shingles of least hash and keeps them in text order, so equal sketches
speak for shared content in equal order. Texts that share a sketch are candidates; banded alignment of
the shingles decides.

Equal word sequences are one class from the start. A sketch's bucket of up to `SMALL` classes is
compared pair by pair. A larger bucket is first compared with its first and its last class and cut by the
next sketch, then by the one after that, which links most of what belongs together by few pairs. Where a
large bucket then still holds classes that are not connected, all its pairs of unconnected classes are
compared, in blocks of `BLOCK`; so each two similar texts that share a sketch end in one class.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from nestline.llm import bloom
from nestline.llm.buffers import STEP, free_name, mix, slices, with_results, words
from nestline.llm.graph import components
from nestline.sources.scratch import written

SHINGLE, SKETCHES, SMALL, LEVELS, BLOCK = 5, 16, 8, 3, 512
SEEDS = np.random.default_rng(77).integers(1, 1 << 63, (2, SKETCHES), dtype=np.uint64) | np.uint64(1)
SKETCH = StructType([StructField("one", LongType()), StructField("two", LongType()),
                     StructField("sketch", ArrayType(LongType()))])
SHAPE = StructType([StructField("shape", BinaryType())])


def labelled_shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of all rows in order, the first shingle of each row, and for each shingle how many
    equal ones its row has before it. A row of fewer than `size` words is one shingle."""
    counts = np.diff(first)
    own = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate(([0], np.cumsum(own)))
    row = np.repeat(np.arange(len(counts)), own)
    place = np.arange(begin[-1]) - begin[row] + first[row]
    length = np.minimum(counts, size)[row]
    out = np.zeros(len(place), np.uint64)
    for k in range(size):
        there = k < length
        out = np.where(there, out * STEP + hashes[np.where(there, place + k, 0)], out) if len(hashes) else out
    out = mix(out)
    key = out ^ mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    runs = np.flatnonzero(new)
    before = np.empty(len(order), np.int64)
    before[order] = np.arange(len(order)) - np.repeat(runs, np.diff(np.append(runs, len(order))))
    return out, begin, before


def row_sketches(shingle: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """SKETCHES values for each row that has shingles (begin holds such rows only), each shingle once in its row."""
    counts = np.diff(begin)
    value = mix(shingle)
    starts = begin[:-1]
    out = np.empty((len(starts), SKETCHES), np.uint64)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    for k in range(SKETCHES):
        seen = (value ^ SEEDS[0, k]) * SEEDS[1, k]
        at = []
        for _ in range(2):
            least = np.minimum.reduceat(seen, starts)
            equal = np.flatnonzero(seen == np.repeat(least, counts))
            lead = equal[np.searchsorted(equal, starts)]
            at.append(lead)
            seen[lead] = most
        low, high = np.minimum(*at), np.maximum(*at)
        single = counts == 1
        out[:, k] = mix(mix(shingle[low]) + np.where(single, np.uint64(0), shingle[high]))
    return out


def sketch_rows(texts: pa.Array) -> list[pa.Array]:
    """The fields of SKETCH: a 128-bit fingerprint of the word sequence and its sketches. Texts without
    words have a fingerprint of the whole text and no sketches."""
    ones, twos, sketches = [], [], []
    for _, _, offsets, data in slices(texts):
        hashes, first = words(offsets, data)
        counts = np.diff(first)
        filled = np.flatnonzero(counts)
        power = np.full(int(counts.max(initial=1)), STEP, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        inside = np.arange(len(hashes)) - np.repeat(first[:-1], counts)
        one, two = np.zeros((2, len(counts)), np.uint64)
        if len(filled):
            lengths = counts[filled].astype(np.uint64)
            one[filled] = mix(np.add.reduceat(hashes * power[inside], first[:-1][filled]) + lengths)
            two[filled] = mix(np.add.reduceat(mix(hashes) * power[inside] * power[inside], first[:-1][filled]) + lengths)
            shingle, begin, before = labelled_shingles(hashes, first, SHINGLE)
            once = before == 0
            own = np.add.reduceat(once, begin[:-1][filled], dtype=np.int64)
            values = row_sketches(shingle[once], np.concatenate(([0], np.cumsum(own)))).view(np.int64)
        rows: list = [[]] * len(counts)
        for k, row in enumerate(filled.tolist()):
            rows[row] = values[k]
        for row in np.flatnonzero(counts == 0).tolist():
            digest = np.frombuffer(hashlib.md5(data[offsets[row]:offsets[row + 1]].tobytes()).digest(), np.uint64)
            one[row], two[row] = digest
        ones.append(one.view(np.int64))
        twos.append(two.view(np.int64))
        sketches += rows
    join = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    return [pa.array(join(ones)), pa.array(join(twos)), pa.array(sketches, pa.list_(pa.int64()))]


def shapes(texts: pa.Array) -> list[pa.Array]:
    """The different shingles of each text in order of first occurrence, four bytes each."""
    out = []
    for _, _, offsets, data in slices(texts):
        hashes, first = words(offsets, data)
        shingle, begin, before = labelled_shingles(hashes, first, SHINGLE)
        short = (shingle >> np.uint64(32)).astype(np.uint32)
        for row in range(len(first) - 1):
            part = slice(begin[row], begin[row + 1])
            out.append(short[part][before[part] == 0].tobytes())
    return [pa.array(out, pa.binary())]


def aligned(a: np.ndarray, b: np.ndarray) -> int:
    """Shingles in the longest common sequence of two sequences of different shingles, or 0 where their
    share can't reach 0.8. Such an alignment leaves a ninth of all shingles unmatched at most, so no
    matched pair lies farther apart than that: the band."""
    total = len(a) + len(b)
    _, i, j = np.intersect1d(a, b, return_indices=True)
    near = np.abs(i - j) <= total // 9
    order = np.argsort(i[near])
    j = j[near][order]
    if 9 * len(j) < 4 * total:
        return 0
    if (j[1:] > j[:-1]).all():
        return len(j)
    tails: list[int] = []
    for x in j.tolist():
        at = bisect_left(tails, x)
        tails[at:at + 1] = [x]
    return len(tails)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the aligned shingles of two texts are 0.8 or more of all shingles of the two."""
    total = len(a) + len(b)
    return 4 * max(len(a), len(b)) <= 5 * min(len(a), len(b)) and 9 * aligned(a, b) >= 4 * total > 0


def similar(batches):
    """The (a, b) of pairs whose aligned shingles are 0.8 or more of all shingles of the two."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2), batch.column(3)):
            keep.append(linked(np.frombuffer(a.as_buffer(), np.uint32), np.frombuffer(b.as_buffer(), np.uint32)))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def unconnected(key: tuple, table: pa.Table) -> pa.Table:
    """The links (a, b) that connect members of two blocks of a bucket, or of one: each pair that neither has
    one part nor is connected by the links before it is compared, in the bucket of its first equal sketch."""
    table = table.sort_by([("rep", "ascending"), ("block", "ascending")])
    rep, part, block = (table.column(c).to_numpy() for c in ("rep", "part", "block"))
    sketch = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, SKETCHES)
    shape = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("shape")]
    counts = np.array([len(x) for x in shape])
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    names, place = np.unique(np.concatenate(shape), return_inverse=True)
    held = np.zeros(len(names), bool)
    at, crossing = int(table.column("i")[0].as_py()), key[1] != key[2]
    part, found = part.copy(), []
    for k in range(len(rep) - 1):
        rest = slice(k + 1, None)
        other = part[rest] != part[k]
        if crossing:
            other &= block[rest] != block[k]
        other &= 4 * np.maximum(counts[rest], counts[k]) <= 5 * np.minimum(counts[rest], counts[k])
        if not other.any():
            continue
        equal = sketch[rest] == sketch[k]
        other &= (equal.argmax(1) == at) & equal[:, at]
        if not other.any():
            continue
        own = place[starts[k]:starts[k] + counts[k]]
        held[own] = True
        common = np.add.reduceat(held[place[starts[k + 1]:]], starts[rest] - starts[k + 1], dtype=np.int64)
        held[own] = False
        other &= 9 * common >= 4 * (counts[rest] + counts[k])
        for j in (np.flatnonzero(other) + k + 1).tolist():
            if part[j] != part[k] and linked(shape[k], shape[j]):
                found.append((rep[k], rep[j]))
                part[part == part[j]] = part[k]
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def remaining(large: DataFrame, labels: DataFrame, classes: DataFrame, shaped: DataFrame) -> DataFrame:
    """The links (a, b) between parts that large buckets (key, i, n, rep) still hold after the components `labels`.

    A bucket of one part is done. The members of others are dealt into blocks by their hash, and each two blocks
    meet in one group of BLOCK texts or so from each."""
    parts = labels.select(F.col("node").alias("rep"), F.col("label").alias("part"))
    members = written(large.join(parts, "rep", "left").withColumn("part", F.coalesce("part", "rep")), "members")
    keys = members.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    rows = (members.join(keys, "key").join(classes.select("rep", "sketch"), "rep").join(shaped.withColumnRenamed("doc_id", "rep"), "rep")
            .withColumn("block", F.pmod(F.xxhash64("rep"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))))
    return (rows.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                        "i", "rep", "part", "block", "sketch", "shape")
            .groupBy("key", "low", "high").applyInArrow(unconnected, "a long, b long"))


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different pairs a < b of (rep, sketch) rows that share a bucket, and the members (key, i, n, rep) of the
    large buckets of one sketch, whose pairs are not all among them."""
    keys = [F.xxhash64(F.lit(level), "i", *[F.element_at("sketch", (F.col("i") + k) % SKETCHES + 1) for k in range(level)])
            .alias(f"key{level}") for level in range(1, LEVELS + 1)]
    rows = classes.where(F.size("sketch") > 0).select("rep", "sketch", F.explode(F.sequence(F.lit(0), F.lit(SKETCHES - 1))).alias("i"))
    rows = rows.select("rep", "i", *keys)
    found = []
    for level in range(1, LEVELS + 1):
        key = f"key{level}"
        sizes = written(rows.groupBy(key).agg(F.count("*").alias("n"), F.min("rep").alias("first"), F.max("rep").alias("last"))
                        .where("n > 1"), "buckets")
        shared = written(rows.join(sizes, key), "shared")
        members = shared.where(F.col("n") <= SMALL).groupBy(key).agg(F.array_sort(F.collect_list("rep")).alias("m"))
        pairs = F.flatten(F.transform("m", lambda x, i: F.transform(
            F.slice("m", i + 2, F.size("m")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
        found.append(members.select(F.explode(pairs).alias("p")).select("p.a", "p.b"))
        rows = shared.where(F.col("n") > SMALL)
        if level == 1:
            large = rows.select(F.col(key).alias("key"), "i", "n", "rep")
        found.append(rows.select(F.col("first").alias("a"), F.col("rep").alias("b")))
        found.append(rows.select(F.col("rep").alias("a"), F.col("last").alias("b")))
        rows = rows.drop(key, "n", "first", "last")
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return written(every.where("a < b").distinct(), "pairs"), large


def near_copies(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, class_id, n_links) for each row with an id: class_id is the smallest id of the rows that are
    linked with it, directly or through others; n_links the number of other texts that its text was found
    to be a near copy of.

    Texts are linked if their words are equal, or if the longest common sequence of their different
    five-word shingles, in order of first occurrence, is 0.8 or more of all their different shingles. A text
    of fewer words is one shingle; null counts as empty; texts without words are linked if equal. Rows
    without id are left out; rows that share an id are one document.
    """
    body = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    body = body.where("doc_id is not null")
    base = written(with_results(body, "text", ["doc_id"], "s", SKETCH, lambda: sketch_rows).select("doc_id", "s.*"), "sketches")
    classes = written(base.groupBy("one", "two").agg(F.min("doc_id").alias("rep"), F.min_by("sketch", "doc_id").alias("sketch")),
                      "classes")
    pairs, large = candidates(classes)
    wanted = bloom.of_longs(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "doc_id", 2 * pairs.count())
    shaped = written(with_results(body.where(wanted(F.col("doc_id"))), "text", ["doc_id"], "s", SHAPE, lambda: shapes)
                     .select("doc_id", "s.shape"), "shapes")
    both = (pairs.join(shaped.select(F.col("doc_id").alias("a"), F.col("shape").alias("left")), "a")
            .join(shaped.select(F.col("doc_id").alias("b"), F.col("shape").alias("right")), "b")
            .select("a", "b", "left", "right"))
    links = written(both.mapInArrow(similar, "a long, b long").distinct(), "links")
    labels = components(links)
    more = written(remaining(large, labels, classes, shaped), "links")
    if not more.isEmpty():
        links = written(links.union(more).distinct(), "links")
        labels = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    known = written(classes.select("one", "two", "rep").join(labels.join(degree, "node"), F.col("rep") == F.col("node"), "left")
                    .select("one", "two", F.coalesce("label", "rep").alias("class_id"),
                            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "known")
    return base.select("doc_id", "one", "two").join(known, ["one", "two"]).select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """docs without the rows whose class has a smaller id; rows without id stay."""
    mark = free_name(docs, "spare")
    spare = (near_copies(docs, text, doc).where("doc_id > class_id").select(F.col("doc_id").alias(mark)).distinct())
    return docs.join(spare, F.col(f"`{doc}`").cast("long") == F.col(mark), "left_anti")
