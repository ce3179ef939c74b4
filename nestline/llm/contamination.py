"""Benchmark decontamination with suffix arrays of the training texts.

Documents of up to `SHARD_BYTES` bytes are a shard: the places of its words form one array of suffixes, ordered
by their next words. Every suffix of a benchmark item that has a whole window is looked for by binary
search; the interval found holds all places of its window. Longer matches are followed word by word in the
suffixes of the items that begin with the window, by binary search among them. Only places whose first words begin some benchmark suffix are sorted: no other place can match,
so the array stays small and nothing is lost.

The benchmark goes to the tasks in blocks of at most `BLOCK_CHARS` characters, so what is broadcast is
bounded whatever the size of the benchmark; more blocks mean more passes and one grouping of what each
pass has found.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from nestline.llm.buffers import column_bytes, free_name, mix, slices, with_results, words, words_in_slices
from nestline.sources.scratch import written

WINDOW, MIN_SHARE = 13, 20
BLOCK_CHARS = 32 << 20
SHARD_BYTES = 16 << 20
#: Words by which places are chosen before they are sorted.
LEAD = 3
TABLE_BITS = 22

FOUND = StructType([
    StructField("n_words", LongType()),
    StructField("starts", ArrayType(LongType())), StructField("ends", ArrayType(LongType())),
    StructField("items", ArrayType(StringType())),
    StructField("longest", LongType()), StructField("longest_start", LongType()), StructField("longest_item", StringType()),
])


class Windows:
    """The windows of one length of a block of items: different ones only, in order of their words, and for each
    the suffixes that begin with it, in order of the words behind it."""

    def __init__(self, length: int, places: np.ndarray, item_of: np.ndarray, ids: list, text: np.ndarray, rank: np.ndarray):
        self.length = length
        order = np.argsort(rank[places], kind="stable")
        places, item_of = places[order], item_of[order]
        rows = text[places[:, None] + np.arange(length)]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        first = np.flatnonzero(fresh)
        self.rows, self.suffixes, self.begin = rows[first], places, np.append(first, len(rows))
        self.items = [{ids[i] for i in item_of[a:b] if ids[i] is not None}
                      for a, b in zip(first, [*first[1:], len(rows)])]
        self.lead = min(LEAD, length)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[lead_slots(self.rows, self.lead)] = True


def lead_slots(rows: np.ndarray, lead: int) -> np.ndarray:
    out = rows[:, 0].copy()
    for k in range(1, lead):
        out = mix(out) + rows[:, k]
    return (mix(out) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def suffix_ranks(text: np.ndarray, item_end: np.ndarray) -> np.ndarray:
    """The rank of each suffix of the items by its words, shorter ones first where one begins the other; equal ones
    share a rank. Suffixes are compared by twice as many words in each round, until no round tells more apart."""
    if not len(text):
        return np.empty(0, np.int64)
    different, rank = np.unique(text, return_inverse=True)
    size, count = 1, len(different)
    while size < (item_end - np.arange(len(text))).max():
        ahead = np.arange(len(text)) + size
        behind = np.where(ahead < item_end, rank[np.minimum(ahead, len(text) - 1)] + 1, 0)
        different, rank = np.unique(rank * (len(text) + 1) + behind, return_inverse=True)
        if len(different) == count:
            break
        size, count = 2 * size, len(different)
    return rank


class Block:
    def __init__(self, rows: list[tuple], window: int):
        hashes, first = words(*column_bytes(pa.array([t for _, t in rows], pa.string())))
        counts = np.diff(first)
        self.ids, self.text = [None if i is None else str(i) for i, _ in rows], np.append(hashes, np.zeros(window, np.uint64))
        self.item_end = np.repeat(first[1:], counts)
        places, item_of = np.arange(len(hashes)), np.repeat(np.arange(len(rows)), counts)
        short = counts[item_of] < window
        lengths = np.where(short, np.where(places == first[item_of], counts[item_of], 0),
                           np.where(places + window <= self.item_end, window, 0))
        rank = suffix_ranks(hashes, self.item_end)
        self.windows = [Windows(int(n), places[lengths == n], item_of[lengths == n], self.ids, self.text, rank)
                        for n in np.unique(lengths) if n]
        self.item_of = item_of
        order = {i: k for k, i in enumerate(sorted({i for i in self.ids if i is not None}))}
        self.id_rank = np.array([order.get(i, len(order)) for i in self.ids], np.int64)

    def next_words(self, suffixes: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The word behind the first `length` words of each suffix, 0 where its item ends."""
        at = suffixes + length
        return np.where(at < self.item_end[suffixes], self.text[at], np.uint64(0))


def before(a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
    """For two arrays of suffix beginnings, whether each row of a comes before its row of b."""
    differ = a != b
    at = differ.argmax(axis=1)
    rows = np.arange(len(a))
    return np.where(differ[rows, at], a[rows, at] < b[rows, at], or_equal)


def search(shard: np.ndarray, wanted: np.ndarray, after_equal: bool) -> np.ndarray:
    """Binary search of all rows of `wanted` in the sorted rows of `shard`."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(shard), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        right = before(shard[middle], wanted[open_], after_equal)
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]
    return low


def shard_matches(block: Block, hashes: np.ndarray, first: np.ndarray) -> tuple:
    """Of a shard's words (rows begin at `first`): window length, place and class of every match."""
    counts = np.diff(first)
    row_end = np.repeat(first[1:], counts)
    found = []
    for n, w in enumerate(block.windows):
        if len(hashes) < w.length:
            continue
        lead = [hashes[k:len(hashes) - w.lead + 1 + k] for k in range(w.lead)]
        slot = lead[0].copy()
        for k in range(1, w.lead):
            slot = mix(slot) + lead[k]
        places = np.flatnonzero(w.table[(mix(slot) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        places = places[places + w.length <= row_end[places]]
        if not len(places):
            continue
        rows = hashes[places[:, None] + np.arange(w.length)]
        order = np.lexsort(rows.T[::-1])
        rows = rows[order]
        low, high = search(rows, w.rows, False), search(rows, w.rows, True)
        hit = np.flatnonzero(high > low)
        sizes = (high - low)[hit]
        if len(hit):
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            found.append((n, places[order[np.repeat(low[hit], sizes) + inside]], np.repeat(hit, sizes)))
    return found


def followed(block: Block, w: Windows, places: np.ndarray, classes: np.ndarray, hashes: np.ndarray, row_end: np.ndarray) -> tuple:
    """For each match of a window the length of the longest one that begins there, and the range of the window's
    suffixes that go on so far."""
    low, high, length = w.begin[classes], w.begin[classes + 1], np.full(len(places), w.length)
    going = np.arange(len(places))
    while len(going := going[places[going] + length[going] < row_end[places[going]]]):
        wanted = hashes[places[going] + length[going]]
        ends = []
        for after_equal in (False, True):
            a, b = low[going].copy(), high[going].copy()
            while (open_ := np.flatnonzero(a < b)).size:
                middle = (a[open_] + b[open_]) // 2
                word = block.next_words(w.suffixes[middle], length[going[open_]])
                right = (word < wanted[open_]) | (after_equal & (word == wanted[open_]))
                a[open_[right]], b[open_[~right]] = middle[right] + 1, middle[~right]
            ends.append(a)
        more = ends[1] > ends[0]
        going = going[more]
        low[going], high[going] = ends[0][more], ends[1][more]
        length[going] += 1
    return length, low, high


def scan(block: Block, texts: pa.Array) -> list:
    """The fields of FOUND for each text."""
    parts = [scan_shard(block, rows, offsets, data) for rows, offsets, data in
             ((last - first, offsets, data) for first, last, offsets, data in slices(texts, SHARD_BYTES))]
    kinds = [f.dataType for f in FOUND]
    return [pa.concat_arrays([p[k] for p in parts]) if parts else pa.array([], to_arrow_type(kind))
            for k, kind in enumerate(kinds)]


def scan_shard(block: Block, rows: int, offsets: np.ndarray, data: np.ndarray) -> list:
    hashes, first = words_in_slices(offsets, data)
    counts = np.diff(first)
    row_of = np.repeat(np.arange(rows), counts)
    row_end = np.repeat(first[1:], counts)
    cover = np.zeros(len(hashes) + 1, np.int64)
    items: dict[int, set] = {}
    longest: list[tuple] = []
    for n, places, classes in shard_matches(block, hashes, first):
        w = block.windows[n]
        cover += np.bincount(places, minlength=len(cover)) - np.bincount(places + w.length, minlength=len(cover))
        pairs = np.unique(row_of[places] * len(w.rows) + classes)
        for row, c in zip((pairs // len(w.rows)).tolist(), (pairs % len(w.rows)).tolist()):
            items.setdefault(row, set()).update(w.items[c])
        length, low, high = followed(block, w, places, classes, hashes, row_end)
        row = row_of[places]
        order = np.lexsort((places, -length, row))
        lead = order[np.concatenate(([True], np.diff(row[order]) > 0))]
        for k in lead.tolist():  # one for each text: the smallest id of those that go on as far
            ids = block.item_of[w.suffixes[low[k]:high[k]]]
            item = int(ids[np.argmin(block.id_rank[ids])])
            longest.append((int(row[k]), -int(length[k]), int(places[k] - first[row[k]]), int(block.id_rank[item]), item))
    best: dict[int, tuple] = {}
    for r, length, start, _, item in sorted(longest):
        best.setdefault(r, (-length, start, block.ids[item]))
    hit = np.cumsum(cover)[:-1] > 0
    starts, ends = [None] * rows, [None] * rows
    for r in best:
        own = np.diff(np.concatenate(([0], hit[first[r]:first[r + 1]].view(np.int8), [0])))
        starts[r], ends[r] = np.flatnonzero(own == 1).tolist(), np.flatnonzero(own == -1).tolist()
    of = [best.get(r, (None, None, None)) for r in range(rows)]
    return [pa.array(counts, pa.int64()), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())),
            pa.array([sorted(items[r]) if r in items else None for r in range(rows)], pa.list_(pa.string())),
            *[pa.array([x[k] for x in of], (pa.int64(), pa.int64(), pa.string())[k]) for k in range(3)]]


def blocks(benchmark: DataFrame, item: str, text: str, block_chars: int):
    """The benchmark's (item, text) rows, in parts of about block_chars characters."""
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).cast("string").alias("t")).where("t is not null")
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = max(1, ceil(chars / block_chars))
    for part in range(parts):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).collect()]


def matches(docs: DataFrame, benchmark: DataFrame, keep: list[str], result: str, text: str = "text", item: str = "item_id",
            item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The columns `keep` of docs and a struct `result`: n_words; starts and ends of the runs of words that
    lie in an occurrence of a window of `window` consecutive benchmark words (an item of fewer words is one
    window); items, the sorted ids of the items with such windows; the longest verbatim match: longest,
    longest_start, longest_item. All but n_words are null where nothing is found.

    Null and empty texts have no words and match nothing; items without words match nothing, items without
    id hit words but are not listed. Repeated rows have results of their own; items of one id count once,
    equal items all. Of equally long matches the first place counts, then the smaller id.
    """
    body = free_name(docs, "body")
    rows = docs.select(*keep, F.col(f"`{text}`").alias(body))
    found: list[str] = []
    for block in blocks(benchmark, item, item_text, block_chars):
        if found:  # one block at a time in memory
            rows = written(rows, "matches")
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def start(sent=sent):
            ready = Block(sent.value, window)
            return lambda texts: scan(ready, texts)

        found.append(free_name(rows, result))
        rows = with_results(rows, body, rows.columns, found[-1], FOUND, start)
    return rows.select(*keep, merged([F.col(f) for f in found]).alias(result))


def merged(found: list[Column]) -> Column:
    """One struct from those that the passes over several blocks give for a row."""
    if len(found) == 1:
        return found[0]
    places = F.array_sort(F.array_distinct(F.flatten(F.filter(F.array(*[
        F.flatten(F.zip_with(f["starts"], f["ends"], lambda a, b: F.sequence(a, b - 1))) for f in found]), F.isnotnull))))
    starts = F.filter(places, lambda p: ~F.array_contains(places, p - 1))
    ends = F.transform(F.filter(places, lambda p: ~F.array_contains(places, p + 1)), lambda p: p + 1)
    items = F.array_sort(F.array_distinct(F.flatten(F.filter(F.array(*[f["items"] for f in found]), F.isnotnull))))
    best = F.array_min(F.filter(F.array(*[F.struct((-f["longest"]).alias("less"), f["longest_start"].alias("start"),
                                                   f["longest_item"].alias("item")) for f in found]),
                                lambda x: x["less"].isNotNull()))
    some = F.size(places) > 0
    return F.struct(found[0]["n_words"].alias("n_words"), F.when(some, starts).alias("starts"), F.when(some, ends).alias("ends"),
                    F.when(some, items).alias("items"), (-best["less"]).alias("longest"),
                    best["start"].alias("longest_start"), best["item"].alias("longest_item"))


def measured(found: str):
    """n_hit, n_items and the verdict as columns of a match struct."""
    r = F.col(found)
    n_hit = F.coalesce(F.aggregate(F.zip_with(r["starts"], r["ends"], lambda a, b: b - a), F.lit(0).cast("long"),
                                   lambda a, b: a + b), F.lit(0).cast("long"))
    n_items = F.coalesce(F.size(r["items"]).cast("long"), F.lit(0).cast("long"))
    return n_hit, n_items, (n_hit > 0) & (n_hit * MIN_SHARE >= r["n_words"])


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
           window: int = WINDOW) -> DataFrame:
    """docs without the rows of which one word in `MIN_SHARE` or more lies in benchmark windows."""
    found = free_name(docs, "found")
    rows = matches(docs, benchmark, docs.columns, found, text, item, item_text, window)
    return rows.where(~measured(found)[2]).select(*[F.col(f"`{c}`") for c in docs.columns])
