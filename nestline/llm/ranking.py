"""Ranked lexical search by bag deduplication.

One scan restricts every document to the words of the items: its bag, the sorted (term, occurrences)
pairs, and its number of words. With the corpus counts from that, a score depends on the bag and on m, the
measure of the document's length, only. Documents are dealt by a hash of both and verified by the values,
so each class of equal ones is scored once against all items; its first k ids are all that an item
can need of it, and the k best classes, by score and then smallest id, all that it can need of the classes.

Items go to the tasks in blocks of at most `BLOCK_CHARS` characters, so what is broadcast is bounded; more
blocks mean more scans. Bags are shuffled once to meet their equals, then at most k classes for each item and
task. Terms are known by 64-bit hashes.
"""

from __future__ import annotations

from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from nestline.llm.buffers import column_bytes, give_back, slices, with_results, words
from nestline.llm.contamination import blocks
from nestline.sources.scratch import written

K = 10
BLOCK_CHARS = 8 << 20
TABLE_BITS = 22
#: Scores and additions that a task works on at a time.
AT_A_TIME = 2_000_000
EXACT = 1 << 53
TOP = 1_000_000_000

BAG = StructType([StructField("n", LongType()), StructField("bag", ArrayType(IntegerType()))])


class Items:
    """The items of a block: their terms by hash, and for each term the items that hold it, and how often."""

    def __init__(self, rows: list[tuple]):
        self.ids = [i for i, _ in rows]
        hashes, first = words(*column_bytes(pa.array([t for _, t in rows], pa.string())))
        self.terms, term = np.unique(hashes, return_inverse=True)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.terms >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        item = np.repeat(np.arange(len(rows)), np.diff(first))
        pairs, self.times = np.unique(term * max(1, len(rows)) + item, return_counts=True)
        self.item = pairs % max(1, len(rows))
        self.start = np.searchsorted(pairs // max(1, len(rows)), np.arange(len(self.terms) + 1))

    def bags(self, texts: pa.Array) -> list:
        """Of each text the number of words, and [term, occurrences, term, ...] of the items' words."""
        counts, sizes, values = [], [], []
        for first, last, offsets, data in slices(texts):
            hashes, begin = words(offsets, data)
            at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
            term = np.minimum(np.searchsorted(self.terms, hashes[at]), len(self.terms) - 1)
            at, term = (x[self.terms[term] == hashes[at]] for x in (at, term)) if len(at) else (at, at)
            row = np.searchsorted(begin, at, "right") - 1
            pairs, times = np.unique(row * max(1, len(self.terms)) + term, return_counts=True)
            row, term = np.divmod(pairs, max(1, len(self.terms)))
            counts.append(np.diff(begin))
            sizes.append(2 * np.bincount(row, minlength=last - first))
            values.append(np.stack([term, times], axis=1).ravel().astype(np.int32))
        ends = np.concatenate(([0], *map(np.cumsum, [np.concatenate(sizes)] if sizes else []))).astype(np.int32)
        flat = np.concatenate(values) if values else np.empty(0, np.int32)
        return [pa.array(np.concatenate(counts) if counts else np.empty(0, np.int64), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]

    def scores(self, weights: np.ndarray, rows: int, row: np.ndarray, term: np.ndarray, times: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The scores of `rows` classes with all items, from the (row, term, occurrences) of their bags."""
        part = weights[term] * (TOP * times // (1000 * times + 8 * m[row]))
        sizes = self.start[term + 1] - self.start[term]
        at = np.arange(sizes.sum()) + np.repeat(self.start[term] - np.cumsum(sizes) + sizes, sizes)
        cell, value = np.repeat(row, sizes) * len(self.ids) + self.item[at], np.repeat(part, sizes) * self.times[at]
        # below EXACT no sum of doubles is rounded
        if int(np.abs(value).max(initial=0)) * max(1, len(self.terms)) < EXACT:
            total = np.bincount(cell, value, rows * len(self.ids)).astype(np.int64)
        else:
            total = np.zeros(rows * len(self.ids), np.int64)
            np.add.at(total, cell, value)
        return total.reshape(rows, len(self.ids))


def count_terms(batches, terms: int):
    """(term, df) of a task's bags."""
    df = np.zeros(terms, np.int64)
    for batch in batches:
        df += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False)[::2], minlength=terms)
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])


def best_classes(batches, items: Items, weights: np.ndarray, k: int, id_type: pa.DataType):
    """(item, item_id, score, members): of a task's (m, bag, members), the k best classes of each item."""
    item, score, first, where = (np.empty(0, np.int64) for _ in range(4))
    least, members, n_items, most = np.ones(len(items.ids), np.int64), {}, len(items.ids), 0
    reach = np.diff(items.start)
    for batch in batches:
        m, bags, ids = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
        ends, values = bags.offsets.to_numpy(), bags.values.to_numpy()
        smallest = ids.values.to_numpy()[ids.offsets.to_numpy()[:-1]]
        work = np.concatenate(([0], np.cumsum(reach[values[ends[0]:ends[-1]:2]])))[(ends - ends[0]) // 2] + n_items * np.arange(len(ends))
        a = 0
        while a < len(m):
            b = max(a + 1, int(np.searchsorted(work, work[a] + AT_A_TIME, "right")) - 1)
            bag = values[ends[a]:ends[b]].reshape(-1, 2).astype(np.int64)
            row = np.repeat(np.arange(b - a), np.diff(ends[a:b + 1]) // 2)
            found = items.scores(weights, b - a, row, bag[:, 0], bag[:, 1], m[a:b])
            if b - a > k:  # no row below the k-th of this part is among the best
                least = np.maximum(least, np.partition(found, b - a - k, axis=0)[b - a - k])
            at, of = np.nonzero(found >= least)
            item, score = np.append(item, of), np.append(score, found[at, of])
            first, where = np.append(first, smallest[a + at]), np.append(where, most + at)
            order = np.lexsort((first, -score, item))
            begin = np.searchsorted(item[order], np.arange(n_items))
            kept = order[np.arange(len(order)) - begin[item[order]] < k]
            item, score, first, where = item[kept], score[kept], first[kept], where[kept]
            full = np.flatnonzero(np.bincount(item, minlength=n_items) == k)
            ends_of = np.searchsorted(item, full, "right") - 1
            least[full] = np.maximum(least[full], score[ends_of])
            new = np.unique(where[where >= most])
            members |= {int(c): ids[a + int(c) - most].as_py() for c in new}
            most += b - a
            a = b
        if len(members) > 2 * n_items * k:
            members = {c: members[c] for c in np.unique(where).tolist()}
    yield pa.RecordBatch.from_arrays(
        [pa.array(item), pa.array([items.ids[i] for i in item.tolist()], id_type), pa.array(score),
         pa.array([members[c] for c in where.tolist()], pa.list_(pa.int64()))], names=["item", "item_id", "score", "members"])
    give_back()


def classes(bags: DataFrame, n_docs: int, n_words: int, k: int) -> DataFrame:
    """(m, bag, members): one row for all documents of a bag and m, with its k smallest ids."""
    held = bags.where("doc_id is not null and size(bag) > 0")
    m = F.expr(f"25L + (75L * n * {n_docs}L) div {max(1, n_words)}L")
    held = held.select("doc_id", m.alias("m"), "bag").withColumn("hash", F.xxhash64("m", "bag"))
    place = F.row_number().over(Window.partitionBy("hash", "m", "bag").orderBy("doc_id"))
    first = held.withColumn("place", place).where(F.col("place") <= k)
    return (first.groupBy("hash", "m", "bag").agg(F.sort_array(F.collect_list("doc_id")).alias("members"))
            .select("m", "bag", "members"))


def search(docs: DataFrame, benchmark: DataFrame, k: int = K, text: str = "text", doc: str = "doc_id", item: str = "item_id",
           item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item, all if fewer;
    equal scores by ascending id.

    A null or empty text has no terms: such an item finds nothing, such a document is not found and does not
    count in N. Documents without id count in all statistics but are not returned. Repeated documents are
    documents of their own, each with a rank; items equal in id and text count once, items that share an id
    otherwise have a ranking each.
    """
    rows = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("body"))
    id_field = benchmark.select(item).schema.fields[0]
    shape = StructType([StructField("item", LongType()), StructField("item_id", id_field.dataType),
                        StructField("score", LongType()), StructField("members", ArrayType(LongType()))])
    id_type, found = to_arrow_type(id_field.dataType), None
    for block in blocks(benchmark, item, item_text, block_chars):
        items = Items(list(dict.fromkeys(block)))
        sent = docs.sparkSession.sparkContext.broadcast(items)
        bags = with_results(rows, "body", ["doc_id"], "b", BAG, lambda sent=sent: sent.value.bags)
        bags = written(bags.select("doc_id", "b.n", "b.bag"), "bags")
        counts = bags.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
        n_docs, n_words = counts.docs, counts.words or 0
        df = np.zeros(len(items.terms), np.int64)
        counted = bags.select("bag").mapInArrow(lambda batches, n=len(df): count_terms(batches, n), "term long, df long")
        for r in counted.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
            df[r.term] = r.df
        weights = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        best = classes(bags, n_docs, n_words, k).mapInArrow(
            lambda batches, sent=sent, weights=weights: best_classes(batches, sent.value, weights, k, id_type), shape)
        top = Window.partitionBy("item").orderBy(F.desc("score"), F.col("members")[0])
        best = best.withColumn("place", F.row_number().over(top)).where(F.col("place") <= k)
        rank = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        ranked = (best.select("item", "item_id", "score", F.explode("members").alias("doc_id"))
                  .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
        found = ranked if found is None else found.union(written(ranked, "ranked"))
    return found
