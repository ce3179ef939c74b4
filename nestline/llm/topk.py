"""Exact top-k search by histogram selection.

All scores of a query are counted in bins, coarse ones first; each round looks only into the bin that
holds the query's k-th score and cuts it anew, until a bin is one score wide. Then the rows at or above
that score are kept, equal ones by smaller id. A task counts its upper bins only, down to the one in
which it has as many rows of its own as are wanted: the k-th score of all rows can't lie lower.

Queries go to the tasks in passes of at most `PASS` of them, so what is broadcast and what a task
counts are bounded; the vectors stay where they are read. Shuffled are bins, and at most k rows for
each query and task.
"""

from __future__ import annotations

from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from nestline.llm.buffers import prepare
from nestline.sources.scratch import written

SCALE, K = 64, 20
#: Queries in a pass, bins in a round, queries and vectors scored at a time.
PASS, BINS, QUERY_BLOCK, VECTOR_BLOCK = 16_384, 256, 512, 4096
SIGN = np.uint64(1 << 63)
EXACT = 1 << 53


def quantised(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as longs; null for vectors that are null or hold a null or non-finite value."""
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(sound, F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Queries:
    """The queries of a pass, by number of components: ids, vectors, and of each the bin that is looked into."""

    def __init__(self, ids: np.ndarray, vectors: list, longest: dict[int, int], k: int):
        sizes = np.array([len(v) for v in vectors], np.int64)
        self.groups = {}
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            matrix = np.array([vectors[i] for i in at], np.int64).reshape(len(at), size)
            # no score is farther from 0 than the product of the lengths
            reach = [min(isqrt(sum(x * x for x in row) * longest.get(size, 0)) + 1, (1 << 63) - 1) for row in matrix.tolist()]
            low = np.array([(1 << 63) - r for r in reach], np.uint64)
            width = np.array([max(1, ceil((2 * r + 1) / BINS)) for r in reach], np.uint64)
            top = np.array([(1 << 63) + r for r in reach], np.uint64)
            order = np.argsort(ids[at])
            self.groups[size] = {"ids": ids[at][order], "matrix": matrix[order], "low": low[order], "top": top[order],
                                 "width": width[order], "need": np.full(len(at), k, np.int64),
                                 "open": np.ones(len(at), bool)}

    def narrow(self, counted: dict[int, tuple[int, int]]) -> None:
        """Takes the (bin, rows above it) of the k-th score of each open query."""
        for g in self.groups.values():
            for i in np.flatnonzero(g["open"]).tolist():
                found = counted.get(int(g["ids"][i]))
                if found is not None:
                    g["low"][i] += np.uint64(found[0]) * g["width"][i]
                    g["top"][i] = min(g["top"][i], g["low"][i] + (g["width"][i] - np.uint64(1)))
                    g["need"][i] -= found[1]
                # without a bin there are fewer rows than wanted: all of them count
                g["open"][i] = found is not None and g["width"][i] > 1
                g["width"][i] = -(-int(g["width"][i]) // BINS)


def score_blocks(batch: pa.RecordBatch, groups: dict):
    """For blocks of a batch's (id, components): the group, its rows, the vectors' ids and all scores as
    unsigned numbers of the same order. A query's own row has the lowest."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    lists = batch.column(1)
    bounds = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(bounds)
    for size, g in groups.items():
        mine = np.flatnonzero(sizes == size)
        for a in range(0, len(mine), VECTOR_BLOCK):
            rows = mine[a:a + VECTOR_BLOCK]
            vectors = values[bounds[rows][:, None] + np.arange(size)].reshape(len(rows), size)
            own = np.searchsorted(g["ids"], ids[rows])
            own_there = (own < len(g["ids"])) & (g["ids"][np.minimum(own, len(g["ids"]) - 1)] == ids[rows])
            for b in range(0, len(g["ids"]), QUERY_BLOCK):
                part = slice(b, min(b + QUERY_BLOCK, len(g["ids"])))
                queries = g["matrix"][part]
                if size * int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) < EXACT:
                    scores = (queries.astype(float) @ vectors.T.astype(float)).astype(np.int64)
                else:
                    scores = queries @ vectors.T
                scores = scores.view(np.uint64) ^ SIGN
                hit = np.flatnonzero(own_there & (own >= part.start) & (own < part.stop))
                scores[own[hit] - b, hit] = 0
                yield g, part, ids[rows], scores


def count_bins(batches, groups: dict):
    """(query_id, bin, n) of a task, upper bins only."""
    counts = {id(g): np.zeros((len(g["ids"]), BINS), np.int64) for g in groups.values()}
    for batch in batches:
        for g, part, _, scores in score_blocks(batch, groups):
            low, width = g["low"][part, None], g["width"][part, None]
            at = np.minimum((scores - low) // width, np.uint64(BINS))
            at[(scores < low) | (scores > g["top"][part, None]) | ~g["open"][part, None]] = BINS
            at = at.astype(np.int64) + np.arange(len(at))[:, None] * (BINS + 1)
            counts[id(g)][part] += np.bincount(at.ravel(), minlength=len(at) * (BINS + 1)).reshape(len(at), BINS + 1)[:, :BINS]
    for g in groups.values():
        n = counts[id(g)]
        above = np.cumsum(n[:, ::-1], axis=1)[:, ::-1] - n
        query, at = np.nonzero((n > 0) & (above < g["need"][:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(g["ids"][query]), pa.array(at.astype(np.int32)), pa.array(n[query, at])],
                                         names=["query_id", "bin", "n"])


def best_rows(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best rows of every query."""
    order = np.lexsort((ids, ~scores, query))
    first = np.concatenate(([True], np.diff(query[order]) > 0)) if len(order) else np.empty(0, bool)
    begin = np.flatnonzero(first)
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[rank < k]


def keep_rows(batches, groups: dict, k: int):
    """(query_id, vec_id, score) of a task: its k best rows at or above each query's k-th score."""
    kept = {id(g): [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)] for g in groups.values()}
    for batch in batches:
        for g, part, ids, scores in score_blocks(batch, groups):
            query, at = np.nonzero((scores >= g["low"][part, None]) & (scores > 0))
            old = kept[id(g)]
            new = [np.concatenate(x) for x in zip(old, (query + part.start, ids[at], scores[query, at]))]
            best = best_rows(*new, k)
            kept[id(g)] = [x[best] for x in new]
    for g in groups.values():
        query, ids, scores = kept[id(g)]
        yield pa.RecordBatch.from_arrays([pa.array(g["ids"][query]), pa.array(ids), pa.array((scores ^ SIGN).view(np.int64))],
                                         names=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, queries: Column, k: int = K, vec: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of vectors that `queries` holds for, the k rows but its own
    with the highest integer inner product of quantised components; ties go to the smaller id, fewer rows
    where there are fewer.

    Rows without id, null vectors and those with a null or non-finite component take no part. An id is one
    vector: of rows that repeat it the one with the smallest components, compared in order, counts. Vectors
    are compared with those of as many components only. Scores are longs.
    """
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{vec}`").cast("long").alias("vec_id"), quantised(F.col(f"`{embedding}`")).alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("asks")).where("vec_id is not null and v is not null")
    rows = written(rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")), "vectors")
    squares = F.aggregate("v", F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x.cast("decimal(19,0)") * x).cast("decimal(38,0)"))
    longest = {r.size: int(r.most) for r in rows.groupBy(F.size("v").alias("size")).agg(F.max(squares).alias("most")).collect()}
    asking = rows.where("asks")
    passes = max(1, ceil(asking.count() / PASS))
    found = []
    for number in range(passes):
        mine = asking.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number).select("vec_id", "v").toArrow()
        state = Queries(mine["vec_id"].to_numpy(), mine["v"].to_pylist(), longest, k)
        pairs = rows.select("vec_id", "v")
        while state.groups and any(g["open"].any() for g in state.groups.values()):
            state.narrow(_counted(pairs, state, k))
        sent = rows.sparkSession.sparkContext.broadcast(state.groups)
        found.append(pairs.mapInArrow(lambda batches, sent=sent: keep_rows(batches, sent.value, k),
                                      "query_id long, vec_id long, score long"))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _counted(pairs: DataFrame, state: Queries, k: int) -> dict:
    """For each query of the pass the bin of its k-th score, from the bins of all tasks."""
    sent = pairs.sparkSession.sparkContext.broadcast(state.groups)
    bins = (pairs.mapInArrow(lambda batches: count_bins(batches, sent.value), "query_id long, bin int, n long")
            .groupBy("query_id", "bin").agg(F.sum("n").alias("n")))
    need = {int(q): int(n) for g in state.groups.values() for q, n in zip(g["ids"], g["need"])}
    down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
    upper = bins.withColumn("above", F.sum("n").over(down) - F.col("n")).where(F.col("above") < k)
    found: dict = {}
    for row in upper.select("query_id", "bin", "n", "above").toLocalIterator():
        if row.above < need[row.query_id] <= row.above + row.n:
            found[row.query_id] = (row.bin, row.above)
    return found
