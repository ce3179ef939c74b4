"""Hard negatives of anchors by spanning-tree bounds.

The anchors of a pass are joined by a spanning tree of least total distance. A task scores its rows with the
root; along an edge, the score of a row can't differ by more than the edge's length times the row's
norm, so the bounds at a parent give bounds at its child. Only rows whose bounds overlap what the child looks for
are scored anew, which makes their bounds exact for its own children. First the best rows of the same label
are found (positives), then, between shares of each positive's score, the best of other labels.

Anchors go out in passes of at most `PASS`, so what is broadcast and what a task keeps is bounded; each
pass reads the vectors twice where they are. Shuffled are the best rows of a task for each anchor and positive.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from nestline.llm.buffers import give_back, prepare
from nestline.llm.topk import quantised
from nestline.sources.scratch import scratch_path, written

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: A negative's score lies between these hundredths of the positive's.
SHARES = (80, 100)
#: Anchors in a pass, rows scored at a time.
PASS, BLOCK = 2048, 1024
EXACT = 1 << 53
#: Norms below it keep every score in 64 bits.
MAX_NORM = 1 << 31
#: What rounding can take from a bound.
SLACK = 1e-9
#: Lower than any score.
LEAST = np.iinfo(np.int64).min


class Anchors:
    """Anchors of a pass with the same number of components, and the spanning tree of them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        self.ids, self.labels, self.matrix = ids, labels, matrix
        points = matrix.astype(float)
        squares = (points * points).sum(axis=1)
        self.parent, best, left = np.full(len(ids), -1), np.full(len(ids), np.inf), np.ones(len(ids), bool)
        self.order, at = [], 0
        for _ in range(len(ids)):
            self.order.append(at)
            left[at] = False
            away = squares + squares[at] - 2 * (points @ points[at])
            closer = left & (away < best)
            best[closer], self.parent[closer] = away[closer], at
            at = int(np.argmin(np.where(left, best, np.inf)))
        self.edge = np.sqrt(((points - points[self.parent]) ** 2).sum(axis=1)) * (1 + SLACK)
        self.most = int(np.abs(matrix).max(initial=0))

    def least_positive(self, k: int) -> list[int]:
        """For each anchor the k-th best score of other anchors of its label, which its k-th positive reaches."""
        out = []
        for i, label in enumerate(self.labels):
            same = np.flatnonzero((self.labels == label) & (np.arange(len(self.ids)) != i))
            scores = np.sort(exact(self.matrix[same], self.matrix[i]))
            out.append(int(scores[-k]) if len(scores) >= k else LEAST)
        return out


def exact(vectors: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles hold them where all sums are small enough."""
    if len(anchor) * int(np.abs(vectors).max(initial=0)) * int(np.abs(anchor).max(initial=0)) < EXACT:
        return (vectors.astype(float) @ anchor.astype(float)).astype(np.int64)
    return vectors @ anchor


def walk(anchors: Anchors, vectors: np.ndarray, wanted):
    """(anchor, rows, scores) down the tree, parents first: `wanted(anchor, low, high)` tells for bounds of all
    rows' scores which rows have to be scored."""
    values = vectors.astype(float)
    norms = np.sqrt((values * values).sum(axis=1)) * (1 + SLACK)
    fits = vectors.shape[1] * anchors.most * int(np.abs(vectors).max(initial=0)) < EXACT
    points = anchors.matrix.astype(float)
    low, high = np.empty((2, len(anchors.ids), len(vectors)))
    for at in anchors.order:
        up = anchors.parent[at]
        if up < 0:
            low[at], high[at] = -np.inf, np.inf
            rows = np.arange(len(vectors))
        else:
            reach = anchors.edge[at] * norms
            low[at], high[at] = low[up] - reach, high[up] + reach
            # doubles round far below half a score where scores fit them
            slack = 0.5 + SLACK * (np.abs(low[at]) + np.abs(high[at]))
            low[at] -= slack
            high[at] += slack
            rows = np.flatnonzero(wanted(at, low[at], high[at]))
        scores = (values[rows] @ points[at]).astype(np.int64) if fits else vectors[rows] @ anchors.matrix[at]
        low[at, rows] = high[at, rows] = scores
        yield at, rows, scores


def read(batches, groups: dict[int, Anchors]):
    """(anchors, ids, labels, vectors) of blocks of a task's (id, label, components)."""
    for batch in batches:
        ids, labels = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        bounds, values = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy(zero_copy_only=False)
        sizes = np.diff(bounds)
        for size in groups:
            mine = np.flatnonzero(sizes == size)
            for a in range(0, len(mine), BLOCK):
                rows = mine[a:a + BLOCK]
                yield size, ids[rows], labels[rows], values[bounds[rows][:, None] + np.arange(size)].reshape(len(rows), size)


class Best:
    """The k best (score, id) so far, ties by smaller id."""

    def __init__(self, k: int, least: int = LEAST):
        self.k, self.least = k, least
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def find_positives(batches, groups: dict[int, Anchors], least: dict[int, list[int]], k: int):
    """(anchor_id, vec_id, score): a task's k best rows of each anchor's label."""
    best = {size: [Best(k, x) for x in least[size]] for size in groups}
    for size, ids, labels, vectors in read(batches, groups):
        anchors, mine = groups[size], best[size]

        def wanted(at, low, high):
            return (labels == anchors.labels[at]) & (ids != anchors.ids[at]) & (high >= mine[at].least)

        for at, rows, scores in walk(anchors, vectors, wanted):
            rows, scores = (x[(labels[rows] == anchors.labels[at]) & (ids[rows] != anchors.ids[at])] for x in (rows, scores))
            mine[at].add(scores, ids[rows])
    for size, anchors in groups.items():
        yield listed({"anchor_id": anchors.ids}, "vec_id", best[size])
    give_back()


def listed(keys: dict[str, np.ndarray], ids: str, best: list[Best]) -> pa.RecordBatch:
    """A row for each of the best rows, with the keys of what they are the best of."""
    counts = [len(b.ids) for b in best]
    columns = {name: np.repeat(values, counts) for name, values in keys.items()}
    columns[ids] = np.concatenate([b.ids for b in best])
    columns["score"] = np.concatenate([b.scores for b in best])
    return pa.RecordBatch.from_pydict(columns)


def window(positive: int, shares: tuple[int, int]) -> tuple[int, int]:
    """The least and the greatest score between hundredths of a positive's."""
    return -(-shares[0] * positive // 100), shares[1] * positive // 100


def find_negatives(batches, groups: dict[int, Anchors], positives: dict[int, list[tuple[int, int]]], shares: tuple[int, int], k: int):
    """(anchor_id, positive_id, positive_score, vec_id, score): for each positive a task's k best rows of other
    labels with a score between the shares of its own."""
    best = {size: [[Best(k) for _ in positives.get(a, [])] for a in anchors.ids.tolist()] for size, anchors in groups.items()}
    sought = {size: [[window(s, shares) for _, s in positives.get(a, [])] for a in anchors.ids.tolist()] for size, anchors in groups.items()}
    for size, ids, labels, vectors in read(batches, groups):
        anchors, mine, windows = groups[size], best[size], sought[size]

        def wanted(at, low, high):
            other = labels != anchors.labels[at]
            hit = np.zeros(len(other), bool)
            for (least, most), found in zip(windows[at], mine[at]):
                hit |= (high >= max(least, found.least)) & (low <= most)
            return other & hit

        for at, rows, scores in walk(anchors, vectors, wanted):
            other = labels[rows] != anchors.labels[at]
            rows, scores = rows[other], scores[other]
            for (least, most), found in zip(windows[at], mine[at]):
                inside = (scores >= least) & (scores <= most)
                found.add(scores[inside], ids[rows[inside]])
    for size, anchors in groups.items():
        of = [(a, *p, b) for a, found in zip(anchors.ids.tolist(), best[size]) for p, b in zip(positives.get(a, []), found)]
        if of:
            keys = np.array([x[:3] for x in of], np.int64).T
            yield listed(dict(zip(("anchor_id", "positive_id", "positive_score"), keys)), "vec_id", [x[3] for x in of])
    give_back()


def mine(vectors: DataFrame, anchors: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         shares: tuple[int, int] = SHARES, scale: int = SCALE, vec: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row that `anchors` holds for
    and each of its positives, the best rows of the same `label`, the best rows of other labels whose score lies
    between `shares` hundredths of the positive's. Ties go to the smaller id; fewer rows where there are fewer.

    Scores are integer inner products of components floor(scale * x). Rows without id or label, null vectors and
    those with a null or non-finite component take no part, nor do those of a norm of MAX_NORM or more. An id
    is one vector: of rows that repeat it the smallest, by components and then label, counts. Vectors are
    compared with those of as many components only. A positive of negative score has no negatives.
    """
    spark = vectors.sparkSession
    prepare(spark)
    named = vectors.select(F.col(f"`{vec}`").cast("long").alias("vec_id"), quantised(F.col(f"`{embedding}`"), scale).alias("v"),
                           label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    named = named.where("vec_id is not null and label is not null and v is not null").where(
        F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) < float(MAX_NORM) ** 2)
    one = named.groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("row"), F.max("anchor").alias("anchor"))
    rows = written(one.select("vec_id", "row.label", "row.v", "anchor"), "vectors")
    asking = rows.where("anchor")
    passes = max(1, ceil(asking.count() / PASS))
    pairs, path = rows.select("vec_id", "label", "v"), scratch_path(spark, "negatives")
    for number in range(passes):
        block = asking.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number).select("vec_id", "label", "v").toArrow().combine_chunks()
        _pass(pairs, block, positives, negatives, shares).write.mode("append").parquet(path)
    found = spark.read.schema("anchor_id long, positive_id long, positive_score long, vec_id long, score long").parquet(path)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def _pass(pairs: DataFrame, block: pa.Table, positives: int, negatives: int, shares: tuple[int, int]) -> DataFrame:
    """What the tasks find for the anchors of one pass."""
    context = pairs.sparkSession.sparkContext
    sizes = np.array([len(v) for v in block["v"]], np.int64)
    ids, labels, lists = block["vec_id"].to_numpy(), block["label"].to_numpy(), block["v"].to_pylist()
    groups = {}
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        groups[size] = Anchors(ids[at], labels[at], np.array([lists[i] for i in at], np.int64).reshape(len(at), size))
    sent = context.broadcast((groups, {size: a.least_positive(positives) for size, a in groups.items()}))
    near = pairs.mapInArrow(lambda batches: find_positives(batches, *sent.value, positives), "anchor_id long, vec_id long, score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen: dict[int, list[tuple[int, int]]] = {}
    for r in near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives).toLocalIterator():
        chosen.setdefault(r.anchor_id, []).append((r.vec_id, r.score))
    windows = context.broadcast(chosen)
    return pairs.mapInArrow(lambda batches: find_negatives(batches, sent.value[0], windows.value, shares, negatives),
                            "anchor_id long, positive_id long, positive_score long, vec_id long, score long")
