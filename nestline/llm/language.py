"""Languages by nearest centroid.

A text is the TF-IDF vector of its hashed letter trigrams, of length 1. Each language has several
centroids, found by clustering; the language of the nearest one by cosine is predicted. A text that is
farther from its centroid than the texts that made it is marked as rejected.

Document frequencies count all learnable texts; the centroids come from at most about `SAMPLE` texts
of each language, chosen by the hash of their ids.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from nestline.llm.buffers import FOLD, prepare, slices, with_results

SLOTS, SAMPLE, CLUSTERS, TURNS = 4096, 400, 4, 12
#: Sharpness of the softmax over the languages' cosines, and how much farther than its centroid's
#: outermost learned text a text may be.
SHARPNESS, SLACK = 20.0, 0.1
IS_LETTER = np.zeros(256, bool)
IS_LETTER[ord("a"):ord("z") + 1] = IS_LETTER[128:] = True
COUNTS = StructType([StructField("slots", ArrayType(IntegerType())), StructField("counts", ArrayType(IntegerType()))])
VERDICT = StructType([StructField("lang", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())])


def trigram_rows(offsets: np.ndarray, data: np.ndarray):
    """For each text the slots of its trigrams, with how often each occurs. Bytes that belong to no letter
    count as one blank each; a trigram has at least one letter."""
    folded = FOLD[data]
    letters = IS_LETTER[folded]
    folded = np.where(letters, folded, 32).astype(np.uint32)
    padded = np.append(folded, (32, 32)).astype(np.uint32)
    there = np.append(letters, (False, False))
    key = (padded[:-2] << 16 | padded[1:-1] << 8 | padded[2:]) * np.uint32(2654435761)
    slots = (key >> np.uint32(32 - 12)).astype(np.int64)
    some = there[:-2] | there[1:-1] | there[2:]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        inner = max(a, b - 2)
        counts = np.bincount(slots[a:inner][some[a:inner]], minlength=SLOTS)
        at = np.flatnonzero(counts)
        yield at, counts[at]


def vector(slots: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = (1 + np.log(counts)) * weights[slots]
    length = np.sqrt((out * out).sum())
    return out / length if length else out


def count_slots(texts: pa.Array) -> list[pa.Array]:
    found = [row for _, _, offsets, data in slices(texts) for row in trigram_rows(offsets, data)]
    return [pa.array([row[k] for row in found], pa.list_(pa.int32())) for k in (0, 1)]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each slot occurs, and the number of texts; tasks send a row for each slot at most."""
    def run(batches):
        seen, rows = np.zeros(SLOTS + 1, np.int64), 0
        for batch in batches:
            for _, _, offsets, data in slices(batch.column(0)):
                for at, _ in trigram_rows(offsets, data):
                    seen[at] += 1
                    rows += 1
        seen[SLOTS] = rows
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["slot", "n"])

    prepare(texts.sparkSession)
    seen = np.zeros(SLOTS + 1, np.int64)
    for row in texts.mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        seen[row.slot] = row.n
    return seen[:SLOTS], int(seen[SLOTS])


def cluster(rows: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids of length 1 and the cosine of the outermost member of each."""
    draw = np.random.default_rng(seed)
    centres = [rows[draw.integers(len(rows))]]
    while len(centres) < min(CLUSTERS, len(rows)):  # the row farthest from all centres so far
        centres.append(rows[(rows @ np.array(centres).T).max(axis=1).argmin()])
    centres = np.array(centres)
    for _ in range(TURNS):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.array([rows[own == k].sum(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    near = rows @ centres.T
    own = near.argmax(axis=1)
    return centres, np.array([np.quantile(near[own == k, k], 0.02) if (own == k).any() else 0.0 for k in range(len(centres))])


class Centroids:
    """weights of the slots; centroids with their languages and the cosine down to which they accept."""

    def __init__(self, weights: np.ndarray, langs: list[str], rows: np.ndarray, edges: np.ndarray):
        self.weights, self.langs, self.rows, self.edges = weights, np.array(langs, object), rows.astype(np.float32), edges
        self.names = sorted(set(langs))
        self.of = np.array([self.names.index(x) for x in langs], np.int64)

    def predict(self, texts: pa.Array) -> list[pa.Array]:
        """Fields of VERDICT. A text without letters, or any if nothing was learned, is `und` with score 0."""
        lang, score, rejected = [], [], []
        for _, _, offsets, data in slices(texts):
            for k, (at, counts) in enumerate(trigram_rows(offsets, data)):
                if not len(self.names) or not has_letter(data[offsets[k]:offsets[k + 1]]):
                    lang.append("und"), score.append(0.0), rejected.append(True)
                    continue
                near = self.rows[:, at] @ vector(at, counts, self.weights).astype(np.float32) if len(at) else np.zeros(len(self.rows))
                best = np.full(len(self.names), -1.0)
                np.maximum.at(best, self.of, near)
                chances = np.exp(SHARPNESS * (best - best.max()))
                first = int(best.argmax())
                nearest = int(np.where(self.of == first, near, -2).argmax())
                lang.append(self.names[first])
                score.append(float(chances[first] / chances.sum()))
                rejected.append(bool(near[nearest] < self.edges[nearest] - SLACK))
        return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]


def has_letter(data: np.ndarray) -> bool:
    folded = FOLD[data]
    if ((folded >= ord("a")) & (folded <= ord("z"))).any():
        return True
    return (data >= 128).any() and any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", doc: str = "doc_id", sample: int = SAMPLE) -> Centroids:
    """Weights and centroids from the rows that have text and language and that `learn` holds for; nothing but
    text and language is learned from."""
    known = docs.where(learn).select(F.col(f"`{doc}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
                                     F.col(f"`{lang}`").cast("string").alias("lang")).where("text is not null and lang is not null")
    seen, rows = document_frequencies(known.select("text"))
    weights = np.log((1 + rows) / (1 + seen)) + 0.1
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return Centroids(weights, [], np.zeros((0, SLOTS)), np.zeros(0))
    # about `sample` texts of each language, by a hash of the id
    every = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, max(1, ceil(n / sample)))])
    chosen = known.where(F.pmod(F.xxhash64("doc_id", "text"), every[F.col("lang")]) == 0)
    got = with_results(chosen, "text", ["lang"], "found", COUNTS, lambda: count_slots).select("lang", "found.*").collect()
    langs, centres, edges = [], [], []
    for name in sorted(sizes):
        matrix = []
        for r in sorted((r for r in got if r.lang == name), key=lambda r: (r.slots, r.counts)):
            row = np.zeros(SLOTS)
            row[r.slots] = vector(np.array(r.slots, np.int64), np.array(r.counts, float), weights)
            matrix.append(row)
        if matrix:
            found, edge = cluster(np.array(matrix), 3)
            langs += [name] * len(found)
            centres.append(found)
            edges.append(edge)
    return Centroids(weights, langs, np.concatenate(centres) if centres else np.zeros((0, SLOTS)),
                     np.concatenate(edges) if edges else np.zeros(0))


def predict(docs: DataFrame, model: Centroids, keep: list[str], result: str, text: str = "text") -> DataFrame:
    """The columns `keep` of docs and a struct `result` of lang, score (0 to 1) and rejected, for each whole text;
    null or without letters: `und`, 0, true."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return with_results(docs, text, keep, result, VERDICT, lambda: sent.value.predict)
