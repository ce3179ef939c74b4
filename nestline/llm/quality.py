"""Quality of texts by a byte-level convolutional network in numpy.

Bytes have learned vectors; learned filters run over every second place of the whole text. A text is
laid into segments of `SEGMENT` bytes, two neighbours make a chunk, so chunks overlap by half. Of each
filter the largest value in a chunk is kept, a small layer turns a chunk's values and length into a
logit, and the mean of a text's logits gives its probability of label 1.

The network is trained on a bounded sample: `TRAIN_ROWS` labelled rows, `TRAIN_CHUNKS` chunks of each.
Scoring reads every byte, segment by segment, so memory is bounded for texts of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from nestline.llm.buffers import free_name, slices, with_results

SEGMENT, STRIDE, WIDTH, DIM, FILTERS, HIDDEN = 512, 2, 8, 8, 32, 16
TRAIN_ROWS, TRAIN_CHUNKS, STEPS, BATCH, RATE = 2000, 2, 800, 64, 0.004
#: A text is kept from this probability on.
KEEP_FROM = 0.3
#: Segments whose filters are computed at a time.
AT_ONCE = 256
SCORE = StructType([StructField("score", DoubleType())])


def segmented(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of SEGMENT bytes and the WIDTH bytes that follow them, the first segment of each text, and the
    bytes that each holds. Ends are filled with 0; an empty text is one segment."""
    lengths = np.diff(offsets)
    own = np.maximum(1, -(-lengths // SEGMENT))
    first = np.concatenate(([0], np.cumsum(own)))
    flat = np.zeros((first[-1] + 1) * SEGMENT, np.uint8)
    inside = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    flat[np.repeat(first[:-1] * SEGMENT, lengths) + inside] = data
    blocks = flat.reshape(-1, SEGMENT)
    follow = blocks[1:, :WIDTH].copy()
    follow[first[1:] - 1] = 0
    held = np.full(first[-1], SEGMENT)
    held[first[1:] - 1] = lengths - (own - 1) * SEGMENT
    return np.hstack((blocks[:-1], follow)), first, held


class Network:
    def __init__(self, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.p = {
            "bytes": draw.normal(0, 0.5, (256, DIM)), "filters": draw.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)),
            "lift": np.zeros(FILTERS), "layer": draw.normal(0, FILTERS ** -0.5, (FILTERS + 1, HIDDEN)), "shift": np.zeros(HIDDEN),
            "out": draw.normal(0, HIDDEN ** -0.5, HIDDEN), "bias": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def windows(self, segments: np.ndarray) -> np.ndarray:
        """The vectors of the WIDTH bytes from every STRIDE-th place of each segment."""
        vectors = self.p["bytes"][segments].reshape(len(segments), -1)
        step = vectors.itemsize
        return np.lib.stride_tricks.as_strided(vectors, (len(segments), SEGMENT // STRIDE, WIDTH * DIM),
                                               (vectors.strides[0], STRIDE * DIM * step, step))

    def pooled(self, segments: np.ndarray) -> np.ndarray:
        """The largest value of each filter in each segment."""
        out = np.empty((len(segments), FILTERS), np.float32)
        for a in range(0, len(segments), AT_ONCE):
            view = self.windows(segments[a:a + AT_ONCE])
            values = view.reshape(-1, WIDTH * DIM) @ self.p["filters"]
            out[a:a + AT_ONCE] = values.reshape(len(view), -1, FILTERS).max(axis=1)
        return out + self.p["lift"]

    def chunk_logits(self, pooled: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, ...]:
        inputs = np.hstack((np.maximum(pooled, 0), np.log1p(held)[:, None] / 7)).astype(np.float32)
        hidden = np.maximum(inputs @ self.p["layer"] + self.p["shift"], 0)
        return hidden @ self.p["out"] + self.p["bias"], hidden, inputs

    def scores(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The probability of each text."""
        segments, first, held = segmented(offsets, data)
        pooled = self.pooled(segments)
        # a chunk is a segment and the next of the same text; the last segment has a chunk of its own
        # only if it is the text's only one
        size = np.diff(first)
        alone, last = size == 1, first[1:] - 1
        after = np.minimum(np.arange(len(pooled)) + 1, len(pooled) - 1)
        both, bytes_in = np.maximum(pooled, pooled[after]), held + held[after]
        both[last], bytes_in[last] = pooled[last], held[last]
        logits = self.chunk_logits(both, bytes_in)[0].astype(float)
        logits[last[~alone]] = 0
        mean = np.add.reduceat(logits, first[:-1]) / np.maximum(size - 1, 1)
        return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))

    def train(self, chunks: list[bytes], labels: np.ndarray, seed: int = 5) -> None:
        """Adam on the logistic loss of chunks of up to two segments."""
        draw = np.random.default_rng(seed)
        lengths = np.array([min(len(c), 2 * SEGMENT) for c in chunks])
        rows = np.zeros((len(chunks), 2 * SEGMENT + WIDTH), np.uint8)
        for k, c in enumerate(chunks):
            c = c[:2 * SEGMENT + (WIDTH if len(c) > 2 * SEGMENT else 0)]
            rows[k, :len(c)] = np.frombuffer(c[:rows.shape[1]], np.uint8)
        # the rarer label weighs more, by the root of how much rarer it is
        share = labels.mean()
        weights = np.where(labels > 0, 1, np.sqrt(share / max(1 - share, 1e-3)) if share else 1).astype(np.float32)
        weights /= weights.mean()
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            at = draw.integers(0, len(chunks), BATCH)
            rate = RATE * (1 - step / (STEPS + 1))
            for k, g in self._gradients(rows[at], lengths[at], labels[at], weights[at]).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                self.p[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def _gradients(self, rows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict:
        n = len(rows)
        parts = np.concatenate((rows[:, :SEGMENT + WIDTH], rows[:, SEGMENT:]))
        view = self.windows(parts)
        values = (view.reshape(-1, WIDTH * DIM) @ self.p["filters"]).reshape(len(parts), -1, FILTERS)
        where = values.argmax(axis=1)
        best = np.take_along_axis(values, where[:, None], axis=1)[:, 0]
        two = lengths > SEGMENT
        second = two[:, None] & (best[n:] > best[:n])
        top = np.where(second, best[n:], best[:n]) + self.p["lift"]
        logit, hidden, inputs = self.chunk_logits(top, lengths)
        d_logit = ((1 / (1 + np.exp(-logit)) - labels) * weights / n).astype(np.float32)
        d_hidden = d_logit[:, None] * self.p["out"] * (hidden > 0)
        d_top = (d_hidden @ self.p["layer"][:FILTERS].T) * (top > 0)
        part = np.arange(n)[:, None] + n * second
        place = np.where(second, where[n:], where[:n])
        used = view[part, place]  # n x FILTERS x (WIDTH * DIM)
        grads = {"out": hidden.T @ d_logit, "bias": d_logit.sum(keepdims=True), "layer": inputs.T @ d_hidden, "shift": d_hidden.sum(0),
                 "lift": d_top.sum(0), "filters": np.einsum("nfk,nf->kf", used, d_top)}
        d_used = (d_top[:, :, None] * self.p["filters"].T[None]).reshape(n, FILTERS, WIDTH, DIM)
        seen = parts[part[:, :, None], place[:, :, None] * STRIDE + np.arange(WIDTH)]
        grads["bytes"] = np.zeros_like(self.p["bytes"])
        np.add.at(grads["bytes"], seen.ravel(), d_used.reshape(-1, DIM))
        return {k: g.astype(np.float32) for k, g in grads.items()}


def held_out(doc: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves `fold` when divided by `folds`; true without an id."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % folds == fold, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", doc: str = "doc_id", label: str = "quality",
        rows: int = TRAIN_ROWS) -> Network:
    """A network trained on `rows` labelled documents that `learn` holds for, those of the smallest hashes of
    their ids. Only texts and labels are learned from. Without labelled rows it gives the same score to all."""
    known = (labels.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
             .where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")))
    chosen = known.where(learn).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    body = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    # the sample is bounded by `rows`
    found = body.join(F.broadcast(chosen), "doc_id").where("text is not null")
    size, span = F.length("text"), 2 * SEGMENT + WIDTH
    cuts = [F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(size - span, F.lit(1))) + 1).cast("int"), F.lit(span))
            for k in range(TRAIN_CHUNKS)]
    got = found.select("doc_id", "label", F.array(*cuts).alias("cuts")).orderBy("doc_id", "label").collect()
    network = Network()
    chunks = [c.encode() for r in got for c in r.cuts]
    if chunks:
        network.train(chunks, np.repeat([r.label for r in got], TRAIN_CHUNKS).astype(np.float32))
    return network


def score(docs: DataFrame, network: Network, keep: list[str], result: str, text: str = "text") -> DataFrame:
    """The columns `keep` of docs and `result`, a struct with the score of each whole text, null as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(network.p)

    def start():
        net = Network()
        net.p = sent.value

        def run(texts):
            out = [net.scores(offsets, data) for _, _, offsets, data in slices(texts, 1 << 20)]
            return [pa.array(np.concatenate(out) if out else np.empty(0))]
        return run

    return with_results(docs, text, keep, result, SCORE, start)


def keep_good(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """docs without the rows whose texts score below KEEP_FROM."""
    mark = free_name(docs, "judged")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return score(docs, network, docs.columns, mark, text).where(F.col(mark)["score"] >= KEEP_FROM).select(*columns)
