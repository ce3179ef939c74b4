"""The network: gradients, independence of slicing, held-out accuracy; the query's columns."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from nestline.llm import quality, queries
from nestline.llm.buffers import column_bytes
from tests.llm.helpers import documents


def test_gradients_equal_differences():
    draw = np.random.default_rng(0)
    net = quality.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rows = draw.integers(32, 120, (6, 2 * quality.SEGMENT + quality.WIDTH)).astype(np.uint8)
    lengths, labels, weights = np.array([100, 512, 700, 1024, 1024, 3]), np.array([0., 1, 1, 0, 1, 0]), np.ones(6)

    def loss():
        parts = np.concatenate((rows[:, :quality.SEGMENT + quality.WIDTH], rows[:, quality.SEGMENT:]))
        best = (net.windows(parts).reshape(-1, quality.WIDTH * quality.DIM) @ net.p["filters"]).reshape(12, -1, quality.FILTERS).max(1)
        top = np.where((lengths > quality.SEGMENT)[:, None], np.maximum(best[:6], best[6:]), best[:6]) + net.p["lift"]
        z = net.chunk_logits(top, lengths)[0]
        return float(np.mean(np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels)))

    grads = net._gradients(rows, lengths, labels, weights)
    for name in ("out", "bias", "layer", "shift", "lift", "filters", "bytes"):
        flat = net.p[name].reshape(-1)
        for at in np.argsort(-np.abs(grads[name].reshape(-1)))[:4]:
            old = flat[at]
            flat[at] = old + 1e-3
            up = loss()
            flat[at] = old - 1e-3
            down = loss()
            flat[at] = old
            assert np.isclose((up - down) / 2e-3, grads[name].reshape(-1)[at], rtol=0.1, atol=2e-4), name


def test_scores_cover_whole_texts_and_not_their_neighbours():
    net = quality.Network()
    texts = ["", "a", "b" * 511, "c" * 512, "d" * 513, "word " * 900, "x" * 200_000 + "!!!! ????" * 60, "é" * 4000]
    alone = [net.scores(*column_bytes(pa.array([t])))[0] for t in texts]
    assert np.allclose(net.scores(*column_bytes(pa.array(texts))), alone)
    changed = net.scores(*column_bytes(pa.array([texts[5][:-600] + "#" * 600])))[0]
    assert changed != alone[5] and all(0 < s < 1 for s in alone)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES["op6_quality_classifier"](spark, sf).collect()}
    assert len(rows) == queries.table(spark, sf, "documents").count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    marks = [(rows[x.doc_id].score, x.quality) for x in queries.table(spark, sf, "labels").collect() if rows[x.doc_id].held_out]
    good, bad = [s for s, q in marks if q], [s for s, q in marks if not q]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean(np.array(good) >= 0.3) > 0.98


def test_odd_rows(spark):
    rows = [(i if i % 4 else None, t) for i, t in enumerate(["plain words here"] * 20 + ["!! ## !!"] * 20 + [None, "", "z" * 300_000])]
    docs = documents(spark, rows, extra=("label", "score", "judged", "cuts"))
    labels = spark.createDataFrame([(i, int(i < 20), 0) for i in range(40)] + [(1, None, 0), (None, 1, 0), (2, 7, 0), (3, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    net = quality.fit(docs, labels, F.lit(True))
    assert quality.score(docs, net, ["doc_id"], "judged").count() == len(rows)
    kept = quality.keep_good(docs, net)
    assert kept.columns == docs.columns and kept.where("text = 'plain words here'").count() == 20
    assert quality.keep_good(docs.limit(0), net).count() == 0
    untrained = quality.fit(docs, labels.limit(0), F.lit(True))
    assert quality.score(docs, untrained, ["doc_id"], "judged").count() == len(rows)
