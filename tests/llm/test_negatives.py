"""Hard negatives against scoring all pairs; bounds; ties, passes, odd rows; SQL."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from nestline.llm import negatives, queries
from tests.conftest import SF
from tools.check_oracle import rows as as_text


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.QUERIES["op13_hard_negatives"](spark, sf).toPandas()
    assert as_text(got) == as_text(db.execute(queries.ORACLE["op13_hard_negatives"]).df())


def brute(rows, anchors=lambda i: i % 4 == 0, positives=3, k=3):
    out = []
    for a, (label, v) in rows.items():
        if anchors(a):
            scores = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, (_, w) in rows.items() if i != a and len(w) == len(v))
            for s, p in [x for x in scores if rows[x[1]][0] == label][:positives]:
                fits = [(n, i) for n, i in scores if rows[i][0] != label and 80 * -s <= 100 * -n <= 100 * -s]
                out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(fits[:k])]
    return sorted(out)


def mine(spark, rows, partitions=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(partitions)
    df = df.withColumns({name: F.lit("clash") for name in ("v", "anchor", "row", "rank", "score")})
    return sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % 4 == 0, F.col("label"), 3, 3).collect())


def clustered(seed, n, scale=1.0, labels=3):
    chosen = random.Random(seed)
    centres = [[chosen.uniform(-1, 1) * scale for _ in range(6)] for _ in range(4)]
    return [(i, [float(np.float32(x + chosen.uniform(-0.2, 0.2) * scale)) for x in chosen.choice(centres)], chosen.randrange(labels)) for i in range(n)]


def whole(rows):
    return {i: (label, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, label in rows}


@pytest.mark.parametrize("scale", [0.01, 1.0, 3000.0, 1e6])
def test_all_pairs(spark, scale):
    rows = clustered(5, 160, scale)
    assert mine(spark, rows) == brute(whole(rows))


def test_ties_and_copies(spark):
    rows = [(i, [0.5, 0.5 if i % 3 else 0.25], i % 2) for i in range(120)]
    assert mine(spark, rows) == brute(whole(rows))


def test_passes(spark, monkeypatch):
    monkeypatch.setattr(negatives, "PASS", 6)
    rows = clustered(6, 100)
    assert mine(spark, rows) == brute(whole(rows))


def test_odd_rows(spark):
    fine = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.9], 0), (4, [0.0, 0.0], 1), (8, [3.0], 1), (9, [2.9], 2), (10, [3.0], 1), (12, [-1.0, -2.0], 5),
            (16, [], 1), (17, [], 1), (20, [], 0)]
    odd = [(5, None, 1), (6, [1.0, None], 1), (24, [float("nan"), 1.0], 1), (7, [float("-inf"), 1.0], 0), (None, [1.0, 1.0], 0), (28, [1.0, 1.0], None),
           (1, [1.0, 2.0], 1), (2, [1.0, 1.9], 3)]
    assert mine(spark, fine + odd) == brute(whole(fine))
    assert mine(spark, []) == []
    assert mine(spark, [(0, [1.0], 1), (4, [1.0], 2)]) == []


def test_bounds_hold_and_spare_work():
    rows = clustered(7, 400, 2.0)
    matrix = np.array([whole(rows)[i][1] for i in range(400)], np.int64)
    anchors = negatives.Anchors(np.arange(60), np.zeros(60, np.int64), matrix[:60])
    assert sorted(anchors.order) == list(range(60)) and (anchors.parent >= 0).sum() == 59
    scored = 0

    def near(at, low, high):
        true = matrix @ matrix[at]
        assert (low <= true).all() and (true <= high).all()
        return high >= np.sort(true)[-20]

    for at, found, scores in negatives.walk(anchors, matrix, near):
        assert (scores == matrix[found] @ matrix[at]).all()
        assert set(np.flatnonzero(matrix @ matrix[at] >= np.sort(matrix @ matrix[at])[-20])) <= set(found.tolist())
        scored += len(found)
    assert scored < 0.8 * 60 * 400
