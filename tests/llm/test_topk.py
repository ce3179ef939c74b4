"""Top-k search against sorting all scores."""

import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from nestline.llm import queries, topk
from tests.conftest import SF
from tools.check_oracle import rows as as_text


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.QUERIES["op1_exact_topk"](spark, sf).toPandas()
    assert as_text(got) == as_text(db.execute(queries.ORACLE["op1_exact_topk"]).df())


def brute(vectors, k, asks):
    out = []
    for q, v in vectors.items():
        if asks(q):
            scores = [(-sum(int(a) * int(b) for a, b in zip(v, w)), c) for c, w in vectors.items() if c != q and len(w) == len(v)]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def search(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank string, score string, v string").repartition(4)
    return sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 3 == 0, k).collect())


def with_extra(vectors):
    return [(i, v, 0, "x", "y", "z") for i, v in vectors]


def test_ties_clusters_and_large_values(spark):
    chosen = random.Random(8)
    for scale in (0.02, 1, 40, 1e6):
        vectors = {i: [chosen.choice([-1.0, 0.0, 0.5, 1.0]) * scale for _ in range(3)] for i in range(120)}
        vectors |= {i: [float(scale)] * 3 for i in range(200, 260)}  # more ties than are wanted
        whole = {i: [int(np.floor(64 * float(np.float32(x)))) for x in v] for i, v in vectors.items()}
        assert search(spark, with_extra(vectors.items())) == brute(whole, 5, lambda q: q % 3 == 0)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (6, [0.0, 1.0]), (6, [0.0, 1.0]), (7, [2.0, 2.0]), (9, [1.0]), (10, [3.0]), (12, []), (13, [])]
    want = brute({0: [64, 128], 6: [0, 64], 7: [128, 128], 9: [64], 10: [192], 12: [], 13: []}, 5, lambda q: q % 3 == 0)
    assert search(spark, with_extra(rows)) == want
    assert search(spark, with_extra([])) == []


def test_passes_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "PASS", 7)
    vectors = {i: [float(i % 11), float(i % 5)] for i in range(90)}
    whole = {i: [int(64 * x) for x in v] for i, v in vectors.items()}
    assert search(spark, with_extra(vectors.items())) == brute(whole, 5, lambda q: q % 3 == 0)
