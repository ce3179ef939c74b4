"""Ranked search against scoring every document; classes, ties, blocks, odd rows; SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from nestline.llm import queries, ranking
from tests.conftest import SF
from tests.llm.helpers import documents
from tools.check_oracle import rows as as_text


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    got = queries.QUERIES["op12_ranked_search"](spark, sf).toPandas()
    assert as_text(got) == as_text(db.execute(queries.ORACLE["op12_ranked_search"]).df())


def terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_words = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for i, bag, n in bags:
            m = 25 + 75 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in terms(text) if bag[t])
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def search(spark, docs, items, k=4, **more):
    table = documents(spark, docs, extra=["n", "bag", "body", "hash", "rank", "score"])
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    return sorted((tuple(r) for r in ranking.search(table, benchmark, k, **more).collect()), key=str)


def made(seed, n):
    chosen = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "ÄB", "x1", "eta", "und", "no", "日本"]
    texts = [" ".join(chosen.choices(words, k=chosen.choice([1, 2, 3, 9]))) for _ in range(n // 3)]
    return [(i, chosen.choice(texts)) for i in range(n)], [(f"q{j}", " ".join(chosen.choices(words, k=3)) + " nowhere") for j in range(9)]


@pytest.mark.parametrize("seed", [1, 2])
def test_copies_and_ties(spark, seed):
    docs, items = made(seed, 150)
    docs += [(1000 + i, "alpha beta") for i in range(40)] + [(5, "alpha, BETA")]  # equal bags in other words
    assert search(spark, docs, items) == brute(docs, items, 4)


def test_blocks_of_items(spark):
    docs, items = made(3, 90)
    assert search(spark, docs, items, block_chars=40) == brute(docs, items, 4)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,! "), (None, "alpha beta"), (4, "alpha"), (4, "alpha"), (5, "beta " * 30_000 + "alpha"), (6, "gamma")]
    items = [("a", "alpha Alpha beta"), ("a", "alpha Alpha beta"), ("b", None), ("c", ""), (None, "gamma"), ("d", "nowhere"), ("e", "gamma")]
    assert search(spark, docs, items) == brute(docs, items, 4)
    assert search(spark, [], items) == [] and search(spark, docs, []) == []


def test_small_parts_and_large_scores(spark, monkeypatch):
    docs, items = made(4, 200)
    monkeypatch.setattr(ranking, "AT_A_TIME", 30)
    assert search(spark, docs, items) == brute(docs, items, 4)
    rows = [("a", "one two two"), ("b", "two")]
    held = ranking.Items(rows)
    bag = (np.array([0, 0]), np.array([0, 1]), np.array([3, 1]), np.array([30]))
    weights = np.array([7, 9])
    small = held.scores(weights, 1, *bag)
    monkeypatch.setattr(ranking, "EXACT", 0)
    assert (held.scores(weights, 1, *bag) == small).all()
