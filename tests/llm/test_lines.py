"""Repeated lines against SQL and a plain count."""

import random

import duckdb
import numpy as np
import pytest

from nestline.llm import bloom, lines, queries
from tests.conftest import SF
from tests.llm.helpers import documents
from tools.check_oracle import rows as as_text

BLANKS = " \t\n\x0b\x0c\r"


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.QUERIES["op8_line_dedup"](spark, sf).toPandas()
    assert as_text(got) == as_text(db.execute(queries.ORACLE["op8_line_dedup"]).df())


def brute(rows):
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(BLANKS))
    held: dict = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 40:
                held.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if doc is None or len(held.get(key(x), ())) < 5 or doc == max(held[key(x)])]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("most, bucket", [(bloom.MAX_BITS, bloom.BUCKET), (8, 25), (8, 1 << 20)])
def test_odd_lines(spark, monkeypatch, most, bucket):
    monkeypatch.setattr(bloom, "MAX_BITS", most)  # a filter of 8 bits is too small for any: buckets of hashes
    monkeypatch.setattr(bloom, "BUCKET", bucket)
    chosen = random.Random(6)
    stock = ["A line that many documents REPEAT, number %d of some" % k for k in range(12)]
    stock += ["é" * 40, "ß" * 39, "x" * 40, "x" * 39, " \t" + "Padded line of more than forty characters" + "\r", "", "   ",
              "padded line of more than forty characters", "y" * 50_000, "trailing \x85 mark of a line that is long enough \x85"]
    rows = [(k if k % 13 else None, f"line {k} of its own, which is long enough to be looked at") for k in range(60)]
    rows = [(d, "\n".join([t, *[chosen.choice(stock) for _ in range(chosen.randint(0, 9))]])) for d, t in rows]
    rows += [(7, None), (8, ""), (9, "\n\n"), (20, rows[20][1]), (20, rows[20][1]), (20, stock[0])]
    docs = documents(spark, rows, extra=("key", "keeper", "dropped_keys", "row_hash", "drop_doc", "drop_text", "drop_hash"))
    got = lines.without_repeats(docs, "got").select("doc_id", "got.*").collect()
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(brute(rows), key=order)


def test_empty_table(spark):
    assert lines.without_repeats(documents(spark, [(1, "a")]).limit(0), "got").count() == 0


@pytest.mark.parametrize("most", [bloom.MAX_BITS, 8])
def test_hashes_seen_twice(spark, monkeypatch, most):
    """All that come again are known, in one task or in several, and few others."""
    monkeypatch.setattr(bloom, "MAX_BITS", most)
    monkeypatch.setattr(bloom, "BUCKET", 1000)
    values = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 9000)
    rows = spark.createDataFrame([(int(x),) for x in [*values, *values[:300], *values[:300], *[int(values[500])] * 4000]], "h long")
    packed = bloom.seen_twice(rows.repartition(5), lambda batch: batch.column(0).to_numpy().view(np.uint64), 13_600)
    known = bloom.contains(packed, values.view(np.uint64))
    assert known[:300].all() and known[500] and known.sum() < 700


def test_filters_never_miss(spark):
    values = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 20_000)
    df = spark.createDataFrame([(int(v),) for v in values], "h long").repartition(5)
    may = bloom.of_longs(df, "h", len(values))
    assert df.where(may("h")).count() == len(values)
    others = spark.range(20_000).selectExpr("xxhash64(id) as h")
    assert others.where(may("h")).count() < 2000
