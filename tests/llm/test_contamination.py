"""Benchmark windows against SQL and a plain search of every place."""

import random
import re

import duckdb
import numpy as np
import pytest

from nestline.llm import contamination, queries
from tests.conftest import SF
from tests.llm.helpers import documents
from tools.check_oracle import rows as as_text


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES["op10_benchmark_decontamination"](spark, sf).toPandas()
    assert as_text(got) == as_text(db.execute(queries.ORACLE["op10_benchmark_decontamination"]).df())


def cut(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    words, hit, ids, best = cut(text), set(), set(), []
    for item, body in items:
        other = cut(body)
        size = min(13, len(other))
        for a in range(len(other) - size + 1) if other else ():
            for p in range(len(words) - size + 1):
                if words[p:p + size] == other[a:a + size]:
                    n = size
                    while p + n < len(words) and a + n < len(other) and words[p + n] == other[a + n]:
                        n += 1
                    best.append((-n, p, item is None, str(item)))
                    hit |= set(range(p, p + size))
                    ids |= set() if item is None else {str(item)}
    n, p, nameless, item = min(best, default=(0, None, True, None))
    return len(words), len(hit), sorted(ids), -n or None, p, None if nameless else item


@pytest.fixture(scope="module")
def corpus():
    chosen = random.Random(4)
    word = lambda: chosen.choice("abcdefghij") + chosen.choice("xyz")
    items = [(i, " ".join(word() for _ in range(chosen.choice([1, 2, 5, 12, 13, 14, 40])))) for i in range(12)]
    items += [(3, items[3][1]), (50, items[4][1]), (None, items[5][1]), (51, None), (52, "!!!")]
    texts = []
    for k in range(60):
        parts = [" ".join(word() for _ in range(chosen.randint(0, 60)))]
        for _ in range(chosen.randint(0, 3)):
            whole = cut(chosen.choice(items)[1])
            a = chosen.randint(0, max(0, len(whole) - 1))
            parts += [" ".join(whole[a:a + chosen.randint(1, 45)]).upper(), word()]
        texts.append((k if k % 9 else None, " -- ".join(parts)))
    texts += [(70, None), (71, ""), (72, "..."), (70, texts[1][1]), (70, texts[1][1]), (73, "é" * 100_000)]
    return texts, items


@pytest.mark.parametrize("block_chars", [1 << 20, 200])
def test_every_place(spark, corpus, block_chars):
    texts, items = corpus
    docs = documents(spark, texts, extra=("n_words", "found", "body", "items"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination.matches(docs, bench, ["text"], "got", block_chars=block_chars)
    n_hit, n_items, verdict = contamination.measured("got")
    rows = rows.select("text", "got", n_hit.alias("h"), n_items.alias("i"), verdict.alias("v")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words, hit, ids, *best = brute(r.text, items)
        assert (r.got.n_words, r.h, r.i, r["got"]["items"] or []) == (words, hit, len(ids), ids)
        assert [r.got.longest, r.got.longest_start, r.got.longest_item] == best and r.v == (hit > 0 and 20 * hit >= words)
    left = contamination.remove(docs, bench)
    assert left.columns == docs.columns and left.count() == sum(not r.v for r in rows)


def test_items_that_share_a_window_and_go_on_differently(spark):
    shared = " ".join(f"s{k}" for k in range(20))
    items = [(i, f"{shared} {' '.join(f'{x}{k}' for k in range(9))}") for i, x in enumerate("abcde")] + [(7, shared), (9, f"q q {shared} b0")]
    texts = [(1, f"x {shared} c0 c1 c2 c9"), (2, f"{shared} y"), (3, f"{shared} b0 b9 and {shared} d0 d1 d2"), (4, f"{shared} e0 e1"), (5, shared)]
    rows = contamination.matches(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string"), ["text"], "got").collect()
    for r in rows:
        assert [r.got.longest, r.got.longest_start, r.got.longest_item] == list(brute(r.text, items)[3:])


def test_suffix_ranks():
    chosen = random.Random(8)
    lengths = [chosen.choice([1, 3, 8, 30]) for _ in range(40)]
    text = np.array([chosen.choice([3, 5, 9]) for _ in range(sum(lengths))], np.uint64)
    end = np.repeat(np.cumsum(lengths), lengths)
    rank = contamination.suffix_ranks(text, end)
    suffixes = [text[k:end[k]].tolist() for k in range(len(text))]
    order = sorted({tuple(x) for x in suffixes})
    assert rank.tolist() == [order.index(tuple(x)) for x in suffixes]


def test_one_word_many_times(spark):
    """All windows are one, and an item's suffixes differ in length only."""
    items = [(1, "no " * 600), (2, "no " * 30 + "yes"), (3, "no")]
    texts = [(1, "no " * 50), (2, "well " + "no " * 30 + "yes"), (3, "no " * 700)]
    rows = contamination.matches(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"], "got").collect()
    assert {r.doc_id: (r.got.longest, r.got.longest_start, r.got.longest_item) for r in rows} == {1: (50, 0, "1"), 2: (31, 1, "2"), 3: (600, 0, "1")}


def test_empty_tables(spark, corpus):
    texts, items = corpus
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    assert contamination.remove(docs.limit(0), bench).count() == 0
    assert contamination.remove(docs, bench.limit(0)).count() == len(texts)
