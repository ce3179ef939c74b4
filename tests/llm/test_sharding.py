"""The hash tree: balance, growth, confined moves; slots; odd rows; SQL."""

import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from nestline.llm import queries, sharding
from tests.conftest import SF
from tests.llm.helpers import documents
from tools.check_oracle import rows as as_text

TREE = {"a": {"x": {0: 1.0, 1: 3.0}, "y": {2: 2.0}}, "b": {"x": {3: 1.0}, "z": {4: 1.0, 5: 0.0}}}


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.QUERIES["op11_hash_tree_sharding"](spark, sf).toPandas()
    assert as_text(got) == as_text(db.execute(queries.ORACLE["op11_hash_tree_sharding"]).df())


def test_rows_follow_weights(spark):
    n = 20_000
    keys = spark.range(n).withColumnRenamed("id", "doc_id")
    found = {r.shard: r["count"] for r in sharding.placed(keys, TREE).groupBy("shard").count().collect()}
    assert set(found) == {0, 1, 2, 3, 4}
    for shard, weight in ((0, 1), (1, 3), (2, 2), (3, 1), (4, 1)):
        assert abs(found[shard] - n * weight / 8) < 5 * (n * weight / 8) ** 0.5


def test_a_new_shard_takes_rows_into_itself_only(spark):
    keys = spark.range(6000).withColumnRenamed("id", "doc_id")
    for count in (16, 17, 18):
        found = sharding.moved(keys, sharding.layout(count), sharding.layout(count + 1)).collect()
        gone = [r for r in found if r.path_before != r.path_after]
        assert {r.path_after.split("/")[-1] for r in gone} == {str(count)}
        assert abs(sum(r.n for r in gone) - 6000 / (count + 1)) < 5 * (6000 / count) ** 0.5


@pytest.mark.parametrize("weight, into", [(6.0, True), (1.0, False), (0.0, False)])
def test_moves_stay_in_the_changed_subtrees(spark, weight, into):
    keys = spark.range(8000).withColumnRenamed("id", "doc_id")
    after = {"a": {"x": {0: 1.0, 1: weight}, "y": {2: 2.0}}, "b": TREE["b"]}
    for r in sharding.moved(keys, TREE, after).where("path_before <> path_after").collect():
        # heavier: rows come into /a, /a/x or shard 1; lighter: they leave these
        old, new = r.path_before.split("/"), r.path_after.split("/")
        level = next(k for k in (1, 2, 3) if old[k] != new[k])
        assert (new if into else old)[level] == ("", "a", "x", "1")[level]


def test_odd_rows(spark):
    texts = [(1, "ä\nb"), (1, "ä\nb"), (2, None), (2, ""), (None, "x"), (None, None), (3, "long " * 50_000)]
    docs = documents(spark, texts, extra=["shard", "slot", "size", "part", "place"])
    got = sharding.assign(docs, sharding.layout(3), sharding.layout(4)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    shard_of = {}
    for r in got:
        assert shard_of.setdefault(r.doc_id, r.shard) == r.shard and r.law == "key"
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert sharding.assign(documents(spark, []), sharding.layout(3), sharding.layout(4)).collect() == []
    one = {r.shard for r in sharding.placed(docs, {"a": {"b": {9: 1.0}}}, result="where").withColumnRenamed("shard", "s").select(F.col("where").alias("shard")).collect()}
    assert one == {9}


def test_slots_of_one_repeated_row(spark):
    rows = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text")).repartition(5)
    got = sharding.assign(rows, sharding.layout(16), sharding.layout(17))
    assert sorted(r.slot for r in got.collect()) == list(range(3000))


def test_bad_trees_are_refused():
    for tree in ({}, {"a": {"b": {0: 0.0}}}, {"a": {"b": {0: -1.0}}}, {"a/c": {"b": {0: 1.0}}}):
        with pytest.raises(ValueError):
            sharding.children(tree)


def test_write(spark, tmp_path):
    docs = documents(spark, [(i, f"text {i}") for i in range(200)], extra=["shard"])
    sharding.write(docs, sharding.layout(16), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    want = {r.doc_id: r.to for r in sharding.placed(docs, sharding.layout(16), result="to").collect()}
    assert {r.doc_id: int(r._shard) for r in back.collect()} == want
    assert set(docs.columns) | {"region", "rack", "_shard"} == set(back.columns)
