"""Languages: held-out accuracy, texts without letters, odd rows."""

import zlib

from pyspark.sql import functions as F

from nestline.llm import language, queries
from tests.llm.helpers import documents


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in queries.table(spark, sf, "documents").collect()}
    rows = queries.QUERIES["op7_language_id"](spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) > 0.97 * len(held)


def test_odd_rows(spark):
    texts = ["the cat and the dog of this house"] * 12 + ["der hund und die katze in dem haus"] * 12
    odd = [None, "", "123 !! 45", "×÷ ∑ 🙂", "é", "a", "the " * 50_000, "qqq xxx zzz jjj"]
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts + odd)]
    docs = documents(spark, rows, extra=("slots", "counts", "found", "rejected")).withColumn(
        "lang", F.when(F.col("text").startswith("the cat"), "en").when(F.col("text").startswith("der"), "de"))
    model = language.fit(docs, F.lit(True))
    got = {r.text: r.found for r in language.predict(docs.withColumn("t", F.col("text")), model, ["text"], "found", "t").collect()}
    assert all(got[t].lang == "und" and got[t].score == 0 for t in odd[:4])
    assert got[texts[0]].lang == "en" and got[texts[-1]].lang == "de" and got[odd[6]].lang == "en"
    assert not got[texts[0]].rejected and got[odd[7]].rejected
    assert got["é"].lang in ("en", "de")
    assert language.predict(docs.limit(0), model, ["text"], "found").count() == 0
    nothing = language.fit(docs.limit(0), F.lit(True))
    assert {r.found.lang for r in language.predict(docs, nothing, ["text"], "found").collect()} == {"und"}


def test_document_frequencies_count_all_texts(spark):
    docs = documents(spark, [(i, f"abc {'xyz' if i % 2 else ''}") for i in range(40)] + [(50, None)])
    seen, rows = language.document_frequencies(docs.select("text"))
    assert rows == 41 and seen.max() == 40 and 20 in seen
