"""License scan against SQL, on the table and on odd texts, and the join against all pairs."""

import duckdb
from pyspark.sql import functions as F

from nestline.llm import licenses, queries
from tests.conftest import SF
from tests.llm.helpers import documents
from tools.check_oracle import rows as as_text


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.QUERIES["op2_license_scan"](spark, sf).toPandas()
    assert as_text(got) == as_text(db.execute(queries.ORACLE["op2_license_scan"]).df())


def test_odd_texts_equal_sql(spark):
    texts = [None, "", "MIT License mit license MIT LICENSE", "the mit-license", "mit\nlicense", "general public license general public license",
             "mit", "license mit", "Apache  License,\tVersion 2.0 licensed under the", "reserved all\nrights", "All rights reserved.",
             "é" * 60_000 + " apache license", "word " * 2000 + "gnu general public license", "İstanbul MİT License",
             "# Permission is hereby\n# granted, free of charge,\n# to any person\n#   obtaining a copy", "all " + "x " * 9 + "rights " + "x " * 9 + "reserved",
             "x " * 300 + "redistribution and use in\nsource or (not) binary\nforms with\nor without modification\nare permitted" + " x" * 300,
             "all all rights all reserved", "rights reserved all all rights",
             *[" ".join(t.split()[:k]) for _, t in licenses.TEMPLATES for k in range(1, len(t.split()) + 1)]]
    rows = [(i if i % 6 else None, t) for i, t in enumerate(texts)] + [(2, texts[2])] * 2 + [(2, texts[5])]
    docs = documents(spark, rows, extra=("labels", "own", "token", "block", "low", "share"))
    db = duckdb.connect()
    db.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    got = licenses.scan(docs).toPandas()
    assert as_text(got) == as_text(db.execute(queries.ORACLE["op2_license_scan"]).df())
    assert licenses.scan(docs.limit(0)).count() == 0


def test_other_thresholds_equal_all_blocks(spark):
    texts = ["a b c d", "a b", "x", "d c b a x", "b b b c", "e f g h i", "a\nb\nc", "f g", "a y y b y y c y y d", "e y f\ny g y h y i j", "d y y c y b y a a b"]
    templates = [("one", "a b c d"), ("two", "x"), ("three", "e f g h i j"), ("four", "b c")]
    docs = documents(spark, list(enumerate(texts)))
    for threshold in (0.3, 0.5, 0.75, 1.0):
        want = {}
        for i, text in enumerate(texts):
            words = text.split()
            for label, t in templates:
                for a in range(len(words)):
                    block = set(words[a:a + licenses.span_of(t)])
                    share = len(block & set(t.split())) / len(set(t.split()))
                    if share >= threshold:
                        want[i, label] = max(share, want.get((i, label), 0))
        got = licenses.block_matches(docs, ["doc_id"], "text", templates, threshold).groupBy("doc_id", "label").agg(F.max("containment").alias("most")).collect()
        assert {(r.doc_id, r.label): r.most for r in got} == want
