"""The stages against plain versions of each, on whole small tables."""

import base64
import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from nestline.llm import quality, queries
from nestline.llm.buffers import column_bytes
from nestline.sources.scratch import written
from tests.llm.helpers import documents
from tests.llm.test_contamination import brute as windows
from tests.llm.test_lines import brute as without_lines
from tests.llm.test_near import brute as classes


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that go into each stage, and those that the last returns."""
    sf = "/root/testdata/sf0.001"
    docs, out = queries.table(spark, sf, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs.collect())
        docs = written(stage(spark, docs, sf), "stage")
    return [*out, docs.collect()]


def test_quality_stage_keeps_what_the_network_passes(spark, sf, stages):
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    net = quality.fit(docs, labels, ~quality.held_out(F.col("doc_id"), 5, 0))
    scores = net.scores(*column_bytes(pa.array([r.text for r in stages[0]])))
    assert sorted(stages[1]) == sorted(r for r, s in zip(stages[0], scores) if s >= 0.3)


def test_line_stage(stages):
    want = {d: (t, len(t)) for d, _, _, t in without_lines([(r.doc_id, r.text) for r in stages[1]])}
    assert {r.doc_id: (r.text, r.n_chars) for r in stages[2]} == want


def test_near_stage_keeps_the_first_of_each_class(stages):
    label, _ = classes({r.doc_id: r.text for r in stages[2]})
    assert sorted(stages[3]) == sorted(r for r in stages[2] if label[r.doc_id] == r.doc_id)


def test_decontamination_stage(spark, sf, stages):
    items = [(r.item_id, r.text) for r in queries.table(spark, sf, "benchmark").collect()]
    found = {r.doc_id: windows(r.text, items) for r in stages[3]}
    assert sorted(stages[4]) == sorted(r for r in stages[3] if not 0 < found[r.doc_id][0] <= 20 * found[r.doc_id][1])


def test_token_stage(stages):
    with open(queries.VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {r.doc_id: [str(i) for i in library.encode_ordinary(r.text)] for r in stages[4]}
    assert {r.doc_id: r.ids_sha256 for r in stages[5]} == {d: hashlib.sha256(",".join(i).encode()).hexdigest() for d, i in want.items()}


def test_stages_keep_columns_and_run_equals_them(spark, sf, stages):
    assert all(r.asDict().keys() == stages[0][0].asDict().keys() for rows in stages[:5] for r in rows)
    assert sorted(corpus_pipeline.run(spark, sf).collect()) == sorted(stages[5])


def test_odd_rows_and_empty_documents(spark, sf):
    rows = [(None, None), (None, "text"), (1, ""), (1, ""), (2, "x" * 100_000), (3, None)]
    docs = documents(spark, rows, extra=("spare", "cleaned", "found", "judged", "body", "row_hash"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
        docs = written(kept, "stage")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
