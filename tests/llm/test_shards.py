"""Slots as a permutation; shards against a plain numbering; reading that resumes."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestline.llm import bpe, queries, shards
from tests.llm.helpers import documents


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 1023, 1024, 1025, 50_000])
def test_every_slot_once(size):
    slots = shards.permuted(np.arange(size), size)
    assert sorted(slots.tolist()) == list(range(size))
    assert size < 100 or (slots != shards.permuted(np.arange(size), size, key=5)).any()


def sequences(texts):
    out = []
    for text in texts:
        ids = list((text or "").encode()) + [shards.END]
        ids += [shards.FILL] * (-len(ids) % shards.LENGTH)
        out += [np.array(ids[a:a + shards.LENGTH], "<u2").tobytes() for a in range(0, len(ids), shards.LENGTH)]
    return out


def test_query_holds_every_sequence_once(spark, sf):
    rows = sorted(queries.QUERIES["op3_training_order_shards"](spark, sf).collect())
    docs = queries.table(spark, sf, "documents")
    want = sequences([r.text for r in docs.collect()])
    slots = sorted(shards.slotted(docs).collect())
    assert [r.slot for r in slots] == list(range(len(want)))
    made = []
    for r in slots:
        row = np.full(shards.LENGTH, shards.FILL, "<u2")
        row[:len(r.piece)] = np.frombuffer(r.piece, np.uint8)
        if r.last:
            row[len(r.piece)] = shards.END
        made.append(row.tobytes())
    assert sorted(made) == sorted(want)
    for k, r in enumerate(rows):
        data = b"".join(made[k * shards.PER_SHARD:(k + 1) * shards.PER_SHARD])
        assert (r.shard, r.first_slot, r.n_bytes, r.sha256) == (k, k * shards.PER_SHARD, len(data), hashlib.sha256(data).hexdigest())
        assert r.n_sequences * shards.STRIDE == r.n_bytes


def test_order_depends_on_rows_alone(spark, sf):
    docs = queries.table(spark, sf, "documents")
    one = sorted(shards.slotted(docs.coalesce(1)).collect())
    assert one == sorted(shards.slotted(docs.repartition(7)).collect())


def test_files_and_resumed_reading(spark, tmp_path, monkeypatch):
    texts = [None, "", "a" * 1023, "b" * 1024, "c" * 70_000, "é" * 3000] + ["same"] * 5 + [f"text {i}" for i in range(4000)]
    docs = documents(spark, [(None if i % 7 == 0 else i // 2, t) for i, t in enumerate(texts)], extra=("slot", "n", "split", "hash"))
    uri = f"file://{tmp_path}/out"
    done = shards.write(shards.slotted(docs), uri).collect()
    want = sequences(texts)
    assert sum(r.n_sequences for r in done) == len(want)
    whole = [r.tobytes() for r in shards.read(uri)]
    assert sorted(whole) == sorted(want)
    for slot in (1, 2047, 2048, len(want) - 1, len(want)):
        assert [r.tobytes() for r in shards.read(uri, slot)] == whole[slot:]
    assert shards.digests(shards.slotted(docs.limit(0))).count() == 0


def code_points(text):
    return np.array([ord(c) for c in text], np.uint32)


def test_ids_beyond_two_bytes_and_above_end(spark, tmp_path):
    texts = ["🙂é" * 700, "", "\u0100\u0101 ids that bytes use as end and fill"]
    docs = documents(spark, list(enumerate(texts)))
    slots = shards.slotted(docs, tokens=code_points, count=F.length)
    end, fill, uri = 0x110000, 0x110001, f"file://{tmp_path}/wide"
    shards.write(slots, uri, np.uint32, end, fill, "<u4").collect()
    got = sorted(row.tolist() for row in shards.read(uri, number="<u4"))
    want = []
    for text in texts:
        ids = [*map(ord, text), end]
        ids += [fill] * (-len(ids) % shards.LENGTH)
        want += [ids[a:a + shards.LENGTH] for a in range(0, len(ids), shards.LENGTH)]
    assert got == sorted(want) and list(shards.read(uri, 2, "<u4"))[0].shape == (shards.LENGTH,)
    with pytest.raises(ValueError):
        shards.digests(slots, np.uint32, end, fill)
    with pytest.raises(Exception, match="must lie below end"):
        shards.digests(slots, np.uint32).collect()


def test_encoded_texts_as_shards(spark, sf, tmp_path):
    path, pattern = queries.VOCABULARY, queries.public_tokenizers.PATTERN
    docs = queries.table(spark, sf, "documents").limit(60).union(documents(spark, [(900, None), (900, "twice"), (900, "twice"), (None, "x")]))
    slots = shards.slotted_ids(bpe.encode(docs, path, pattern))
    end, fill, uri = 50256, 50257, f"file://{tmp_path}/ids"
    shards.write(slots, uri, np.int32, end, fill).collect()
    want = []
    for row in docs.collect():
        ids = [*bpe.codec(path, pattern).encode(row.text or ""), end]
        ids += [fill] * (-len(ids) % shards.LENGTH)
        want += [ids[a:a + shards.LENGTH] for a in range(0, len(ids), shards.LENGTH)]
    assert sorted(row.tolist() for row in shards.read(uri)) == sorted(want)
    assert sorted(r.slot for r in slots.select("slot").collect()) == list(range(len(want)))
