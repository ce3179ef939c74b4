"""Repeated lines, found with two Bloom filters.

One scan fills a filter of line hashes seen once and one of those seen twice; with more lines than one filter
holds, the hashes alone are dealt into buckets with two filters each. A second scan keeps the
lines that the second filter knows: only these suspected repeats are shuffled, with their whole keys,
counted exactly and given a document that keeps them. Texts are shuffled only for documents that may
lose a line; all others are finished where they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from nestline.llm import bloom
from nestline.llm.buffers import FOLD, free_name, run_hashes, slices, with_results
from nestline.sources.scratch import written

MIN_CHARS, MIN_DOCS = 40, 5
#: White space stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS.encode())] = True
SUSPECTS = StructType([StructField("keys", ArrayType(StringType()))])


def key_runs(offsets: np.ndarray, data: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and byte after the last of every line's key that has at least min_chars code points."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)))
    ends = np.sort(np.concatenate((breaks, offsets[1:])))
    filled = np.flatnonzero(~IS_BLANK[data])
    low, high = np.searchsorted(filled, starts), np.searchsorted(filled, ends)
    some = high - low >= min(min_chars, 1)
    low, high = low[some], high[some]
    starts, ends = filled[low], filled[high - 1] + 1
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    long = chars[ends] - chars[starts] >= min_chars
    starts, ends = starts[long], ends[long]
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def line_hashes(batch: pa.RecordBatch, min_chars: int) -> np.ndarray:
    """Hashes of the keys of an Arrow batch of texts, once for each text."""
    out = []
    for _, _, offsets, data in slices(batch.column(0)):
        rows, starts, ends = key_runs(offsets, data, min_chars)
        hashes = run_hashes(FOLD[data], starts, ends)
        order = np.lexsort((hashes, rows))
        rows, hashes = rows[order], hashes[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
        out.append(hashes[new])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def suspect_keys(texts: pa.Array, packed: np.ndarray, min_chars: int) -> list[pa.Array]:
    """For each text its different keys that the filter of keys seen twice may hold; null if none."""
    found: list = [None] * len(texts)
    for first, _, offsets, data in slices(texts):
        rows, starts, ends = key_runs(offsets, data, min_chars)
        folded = FOLD[data]
        seen = bloom.contains(packed, run_hashes(folded, starts, ends))
        raw = folded.tobytes()
        for row, a, b in zip(rows[seen].tolist(), starts[seen].tolist(), ends[seen].tolist()):
            if found[first + row] is None:
                found[first + row] = set()
            found[first + row].add(raw[a:b].decode())
    return [pa.array([f and sorted(f) for f in found], pa.list_(pa.string()))]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(BLANKS)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def dropped_keys(docs: DataFrame, text: str, doc: str, min_chars: int, min_docs: int) -> DataFrame:
    """(doc_id, text_hash, keys): the keys whose lines go from each document that loses some."""
    body = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    breaks = F.length("text") - F.length(F.translate("text", "\n", ""))
    lines = body.agg(F.sum(breaks + 1)).first()[0] or 0
    packed = bloom.seen_twice(body.select("text"), lambda batch: line_hashes(batch, min_chars), lines)
    sent = body.sparkSession.sparkContext.broadcast(packed)
    numbered = body.where("doc_id is not null").withColumn("text_hash", F.xxhash64("text"))
    suspects = with_results(numbered, "text", ["doc_id", "text_hash"], "found", SUSPECTS,
                            lambda: lambda texts: suspect_keys(texts, sent.value, min_chars))
    suspects = written(suspects.where("found.keys is not null")
                       .select("doc_id", "text_hash", F.explode("found.keys").alias("key")), "suspects")
    repeats = (suspects.groupBy("key").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))
               .where(F.col("docs") >= min_docs).select("key", "keeper"))
    # written: both sides of the join are then dealt by it alone, so a very common line can be split
    repeats = written(repeats, "repeats")
    return written(suspects.join(repeats, "key").where("doc_id < keeper")
                   .groupBy("doc_id", "text_hash").agg(F.collect_set("key").alias("keys")), "dropped")


def without_repeats(docs: DataFrame, result: str, text: str = "text", doc: str = "doc_id", min_chars: int = MIN_CHARS,
                    min_docs: int = MIN_DOCS) -> DataFrame:
    """The columns of docs and a struct `result`: n_lines, n_dropped and kept, the text without lines repeated
    elsewhere.

    A line's key is the line without `BLANKS` at both ends and with A-Z in lower case. Keys of min_chars code
    points or more that are in min_docs or more documents lose all their lines but those of the largest id.
    A null or empty text is one empty line, kept as an empty text. Rows that share an id are one document.
    Rows without id are no documents: they neither count nor lose lines.
    """
    dropped = dropped_keys(docs, text, doc, min_chars, min_docs)
    mark, keys, other, other_doc, other_text = [
        free_name(docs, n) for n in ("row_hash", "dropped_keys", "drop_hash", "drop_doc", "drop_text")]
    drops = dropped.select(F.xxhash64("doc_id", "text_hash").alias(other), F.col("doc_id").alias(other_doc),
                           F.col("text_hash").alias(other_text), F.col("keys").alias(keys))
    own_doc, own_text = F.col(f"`{doc}`").cast("long"), F.xxhash64(F.col(f"`{text}`").cast("string"))
    rows = docs.withColumn(mark, F.xxhash64(own_doc, own_text))
    may_lose = bloom.of_longs(drops, other, drops.count())
    rest, some = rows.where(~may_lose(F.col(mark))), rows.where(may_lose(F.col(mark)))
    some = some.join(drops, (F.col(mark) == F.col(other)) & (own_doc == F.col(other_doc)) & (own_text == F.col(other_text)), "left")
    of = F.col(f"`{text}`").cast("string")
    kept = F.when(F.col(keys).isNull(), lines_of(of)).otherwise(
        F.filter(lines_of(of), lambda line: ~F.array_contains(F.col(keys), key_of(line))))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    count = F.size(lines_of(of)).cast("long")
    lost = some.select(*columns, F.struct(
        count.alias("n_lines"), (count - F.size(kept)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept")).alias(result))
    whole = rest.select(*columns, F.struct(
        count.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.coalesce(of, F.lit("")).alias("kept")).alias(result))
    return lost.unionByName(whole)
