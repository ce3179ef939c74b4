"""Byte-level BPE by monoid tree reduction.

A text is cut by the vocabulary's pattern and each part is encoded on its own. A part is halved until
its pieces are short, the pieces are merged directly, and neighbours are joined up the tree: `join`
re-encodes a window of tokens on both sides of the seam. A sequence of tokens is the encoding of its
bytes exactly if every two neighbours are the encoding of their own bytes, so the tokens outside are
final as soon as both edges of the window satisfy that; else the window doubles. Decoding is the
concatenation of the tokens' bytes up the same tree. The short pieces of many texts are merged together,
one merge of every piece at a time, and the encodings of parts that come again are remembered.

Null texts are empty: no tokens, no bytes. Any bytes can be encoded, as the vocabulary holds all single
bytes. Each row has a result of its own, so repeated rows and ids are no matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from nestline.llm.buffers import free_name, prepare, with_results

#: Bytes up to which a piece is merged without halving, tokens in the first window on a side of a seam,
#: the number of different parts whose encodings a task remembers, and characters of texts encoded together.
LEAF, WINDOW, MEMORY, TOGETHER = 24, 2, 200_000, 1 << 20
NONE = (1 << 31) - 1
#: Finds characters for which the standard library's classes may differ from the Unicode categories.
BEYOND_LATIN = re.compile("[^\x00-\x1b\x20-\x7f\xc0-\u024f]").search


def latin_pattern(pattern: str) -> str:
    """The same pattern for the standard library, which is faster; equal on texts of Latin characters."""
    for category, plain in ((r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)"), (r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d")):
        pattern = pattern.replace(category, plain)
    return pattern


class Codec:
    """Encoder and decoder of one vocabulary: `ranks` by token bytes, `pattern` for the parts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.any_parts = ranks, regex.compile(pattern).findall
        self.latin_parts = re.compile(latin_pattern(pattern)).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.decimal = {rank: f"{rank}," for rank in ranks.values()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pairs = {ranks[token[:k]] << 32 | ranks[token[k:]]: rank for token, rank in ranks.items()
                      for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks}
        self.stable = lru_cache(1 << 16)(self._stable)
        # of parts of late, and of those of the time before: decimal ids with a comma behind each, decoded bytes
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}
        self.older: tuple[dict[str, str], dict[str, bytes]] = {}, {}
        pairs = np.fromiter(self.pairs, np.int64, len(self.pairs))
        order = np.argsort(pairs)
        self.pair_keys = np.append(pairs[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.fromiter(self.pairs.values(), np.int32, len(self.pairs))[order], np.int32(NONE))
        self.first = np.array(self.single, np.int32)
        self.first_pairs = self.rank_of(self.first[:, None], self.first[None])

    def parts(self, text: str) -> list[str]:
        return self.any_parts(text) if BEYOND_LATIN(text) else self.latin_parts(text)

    def merge(self, piece: bytes) -> list[int]:
        """The pair of lowest rank is merged, leftmost first, until no pair is in the vocabulary."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        get = self.pairs.get
        ids = [self.single[b] for b in piece]
        ranks = [get(a << 32 | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NONE:
            at = ranks.index(best)
            ids[at:at + 2] = [best]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(best << 32 | ids[at + 1], NONE)
            if at:
                ranks[at - 1] = get(ids[at - 1] << 32 | best, NONE)
        return ids

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that two neighbours make, NONE where there is none."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, wanted)
        return np.where(self.pair_keys[at] == wanted, self.pair_ranks[at], np.int32(NONE))

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """merge() of every piece, those of one length together."""
        out: list = [None] * len(pieces)
        lengths: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = [whole]
            else:
                lengths.setdefault(len(piece), []).append(k)
        for length, at in lengths.items():
            data = np.frombuffer(b"".join([pieces[k] for k in at]), np.uint8).reshape(len(at), length)
            rows, ids, ranks = np.array(at), self.first[data], self.first_pairs[data[:, :-1], data[:, 1:]]
            while len(rows):
                if ids.shape[1] > 1:
                    best = ranks.argmin(axis=1)
                    made = ranks[np.arange(len(rows)), best]
                    going = made != NONE
                else:
                    best, made, going = rows, rows, np.zeros(len(rows), bool)
                for k, row in zip(rows[~going].tolist(), ids[~going].tolist()):
                    out[k] = row
                rows, ids, ranks, best, made = (x[going] for x in (rows, ids, ranks, best, made))
                line = np.arange(len(rows))
                ids[line, best] = made
                ids, ranks = without(ids, best + 1), without(ranks, best)
                right, left = np.flatnonzero(best < ranks.shape[1]), np.flatnonzero(best > 0)
                ranks[right, best[right]] = self.rank_of(made[right], ids[right, best[right] + 1])
                ranks[left, best[left] - 1] = self.rank_of(ids[left, best[left] - 1], made[left])
        return out

    def _stable(self, left: int, right: int) -> bool:
        return self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings in a row."""
        if not left or not right:
            return left + right
        if self.stable(left[-1], right[0]):
            return left + right
        width = WINDOW
        while True:
            before, after = left[:-width], right[width:]
            middle = self.merge(self.decode(left[-width:] + right[:width]))
            if (not before or self.stable(before[-1], middle[0])) and (not after or self.stable(middle[-1], after[0])):
                return before + middle + after
            width *= 2

    def encode_parts(self, parts: list[bytes]) -> list[list[int]]:
        """The encoding of each part: halved down to leaves, which are merged together, and joined up the tree."""
        leaves: dict[bytes, list[int]] = {}

        def halves(part: bytes) -> tuple[bytes, bytes]:
            return part[:len(part) // 2], part[len(part) // 2:]

        def cut(part: bytes) -> None:
            if len(part) <= LEAF or part in self.ranks:
                leaves[part] = []
            else:
                for half in halves(part):
                    cut(half)  # as deep as the logarithm of the length

        def joined(part: bytes) -> list[int]:
            found = leaves.get(part)
            return self.join(*map(joined, halves(part))) if found is None else found

        for part in parts:
            cut(part)
        leaves = dict(zip(leaves, self.merge_all(list(leaves))))
        return list(map(joined, parts))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def remember(self, parts: set[str]) -> None:
        """Sees that `ids` and `decoded` hold each part."""
        if len(self.ids) >= MEMORY // 2:
            self.ids, self.decoded, self.older = {}, {}, (self.ids, self.decoded)
        new = parts - self.ids.keys()
        again = new & self.older[0].keys()
        new = list(new - again)
        for kept, old in zip((self.ids, self.decoded), self.older):
            kept.update(zip(again, map(old.__getitem__, again)))
        found = self.encode_parts([part.encode() for part in new])
        decimal = self.decimal.__getitem__
        self.ids.update(zip(new, ["".join(map(decimal, ids)) for ids in found]))
        self.decoded.update(zip(new, map(self.decode, found)))

    def encode(self, text: str) -> list[int]:
        parts = self.parts(text)
        different = list(dict.fromkeys(parts))
        of = dict(zip(different, self.encode_parts([part.encode() for part in different])))
        return [i for part in parts for i in of[part]]

    def round_trips(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text the number of ids, SHA-256 of the ids in decimal joined by commas, SHA-256 of the decoded bytes."""
        every = list(map(self.parts, texts))
        self.remember(set().union(*every))
        out = []
        for parts in every:
            ids = "".join(map(self.ids.__getitem__, parts))
            out.append((ids.count(","), hashlib.sha256(ids[:-1].encode()).hexdigest(),
                        hashlib.sha256(b"".join(map(self.decoded.__getitem__, parts))).hexdigest()))
        return out


def without(matrix: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The matrix without one entry in each row."""
    stay = np.ones(matrix.shape, bool)
    stay[np.arange(len(matrix)), column] = False
    return matrix[stay].reshape(len(matrix), matrix.shape[1] - 1)


def together(texts: pa.Array):
    """Runs of texts of about TOGETHER characters; null is empty."""
    run, size = [], 0
    for text in texts:
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= TOGETHER:
            yield run
            run, size = [], 0
    if run:
        yield run


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with one `base64 rank` on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", result: str = "ids") -> DataFrame:
    """The columns of docs and the array of token ids of each whole text, `result`."""
    work = free_name(docs, "encoded")

    def start():
        encoder = codec(path, pattern).encode
        return lambda texts: [pa.array([encoder(t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))]

    fields = StructType([StructField("ids", ArrayType(IntegerType()))])
    out = with_results(docs, text, docs.columns, work, fields, start)
    return out.select(*docs.columns, out[work]["ids"].alias(result))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", result: str = "decoded") -> DataFrame:
    """The columns of docs and the text that an array of ids stands for; bytes that are no UTF-8 become
    U+FFFD, null ids an empty text."""
    prepare(docs.sparkSession)

    @_text_udf
    def decoded(batch):
        of = codec(path, pattern).decode
        return batch.map(lambda x: of([] if x is None else x.tolist()).decode("utf-8", "replace"))

    return docs.withColumn(result, decoded(docs[ids]))


def _text_udf(function):
    from pyspark.sql.functions import pandas_udf

    return pandas_udf(function, "string")


def round_trip(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` and, for the encoding of each whole text and its decoding, n_tokens, ids_sha256, decoded_sha256."""
    def start():
        of = codec(path, pattern).round_trips

        def run(texts):
            rows = [row for some in together(texts) for row in of(some)]
            return [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.string())]
        return run

    fields = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
                         StructField("decoded_sha256", StringType())])
    out = with_results(docs, text, keep, "found", fields, start)
    return out.select(*keep, "found.*")
