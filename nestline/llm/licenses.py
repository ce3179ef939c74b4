"""License scan: stated phrases, and an exact set-similarity join of text blocks with license templates.

A block is a run of neighbouring words, wherever lines end, as the set of these; its length is that of the
template and a share `SLACK` more, so words that stand far apart don't make a template. Tokens are ordered by
the number of documents that hold them, rarest first. A block that holds the share `THRESHOLD` of a template's
tokens must hold one of the template's first tokens in that order (prefix filter), at least as many
template tokens as needed (length filter), and enough behind the shared token on both sides (positional
filter); what is left is verified by the overlap itself. Blocks are made around the first tokens only. All steps are DataFrame functions; the templates are a parameter of
bounded size, only their tokens' document counts, at most MAX_TOKENS of them, come to the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
THRESHOLD, SLACK, MAX_TOKENS = 0.8, 0.25, 10_000
#: Sentences by which licenses and claims are stated, with the label each stands for.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("proprietary", "all rights reserved"),
)


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def words_of(lowered_text: Column) -> Column:
    return F.array_remove(F.split(lowered_text, NO_WORD, -1), "")


def bound(value: Column, function: Callable[[Column], Column]) -> Column:
    """function(value), with value computed once however often the function uses it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def needed(tokens: int, threshold: float) -> int:
    """The least overlap whose share of the tokens reaches the threshold."""
    return next(n for n in range(tokens + 1) if n / tokens >= threshold)


def span_of(template: str) -> int:
    """The number of words of a template's blocks."""
    return len(template.split()) + ceil(SLACK * len(template.split()))


def phrase_places(words: Column, phrase: str) -> Column:
    """Indices of the words at which the phrase's words stand in a row."""
    parts = phrase.split(" ")
    columns = [words if k == 0 else F.slice(words, k + 1, F.greatest(F.size(words), F.lit(1))) for k in range(len(parts))]
    zipped = F.arrays_zip(*[c.alias(f"w{k}") for k, c in enumerate(columns)])

    def stands(x, i):
        found = x["w0"] == parts[0]
        for k in range(1, len(parts)):
            found = found & (x[f"w{k}"] == parts[k])
        return F.when(found, i.cast("long"))

    return F.filter(F.transform(zipped, stands), lambda i: i.isNotNull())


def most_held(near: Column, middle: Column, tokens: Column, span: Column) -> Column:
    """Of the blocks of `span` words in `near` that hold the word at `middle`, the most different `tokens` in one."""
    held = F.filter(F.transform(near, lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
                    lambda x: F.array_contains(tokens, x["word"]) & (F.abs(x["at"] - middle) < span))

    def counted(marks: Column) -> Column:
        first = F.filter(marks, lambda x: x["at"] <= middle)
        return F.array_max(F.transform(first, lambda x: F.size(F.array_distinct(F.transform(
            F.filter(marks, lambda y: (y["at"] >= x["at"]) & (y["at"] < x["at"] + span)), lambda y: y["word"])))))
    return bound(held, counted)


def block_matches(body: DataFrame, key: list[str], low: str, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, label, containment) for the blocks of the lower-cased text `low` that hold `threshold` or more of the
    different words of a template: for each place of a template's first tokens the best of the blocks around it."""
    sets = [(label, sorted(set(text.split())), span_of(text)) for label, text in templates]
    vocabulary = sorted({t for _, tokens, _ in sets for t in tokens})
    if len(vocabulary) > MAX_TOKENS:
        raise ValueError(f"the templates have more than {MAX_TOKENS} different words")
    held = F.array_intersect(F.lit(vocabulary), words_of(F.col(low)))
    counted = {r.token: r["count"] for r in body.select(F.explode(held).alias("token")).groupBy("token").count().collect()}
    order = sorted(vocabulary, key=lambda t: (counted.get(t, 0), t))
    rank = {t: k for k, t in enumerate(order)}
    postings = []
    for number, (label, tokens, span) in enumerate(sets):
        tokens = sorted(tokens, key=rank.get)
        need = needed(len(tokens), threshold)
        postings += [(tokens[p], number, label, tokens, p, len(tokens), need, span) for p in range(len(tokens) - need + 1)]
    spark = body.sparkSession
    postings_df = spark.createDataFrame(
        postings, "token string, template int, label string, tokens array<string>, p int, size int, need int, span int")
    leads, reach = sorted({p[0] for p in postings}), max(p[-1] for p in postings) - 1

    def around(words: Column) -> Column:
        """(token, words before and behind it, its index among these) of each first token."""
        def place(word: Column, i: Column) -> Column:
            start = F.greatest(i - reach, F.lit(0))
            return F.when(word.isin(*leads), F.struct(
                word.alias("token"), F.slice(words, start + 1, i - start + 1 + reach).alias("near"), (i - start).alias("middle")))
        return F.filter(F.transform(words, place), lambda x: x.isNotNull())

    found = F.when(F.size(F.array_intersect(F.lit(leads), words_of(F.col(low)))) > 0, bound(words_of(F.col(low)), around))
    pairs = (body.select(*key, F.explode(found).alias("x")).select(*key, "x.*").withColumn("block", F.array_intersect(F.lit(order), "near"))
             .join(postings_df, "token")
             .where(F.least(F.col("size") - F.col("p"), F.size("block") - F.array_position("block", F.col("token")) + 1) >= F.col("need"))
             .where(F.size(F.array_intersect("block", "tokens")) >= F.col("need")))
    overlap = most_held(F.col("near"), F.col("middle"), F.col("tokens"), F.col("span"))
    return (pairs.withColumn("overlap", overlap).where(F.col("overlap") >= F.col("need"))
            .select(*key, "label", (F.col("overlap") / F.col("size")).cast("double").alias("containment")))


def scan(docs: DataFrame, text: str = "text", doc: str = "doc_id", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """For each row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of all PHRASES in the words of the lower-cased text; first_word and last_word are
    the least and the largest of them, else null. labels adds those of matching templates; both are sorted,
    different and joined by commas, else empty. score is 1 where a phrase stands, else the largest share that a
    matching block holds of a template, else 0. Null texts are empty. Rows may lack an id or share one; equal
    rows have equal results.
    """
    body = docs.select(F.col(f"`{doc}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("text_hash"),
                       lowered(F.col(f"`{text}`")).alias("low"))
    found = (block_matches(body, ["doc_id", "text_hash"], "low", templates, threshold).groupBy("doc_id", "text_hash")
             .agg(F.collect_set("label").alias("own"), F.max("containment").alias("share"))
             .select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "own", "share"))
    # a text without the phrases' common word has no place to look for
    def phrases(words):
        places = [phrase_places(words, phrase) for phrase, _ in PHRASES]
        return F.struct(F.size(words).cast("long").alias("n_words"), F.when(F.array_contains(words, "license"), F.array(*places)).alias("places"))

    based = (body.select("doc_id", "text_hash", bound(words_of(F.col("low")), phrases).alias("s"))
             .select("doc_id", "text_hash", "s.n_words", F.coalesce(F.flatten("s.places"), F.array().cast("array<bigint>")).alias("places"),
                     F.array_compact(F.array(*[F.when(F.size(F.get("s.places", F.lit(k))) > 0, F.lit(label))
                                               for k, (_, label) in enumerate(PHRASES)])).alias("base")))
    joined = based.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")), "left")
    own = F.coalesce("own", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"), F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
