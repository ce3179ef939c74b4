"""Personal data: stated kinds by pattern, further identifiers by bootstrapped contexts.

The stated kinds are found in each whole text. They and long keys of letters and digits are the seeds.
Every found span and every longer token with digits is an instance, the two words before it are its pattern. Patterns and instances
form a graph that is scored in rounds: a pattern by the share of its instances that are known, an
instance by the patterns it stands in. Patterns of high score and enough known instances then mark all
their instances, so identifiers that no rule describes are found where such data usually stand.

All steps are DataFrame functions. One scan writes the narrow spans and instances; the graph holds
64-bit hashes only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from nestline.llm.licenses import bound
from nestline.sources.scratch import written

KINDS = ("email", "ip", "card", "phone")
#: Each finds what the kind's contract says, without going over a run of characters more than once: a match can
#: begin only where such a run begins or the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without it has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
INSTANCE = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
EDGES = "!\"#$%&'()*,-./:;<=>?@[\\]^_`{|}~+"
#: Context that is looked at, least length and digits of a token as an instance, characters of a key.
CONTEXT_CHARS, MIN_LENGTH, MIN_DIGITS, KEY_LENGTH = 64, 6, 4, 16
ROUNDS, ACCEPT, SUPPORT, TRUST = 3, 0.8, 3, 0.9
#: Lengths that are summed before they are put behind those of earlier ones.
RUN = 128


def digits(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "0123456789", ""))


def luhn(match: Column) -> Column:
    """Whether the digits of a match pass the check of card numbers."""
    def passes(d):
        size = F.length(d)
        values = F.transform(F.sequence(F.lit(1), size), lambda i: bound(
            F.substr(d, i, F.lit(1)).cast("int") * F.when((size - i) % 2 == 1, 2).otherwise(1), lambda x: x - F.when(x > 9, 9).otherwise(0)))
        return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0
    return bound(F.translate(match, " -", ""), passes)


HOLDS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda part: part.cast("double") <= 255),
    "card": luhn,
    "phone": lambda m: digits(m).between(9, 15),
}


def running(lengths: Column) -> Column:
    """Sums of an array up to each entry."""
    def add(state, run):
        inner = F.aggregate(run, F.struct(state["total"].alias("total"), F.array().cast("array<bigint>").alias("sums")),
                            lambda s, x: bound(s["total"] + x, lambda t: F.struct(t.alias("total"), F.array_append(s["sums"], t).alias("sums"))))
        return bound(inner, lambda i: F.struct(i["total"].alias("total"), F.concat(state["sums"], i["sums"]).alias("sums")))

    runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size(lengths) / RUN).cast("int") - 1), lambda k: F.slice(lengths, k * RUN + 1, F.lit(RUN)))
    none = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<bigint>").alias("sums"))
    return F.when(F.size(lengths) > 0, F.aggregate(runs, none, add)["sums"]).otherwise(F.array().cast("array<bigint>"))


def found_at(text: Column, pattern: str) -> Column:
    """Array of (match, gap, start): all matches, the text between the last one and each, and where it starts."""
    def place(parts):
        pairs = F.zip_with(parts["match"], F.slice(parts["gap"], F.lit(1), F.size(parts["match"])),
                           lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
        ends = running(F.transform(pairs, lambda p: (F.length(p["match"]) + F.length(p["gap"])).cast("bigint")))
        return F.zip_with(pairs, ends, lambda p, e: F.struct(p["match"].alias("match"), p["gap"].alias("gap"),
                                                            (e - F.length(p["match"])).alias("start")))
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), F.split(text, pattern, -1).alias("gap"))
    return bound(parts, place)


def context(matches: Column, k: Column) -> Column:
    """Hash of the two words, or the one, before the token of match k, null if there is none; earlier matches are words too."""
    tail = lambda x: F.substring(x, -CONTEXT_CHARS, CONTEXT_CHARS)
    earlier = [F.coalesce(F.concat(tail(m["gap"]), tail(m["match"])), F.lit("")) for m in (F.get(matches, k - 2), F.get(matches, k - 1))]
    text = F.lower(tail(F.concat(*earlier, tail(F.get(matches, k)["gap"]))))
    edges = "".join(f"\\{c}" for c in EDGES)
    return bound(F.regexp_extract(text, rf"((?:\S+\s+)?\S+)\s+[{edges}]*\z", 1),
                 lambda before: F.when(F.length(before) > 0, F.xxhash64(F.regexp_replace(before, r"\s+", " "))))


def spans_of(text: Column, kind: str) -> Column:
    """Array of (kind, start, end, pattern, instance) of the matches that hold; each whole match is an instance."""
    found = bound(found_at(text, PATTERNS[kind]), lambda matches: F.transform(matches, lambda m, k: F.when(
        HOLDS[kind](m["match"]), F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), (m["start"] + F.length(m["match"])).alias("end"),
                                          context(matches, k).alias("pattern"), F.xxhash64(m["match"]).alias("instance")))))
    spans = F.filter(found, lambda s: s.isNotNull())
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,pattern:bigint,instance:bigint>>")
    return spans if NEEDS[kind] is None else F.when(F.contains(text, F.lit(NEEDS[kind])), spans).otherwise(empty)


def instances_of(text: Column) -> Column:
    """Array of (start, end, pattern, instance, key): tokens with digits, without punctuation around them."""
    def token(matches, m, k):
        def cut(core):
            lead = F.length(m["match"]) - F.length(F.ltrim(m["match"], F.lit(EDGES)))
            return F.struct((m["start"] + lead).alias("start"), (m["start"] + lead + F.length(core)).alias("end"),
                            context(matches, k).alias("pattern"),
                            F.xxhash64(core).alias("instance"),
                            (core.rlike(f"^[A-Za-z0-9]{{{KEY_LENGTH},}}+$") & core.rlike("[A-Za-z]")).alias("key"),
                            (F.length(core) >= MIN_LENGTH).alias("long"), (digits(core) >= MIN_DIGITS).alias("numbered"))
        return bound(F.trim(m["match"], F.lit(EDGES)), cut)

    tokens = bound(found_at(text, INSTANCE), lambda matches: F.transform(matches, lambda m, k: token(matches, m, k)))
    return F.filter(tokens, lambda i: i["pattern"].isNotNull() & i["long"] & i["numbered"])


def scanned(docs: DataFrame, text: str, doc: str) -> DataFrame:
    """(doc_id, text_hash, base, instances) of every row, written once. Instances are the base spans and the tokens."""
    body = docs.select(F.col(f"`{doc}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    overlaps = lambda i, base: F.exists(base, lambda b: (b["start"] < i["end"]) & (b["end"] > i["start"]))
    spans = F.struct(F.concat(*[spans_of(F.col("text"), kind) for kind in KINDS]).alias("base"), instances_of(F.col("text")).alias("all"))
    whole = lambda base: F.transform(F.filter(base, lambda b: b["pattern"].isNotNull()), lambda b: F.struct(
        b["start"].alias("start"), b["end"].alias("end"), b["pattern"].alias("pattern"), b["instance"].alias("instance"),
        F.lit(True).alias("known"), F.lit(True).alias("seed")))
    bare = lambda base: F.transform(base, lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    row = bound(spans, lambda s: F.struct(bare(s["base"]).alias("base"), F.concat(whole(s["base"]), F.transform(s["all"], lambda i: bound(
        overlaps(i, s["base"]), lambda known: F.struct(i["start"].alias("start"), i["end"].alias("end"), i["pattern"].alias("pattern"),
                                                       i["instance"].alias("instance"), known.alias("known"),
                                                       (known | i["key"]).alias("seed"))))).alias("instances")))
    return written(body.select("doc_id", F.xxhash64("text").alias("text_hash"), row.alias("s")).select("doc_id", "text_hash", "s.*"), "spans")


def good_patterns(occurrences: DataFrame, rounds: int = ROUNDS, accept: float = ACCEPT, support: int = SUPPORT) -> DataFrame:
    """The patterns whose instances are known by a share of `accept` or more, `support` of them at least.

    `occurrences` has pattern, instance and seed. Each round a pattern's score is the mean of its instances'
    scores; an instance that is no seed scores 1 - product of (1 - TRUST * score) over its patterns of enough
    support.
    """
    links = written(occurrences.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "links")
    scored = links.withColumn("score", F.col("seed").cast("double"))
    for turn in range(rounds):
        patterns = scored.groupBy("pattern").agg(F.avg("score").alias("share"), F.count_if(F.col("score") >= 0.5).alias("known"))
        patterns = written(patterns.where(F.col("known") >= support).select("pattern", "share"), "patterns")
        if turn < rounds - 1:
            heard = (links.join(patterns, "pattern").groupBy("instance")
                     .agg((1 - F.exp(F.sum(F.log(1 - TRUST * F.col("share"))))).alias("heard")))
            heard = written(heard, "heard")
            scored = links.join(heard, "instance", "left").select(
                "pattern", "instance", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("heard", F.lit(0.0))).alias("score"))
    return patterns.where(F.col("share") >= accept).select("pattern")


def find(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, base, added) for each row of docs: the spans of KINDS, by kind and then start, and further
    identifiers of kind `id` by start, none of which touches a base span. Starts and ends count code points.

    Null texts are empty and have no spans. Equal rows have equal results; rows may lack an id or share one.
    """
    rows = scanned(docs, text, doc)
    flat = rows.select("doc_id", "text_hash", F.explode("instances").alias("i")).select("doc_id", "text_hash", "i.*")
    added = (flat.where("not known").join(good_patterns(flat), "pattern")
             .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct(F.lit("id").alias("kind"), "start", "end"))).alias("added"))
             .select(F.col("doc_id").alias("added_id"), F.col("text_hash").alias("added_hash"), "added"))
    return rows.join(added, F.col("doc_id").eqNullSafe(F.col("added_id")) & (F.col("text_hash") == F.col("added_hash")), "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
