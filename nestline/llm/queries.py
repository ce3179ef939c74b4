"""Each operator on its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from nestline.llm import bpe, contamination, language, licenses, lines, near, negatives, pii, quality, ranking, sharding, shards, topk

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE encoding and decoding of every document."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN, ["doc_id"])


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in benchmark windows, the items they come from and the verdict."""
    found = contamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"], "found")
    n_hit, n_items, verdict = contamination.measured("found")
    return found.select("doc_id", F.col("found.n_words").alias("n_words"), n_hit.alias("n_hit"), n_items.alias("n_items"),
                        F.sha2(F.coalesce(F.array_join("found.items", ","), F.lit("")), 256).alias("items_sha256"),
                        verdict.alias("contaminated"))


#: Lower-cased A-Z and cut into words, as all operators do.
WORDS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE["op10_benchmark_decontamination"] = f"""
WITH items AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
windows AS (
    SELECT item_id, len(w) AS n, array_to_string(w, ' ') AS x FROM items WHERE len(w) BETWEEN 1 AND 12
    UNION ALL
    SELECT item_id, 13, array_to_string(w[i:i + 12], ' ')
    FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM items WHERE len(w) >= 13)),
places AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT r, i, n, item_id FROM places JOIN windows USING (n, x)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
           FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its lines that later documents repeat."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.without_repeats(docs, "found").select(
        "doc_id", "found.n_lines", "found.n_dropped", F.sha2("found.kept", 256).alias("kept_sha256"))


ORACLE["op8_line_dedup"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
    SELECT r, doc_id, i, l[i] AS line,
           translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT r, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM docs)),
repeated AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
             GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT r, doc_id, i, line, coalesce(doc_id < keeper, false) AS gone FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document and the number of texts its own is linked with."""
    return near.near_copies(table(spark, sf_dir, "documents"))


@query
def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of every twentieth vector."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE["op1_exact_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, by a network that the held-out fifth had no part in."""
    docs = table(spark, sf_dir, "documents")
    out = quality.held_out(F.col("doc_id"), 5, 0)
    network = quality.fit(docs, table(spark, sf_dir, "labels"), ~out)
    return quality.score(docs, network, ["doc_id"], "judged").select(
        "doc_id", out.alias("held_out"), F.col("judged.score").alias("score"),
        (F.col("judged.score") >= quality.KEEP_FROM).cast("int").alias("predicted"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by centroids that the held-out third had no part in."""
    docs = table(spark, sf_dir, "documents")
    out = quality.held_out(F.col("doc_id"), 3, 1)
    model = language.fit(docs, ~out)
    return language.predict(docs, model, ["doc_id"], "found").select(
        "doc_id", out.alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template matches of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


TEMPLATES_SQL = ", ".join(f"('{label}', '{text}', {licenses.span_of(text)})" for label, text in licenses.TEMPLATES)
PHRASES_SQL = " UNION ALL ".join(
    f"SELECT r, i - 1 AS p, '{label}' AS label FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs) "
    f"WHERE array_to_string(w[i:i + {len(phrase.split()) - 1}], ' ') = '{phrase}'" for phrase, label in licenses.PHRASES)

ORACLE["op2_license_scan"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text, {WORDS_SQL} AS w FROM documents),
templates AS (SELECT label, span, list_distinct(string_split(t, ' ')) AS tokens FROM (VALUES {TEMPLATES_SQL}) x(label, t, span)),
places AS ({PHRASES_SQL}),
base AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word FROM places GROUP BY r),
texts AS (SELECT r, w, label, span, tokens FROM docs, templates
          WHERE len(list_intersect(list_distinct(w), tokens)) / len(tokens)::DOUBLE >= {licenses.THRESHOLD}),
blocks AS (SELECT label, r, tokens, list_distinct(w[i:i + span - 1]) AS b
           FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM texts) WHERE list_contains(tokens, w[i])),
shares AS (SELECT r, label, len(list_intersect(b, tokens)) / len(tokens)::DOUBLE AS share FROM blocks),
own AS (SELECT r, label, max(share) AS share FROM shares WHERE share >= {licenses.THRESHOLD} GROUP BY r, label),
lists AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels
          FROM (SELECT r, label FROM own UNION SELECT r, label FROM places) GROUP BY r),
bases AS (SELECT r, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT r, label FROM places) GROUP BY r),
best AS (SELECT r, max(share) AS share FROM own GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0) END::DOUBLE AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN lists USING (r) LEFT JOIN bases USING (r) LEFT JOIN best USING (r)
"""


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document, how many the method has added, and whether there is any."""
    found = pii.find(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
                        pii.listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
                        (F.size(F.concat("base", "added")) > 0).alias("private"))


@query
def op3_training_order_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of all documents in training order, bytes as tokens."""
    return shards.digests(shards.slotted(table(spark, sf_dir, "documents")))


#: Shards of the query.
SHARDS = 16


@query
def op11_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document, and its shard when one more is added."""
    return sharding.assign(table(spark, sf_dir, "documents"), sharding.layout(SHARDS), sharding.layout(SHARDS + 1))


def crc32_entry(byte: int) -> int:
    """The remainder that CRC-32, polynomial EDB88320 in reverse bit order, has for one byte."""
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
    return byte


def draws_sql(nodes: str) -> str:
    """The path with the smallest draw of `nodes`, a table of (key, parent, path, weight), for each key and parent."""
    u = f"(('0x' || substr(md5(key || path), 1, {sharding.DIGITS}))::BIGINT + 0.5) / {16 ** sharding.DIGITS}::DOUBLE"
    return f"SELECT key, arg_min(path, -ln({u}) / weight) AS path FROM ({nodes}) GROUP BY key"


def descent_sql(name: str, tree: sharding.Tree) -> str:
    """Tables by which `name` gets (key, path), the leaf of each key in keys."""
    tables, above = [], "(SELECT key, '' AS path FROM keys)"
    for depth, level in enumerate(sharding.children(tree)):
        nodes = ", ".join(f"('{parent}', '{path}', {weight}::DOUBLE)" for parent, below in level.items() for path, weight in below.items())
        nodes = f"SELECT key, x.path, weight FROM {above} a JOIN (VALUES {nodes}) x(parent, path, weight) ON x.parent = a.path"
        above = f"{name}{depth}" if depth < 2 else name
        tables.append(f"{above} AS ({draws_sql(nodes)})")
    return ",\n".join(tables)


ORACLE["op11_hash_tree_sharding"] = f"""
WITH docs AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, coalesce(text, '') AS text FROM documents),
keys AS (SELECT DISTINCT key FROM docs),
{descent_sql("now", sharding.layout(SHARDS))},
{descent_sql("later", sharding.layout(SHARDS + 1))},
remainders AS (SELECT [{", ".join(str(crc32_entry(b)) for b in range(256))}]::BIGINT[] AS k),
summed AS (
    SELECT doc_id, key, len(b) + 1 AS size,
           xor(list_reduce(b, lambda c, x: xor(c >> 8, k[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32
    FROM (SELECT doc_id, key, list_transform(regexp_extract_all(hex(text), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM docs), remainders),
placed AS (
    SELECT doc_id, size::BIGINT AS size, text_crc32, string_split(n.path, '/')[4]::INTEGER AS shard, string_split(l.path, '/')[4]::INTEGER AS grown_shard
    FROM summed JOIN now n USING (key) JOIN later l USING (key))
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, size, text_crc32) - 1 AS slot
FROM placed
"""


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item."""
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op12_ranked_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS t FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, {WORDS_SQL} AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
wanted AS (SELECT i, term, count(*) AS q FROM (SELECT i, unnest(t) AS term FROM items) GROUP BY ALL),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs)
         WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
totals AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM docs WHERE len(t) > 0),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY term),
lengths AS (SELECT r, doc_id, 25 + (75 * len(t) * n) // l AS m FROM docs, totals WHERE len(t) > 0 AND doc_id IS NOT NULL),
scores AS (SELECT i, r, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (r) GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank
           FROM scores JOIN items USING (i) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {ranking.K}
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that are almost as near to an anchor as its positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLE["op13_hard_negatives"] = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
           FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {negatives.POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND {negatives.SHARES[0]} * positive_score <= 100 * score AND 100 * score <= {negatives.SHARES[1]} * positive_score
QUALIFY rank <= {negatives.NEGATIVES}
"""
