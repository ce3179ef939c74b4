"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions and racks. A row's key descends it: at each level every child
draws -ln(u) / weight, u being a hash of the key and the child's path, and the smallest draw wins, so a
child gets rows in proportion to its weight. A draw depends on the child alone. Where weights change, rows
move only into subtrees that became heavier or out of those that became lighter; all others stay in
their region, rack and shard. Shards that are added later get a region each (`layout`), so that a new
one takes rows into itself only.

The descent is one column expression whose size is that of the tree; a row hashes the children of three
nodes. Slots number the rows of a shard without gaps: narrow rows are dealt in ranges of equal size, numbered
inside each, and the sizes of the shard's earlier ranges are added, so no task holds a whole shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from nestline.llm.buffers import free_name
from nestline.llm.licenses import bound
from nestline.sources.scratch import written

#: region -> rack -> shard -> weight.
Tree = dict[str, dict[str, dict[int, float]]]
#: Shards of the first layout, racks of a region and shards of a rack in it.
FIRST, RACKS, PER_RACK = 16, 2, 2
#: Hexadecimal digits of a hash that make a draw.
DIGITS = 13


def layout(shards: int, first: int = FIRST, weight: float = 1.0) -> Tree:
    """The tree of `shards` equal shards: the first ones in full regions, each later one in a region of its own."""
    tree: Tree = {}
    for shard in range(shards):
        region, rack = shard // (RACKS * PER_RACK), shard // PER_RACK % RACKS
        if shard >= first:
            region, rack = f"added-{shard}", 0
        tree.setdefault(str(region), {}).setdefault(str(rack), {})[shard] = weight
    return tree


def children(tree: Tree) -> list[dict[str, dict[str, float]]]:
    """For each level the path of a node, and its children's paths with their weights; without those of weight 0."""
    levels: list[dict[str, dict[str, float]]] = [{"": {}}, {}, {}]
    for region, racks in tree.items():
        for rack, shards in racks.items():
            for shard, weight in shards.items():
                if weight < 0 or "/" in f"{region}{rack}":
                    raise ValueError(f"weight {weight} of shard {shard} is below 0, or a name in {region}, {rack} has a slash")
                path = ""
                for level, name in zip(levels if weight else (), (region, rack, shard)):
                    below = level.setdefault(path, {})
                    path = f"{path}/{name}"
                    below[path] = below.get(path, 0.0) + weight
    if not levels[0][""]:
        raise ValueError("no shard has a weight above 0")
    return levels


def drawn(key: Column, nodes: Column) -> Column:
    """Of an array of (path, weight) the path with the smallest draw."""
    def draw(node: Column) -> Column:
        digest = F.md5(F.concat(key, node["path"]))
        u = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** DIGITS)
        return F.struct((-F.ln(u) / node["weight"]).alias("draw"), node["path"].alias("path"))
    return F.array_min(F.transform(nodes, draw))["path"]


def path_of(key: Column, tree: Tree) -> Column:
    """/region/rack/shard of a row. A null key is the empty one."""
    def listed(nodes: dict[str, float]) -> Column:
        return F.array(*[F.struct(F.lit(path).alias("path"), F.lit(float(weight)).alias("weight")) for path, weight in nodes.items()])

    def below(path: Column, level: dict[str, dict[str, float]]) -> Column:
        nodes = F.create_map(*[x for parent, under in level.items() for x in (F.lit(parent), listed(under))])
        return bound(path, lambda at: drawn(name, nodes[at]))

    name = F.coalesce(key.cast("string"), F.lit(""))
    top, racks, shards = children(tree)
    return below(below(drawn(name, listed(top[""])), racks), shards)


def shard_in(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1).cast("int")


def placed(docs: DataFrame, tree: Tree, key: str = "doc_id", result: str = "shard") -> DataFrame:
    """All columns of docs and `result`, the shard that the key and the tree decide on."""
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], shard_in(path_of(F.col(f"`{key}`"), tree)).alias(result))


def moved(docs: DataFrame, before: Tree, after: Tree, key: str = "doc_id") -> DataFrame:
    """(path_before, path_after, n): how many rows lie where in the two trees."""
    old, new = (path_of(F.col(f"`{key}`"), tree) for tree in (before, after))
    return docs.groupBy(old.alias("path_before"), new.alias("path_after")).agg(F.count(F.lit(1)).alias("n"))


def slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """`rows`, written, with `slot`: the row's place in its shard by the columns `order`, nulls last, from 0.

    Rows equal in all of `order` are told apart by where they are written, so a row that repeats many times
    is spread as well; which of them gets which of their slots is left open.
    """
    by = [F.asc(shard), *[F.asc_nulls_last(c) for c in order]]
    part, spot = free_name(rows, "part"), free_name(rows, "spot")
    spread = written(rows, "placed").withColumn(spot, F.xxhash64("_metadata.file_name", "_metadata.row_index"))
    dealt = written(spread.repartitionByRange(*by, F.asc(spot)).withColumn(part, F.spark_partition_id()).drop(spot), "dealt")
    sizes = dealt.groupBy(shard, part).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(shard).alias("of_shard"), F.col(part).alias("of_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy(shard, part).orderBy(*by[1:]))
    return (dealt.withColumn("slot", place).join(starts, (F.col(shard) == F.col("of_shard")) & (F.col(part) == F.col("of_part")))
            .withColumn("slot", (F.col("start") + F.col("slot") - 1).cast("long")).drop(part, "of_shard", "of_part", "start"))


def assign(docs: DataFrame, tree: Tree, grown: Tree, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row: where it is in `tree` and where in
    `grown`. The law is `key`: the id and the tree decide, equal ids share a shard, whatever their texts.

    The size is that of the text in UTF-8 plus 1; a null text has no bytes. Rows without id share the empty
    key and come last in their shard. Slots follow id, size and checksum; repeated rows have a slot each.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    key = F.col(f"`{doc}`")
    rows = docs.select(key.cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
                       F.lit("key").alias("law"), shard_in(path_of(key, tree)).alias("shard"), shard_in(path_of(key, grown)).alias("grown_shard"))
    return slots(rows, "shard", ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write(docs: DataFrame, tree: Tree, path: str, key: str = "doc_id") -> None:
    """Writes docs as Parquet below `path`, a folder for each region, rack and shard. A shard of many rows is
    written by many tasks."""
    where = free_name(docs, "where_to")
    names = [free_name(docs, name) for name in ("region", "rack", "shard")]
    parts = F.split(where, "/")
    rows = docs.withColumn(where, path_of(F.col(f"`{key}`"), tree)).withColumns({name: F.get(parts, F.lit(k + 1)) for k, name in enumerate(names)})
    rows.drop(where).hint("rebalance", *names).write.partitionBy(*names).parquet(path)
