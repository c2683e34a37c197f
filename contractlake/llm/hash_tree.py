"""Sharding by a hierarchical weighted hash tree.

Regions hold racks, racks hold shards. A row descends from the root: at each level every child draws
ln(u) / weight with u hashed from the row's key and the child's name, and the largest draw wins, so children get rows in
proportion to their weights. Draws don't depend on the other children: when a child's weight rises, rows move only into
its subtree, and when it falls, only out of it. A shard that is added to a running layout gets a region of its own, so
the rows it takes are the only ones that move.

Draws are DataFrame expressions; only ids and sizes are shuffled, by ranges of (shard, id), which an id on many rows is spread over. Contract: a null key is a key of its own; a null text has
no bytes; repeated rows go to one shard and have neighbouring slots; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlake.llm.stage import saved
from contractlake.operators.ids import assign_dense_ids

REGION_RACKS, RACK_SHARDS = 2, 4


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; a shard has a number and no children."""
    name: str
    children: tuple[Node, ...] = ()
    own_weight: float = 1.0
    shard: int = -1

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def layout(shards: int, added: int = 0) -> Node:
    """The tree of ``shards`` equal shards set up at once, in regions of two racks of four, and ``added`` ones that came later."""
    regions = []
    for first in range(0, shards, REGION_RACKS * RACK_SHARDS):
        racks = []
        for rack in range(first, min(shards, first + REGION_RACKS * RACK_SHARDS), RACK_SHARDS):
            inside = range(rack, min(shards, rack + RACK_SHARDS))
            racks.append(Node(f"rack-{rack // RACK_SHARDS}", tuple(Node(f"shard-{s}", shard=s) for s in inside)))
        regions.append(Node(f"region-{first // (REGION_RACKS * RACK_SHARDS)}", tuple(racks)))
    for s in range(shards, shards + added):
        regions.append(Node(f"region-of-{s}", (Node(f"rack-of-{s}", (Node(f"shard-{s}", shard=s),)),)))
    return Node("root", tuple(regions))


def depth(node: Node) -> int:
    """Levels below ``node``; all shards must stand equally deep."""
    below = {depth(c) for c in node.children}
    if len(below) > 1:
        raise ValueError("all shards of a tree must be on one level")
    return 1 + below.pop() if below else 0


def nodes(node: Node) -> list[Node]:
    return [node, *(x for c in node.children for x in nodes(c))]


def draw(key: Column, name: Column, weight: Column) -> Column:
    """ln(u) / weight, with u in (0, 1) from the first 48 bits of md5(key/name)."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), name)), 1, 12), 16, 10).cast("double")
    return F.log((bits + F.lit(0.5)) / F.lit(float(1 << 48))) / weight


def descend(key: Column, tree: Node) -> Column:
    """The shard that ``key`` reaches; nodes without weight get nothing, ties go to the later name. Names are unique in a tree."""
    def child(c: Node) -> Column:
        return F.struct(F.lit(c.name).alias("name"), F.lit(float(c.weight)).alias("weight"))

    every = nodes(tree)
    children = F.create_map(*[x for n in every if n.children for x in (F.lit(n.name), F.array(*[child(c) for c in n.children if c.weight > 0]))])
    at = F.lit(tree.name)
    for _ in range(depth(tree)):
        draws = F.transform(F.element_at(children, at), lambda c: F.struct(draw(key, c["name"], c["weight"]).alias("draw"), c["name"].alias("name")))
        at = F.array_max(draws)["name"]
    return F.element_at(F.create_map(*[x for n in every if not n.children for x in (F.lit(n.name), F.lit(n.shard))]), at)


def place(docs: DataFrame, tree: Node, grown: Node | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard), one per input row. ``slot`` numbers a shard's rows by id without gaps."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       descend(key, tree).alias("shard"), (descend(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "placed")  # tells equal rows apart: no key fills a partition
    ranked = assign_dense_ids(rows, ["shard", "id", "text_crc32", "size", "row"], "rank", start=0)
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first"))  # a row for each shard of the layout
    return (ranked.join(F.broadcast(first), "shard")
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("rank") - F.col("first")).alias("slot"), "grown_shard"))
