"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A tree has regions, racks and shards. A row descends it level by level: every child of the node it has come to draws
-ln(u) / weight, with u hashed from the row's key and the child's name and weight the sum of the shards below it, and
the least draw wins. A child is chosen with a chance in proportion to its weight. Where weights change, only draws of
nodes with another sum change: rows move only into or out of those, and within them only below nodes that changed in
turn. Weight shifted between two shards of a rack moves no row of another rack.

A tree may hold places for shards to come: closed shards, which count in the sums but take no rows. A row that comes to
one descends again with other draws, until it comes to an open shard. To open a shard changes no sum, so the only rows
that move are those that had come to it before, and they move into it. Where no place is left, a shard is added as a
region of its own, which changes no other sum either.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, let


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0
    open: bool = True

    @property
    def path(self) -> tuple[str, str, str]:
        """Names of the nodes down to it, each unique in the tree."""
        return self.region, f"{self.region}/{self.rack}", f"{self.region}/{self.rack}/{self.shard}"


#: Places of an even tree before shards are added as regions of their own, and descents of a row before it draws among all
#: open shards at once.
PLACES, DESCENTS = 32, 48


def even_tree(shards: int = 24, per_rack: int = 4, racks: int = 2) -> tuple[Leaf, ...]:
    """Equal shards, per_rack to a rack and racks to a region, in a tree of PLACES places; more are regions of their own.

    even_tree(n + 1) is grown(even_tree(n)), so the number of shards decides the tree.
    """
    placed = [Leaf(f"region{i // per_rack // racks}", f"rack{i // per_rack % racks}", i, open=i < shards) for i in range(PLACES)]
    return (*placed, *(Leaf(f"added{i}", "rack0", i) for i in range(PLACES, shards)))


def grown(tree: tuple[Leaf, ...], weight: float = 1.0) -> tuple[Leaf, ...]:
    """tree with one more shard: the first closed one opened, with its own weight, or one of this weight in a region of
    its own. Rows move into the new shard only."""
    closed = next((i for i, x in enumerate(tree) if not x.open), None)
    if closed is not None:
        return (*tree[:closed], replace(tree[closed], open=True), *tree[closed + 1 :])
    shard = max((x.shard for x in tree), default=-1) + 1
    return (*tree, Leaf(f"added{shard}", "rack0", shard, weight))


def sums(tree: tuple[Leaf, ...]) -> dict[str, dict[str, float]]:
    """Of each inner node (the root is an empty name) the children and their weights."""
    out: dict[str, dict[str, float]] = {}
    for leaf in tree:
        for node, child in zip(("", *leaf.path[:-1]), leaf.path, strict=True):
            below = out.setdefault(node, {})
            below[child] = below.get(child, 0.0) + leaf.weight
    return out


def _child(key: Column, children: Column, *again: Column) -> Column:
    """The name of the child with the least draw; u lies strictly between 0 and 1. again: the number of a later descent."""

    def draw(c: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, c["name"], *again), 11)
        return F.struct((-F.log((bits.cast("double") + 0.5) / float(1 << 53)) / c["weight"]).alias("draw"), c["name"].alias("name"))

    return F.array_min(F.transform(children, draw))["name"]


def descend(key: Column, tree: tuple[Leaf, ...]) -> Column:
    """The shard that a key comes to. Only the children of the nodes on its way draw, so a row costs as many hashes as
    these have, and not as many as there are shards. The tree is a constant of the plan."""
    nodes = sums(tree)
    entry = lambda name, weight: F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"))
    listed = F.map_from_arrays(F.array(*map(F.lit, nodes)), F.array(*[F.array(*[entry(n, w) for n, w in c.items()]) for c in nodes.values()]))
    taking = [x for x in tree if x.open]
    shards = F.map_from_arrays(F.array(*[F.lit(x.path[-1]) for x in taking]), F.array(*[F.lit(x.shard) for x in taking]))

    def leaf(*again: Column) -> Column:
        """The shard of one descent, null if it is closed."""
        region = _child(key, F.element_at(listed, F.lit("")), *again)
        rack = let(region, lambda r: _child(key, F.element_at(listed, r), *again))
        return let(let(rack, lambda r: _child(key, F.element_at(listed, r), *again)), lambda x: F.try_element_at(shards, x))

    if len(taking) == len(tree):
        return leaf()
    tried = F.aggregate(F.sequence(F.lit(1), F.lit(DESCENTS)), leaf(), lambda found, i: F.coalesce(found, leaf(i)))
    flat = F.array(*[entry(x.path[-1], x.weight) for x in taking])
    return F.coalesce(tried, F.element_at(shards, _child(key, flat)))


def place(rows: DataFrame, key: str, trees: dict[str, tuple[Leaf, ...]]) -> DataFrame:
    """rows with one int column for each tree: the shard that the row descends to.

    Weights must be above 0 and a shard open. A null key is a key like any other, so all null keys meet in one shard;
    equal keys do too. Narrow: no shuffle. A tree can't have the name of a column of rows.
    """
    if any(x.weight <= 0 for tree in trees.values() for x in tree):
        raise ValueError("weights must be above 0")
    if not all(any(x.open for x in tree) for tree in trees.values()):
        raise ValueError("a tree needs an open shard")
    if clash := {c.lower() for c in rows.columns} & {n.lower() for n in trees}:
        raise ValueError(f"rows have columns with the names of trees: {sorted(clash)}")
    return rows.withColumns({name: descend(F.col(key), tree) for name, tree in trees.items()})


def numbered(rows: DataFrame, shard: str, row: str, slot: str, bins: int = 1024) -> DataFrame:
    """rows with a gapless number from 0 within each shard.

    row names a column that is unique over all rows. A shard may hold any share of them, so its rows are numbered in
    `bins` parts by a hash of row, each after the parts before it. The parts' counts, at most shards x bins rows, are
    the only thing broadcast.
    """
    parts = rows.select(F.struct("*").alias("row"), F.col(shard).alias("shard"), F.col(row).alias("id"))
    parts = parts.withColumn("bin", F.pmod(F.xxhash64("id"), F.lit(bins)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    starts = counts.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("id")) - 1
    placed = parts.withColumn("within", within).join(F.broadcast(starts), ["shard", "bin"])
    return placed.select("row.*", (F.col("start") + F.col("within")).alias(slot))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Law `key`: doc_id and the number of shards decide each document's shard.

    Null text counts as no bytes (size 8, CRC of nothing). Repeated rows meet in one shard and each get a slot of their
    own. Other columns are not read, whatever their names.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.monotonically_increasing_id().alias("_row"),
    )
    tree = even_tree(shards)
    placed = cut(place(facts, "doc_id", {"shard": tree, "grown_shard": grown(tree)}))
    return numbered(placed, "shard", "_row", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard"
    )
