"""Prefix trie of conversations with subtree totals, rolled up by bands of depth.

A node is a distinct sequence of first turns. Its name is its depth and a running sum of
92-bit hashes of (position, turn), so the prefixes of a conversation of any length come
from running totals over blocks of turns. (Two of n nodes share a name with a probability
of about n^2 / 1e28.)

Subtree totals. Depths are cut into bands of a fixed height. Inside a band each node adds
its value to its ancestors there, at most ``band`` of them. The tops of the bands then form
a smaller trie, in which the same is done with bands of bands; the completed total of a
top goes to the ancestors of its parent in the band above. So a trie of depth D takes
log(D) / log(band) levels, and no node meets more than ``band`` ancestors in one.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typerank.llm.common import dropped, staged
from typerank.operators.ordered import add_start, block_starts, positions

#: Turns of a conversation that one task orders, by the width of a block of turn numbers.
BLOCK_BITS = 10
#: Ids in one packed row of a node's list.
IDS = 4096
NAME = "decimal(38,0)"


@dataclass(frozen=True)
class Trie:
    """nodes(depth, name, parent, conv_id, parent_conv_id, n_convs, n_children, bytes,
    n_leaves, saved, turn_hash) and ends(conv, depth, name): where each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, role, text, turn_hash, bytes): turns from 0 on, null turn numbers first,
    ties by role and then text; null role or text is empty. Rows without a conversation
    are left out."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn(
        "block", F.coalesce(F.shiftright("turn", BLOCK_BITS), F.lit(-(1 << 60)))
    ).withColumn("order", F.struct("turn", "role", "text"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return positions(rows, ["conv"], "block", "order").select(
        "conv", "pos", "role", "text", digest.alias("turn_hash"), F.octet_length("text").cast("long").alias("bytes")
    )


def shared_histories(turns: DataFrame, group: int = 5, longest: int = 8) -> tuple[DataFrame, DataFrame]:
    """(conversations (conv), their turns (conv, depth, turn_hash, bytes)), rebuilt: the
    first h turns of the first conversation of each ``group`` ids, then the own turns
    after the first h, where h is the CRC-32 of the id modulo ``longest`` + 1.

    ``turns`` is a stored table. A first conversation is sent to at most ``group`` others,
    with at most ``longest`` turns.
    """
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select(
        "conv",
        "n",
        (F.col("conv") - F.col("conv") % group).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % (longest + 1)).alias("h"),
    )
    convs = staged(convs, "convs")
    lengths = convs.select(F.col("conv").alias("base"), F.col("n").alias("there"))
    convs = staged(
        convs.join(lengths, "base", "left").select(
            "conv", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("have")
        ),
        "convs",
    )
    heads = turns.where(F.col("pos") < longest).select(F.col("conv").alias("base"), "pos", "turn_hash", "bytes")
    taken = convs.join(heads, "base").where("pos < h")
    own = turns.drop("role", "text").join(convs, "conv").where("pos >= h")
    rows = taken.select("conv", (F.col("pos") + 1).alias("depth"), "turn_hash", "bytes").union(
        own.select("conv", (F.col("pos") - F.col("h") + F.col("have") + 1).alias("depth"), "turn_hash", "bytes")
    )
    return convs.select("conv"), staged(rows, "rebuilt")


def _number(digest: Column) -> Column:
    """The first 92 bits of a hexadecimal digest."""
    part = lambda at, n: F.conv(F.substring(digest, at, n), 16, 10).cast("decimal(15,0)")
    return (part(1, 11) * F.lit(1 << 48).cast("decimal(15,0)") + part(12, 12)).cast("decimal(28,0)")


def named_prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, turn_hash, bytes) with ``name`` and ``parent``, the name before."""
    value = _number(F.sha2(F.concat_ws(":", "depth", "turn_hash"), 256))
    rows = rows.withColumn("value", value).withColumn("block", F.shiftright("depth", BLOCK_BITS))
    starts = block_starts(rows, ["conv"], "block", F.col("value"))
    before = add_start(rows, starts, ["conv"], "block", "depth", F.col("value"), "before")
    return before.select(
        "conv",
        "depth",
        "turn_hash",
        "bytes",
        (F.col("before") + F.col("value")).cast(NAME).alias("name"),
        F.col("before").cast(NAME).alias("parent"),
    )


def _root(convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast(NAME)
    return convs.select("conv", F.lit(0).cast("long").alias("depth"), zero.alias("name"))


def _nodes(convs: DataFrame, members: DataFrame) -> DataFrame:
    """Every node with its smallest member, its parent's, and its number of children."""
    found = members.groupBy("depth", "name").agg(
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("parent").alias("parent"),
        F.first("bytes").alias("bytes"),
        F.first("turn_hash").alias("turn_hash"),
    )
    root = _root(convs).groupBy("depth", "name").agg(
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.lit(None).cast(NAME).alias("parent"),
        F.lit(0).cast("long").alias("bytes"),
        F.lit(None).cast("string").alias("turn_hash"),
    )
    found = staged(found.unionByName(root), "nodes")
    above = found.select(
        (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    below = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    below = staged(below, "children")
    tree = found.join(above, ["depth", "parent"], "left").join(below, ["depth", "name"], "left")
    tree = staged(tree.fillna(0, ["n_children"]), "tree")
    dropped(found, below)
    return tree


def _paths(spine: DataFrame, nodes: DataFrame, step: int, band: int) -> DataFrame:
    """(depth, name, above, top): for each node whose depth is a multiple of ``step``, the
    ancestors of its band with itself; and, ``top``, for the first node of a band, the
    ancestors of the band before."""
    at = spine.where(F.col("depth") % step == 0)
    number = F.floor(F.col("depth") / (step * band))
    own = at.withColumn("band", number).withColumn("top", F.lit(False))
    tops = at.where((F.col("depth") > 0) & (F.col("depth") % (step * band) == 0))
    tops = tops.withColumn("band", number - 1).withColumn("top", F.lit(True))
    so_far = W.partitionBy("conv", "band").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    above = F.collect_list(F.when(~F.col("top"), F.struct("depth", "name"))).over(so_far)
    # One conversation of each node tells its path.
    first = nodes.select(F.col("conv_id").alias("conv"), "depth")
    return own.union(tops).withColumn("above", above).join(first, ["conv", "depth"], "left_semi").select(
        "depth", "name", "above", "top"
    )


def _added(values: DataFrame, paths: DataFrame) -> DataFrame:
    """(depth, name, leaves, saved) added up over the ancestors that ``paths`` list."""
    each = values.join(paths.select("depth", "name", "above"), ["depth", "name"])
    return each.select("leaves", "saved", F.inline("above")).groupBy("depth", "name").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )


def subtree_totals(spine: DataFrame, nodes: DataFrame, values: DataFrame, deepest: int, band: int, step: int = 1) -> DataFrame:
    """(depth, name, leaves, saved) of the subtree of each node with a depth that is a
    multiple of ``step``; ``values`` has such nodes' own."""
    paths = staged(_paths(spine, nodes, step, band), "paths")
    inside = staged(_added(values, paths.where("NOT top")), "inside")
    if deepest < step * band:
        dropped(paths)
        return inside
    tops = inside.where(F.col("depth") % (step * band) == 0)
    complete = subtree_totals(spine, nodes, tops, deepest, band, step * band)
    handed = _added(complete.where("depth > 0"), paths.where("top"))
    total = inside.union(handed).groupBy("depth", "name").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    total = staged(total, "totals")
    dropped(paths, inside, complete)
    return total


def prefix_trie(convs: DataFrame, rows: DataFrame, band: int = 4) -> Trie:
    """Trie of the conversations ``convs`` (conv) with turns ``rows`` (conv, depth from 1,
    turn_hash, bytes), both stored.

    A conversation without turns is a member of the root only. ``saved`` of a subtree:
    each node's (members - 1) times the bytes of its last text. No conversation, no node.
    """
    members = staged(named_prefixes(rows), "members")
    tree = _nodes(convs, members)
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    spine = members.select("conv", "depth", "name").union(_root(convs))
    own = tree.select(
        "depth",
        "name",
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    totals = subtree_totals(spine, tree, own, deepest, band)
    nodes = tree.join(totals.withColumnRenamed("leaves", "n_leaves"), ["depth", "name"])
    last = members.groupBy("conv").agg(F.max(F.struct("depth", "name")).alias("last"))
    ends = convs.join(last, "conv", "left").select(
        "conv",
        F.coalesce("last.depth", F.lit(0).cast("long")).alias("depth"),
        F.coalesce("last.name", F.lit(0).cast(NAME)).alias("name"),
    )
    return Trie(nodes, staged(ends, "ends"))


def node_texts(trie: Trie, turns: DataFrame) -> DataFrame:
    """(depth, conv_id, role, text): the last turn of each node."""
    said = turns.groupBy("turn_hash").agg(F.min(F.struct("role", "text")).alias("said"))
    return trie.nodes.join(said, "turn_hash").select("depth", "conv_id", "said.role", "said.text")


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256): SHA-256 of the ids that end at a node, ascending and
    joined by commas.

    A node may hold a third of all ends. They are sorted by ranges that split a node and
    packed into rows of ``IDS`` ids; the digest of a node then reads its packed rows one
    by one.
    """

    def pack(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            conv, depth, name = (batch.column(c).to_pylist() for c in ("conv", "depth", "name"))
            rows, first = [], 0
            for i in range(1, len(conv) + 1):
                if i == len(conv) or i - first == IDS or (depth[i], name[i]) != (depth[first], name[first]):
                    rows.append((depth[first], name[first], conv[first], ",".join(map(str, conv[first:i]))))
                    first = i
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), packed.types)], packed.names
                )

    def digest(batches: Iterator[pa.RecordBatch]):
        node, state, out = None, None, []
        for batch in batches:
            for depth, name, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "ids"))):
                if (depth, name) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = (depth, name), hashlib.sha256(ids.encode())
            if out:
                yield table(out)
                out = []
        if node:
            yield table([(*node, state.hexdigest())])

    def table(rows):
        types = [pa.int64(), pa.decimal128(38, 0), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["depth", "name", "ends_sha256"]
        )

    packed = pa.schema(
        [("depth", pa.int64()), ("name", pa.decimal128(38, 0)), ("first", pa.int64()), ("ids", pa.string())]
    )
    ranges = ends.select("conv", "depth", "name").repartitionByRange("depth", "name", "conv")
    ranges = ranges.sortWithinPartitions("depth", "name", "conv")
    lists = ranges.mapInArrow(pack, f"depth long, name {NAME}, first long, ids string")
    lists = lists.repartition("depth", "name").sortWithinPartitions("depth", "name", "first")
    return lists.mapInArrow(digest, f"depth long, name {NAME}, ends_sha256 string")


def described(trie: Trie) -> DataFrame:
    """One row a node, with the digest of the conversations that end there."""
    nobody = hashlib.sha256(b"").hexdigest()
    return trie.nodes.join(end_digests(trie.ends), ["depth", "name"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
    )
