"""Conversation prefix trie: what conversations share from their start, and what that saves.

Turns are encoded by a dictionary of the distinct (role, text), so a conversation is a path of
numbers. Equal paths are one row; the distinct ones are dealt over shards by range, and every
shard builds a ternary search tree of its sorted paths, medians first, which keeps it balanced.
A plain loop over its nodes, children before parents, accumulates members, children, leaves
and savings.

Only prefixes of a shard's first or last path can have members in other shards. These
boundary nodes leave a shard with what hangs on them inside it, are merged by a key chained
from their turns, and sum their subtrees by pointer doubling, in as many rounds as the depth
has binary digits. Everything else is final in its shard.

A task holds one shard (about ``SHARD`` numbers, plus one path); a path of its own is as long
as its conversation. Members of a node with a digest of their own are read as a sorted
stream, never held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from timepoint.llm.common import durable

#: Numbers (turns of distinct paths) of a shard on average.
SHARD = 1 << 17
#: Fixed by the contract: bases are every hundredth conversation, heads have up to five turns.
EVERY, HEADS = 100, 6
_ROOT = b"root"
_NODE = (
    "shard int, key binary, parent_key binary, depth bigint, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, n bigint, ends_sha256 string"
)
_EMPTY_HASH = hashlib.sha256(b"").hexdigest()


class TernaryTree:
    """A ternary search tree of paths; each of its nodes is one node of the trie."""

    def __init__(self) -> None:
        # node 0 is the textless root, which has no symbol
        self.symbol: list[int] = [0]
        self.low, self.high, self.equal = [0], [0], [0]
        self.up: list[int] = [0]
        self.depth: list[int] = [0]
        self.length: list[int] = [0]
        self.members: list[int] = [0]
        self.smallest: list[int] = [np.iinfo(np.int64).max]
        self.ends: list[str | None] = [None]

    def _node(self, symbol: int, length: int, up: int) -> int:
        self.symbol.append(symbol)
        for links in (self.low, self.high, self.equal, self.members):
            links.append(0)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        self.length.append(length)
        self.smallest.append(np.iinfo(np.int64).max)
        self.ends.append(None)
        return len(self.symbol) - 1

    def _child(self, at: int, symbol: int, length: int) -> int:
        """The child of ``at`` with ``symbol``, made if there is none."""
        found = self.equal[at]
        if not found:
            self.equal[at] = self._node(symbol, length, at)
            return self.equal[at]
        while self.symbol[found] != symbol:
            side = self.low if symbol < self.symbol[found] else self.high
            if not side[found]:
                side[found] = self._node(symbol, length, at)
                return side[found]
            found = side[found]
        return found

    def insert(self, path: list[int], lengths: list[int], n: int, smallest: int, ends: str) -> None:
        """A path that ``n`` conversations have, of which ``smallest`` is the first."""
        at = 0
        self._count(at, n, smallest)
        for symbol, length in zip(path, lengths, strict=True):
            at = self._child(at, symbol, length)
            self._count(at, n, smallest)
        self.ends[at] = ends

    def _count(self, at: int, n: int, smallest: int) -> None:
        self.members[at] += n
        if smallest < self.smallest[at]:
            self.smallest[at] = smallest

    def along(self, path: list[int]) -> list[int]:
        """The nodes of a path that is in the tree, root first."""
        nodes = [0]
        for symbol in path:
            nodes.append(self._child(nodes[-1], symbol, 0))
        return nodes

    def subtrees(self, boundary: set[int]) -> tuple[list[int], list[int], list[int]]:
        """Children, leaves and savings per node; boundary nodes have only what is inside.

        A node is made after its parent, so the last nodes come first here.
        """
        size = len(self.symbol)
        children, leaves, saved = [0] * size, [0] * size, [0] * size
        for at in range(size - 1, -1, -1):
            if at in boundary:
                continue
            if not children[at]:
                leaves[at] = 1
            saved[at] += (self.members[at] - 1) * self.length[at]
            up = self.up[at]
            children[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
        return children, leaves, saved


def _medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves, and so on."""
    spans = [(0, n)]
    for start, stop in spans:
        if start < stop:
            middle = (start + stop) // 2
            yield middle
            spans += [(start, middle), (middle + 1, stop)]


def _shard_nodes(batches: Iterator[pa.RecordBatch], shard: int) -> dict[str, list] | None:
    """The nodes of one shard's sorted paths."""
    paths, lengths, first, counts, ends = [], [], [], [], []
    for batch in batches:
        lists = batch.column("path")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).tolist()
        turns = lists.flatten()
        ids, n = (turns.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        at = 0
        for size in sizes:
            # arrays of numbers until a path is inserted
            paths.append(ids[at : at + size])
            lengths.append(n[at : at + size])
            at += size
        first += batch.column("first").to_pylist()
        counts += batch.column("n_convs").to_pylist()
        ends += batch.column("ends").to_pylist()
    if not paths:
        return None
    tree = TernaryTree()
    for k in _medians(len(paths)):
        tree.insert(paths[k].tolist(), lengths[k].tolist(), counts[k], first[k], ends[k])
    keys: dict[int, bytes] = {0: _ROOT}
    for path in (paths[0], paths[-1]):
        for at in tree.along(path.tolist())[1:]:
            if at not in keys:
                symbol = int(tree.symbol[at]).to_bytes(8, "big", signed=True)
                keys[at] = hashlib.blake2b(keys[tree.up[at]] + symbol, digest_size=16).digest()
    children, leaves, saved = tree.subtrees(set(keys))
    nodes = range(len(tree.symbol))
    return {
        "shard": [shard] * len(nodes),
        "key": [keys.get(at) for at in nodes],
        "parent_key": [keys.get(tree.up[at]) if at else None for at in nodes],
        "depth": tree.depth,
        "conv_id": tree.smallest,
        "parent_conv_id": [tree.smallest[tree.up[at]] if at else None for at in nodes],
        "n_convs": tree.members,
        "n_children": children,
        "n_leaves": leaves,
        "saved_tokens": saved,
        "n": tree.length,
        "ends_sha256": tree.ends,
    }


def _sharded(paths: DataFrame, shards: int) -> DataFrame:
    """All shards' nodes, those of inner prefixes final, the others to be merged by ``key``."""
    schema = T.StructType.fromDDL(_NODE)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = _shard_nodes(batches, TaskContext.get().partitionId())
        if nodes is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[f.name], type=f.type) for f in arrow], schema=arrow
            )

    ordered = paths.repartitionByRange(shards, "path").sortWithinPartitions("path")
    return ordered.select("path", "first", "n_convs", "ends").mapInArrow(run, schema)


def _subtree_sums(edges: DataFrame) -> DataFrame:
    """(key, n_leaves, saved_tokens) summed over the subtrees of the boundary tree.

    After k rounds a node has the sum of its descendants less than 2^k below it and points
    2^k up; who points at a node is exactly what the next round adds to it.
    """
    deepest = edges.agg(F.max("depth")).first()[0] or 0
    sums = edges.select("key", F.col("parent_key").alias("jump"), "n_leaves", "saved_tokens")
    reach = 1
    while reach <= deepest:
        gain = sums.filter("jump is not null").groupBy(F.col("jump").alias("key")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved")
        )
        further = (
            sums.filter("jump is not null")
            .select("key", "jump")
            .join(sums.select(F.col("key").alias("jump"), F.col("jump").alias("_jump")), "jump")
            .select("key", F.col("_jump").alias("jump"))
        )
        sums = durable(
            sums.drop("jump")
            .join(further, "key", "left")
            .join(gain, "key", "left")
            .select(
                "key",
                "jump",
                (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens"),
            )
        )
        reach *= 2
    return sums.drop("jump")


_RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _merged(nodes: DataFrame) -> DataFrame:
    """The trie of all shards from their nodes."""
    inner, edge = nodes.filter("key is null"), nodes.filter("key is not null")
    joined = edge.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"),
        F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.max("n").alias("n"),
        F.max("ends_sha256").alias("ends_sha256"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    below = edge.filter("parent_key is not null").select("key", "parent_key").distinct()
    below = below.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("_below"))
    n_children = F.col("n_children") + F.coalesce("_below", F.lit(0))
    edges = durable(
        joined.join(below, "key", "left")
        .withColumn("n_children", n_children)
        .withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("n"))
        .drop("_below", "n")
    )
    parents = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    whole = edges.drop("n_leaves", "saved_tokens").join(_subtree_sums(edges), "key")
    # a shard's own copy of its boundary: the root's many children stay in their shards
    here = edge.select("shard", F.col("key").alias("parent_key")).join(parents, "parent_key")
    children = inner.filter("parent_key is not null").drop("parent_conv_id")
    found = [
        inner.filter("parent_key is null"),
        children.join(here, ["shard", "parent_key"]),
        whole.join(parents, "parent_key", "left"),
    ]
    out = [
        rows.select(*_RESULT[:-1], F.coalesce("ends_sha256", F.lit(_EMPTY_HASH)).alias("ends_sha256"))
        for rows in found
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])


def _list_hashes(members: DataFrame) -> DataFrame:
    """(first, ends): SHA-256 of the ascending conv_ids of each ``first``, comma-joined.

    Read as a stream in order; the digest takes them as they come, so a list of any length
    needs no memory. One list is one digest, which cannot be split over tasks.
    """
    arrow = pa.schema([("first", pa.int64()), ("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, hashlib.sha256()
        for batch in batches:
            first = batch.column("first").to_numpy()
            starts = np.flatnonzero(np.append(True, first[1:] != first[:-1])) if len(first) else []
            done: list[tuple[int, str]] = []
            for start, stop in zip(starts, [*starts[1:], len(first)], strict=True):
                if now is not None and now != first[start]:
                    done.append((now, digest.hexdigest()))
                if now != first[start]:
                    now, digest = int(first[start]), hashlib.sha256()
                    more = False
                else:
                    more = True
                ids = batch.column("conv_id").slice(start, stop - start).cast(pa.string())
                text = ",".join(ids.to_pylist())
                digest.update(("," + text if more else text).encode())
            yield pa.RecordBatch.from_pylist([{"first": a, "ends": b} for a, b in done], schema=arrow)
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"first": now, "ends": digest.hexdigest()}], schema=arrow)

    ordered = members.select("first", "conv_id").repartition("first").sortWithinPartitions("first", "conv_id")
    return ordered.mapInArrow(run, "first bigint, ends string")


def prefix_trie(paths: DataFrame, shard: int = SHARD) -> DataFrame:
    """The trie of ``paths`` (conv_id, path array<struct<id bigint, n bigint>>), a row per node.

    ``id`` names a turn, ``n`` is its length and must be the same wherever the id is; conv_id is
    unique and not NULL. An empty path ends at the root. Columns: conv_id (the smallest member),
    depth, parent_conv_id (NULL at the root), n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. No paths give no nodes.
    """
    paths = durable(paths.select("conv_id", "path"))
    groups = durable(paths.groupBy("path").agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n_convs")))
    many = groups.filter("n_convs > 1")
    lists = _list_hashes(paths.join(many.select("path", "first"), "path"))
    alone = groups.filter("n_convs = 1").withColumn("ends", F.sha2(F.col("first").cast("string"), 256))
    distinct = alone.unionByName(many.join(lists, "first").select(*alone.columns))
    turns = groups.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    return _merged(durable(_sharded(distinct, max(1, -(-turns // shard)))))


def encoded(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): each conversation's turns in order, as ids of a dictionary of turns.

    Order: ``turn``, NULL first, equal turns by a hash of role and text. A NULL role or text is
    empty. Rows without a conv_id are in no conversation; repeated rows are turns of their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = durable(
        conversations.filter(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.unhex(F.sha2(named, 256)).alias("digest"),
            F.char_length(text).cast("long").alias("n"),
        )
    )
    # sorted, so that the order of ids is that of hashes and does not change from run to run
    dictionary = durable(turns.groupBy("digest").agg(F.max("n").alias("n")).orderBy("digest"))
    dictionary = dictionary.withColumn("id", F.monotonically_increasing_id())
    coded = turns.drop("n").join(dictionary, "digest")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "id", "n")))
    path = F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["n"].alias("n")))
    return coded.groupBy("conv_id").agg(path.alias("path"))


def _head_size(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt(paths: DataFrame) -> DataFrame:
    """Paths whose first h turns are those of the conversation at the last multiple of 100."""
    own = durable(paths)
    heads = own.filter(F.col("conv_id") % EVERY == 0).select(
        F.col("conv_id").alias("_base"), F.slice("path", 1, HEADS - 1).alias("_head")
    )
    h = _head_size(F.col("conv_id"))
    based = own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % EVERY).join(heads, "_base", "left")
    none = F.slice("path", 1, 0)
    return based.select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("_head", none), F.lit(1), h),
            F.slice("path", h + 1, F.size("path")),
        ).alias("path"),
    )


def conversation_trie(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """The trie of the rebuilt conversations; see ``encoded``, ``rebuilt`` and ``prefix_trie``.

    No conversations (an empty table, or no row with a conv_id) give no nodes. Columns beyond
    conv_id, turn, role and text aren't looked at.
    """
    return prefix_trie(rebuilt(encoded(conversations)), shard)
