"""Prefix trie of conversations, by ternary search trees over ranges of their turn sequences.

Turns are dictionary-encoded: each distinct (role, text) has a number, and a conversation is the
sequence of its turns' numbers. Sequences are sorted over all tasks. Each task reads its range in
blocks of bounded size, and each block is a shard: its distinct sequences go into a ternary search tree,
the median first, then the medians of both halves, so that the trees of siblings are balanced. One pass
over the nodes, children before parents, sums members, leaves and savings.

A node whose sequence is no prefix of the first or last sequence of its shard is whole. The others may
go on in the next shard. They carry the digest of their prefix, by which the parts of a node are added.
What is shared at the border of two shards has been counted on both sides: the common prefix of the last
sequence of one and the first of the next says by how much, for each node on it. Text never leaves
the dictionary, and no group of members is held: ids of members are hashed as sorted streams.

Defined results: rows without ``conv_id`` take no part. Turns of one number, or without one, are ordered
by role and then by the digest of role and text; repeated rows are turns each. Conversations without turns
belong to the root. Without conversations there are no nodes. The turns of one conversation, as numbers,
are one row (12 bytes a turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablesync.llm.common import materialize
from tablesync.operators.batches import with_row_index

#: Turns and conversations in a shard, at least.
BLOCK_TURNS = 200_000
BLOCK_ROWS = 50_000

#: Families of conversations: those that share the one divisible by this, and turns taken from it, less one.
FAMILY = 5
MOST_SHARED = 9

#: Nodes on borders of shards up to this number are broadcast, about 40 bytes each.
BROADCAST_NODES = 1_000_000

NODE, BORDER, SHARD = 0, 1, 2

NODES = (
    "kind int, shard long, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
    "ends binary, ends_text string, first_keys array<binary>, last_keys array<binary>, last_bytes array<long>"
)


def encoded(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``ids`` and ``sizes`` (bytes of text) of the turns of each conversation, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").isNotNull().alias("numbered"),
        "turn",
        role.alias("role"),
        # The length keeps role and text apart.
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.octet_length(text).alias("size"),
    )
    turns = materialize(turns, "turns")
    dictionary = with_row_index(turns.select("digest").distinct(), ["digest"], "number")
    numbered = turns.join(dictionary, "digest")
    ordered = F.array_sort(F.collect_list(F.struct("numbered", "turn", "role", "digest", "number", "size")))
    grouped = numbered.groupBy("conv_id").agg(ordered.alias("turns"))
    return grouped.select("conv_id", F.col("turns.number").alias("ids"), F.col("turns.size").alias("sizes"))


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Each conversation with its first turns taken from the first of its family."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    own = sequences.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("shared", shared.cast("int"))
    start = sequences.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), *(F.slice(c, 1, MOST_SHARED).alias(f"first_{c}") for c in ("ids", "sizes"))
    )

    def joined(c: str, kind: str) -> Column:
        first = F.coalesce(F.slice(f"first_{c}", F.lit(1), F.col("shared")), F.array().cast(f"array<{kind}>"))
        return F.concat(first, F.slice(c, F.col("shared") + 1, F.greatest(F.size(c), F.lit(1))))

    return own.join(start, "family", "left").select("conv_id", joined("ids", "bigint").alias("ids"), joined("sizes", "int").alias("sizes"))


def medians(n: int) -> Iterator[int]:
    """The places 0 to n - 1, the middle one first, then those of both halves."""
    halves = [(0, n)]
    while halves:
        low, high = halves.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            halves += [(middle + 1, high), (low, middle)]


class TernaryTree:
    """Sequences of numbers. Node 0 is the root; each other node has a number, lower and higher siblings, and a first child in ``equal``."""

    def __init__(self) -> None:
        self.number, self.lower, self.higher, self.equal, self.up, self.depth, self.size = [-1], [-1], [-1], [-1], [-1], [0], [0]

    def _add(self, number: int, up: int, size: int) -> int:
        for column, value in ((self.number, number), (self.lower, -1), (self.higher, -1), (self.equal, -1), (self.up, up), (self.depth, self.depth[up] + 1), (self.size, size)):
            column.append(value)
        return len(self.number) - 1

    def insert(self, ids: list[int], sizes: list[int]) -> int:
        """The node where the sequence ends."""
        at = 0
        for number, size in zip(ids, sizes, strict=True):
            link, place = self.equal, at
            while (node := link[place]) >= 0 and self.number[node] != number:
                link, place = (self.lower if number < self.number[node] else self.higher), node
            if node < 0:
                node = link[place] = self._add(number, at, size)
            at = node
        return at

    def path(self, node: int) -> list[int]:
        """The nodes from the root to this one."""
        found = []
        while node >= 0:
            found.append(node)
            node = self.up[node]
        return found[::-1]


def shard_nodes(shard: int, rows: list[tuple[list[int], list[int], list[int]]]) -> pa.RecordBatch:
    """The nodes of a shard. ``rows``: its distinct sequences in order, each with its sizes and the conversations that have it, in order."""
    tree = TernaryTree()
    ends: dict[int, list[int]] = {}
    last = [0] * len(rows)
    for i in medians(len(rows)):
        last[i] = tree.insert(rows[i][0], rows[i][1])
        ends[last[i]] = rows[i][2]
    n = len(tree.number)
    convs, least, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    for node, members in ends.items():
        convs[node], least[node] = len(members), min(members)
    # A node is made after its parent, so from the last to the first children come before parents.
    for node in range(n - 1, -1, -1):
        leaves[node] = leaves[node] or 1
        saved[node] += (convs[node] - 1) * tree.size[node]
        up = tree.up[node]
        if up >= 0:
            convs[up] += convs[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    first_path, last_path = tree.path(last[0]), tree.path(last[-1])
    keys: dict[int, bytes] = {}
    for path in (first_path, last_path):
        for node in path:
            if node not in keys:
                keys[node] = hashlib.blake2b(keys[tree.up[node]] + tree.number[node].to_bytes(8, "little"), digest_size=16).digest() if node else b"\0" * 16
    listed = [",".join(map(str, ends[node])) if node in ends else None for node in range(n)]
    inside = [node not in keys for node in range(n)]
    parent = [None if up < 0 or up in keys else least[up] for up in tree.up]
    columns = {
        "kind": [NODE if x else BORDER for x in inside] + [SHARD],
        "shard": [shard] * (n + 1),
        "key": [keys.get(node) for node in range(n)] + [None],
        "parent_key": [keys.get(up) for up in tree.up] + [None],
        "conv_id": [*least, None],
        "depth": [*tree.depth, None],
        "parent_conv_id": [*parent, None],
        "n_convs": [*convs, None],
        "n_children": [*children, None],
        "n_leaves": [*leaves, None],
        "saved": [*saved, None],
        "ends": [hashlib.sha256((t or "").encode()).digest() if x else None for t, x in zip(listed, inside, strict=True)] + [None],
        "ends_text": [None if x else t for t, x in zip(listed, inside, strict=True)] + [None],
        "first_keys": [None] * n + [[keys[x] for x in first_path]],
        "last_keys": [None] * n + [[keys[x] for x in last_path]],
        "last_bytes": [None] * n + [[tree.size[x] for x in last_path]],
    }
    kinds = {"kind": pa.int32(), "key": pa.binary(), "parent_key": pa.binary(), "ends": pa.binary(), "ends_text": pa.string(), "first_keys": pa.list_(pa.binary()), "last_keys": pa.list_(pa.binary()), "last_bytes": pa.list_(pa.int64())}
    return pa.record_batch([pa.array(v, kinds.get(c, pa.int64())) for c, v in columns.items()], names=list(columns))


def _shards(turns: int, most_rows: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple[list[int], list[int], list[int]]] = []
        size = count = 0
        for batch in batches:
            for conv, ids, sizes in zip(*(batch.column(c) for c in ("conv_id", "ids", "sizes")), strict=True):
                sequence = ids.values.to_pylist() if ids.values is not None else []
                if rows and rows[-1][0] == sequence:
                    rows[-1][2].append(conv.as_py())
                else:
                    rows.append((sequence, sizes.values.to_pylist() if sizes.values is not None else [], [conv.as_py()]))
                    size += len(sequence)
                count += 1
                if size >= turns or count >= most_rows:
                    yield shard_nodes(number, rows)
                    rows, size, count, number = [], 0, 0, number + 1
        if rows:
            yield shard_nodes(number, rows)

    return shards


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each key; its texts come in order, and only the state of one hash is held."""
    key, state = None, None
    for batch in batches:
        keys, found = [], []
        for own, text in zip(batch.column("key").to_pylist(), batch.column("ends_text").to_pylist(), strict=True):
            if own != key:
                if key is not None:
                    keys.append(key)
                    found.append(state.digest())
                key, state = own, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield pa.record_batch({"key": pa.array(keys, pa.binary()), "ends": pa.array(found, pa.binary())})
    if key is not None:
        yield pa.record_batch({"key": pa.array([key], pa.binary()), "ends": pa.array([state.digest()], pa.binary())})


def _borders(shards: DataFrame) -> DataFrame:
    """For each node on a border what the shards on its two sides have counted twice."""
    # One number for each shard goes through the window; the paths meet in a join.
    order = shards.select("shard", F.lead("shard").over(Window.orderBy("shard")).alias("next"))
    ends = shards.select("shard", "last_keys", "last_bytes").join(order, "shard")
    starts = shards.select(F.col("shard").alias("next"), "first_keys")
    both = ends.join(starts, "next").withColumn("shared", F.size(F.filter(F.arrays_zip("last_keys", "first_keys"), lambda x: x["last_keys"] == x["first_keys"])))
    # The path's sizes summed from the front: a node's share is the sum of the common prefix less what stands above it.
    sums = F.aggregate(
        F.slice("last_bytes", F.lit(1), F.col("shared")),
        F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("above")),
        lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["above"], F.array(acc["sum"])).alias("above")),
    )
    both = both.withColumn("sums", sums)
    each = both.select(F.posexplode(F.slice("last_keys", F.lit(1), F.col("shared"))).alias("depth", "key"), "shared", "sums", F.size("last_keys").alias("long"))
    return each.groupBy("key").agg(
        F.sum(F.col("sums.sum") - F.get("sums.above", F.col("depth"))).alias("saved_again"),
        F.count_if(F.col("long") == F.col("shared")).alias("leaves_again"),
        F.count_if(F.col("depth") + 1 < F.col("shared")).alias("children_again"),
    )


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The nodes of the trie of rebuilt ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``)."""
    sequences = materialize(rebuilt(encoded(conversations.select("conv_id", "turn", "role", "text"))), "sequences")
    # The id spreads equal sequences over ranges.
    order = ["ids", "conv_id"]
    sorted_rows = sequences.repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialize(sorted_rows.mapInArrow(_shards(block_turns, block_rows), NODES), "nodes", ["kind"])
    found = found.withColumn("kind", F.col("kind").cast("int"))

    pieces = found.where(F.col("kind") == BORDER)
    listed = pieces.where("ends_text is not null").select("key", "shard", "ends_text")
    hashed = listed.repartition("key").sortWithinPartitions("key", "shard").mapInArrow(_hashed, "key binary, ends binary")
    sums = pieces.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved"))
    )
    again = _borders(found.where(F.col("kind") == SHARD))
    border = sums.join(again, "key", "left").join(hashed, "key", "left")

    def less(name: str, twice: str) -> Column:
        return (F.col(name) - F.coalesce(F.col(twice), F.lit(0))).alias(name)

    border = materialize(
        border.select(
            "key", "parent_key", "conv_id", "depth", "n_convs", less("n_children", "children_again"), less("n_leaves", "leaves_again"),
            (F.col("saved") + F.coalesce("saved_again", F.lit(0))).alias("saved"), F.coalesce("ends", F.unhex(F.sha2(F.lit(b""), 256))).alias("ends"),
        ),
        "border-nodes",
    )
    parents = border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("outer"))
    if border.count() <= BROADCAST_NODES:
        parents = F.broadcast(parents)
    columns = ["conv_id", "depth", "parent_key", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    whole = found.where(F.col("kind") == NODE).select(*columns)
    nodes = whole.unionByName(border.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns))
    return nodes.join(parents, "parent_key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "outer").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.lower(F.hex("ends")).alias("ends_sha256"),
    )
