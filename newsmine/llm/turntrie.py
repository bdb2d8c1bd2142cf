"""Prefix trie of conversations: ternary search trees over range shards, merged at their seams.

Turns are replaced by dictionary numbers, conversations are sorted by their number
sequences, and the sorted rows are cut into shards. Each shard builds one ternary
search tree, inserting its distinct sequences by medians, and one pass over the tree
accumulates members, leaves and words. Only the paths to a shard's first and last
sequence can lie in other shards too: their nodes are emitted as partial sums, and
what two neighbouring shards both counted is subtracted once at their seam, so that a
plain sum over all shards is right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmine.llm.common import Batches, looked_up, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Turns in one shard's tree; one conversation alone may be longer.
SHARD = 1 << 16
NODE, EDGE, ENDS, BORDER = 0, 1, 2, 3
NO_ENDS = hashlib.sha256().hexdigest()
_SCHEMA = pa.schema(
    [("kind", pa.int8()), ("shard", pa.int64()), ("node", pa.binary()), ("parent", pa.binary())]
    + [(k, pa.int64()) for k in ("depth", "low", "parent_low", "members", "children", "leaves", "words", "distinct")]
    + [("ends", pa.string()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("front", pa.bool_())]
)
SCHEMA = (
    "kind byte, shard long, node binary, parent binary, depth long, low long, parent_low long, members long, children long, "
    "leaves long, words long, distinct long, ends string, ids array<long>, sizes array<long>, front boolean"
)


def encoded(conversations: DataFrame) -> DataFrame:
    """(conv, turns): each conversation's turns in order as (id, words) from a dictionary of all distinct turns.

    Null roles and texts are empty. Turns are sorted by their number, null first, and
    turns with equal numbers by the SHA-256 of role and text. Rows without a conv_id
    belong to no conversation. A conversation's numbers (16 bytes a turn) are one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    known = F.col("conv_id").isNotNull()
    rows = stored(
        conversations.where(known).select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), key.alias("key"), words.alias("words")),
        "trie-turns",
    )
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.max("words").alias("words"))
    # Written once: the numbers stay what they are.
    dictionary = stored(counted.withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    numbered = looked_up(rows.drop("words"), dictionary, "key", "many", rows.count())
    ordered = F.sort_array(F.collect_list(F.struct("turn", "key", "id", "words")))
    turns = F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words")))
    return numbered.groupBy("conv").agg(turns.alias("turns"))


def rebuilt(own: DataFrame, first: Column, heads: Column, longest: int) -> DataFrame:
    """(conv, turns): the first ``heads`` turns (``longest`` at most) of conversation ``first``, then the own turns after as many."""
    begins = own.select(F.col("conv").alias("_first"), F.slice("turns", 1, longest).alias("_begin"))
    met = own.withColumns({"_first": first, "_heads": heads.cast("int")}).join(begins, "_first", "left")
    begin = F.coalesce(F.slice("_begin", F.lit(1), F.col("_heads")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("_heads") + 1, F.size("turns"))
    return met.select("conv", F.concat(begin, rest).alias("turns"))


class TernaryTree:
    """A ternary search tree of number sequences; entry 0 is the trie's root.

    An entry is one trie node: ``low`` and ``high`` lead to smaller and greater last
    turns below the same parent, ``same`` to the sequences that go on from here.
    """

    def __init__(self) -> None:
        self.key, self.low, self.same, self.high = [-1], [-1], [-1], [-1]
        self.up, self.depth, self.size = [-1], [0], [0]

    def _new(self, turn: int, size: int, above: int) -> int:
        for column, value in ((self.key, turn), (self.low, -1), (self.same, -1), (self.high, -1), (self.up, above), (self.depth, self.depth[above] + 1), (self.size, size)):
            column.append(value)
        return len(self.key) - 1

    def insert(self, turns: list[int], sizes: list[int]) -> int:
        """The entry at which the sequence ends."""
        above = 0
        for turn, size in zip(turns, sizes, strict=True):
            at = self.same[above]
            if at < 0:
                at = self.same[above] = self._new(turn, size, above)
            while self.key[at] != turn:
                side = self.low if turn < self.key[at] else self.high
                if side[at] < 0:
                    side[at] = self._new(turn, size, above)
                at = side[at]
            above = at
        return above


def medians(n: int) -> Iterator[int]:
    """0 … n-1, the middle first, then the middles of both halves, and so on: keeps the trees balanced."""
    waiting = [(0, n)]
    while waiting:
        low, high = waiting.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += [(middle + 1, high), (low, middle)]


def path_names(turns: list[int]) -> list[bytes]:
    """Name of every node on the way to a sequence: the SHA-256 of the turns so far (the root's first)."""
    running = hashlib.sha256()
    names = [running.digest()]
    for turn in turns:
        running.update(turn.to_bytes(8, "big"))
        names.append(running.digest())
    return names


def seam(last: list[int], sizes: list[int], first: list[int]) -> dict[str, list]:
    """What two neighbouring shards both counted at the nodes they share, negative."""
    common = 0
    while common < min(len(last), len(first)) and last[common] == first[common]:
        common += 1
    names = path_names(last[:common])
    depth = np.arange(common + 1)
    tail = np.concatenate([np.cumsum(sizes[:common][::-1])[::-1], [0]]).astype(np.int64)
    # Words of the shared nodes from each depth on; the root has none.
    distinct = tail[np.maximum(depth - 1, 0)]
    return {
        "kind": [EDGE] * (common + 1), "node": names, "parent": [None, *names[:-1]], "depth": depth.tolist(), "members": [0] * (common + 1),
        "children": (-(depth < common).astype(int)).tolist(), "leaves": [-int(common == len(last))] * (common + 1),
        "words": [0] * (common + 1), "distinct": (-distinct).tolist(),
    }


def table(columns: dict[str, list]) -> pa.RecordBatch:
    rows = len(columns["kind"])
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _SCHEMA], schema=_SCHEMA)


@dataclass
class Shard:
    """Neighbouring rows of the sorted conversations: distinct sequences with the conv_ids that end there."""

    number: int
    turns: list[list[int]] = field(default_factory=list)
    sizes: list[list[int]] = field(default_factory=list)
    convs: list[list[int]] = field(default_factory=list)
    weight: int = 0

    def add(self, conv: int, turns: list[int], sizes: list[int]) -> None:
        if self.turns and self.turns[-1] == turns:
            self.convs[-1].append(conv)
        else:
            self.turns.append(turns)
            self.sizes.append(sizes)
            self.convs.append([conv])
            self.weight += len(turns)
        self.weight += 1

    def records(self) -> Iterator[pa.RecordBatch]:
        """Its nodes: whole ones, partial sums on the way to the first and last sequence, and lists of ends there."""
        tree = TernaryTree()
        ends = {tree.insert(self.turns[k], self.sizes[k]): k for k in medians(len(self.turns))}
        n = len(tree.key)
        members, low, children, leaves, distinct = [0] * n, [None] * n, [0] * n, [0] * n, tree.size[:]
        words = [0] * n
        for at, k in ends.items():
            members[at], low[at] = len(self.convs[k]), self.convs[k][0]
        # A node is entered before all nodes below it: backwards, each is whole when its parent takes it.
        for at in range(n - 1, -1, -1):
            words[at] += members[at] * tree.size[at]
            leaves[at] = leaves[at] or 1
            if at:
                up = tree.up[at]
                members[up] += members[at]
                low[up] = low[at] if low[up] is None else min(low[up], low[at])
                children[up] += 1
                leaves[up] += leaves[at]
                words[up] += words[at]
                distinct[up] += distinct[at]
        names: dict[int, bytes] = {}
        for k in (0, len(self.turns) - 1):
            way = path_names(self.turns[k])
            at = next(a for a, j in ends.items() if j == k)
            for name in reversed(way):
                names[at] = name
                at = tree.up[at]
        text = {at: ",".join(map(str, self.convs[k])) for at, k in ends.items()}
        inner = [at for at in range(n) if at not in names]
        front = [tree.up[at] in names for at in inner]
        pick = lambda values, rows: [values[at] for at in rows]
        sums = {"depth": tree.depth, "low": low, "members": members, "children": children, "leaves": leaves, "words": words, "distinct": distinct}
        yield table({
            "kind": [NODE] * len(inner), "shard": [self.number] * len(inner), **{k: pick(v, inner) for k, v in sums.items()},
            "parent": [names.get(tree.up[at]) for at in inner], "parent_low": [None if f else low[tree.up[at]] for at, f in zip(inner, front, strict=True)],
            "ends": [hashlib.sha256(text[at].encode()).hexdigest() if at in text else NO_ENDS for at in inner], "front": front,
        })
        edge = sorted(names)
        yield table({
            "kind": [EDGE] * len(edge), "shard": [self.number] * len(edge), "node": pick(names, edge),
            "parent": [names.get(tree.up[at]) for at in edge], **{k: pick(v, edge) for k, v in sums.items()},
        })
        lists = [at for at in edge if at in text]
        yield table({"kind": [ENDS] * len(lists), "node": pick(names, lists), "low": [self.convs[ends[at]][0] for at in lists], "ends": pick(text, lists)})


def _records(batches: Batches) -> Batches:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    shard, first, done = Shard(part << 32), None, 0
    before: tuple[list[int], list[int]] | None = None
    for batch in batches:
        convs = batch.column(0).to_pylist()
        turns = batch.column(1)
        for at, conv in enumerate(convs):
            whole = turns[at].values
            ids, sizes = whole.field("id").to_pylist(), whole.field("words").to_pylist()
            if shard.weight >= SHARD:
                yield from shard.records()
                before = (shard.turns[-1], shard.sizes[-1])
                done += 1
                shard = Shard((part << 32) + done)
                yield table(seam(*before, ids))
            first = (ids, sizes) if first is None else first
            shard.add(conv, ids, sizes)
    if first is not None:
        yield from shard.records()
        for side, (ids, sizes) in enumerate((first, (shard.turns[-1], shard.sizes[-1]))):
            yield table({"kind": [BORDER], "shard": [part], "depth": [side], "ids": [ids], "sizes": [sizes]})


def _seams(batches: Batches) -> Batches:
    for batch in batches:
        for last, sizes, first in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            yield table(seam(last, sizes, first))


def _digests(batches: Batches) -> Batches:
    """(node, ends): hash of each node's conv_ids, fed piece by piece in their order."""
    name, running = None, hashlib.sha256()
    for batch in batches:
        names, hashes = [], []
        for node, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if node != name:
                if name is not None:
                    names.append(name)
                    hashes.append(running.hexdigest())
                name, running = node, hashlib.sha256()
            else:
                running.update(b",")
            running.update(piece.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(hashes, pa.string())], names=["node", "ends"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([running.hexdigest()])], names=["node", "ends"])


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the ``turns`` of ``sequences`` (conv, turns<id, words>), the root included.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``conv`` has no nulls and no repeats. Sequences are dealt
    to tasks by ranges of (ids, conv), so copies of one conversation, however many, are
    spread as well. Saved tokens of a subtree are the words of all its members from
    its top on, less the words of its distinct nodes; both are sums over shards.

    A node is named by the SHA-256 of its turns where shards meet. No sequences give
    no rows. One sequence has to fit into a task, a list of conv_ids does not.
    """
    ids = F.transform("turns", lambda t: t["id"])
    keyed = stored(sequences.select("conv", "turns", ids.alias("ids")), "trie-sequences")
    placed = keyed.repartitionByRange("ids", "conv").sortWithinPartitions("ids", "conv")
    made = stored(placed.select("conv", "turns").mapInArrow(_records, SCHEMA), "trie-records")
    # Two rows for each partition of the sort: a setting, not a size of the data.
    border = made.where(F.col("kind") == BORDER).groupBy("shard").agg(
        F.max(F.when(F.col("depth") == 0, F.col("ids"))).alias("first"),
        F.max(F.when(F.col("depth") == 1, F.struct("ids", "sizes"))).alias("last"),
    )
    pairs = border.select("last", F.lead("first").over(W.orderBy("shard")).alias("next")).where("next is not null")
    seams = pairs.select("last.ids", "last.sizes", "next").mapInArrow(_seams, SCHEMA)
    partial = made.where(F.col("kind") == EDGE)
    sums = [F.sum(c).alias(c) for c in ("members", "children", "leaves", "words", "distinct")]
    merged = stored(partial.unionByName(seams).groupBy("node").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("low").alias("low"), *sums), "trie-edges")
    lows = merged.select(F.col("node").alias("parent"), F.col("low").alias("known"))
    pieces = made.where(F.col("kind") == ENDS).select("node", "low", "ends")
    digests = pieces.repartition("node").sortWithinPartitions("node", "low").select("node", "ends").mapInArrow(_digests, "node binary, ends string")
    edges = merged.join(lows, "parent", "left").join(digests, "node", "left").withColumn("parent_low", F.col("known"))
    edges = edges.withColumn("ends", F.coalesce("ends", F.lit(NO_ENDS)))
    nodes = made.where(F.col("kind") == NODE)
    # By shard as well: no key has more rows than one shard.
    of_shard = partial.select("shard", F.col("node").alias("parent")).join(lows, "parent")
    front = nodes.where("front").join(of_shard, ["shard", "parent"]).withColumn("parent_low", F.col("known"))
    result = [
        F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("members").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("words") - F.col("distinct")).alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    ]
    return nodes.where("not front").select(*result).unionByName(front.select(*result)).unionByName(edges.select(*result))
