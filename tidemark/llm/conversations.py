"""Prefix trie of conversations, its totals passed from the deepest nodes to the root.

A node is a depth and a hash of the turns that lead to it. Light subtrees are shards: inside one, nodes come in reverse
level order and totals travel to parents through a queue that spills. What is left above the shards is a smaller trie, whose
nodes have received the totals of the shard roots; it is cut into shards again, until none is left.
"""

from __future__ import annotations

import heapq
import struct
import tempfile
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import quoted, small
from tidemark.session import cut_lineage

#: Conversations of one hundred share the first turns of the one that begins it; h is below six.
FAMILY, HEADS = 100, 6
#: Turns at or below a shard root, at most, in the first round; later rounds have fewer nodes and may hold more.
SHARD_TURNS, GROWTH = 1024, 8
#: Turns of one conversation that are summed in one group, and ids of conversations that are joined in one.
BLOCK, ID_BITS = 4096, 12
#: Nodes that a task takes, about.
TASK_NODES = 1 << 15
#: Messages that a queue holds in memory.
QUEUE = 1 << 17
#: Characters of a text that order turns of equal number and role, before its hash.
HEAD_CHARS = 64

KEY = ["depth", "k1", "k2"]


def ordered(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, pos, h1, h2, chars): every turn with its place in its conversation and two hashes of role and text.

    Rows are dealt by ranges of conversation and turn, so a conversation of very many turns is split; the few that reach
    over a border take the counts of the ranges before.
    """
    word = lambda name: F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(quoted(conv)).cast("long").alias("conv_id"),
        F.col(quoted(turn)).alias("turn"),
        word(role).alias("role"),
        F.substring(word(text), 1, HEAD_CHARS).alias("head"),
        F.xxhash64(F.lit(1), word(role), word(text)).alias("h1"),
        F.xxhash64(F.lit(2), word(text), word(role)).alias("h2"),
        F.length(word(text)).cast("long").alias("chars"),
    ).where("conv_id IS NOT NULL")
    order = ["turn", "role", "head", "h1", "h2"]
    dealt = rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    k = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order)).cast("long")
    dealt = cut_lineage(dealt.select("conv_id", "part", "h1", "h2", "chars", k.alias("k")), "turns")
    counts = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    over = counts.select("conv_id", "part", F.sum("n").over(earlier).alias("before")).where("before IS NOT NULL")
    over = small(cut_lineage(over, "over"))
    placed = dealt.join(over, ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("k") + F.coalesce("before", F.lit(0)) - 1).alias("pos"), "h1", "h2", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(c, pos, h1, h2, chars, last): the turns of every rebuilt conversation, and how many it has.

    A row with pos -1 stands for the conversation before its first turn. A family's first turns are few, whatever the
    length of its conversations.
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1))
    heads = heads.withColumnRenamed("conv_id", "base")
    have = heads.groupBy("base").agg(F.count(F.lit(1)).alias("have"))
    c = F.col("conv_id")
    convs = own.select(
        "conv_id",
        "own",
        (c - c % FAMILY).alias("base"),
        (F.crc32(c.cast("string").cast("binary")) % HEADS).alias("h"),
    ).join(have, "base", "left")
    convs = convs.withColumn("take", F.least("h", F.coalesce("have", F.lit(0))))
    convs = convs.withColumn("last", F.col("take") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = cut_lineage(convs.select("conv_id", "base", "h", "take", "last"), "conversations")
    columns = ["pos", "h1", "h2", "chars", "last"]
    first = convs.join(heads, "base").where("pos < h").select(c.alias("c"), *columns)
    rest = turns.join(convs, "conv_id").where("pos >= h").withColumn("pos", F.expr("pos + take - h"))
    zero = F.lit(0).cast("long")
    start = convs.select(c.alias("c"), F.lit(-1).cast("long").alias("pos"), zero, zero, zero, "last")
    return first.unionByName(rest.select(c.alias("c"), *columns)).unionByName(start.toDF("c", *columns))


def paths(turns: DataFrame) -> DataFrame:
    """(c, depth, k1, k2, p1, p2, chars, last): the nodes of every conversation, keyed by the hashes of all turns so far.

    A key is the exclusive or of 64-bit hashes of (place, turn), twice; with the depth, 128 bits tell sequences apart.
    The parent's key follows by taking the last turn out again. Long conversations are summed block by block.
    """
    salted = lambda n: F.when(F.col("pos") >= 0, F.xxhash64(F.lit(n), "pos", "h1", "h2")).otherwise(F.lit(0))
    block = F.floor(F.greatest("pos", F.lit(0)) / BLOCK).cast("long")
    rows = turns.select("c", "pos", "chars", "last", block.alias("block"), salted(3).alias("t1"), salted(4).alias("t2"))
    rows = cut_lineage(rows, "rebuilt")
    sums = rows.where(F.col("last") > BLOCK).groupBy("c", "block").agg(F.bit_xor("t1").alias("b1"), F.bit_xor("t2").alias("b2"))
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "c", "block", F.bit_xor("b1").over(earlier).alias("b1"), F.bit_xor("b2").over(earlier).alias("b2")
    ).where("b1 IS NOT NULL")
    carried = small(cut_lineage(carried, "carried"))
    so_far = Window.partitionBy("c", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    keyed = rows.withColumn("r1", F.bit_xor("t1").over(so_far)).withColumn("r2", F.bit_xor("t2").over(so_far))
    keyed = keyed.join(carried, ["c", "block"], "left")
    with_carry = lambda r, b: F.col(r).bitwiseXOR(F.coalesce(b, F.lit(0)))
    keyed = keyed.withColumn("k1", with_carry("r1", "b1")).withColumn("k2", with_carry("r2", "b2"))
    return keyed.select(
        "c",
        (F.col("pos") + 1).alias("depth"),
        "k1",
        "k2",
        F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("t2")).alias("p2"),
        "chars",
        "last",
    )


class Queue:
    """Messages in the order of the nodes that receive them; beyond ``limit`` sorted runs go to a file.

    The file has no name and ends with the task attempt that wrote it; a retry starts from the rows of its shard.
    """

    RECORD, SIZE, READ = "<6q", 48, 1024

    def __init__(self, limit: int = QUEUE):
        self.limit = limit
        self.heap: list[tuple] = []
        self.file = None
        self.heads: list[tuple] = []

    def put(self, message: tuple[int, ...]) -> None:
        """(minus depth, k1, k2) of the receiver, then what it receives."""
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        for message in sorted(self.heap):
            self.file.write(struct.pack(self.RECORD, *message))
        self.heap.clear()
        self._next(at, self.file.tell(), [])

    def _next(self, at: int, end: int, block: list[tuple]) -> None:
        """Offer the next message of the run that goes on at ``at``; ``block`` holds those read, the next one last."""
        if not block and at < end:
            self.file.seek(at)
            data = self.file.read(min(end - at, self.READ * self.SIZE))
            at += len(data)
            block = list(struct.iter_unpack(self.RECORD, data))[::-1]
        if block:
            heapq.heappush(self.heads, (block.pop(), end, at, block))

    def take(self, node: tuple[int, int, int]) -> Iterator[tuple[int, ...]]:
        """The messages for ``node``; none is left for a node before it."""
        while True:
            run = bool(self.heads) and (not self.heap or self.heads[0][0] < self.heap[0])
            if not run and not self.heap:
                return
            first = self.heads[0][0] if run else self.heap[0]
            if first[:3] != node:
                return
            if run:
                message, end, at, block = heapq.heappop(self.heads)
                self._next(at, end, block)
            else:
                message = heapq.heappop(self.heap)
            yield message[3:]

    def clear(self) -> None:
        self.heap.clear()
        self.heads.clear()
        if self.file:
            self.file.close()
            self.file = None


def passed_up(batches: Iterator[pa.RecordBatch], limit: int = QUEUE) -> Iterator[pa.RecordBatch]:
    """Totals of the nodes of whole shards; rows come shard by shard, the deepest nodes first.

    Columns: the shard root's key, the node's and its parent's, what the node saves itself, and what it has received from
    shards below it (children, leaves, saved).
    """
    queue = Queue(limit)
    now = None
    names = [*KEY, "p1", "p2", "top", "n_children", "n_leaves", "saved_tokens"]
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            shard, (depth, k1, k2, p1, p2, saved, children, leaves, received) = row[:3], row[3:]
            if shard != now:
                queue.clear()
                now = shard
            saved += received
            for n, below, tokens in queue.take((-depth, k1, k2)):
                children += n
                leaves += below
                saved += tokens
            leaves = leaves if children else 1
            top = shard == (depth, k1, k2)
            if not top:
                queue.put((1 - depth, p1, p2, 1, leaves, saved))
            out.append((depth, k1, k2, p1, p2, top, children, leaves, saved))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*out, strict=True)], names)


def totals(walks: DataFrame, nodes: DataFrame, shard_turns: int = SHARD_TURNS, queue: int = QUEUE) -> DataFrame:
    """(depth, k1, k2, n_children, n_leaves, saved_tokens) of every node.

    ``walks`` (c, depth, k1, k2, last) has every node of every conversation, ``nodes`` each node once with ``rep``, its
    smallest member, ``weight``, the turns of its members from there on, and ``saves``. Weights fall along every path, so the
    nodes of at most ``shard_turns`` form whole subtrees: the shards. The heavy nodes above are at most
    turns / shard_turns for each depth; they go on as a trie of one conversation for each of its leaves.
    """
    done = None
    zero = F.lit(0).cast("long")
    nodes = nodes.select(*KEY, "p1", "p2", "rep", "weight", "saves", *[zero.alias(x) for x in ("xc", "xl", "xs")])
    while True:
        light, heavy = nodes.where(F.col("weight") <= shard_turns), nodes.where(F.col("weight") > shard_turns)
        heavy = cut_lineage(heavy, "heavy")
        parents = heavy.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
        tops = light.join(parents, ["depth", "p1", "p2"], "left_semi").select(*KEY)
        tops = tops.unionByName(light.where("depth = 0").select(*KEY))
        shard = [F.col(x).alias(f"s_{x}") for x in KEY]
        owners = cut_lineage(walks.join(tops, KEY).select("c", *shard), "owners")
        parts = max(1, light.count() // TASK_NODES + 1)
        ours = light.join(owners, light["rep"] == owners["c"]).select(
            *[f"s_{x}" for x in KEY], *KEY, "p1", "p2", "saves", "xc", "xl", "xs"
        )
        by_shard = ours.repartition(parts * 4, *[f"s_{x}" for x in KEY]).sortWithinPartitions(
            *[f"s_{x}" for x in KEY], F.desc("depth"), "k1", "k2"
        )
        shape = "depth long, k1 long, k2 long, p1 long, p2 long, top boolean, n_children long, n_leaves long, saved_tokens long"
        found = cut_lineage(by_shard.mapInArrow(lambda batches: passed_up(batches, queue), shape), "totals")
        result = found.select(*KEY, "n_children", "n_leaves", "saved_tokens")
        done = result if done is None else done.unionByName(result)
        if heavy.isEmpty():
            return done
        received = found.where("top AND depth > 0").groupBy((F.col("depth") - 1).alias("depth"), "p1", "p2").agg(
            F.count(F.lit(1)).alias("rc"), F.sum("n_leaves").alias("rl"), F.sum("saved_tokens").alias("rs")
        )
        received = received.withColumnsRenamed({"p1": "k1", "p2": "k2"})
        inner = heavy.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        ends = heavy.join(inner.distinct(), KEY, "left_anti").select(F.col("rep").alias("c"), F.col("depth").alias("last"))
        walks = cut_lineage(walks.drop("last").join(ends, "c").where("depth <= last").select("c", *KEY, "last"), "walks")
        nodes = heavy.drop("rep", "weight").join(weighed(walks), KEY).join(received, KEY, "left")
        for held, new in (("xc", "rc"), ("xl", "rl"), ("xs", "rs")):
            nodes = nodes.withColumn(held, F.col(held) + F.coalesce(new, F.lit(0))).drop(new)
        nodes = cut_lineage(nodes, "nodes")
        shard_turns *= GROWTH


def weighed(walks: DataFrame, *more: Column) -> DataFrame:
    """Each node once, with its smallest conversation and the turns from there on."""
    weight = F.sum(F.col("last") - F.col("depth") + 1).alias("weight")
    return walks.groupBy(*KEY).agg(F.min("c").alias("rep"), weight, *more)


def end_digests(walks: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): digest of the ids of the conversations that end at each node, in order.

    Ids are joined by ranges first, so that a node where very many conversations end sends few long texts through
    the one digest it has.
    """
    ends = walks.where("depth = last").select(*KEY, "c", F.shiftright("c", ID_BITS).alias("range"))
    ids = F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",")
    ranges = ends.groupBy(*KEY, "range").agg(ids.alias("ids"))
    names = [*KEY, "ends_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, None, []
        for batch in batches:
            for *node, ids in zip(*(c.to_pylist() for c in batch.select([*KEY, "ids"]).columns), strict=True):
                if node != now:
                    if now:
                        out.append((*now, digest.hexdigest()))
                    now, digest = node, sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
                out = []
        if now:
            yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, [*now, digest.hexdigest()], strict=True)})

    dealt = ranges.repartition(*KEY).sortWithinPartitions(*KEY, "range")
    return dealt.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    shard_turns: int = SHARD_TURNS,
    queue: int = QUEUE,
) -> DataFrame:
    """One row for each node of the prefix trie of the rebuilt conversations.

    Turns are ordered by ``turn``, null first; equal numbers by role, then by the first 64 characters and a hash of the
    text, so repeated rows are turns of their own. A null role or text is empty, rows without a conversation are left
    out. A conversation c is rebuilt from the first h turns of conversation c - c % 100 (the remainder has the sign of c)
    and its own turns after its first h, with h = crc32 of its id % 6. A node is a depth and 128 bits of hashes of the
    turns that lead to it. Other columns are not read; an empty table gives no rows.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    walks = cut_lineage(paths(rebuilt(ordered(conversations, conv_col, turn_col, role_col, text_col))), "paths")
    saves = ((F.count(F.lit(1)) - 1) * F.min("chars")).alias("saves")
    parents = [F.min("p1").alias("p1"), F.min("p2").alias("p2")]
    nodes = cut_lineage(weighed(walks, F.count(F.lit(1)).alias("n_convs"), saves, *parents), "nodes")
    found = totals(walks.select("c", *KEY, "last"), nodes, shard_turns, queue)
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("rep").alias("parent_conv_id")
    )
    none = F.lit(sha256(b"").hexdigest())
    return (
        nodes.select(*KEY, "p1", "p2", F.col("rep").alias("conv_id"), "n_convs")
        .join(above, ["depth", "p1", "p2"], "left")
        .join(found, KEY)
        .join(end_digests(walks), KEY, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
