"""The prefix trie against a plain version that builds every prefix."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from tidemark.llm import base, conversations, queries  # noqa: F401

from .conftest import SOME, TINY


def plain(rows):
    """Sorted rows of the trie; turns of one conversation have different numbers."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    lengths = {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        turns = own.get(int(c - abs(c) % 100 * (1 if c > 0 else -1)), [])[:h] + own[c][h:]
        lengths[c] = len(turns)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        totals[node] = (sum(totals[k][0] for k in kids) or 1, saved + sum(totals[k][1] for k in kids))
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in who if lengths[c] == len(node))
        parent = members[node[:-1]][0] if node else None
        leaves, saved = totals[node]
        digest = sha256(ends.encode()).hexdigest()
        out.append((who[0], len(node), parent, len(who), len(children[node]), leaves, saved, digest))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("sf", [TINY, SOME])
def test_query_equals_brute_force(spark, sf):
    assert got(base.QUERIES["op13_conversation_trie"](spark, sf)) == plain(table(spark, sf))


SHAPE = "conv_id long, turn long, role string, text string"


def made(seed=5, n=400):
    """Conversations that share turns in many ways, a third of them the same one; negative ids, gaps and null turns."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(-150, n), *range(4_000_000, 4_000_120), 1 << 62]:
        if rng.random() < 0.15:
            continue
        size = rng.randint(1, 9)
        same = rng.random() < 0.35
        for turn in range(size):
            text = f"turn {turn}" if same else rng.choice(["a", "b", "", None, "long " * 20])
            rows.append((c, None if turn == 0 and c % 3 == 0 else turn, rng.choice(["user", "user", None]) if not same else "user", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [1, 7, 60, 10**6])
def test_shards_of_any_size_give_the_same(spark, shard_turns):
    """From every node a shard of its own in the first round to one shard for the whole trie."""
    rows = made()
    docs = spark.createDataFrame(rows, SHAPE).repartition(4)
    assert got(conversations.trie(docs, shard_turns=shard_turns)) == plain(rows)


def test_long_conversations_are_summed_in_blocks(spark, monkeypatch):
    """One conversation holds a third of all rows, and is split by ranges and blocks."""
    monkeypatch.setattr(conversations, "BLOCK", 16)
    rows = [(700, t, "user", f"t{t % 3}") for t in range(300)] + [(701, t, "user", f"t{t % 3}") for t in range(200)]
    rows += [(c, t, "user", "x") for c in range(40) for t in range(5)]
    docs = spark.createDataFrame(rows, SHAPE).repartition(3)
    assert got(conversations.trie(docs, shard_turns=50)) == plain(rows)


def test_queue_that_spills_gives_messages_in_order():
    rng = random.Random(2)
    queue, sent = conversations.Queue(limit=10), defaultdict(list)
    nodes = sorted({(-rng.randint(0, 30), rng.randint(-9, 9), rng.randint(-9, 9)) for _ in range(300)})
    for node in rng.choices(nodes, k=5000):
        message = (rng.randint(0, 9), rng.randint(0, 9), rng.randint(0, 1 << 60))
        sent[node].append(message)
        queue.put((*node, *message))
    assert queue.file is not None
    for node in nodes:
        assert sorted(queue.take(node)) == sorted(sent[node])
    assert not queue.heap and not queue.heads
    queue.clear()
    assert queue.file is None


def test_a_spilling_queue_gives_the_same_totals(spark):
    rows = made(seed=6, n=150)
    docs = spark.createDataFrame(rows, SHAPE)
    assert got(conversations.trie(docs, queue=3)) == plain(rows)


def test_odd_conversations(spark):
    rows = [(None, 0, "user", "x"), (5, None, None, None), (100, 0, "user", "hi"), (101, 0, "user", None), (102, 3, "", "")]
    docs = spark.createDataFrame(rows, SHAPE)
    assert got(conversations.trie(docs)) == plain(rows)
    clash = docs.selectExpr("*", "1 AS depth", "2 AS pos", "3 AS k1", "'x' AS head", "4 AS last")
    assert got(conversations.trie(clash)) == plain(rows)
    assert conversations.trie(docs.limit(0)).count() == 0
    # Repeated rows are turns of their own, in an order that doesn't depend on where they lie.
    twice = [(7, 0, "user", "a")] * 3 + [(7, 0, "bot", "b"), (7, 0, "user", "A" * 100), (7, 1, "user", "very long " * 50_000)]
    first = got(conversations.trie(spark.createDataFrame(twice, SHAPE)))
    again = got(conversations.trie(spark.createDataFrame(twice[::-1], SHAPE).repartition(4)))
    assert first == again
    h = zlib.crc32(b"7") % 6
    assert max(r[1] for r in first) == 6 - h
