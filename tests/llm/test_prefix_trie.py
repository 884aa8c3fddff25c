import hashlib
import math
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from voicetide.llm import prefix_trie as pt
from voicetide.llm import queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The rows of the trie, by dictionaries of whole prefixes."""
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            given[conv].append((turn is not None, turn or 0, role or "", hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in given.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(built[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


def test_query_against_brute_force(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").collect()
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in rows])
    assert found(queries.op11_prefix_trie(spark, small)) == want


@pytest.mark.parametrize("shares, queue", [(1, 1), (8, 3), (10_000, 100)])
def test_shards_and_spilled_queues_change_nothing(spark, shares, queue):
    """A third of the conversations are one and the same; another third share a first turn."""
    rows = []
    for c in range(90):
        texts = ["same"] * 6 if c % 3 == 0 else ["hello", *[f"{c % (d + 2)}" for d in range(c % 7)]]
        rows += [(c, d, "user" if d % 2 else "assistant", t) for d, t in enumerate(texts)]
    assert found(pt.prefix_trie(spark.createDataFrame(rows, TURNS), shares, queue)) == brute(rows)


def test_cases(spark):
    """Nulls, ties, repeated rows, negative ids, absent families, clashing columns, a long conversation."""
    rows = [
        (1, None, "user", "first"), (1, 1, None, None), (1, 1, None, None), (1, 1, "b", "x"), (1, 1, "a", "y"),
        (250, 3, "user", "no family"), (-5, 1, "user", "below zero"), (0, 1, "ab", "c"), (2, 1, "a", "bc"),
        (None, 1, "user", "nobody's"), (7, 1, "user", "\U0001f600é"), (9, 2, "user", "z" * 50_000),
        *[(300, i, "user", f"turn {i % 5}") for i in range(700)],
    ]
    turns = spark.createDataFrame(rows, TURNS)
    for name in ("pos", "key", "node", "parent", "shard", "depth", "h", "first", "part", "_turn", "_role"):
        turns = turns.withColumn(name, F.lit("clash"))
    assert found(pt.prefix_trie(turns)) == brute(rows)


def test_a_conversation_may_keep_no_turn(spark):
    """Conversation 250 has no family head; its own turns all lie before its first h."""
    c = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 > 1)
    assert found(pt.prefix_trie(spark.createDataFrame([(c, 1, "u", "x")], TURNS))) == brute([(c, 1, "u", "x")])


def test_empty(spark):
    assert found(pt.prefix_trie(spark.createDataFrame([], TURNS))) == []


def test_queue_merges_its_runs():
    queue = pt.Queue(3)
    for i in range(50):
        queue.push((i * 7 % 10, bytes([i % 4]), i))
    got = [m for place in range(10) for node in range(4) for m in queue.take(place, bytes([node]))]
    assert len(got) == 50 and len(queue.runs) > 10 and len(queue) == 0
    assert [m[:2] for m in got] == sorted(m[:2] for m in got) and sorted(m[2] for m in got) == list(range(50))


def test_ends_come_in_order_over_blocks(spark):
    ids = [5, 40, 100, 3, 99, 1000]
    rows = spark.createDataFrame([(bytearray(b"n"), c, True) for c in ids], "node binary, conv_id long, last boolean")
    want = hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert [r.ends_sha256 for r in pt.ends(rows, block_ids=8).collect()] == [want]
