"""The prefix trie against a plain one built in Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from quarry.llm.prefix_trie import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    for turns in convs.values():
        turns.sort()
    full = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        rest = c - (c % 5 if c >= 0 else -(-c % 5))
        full[c] = tuple(x[2:] for x in convs.get(rest, [])[:h] + convs[c][h:])
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * (len(node[-1][1].encode()) if node else 0)
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(full[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, **kw):
    return sorted(map(tuple, trie(spark, spark.createDataFrame(rows, SCHEMA), **kw).collect()), key=repr)


def conversations(seed, n, longest, words=2, hot=0):
    r = random.Random(seed)
    rows = []
    for c in range(-n // 4, n):
        m = r.randint(1, longest)
        # Copies of one conversation, and few distinct turns.
        rows += [(c, t, "user" if t % 2 else "assistant", "hé" if c < hot else "w" * r.randrange(words)) for t in range(m if c >= hot else longest)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "rows, kw",
    [
        (conversations(1, 60, 6), {}),
        (conversations(2, 60, 6), {"width": 3, "shard_rows": 7}),
        (conversations(3, 40, 14, hot=20), {"width": 2, "shard_rows": 5}),
        (conversations(4, 30, 40, words=3), {"width": 8, "shard_rows": 16}),
        (conversations(5, 12, 9), {"width": 1, "shard_rows": 1}),
    ],
)
def test_equals_a_plain_trie(spark, rows, kw):
    assert got(spark, rows, **kw) == brute(rows)


def test_a_conversation_with_a_third_of_all_turns(spark):
    rows = conversations(6, 50, 8) + [(1000, t, "user", f"{t % 7}") for t in range(150)] + [(1005, t, "user", f"{t % 7}") for t in range(149)]
    assert got(spark, rows, width=16, shard_rows=10) == brute(rows)


def test_nulls_repeats_and_turnless(spark):
    rows = [(0, None, None, None), (0, 1, "user", None), (0, 1, "user", None), (7, 0, "a", ""), (None, 3, "x", "y"), (3, 2, "é", "long " * 40_000), (3, None, "", "b")]
    assert got(spark, rows) == brute(rows)


def test_empty_and_clashing_columns(spark):
    assert trie(spark, spark.createDataFrame([], SCHEMA)).collect() == []
    rows = conversations(7, 10, 4)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", band long, shard string, `Depth` int")
    assert sorted(map(tuple, trie(spark, df).collect()), key=repr) == brute(rows)
