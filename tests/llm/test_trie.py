"""The prefix trie against a plain dictionary of prefixes: shared starts, copies, long conversations, odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ratelake.llm import trie

COLUMNS = "conv_id long, turn long, role string, text string, depth int, part string, a long"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built = tuple(turns.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:])
        ends[built].append(c)
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        words = len(p[-1][1].encode().split()) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[c] for c in children[p])
    return sorted((min(m), len(p), -1 if not p else min(members[p[:-1]]), len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def built(spark, rows, **settings):
    df = spark.createDataFrame([tuple(r) + (3, "x", 5) for r in rows], COLUMNS)
    out = trie.prefix_trie(df, **settings)
    assert out.columns == NAMES
    return sorted(tuple(-1 if v is None else v for v in r) for r in out.collect())


def talk(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", " ".join(["hello"] * rng.randrange(0, 3)) + " x\x1c y"))
    return rows


@pytest.mark.parametrize("settings", [{}, {"shard_rows": 50}, {"shard_rows": 30, "band": 2}])
def test_shared_starts(spark, settings):
    rows = talk(4)
    rows += [(1000 + i, t, r, x) for i in range(60) for c, t, r, x in rows if c == 7]      # many copies
    assert built(spark, rows, **settings) == brute(rows)


def test_long_conversation_in_bands(spark):
    rows = [(5, t, "user", f"turn {t % 7}") for t in range(600)] + [(c, t, "user", f"turn {t % 7}") for c in (25, 45) for t in range(300)]
    rows += [(65, t, "user", "turn 0" if t else "else") for t in range(40)] + talk(9, 30)
    random.Random(1).shuffle(rows)
    assert built(spark, rows, band=64, shard_rows=100) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, 0, None, None), (0, None, "user", "first"), (0, 0, "user", "tie"), (0, 0, "user", "tie"), (None, 0, "user", "no id"),
            (-3, 1, "user", "below zero"), (-23, 2, "", ""), (21, 5, "a", "b"), (22, 5, "ab", ""), (23, 5, "", "ab"),
            (24, 5, "ab", ""), (41, 0, "user", "word " * 20_000), (2 ** 40, 1, "user", "far"), (2 ** 40, 2, "user", "\U0001F600 \x00")]
    assert built(spark, rows) == brute(rows)
    assert built(spark, []) == [] and built(spark, [(None, None, None, None)]) == []
    only = [(c, 0, "user", "x") for c in range(1, 12)]                                       # some lose their only turn
    assert built(spark, only) == brute(only)


def test_slots_are_minimal_and_know_their_keys():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-2 ** 62, 2 ** 62, (2, 5000))
    a[:2500] = 1                                                                             # keys that share a half
    slots = trie.Slots(a, b)
    assert sorted(slots.find(a, b)) == list(range(5000))
    assert (slots.find(b, a) == -1).all()
