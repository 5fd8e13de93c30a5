"""The trie against brute force: nulls, ties, repeats, one long chain, no rows."""

from __future__ import annotations

import collections
import hashlib
import random

from topicloom.llm import conversation_trie, queries
from topicloom.llm.conversation_trie import CHUNK

SCHEMA = ("conv_id bigint, turn bigint, role string, text string, idx int, digest string, "
          "chain string, `odd.name` int")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)


def said(role, text):
    role, text = role or "", text or ""
    key = f"{len(role.encode())}:{role}{text}"
    return hashlib.sha256(key.encode()).hexdigest(), len(text.encode())


def sequences(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest, size = said(role, text)
            turns[conv].append((turn is not None, turn or 0, digest, size))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}


def brute(built):
    """Every node with its totals, by walking all openings of all conversations."""
    members = collections.defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[tuple(t[0] for t in ts[:d])].append(c)
    out = set()
    kids = collections.Counter(p[:-1] for p in members if p)
    below = collections.defaultdict(lambda: [0, 0])
    for p, ms in members.items():
        size = built[ms[0]][len(p) - 1][1] if p else 0
        for d in range(len(p) + 1):
            below[p[:d]][0] += not kids[p]
            below[p[:d]][1] += (len(ms) - 1) * size
    for p, ms in members.items():
        ends = ",".join(str(c) for c in sorted(m for m in ms if len(built[m]) == len(p)))
        out.add((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), kids[p],
                 below[p][0], below[p][1], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie(spark, rows):
    turns = conversation_trie.ordered_turns(table(spark, rows))
    got = conversation_trie.prefix_trie(turns, turns.select("conv").distinct())
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                           "n_leaves", "saved_tokens", "ends_sha256"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_random_tries(spark):
    rng = random.Random(5)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, "user", rng.choice("ab") * (1 + t)))
    # Copies, nulls, repeated turns, ties, rows without conversation.
    rows += [(100 + k, t, "user", "same") for k in range(30) for t in range(3)]
    rows += [(200, None, None, None), (200, None, "user", "é"), (200, 0, "user", None),
             (201, 5, "user", "tie"), (201, 5, "bot", "tie"), (201, 5, "bot", "tie"),
             (202, 5, "bot", "tie"), (202, 5, "user", "tie"), (202, 5, "bot", "tie"),
             (None, 0, "user", "nobody"), (-3, 0, "user", "a"), (203, 0, "us", "era"),
             (204, 0, "user", "a")]
    assert trie(spark, rows) == brute(sequences(rows))


def test_long_chains(spark):
    """Conversations of several chunks that share some, all, or none of their turns."""
    long = [(1, t, "user", f"t{t}") for t in range(3 * CHUNK + 5)]
    rows = long + [(2, t, "user", f"t{t}") for t in range(2 * CHUNK)]
    rows += [(3, t, "user", f"t{t}" if t < CHUNK + 3 else f"x{t}") for t in range(2 * CHUNK + 9)]
    rows += [(4, *r[1:]) for r in long] + [(5, 0, "user", "w " * 50_000)]
    assert trie(spark, rows) == brute(sequences(rows))


def test_rounds_follow_the_logarithm(spark):
    """A path of 200 nodes takes two rounds, a full binary tree of depth 6 one a level."""
    def nodes(parents):
        kids = collections.Counter(p for p in parents if p is not None)
        depth = {}
        for k, p in enumerate(parents):
            depth[k] = 0 if p is None else depth[p] + 1
        return spark.createDataFrame([(k, p, depth[k], kids[k], 1, int(not kids[k]))
                                      for k, p in enumerate(parents)],
                                     "id bigint, parent bigint, depth bigint, kids bigint, "
                                     "size bigint, leaves bigint")
    path, rounds = conversation_trie.subtree_sums(nodes([None, *range(199)]), ["size", "leaves"])
    assert rounds == 2
    assert {tuple(r) for r in path.collect()} == {(k, 200 - k, 1) for k in range(200)}
    full, rounds = conversation_trie.subtree_sums(
        nodes([None, *[(k - 1) // 2 for k in range(1, 127)]]), ["size", "leaves"])
    assert rounds == 7
    assert {r["id"]: r["leaves"] for r in full.collect()}[0] == 64


def test_empty(spark):
    assert trie(spark, []) == set()
    assert trie(spark, [(None, 1, "user", "x")]) == set()


def test_grafts_of_absent_and_short_conversations(spark):
    """Conversation 7 borrows from 5, which is absent; 11 borrows from 10, which is short."""
    rows = [(7, t, "user", f"a{t}") for t in range(9)] + [(10, 0, "user", "only")]
    rows += [(11, t, "user", f"b{t}") for t in range(12)] + [(4, 0, "user", "gone")]
    turns = conversation_trie.ordered_turns(table(spark, rows))
    built, convs = queries.grafted_turns(turns)
    import zlib
    own = sequences(rows)
    want = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    got = conversation_trie.prefix_trie(built, convs)
    assert {tuple(r) for r in got.collect()} == brute(want)
