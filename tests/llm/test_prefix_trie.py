"""The prefix trie against one made of nested tuples."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tripmart.llm import prefix_trie
from tripmart.llm.queries import QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_key(row):
    text = f"{len(row[2].encode())}:{row[2]}{len(row[3].encode())}:{row[3]}"
    return (row[1] is not None, row[1] or 0, hashlib.sha256(text.encode()).hexdigest())


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((c, turn, role or "", text or ""))
    turns = {c: [r[2:] for r in sorted(t, key=turn_key)] for c, t in turns.items()}
    members = defaultdict(list)
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - int(np.fmod(c, 5))
        paths[c] = tuple(turns.get(first, [])[:h] + own[h:])
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    out = []
    for node, convs in members.items():
        here = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves[node],
                    saved[node], hashlib.sha256(here.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted(map(tuple, frame.select(*COLUMNS).collect()), key=repr)


def conversations():
    """Shared first turns, whole copies, gaps in the ids, long and empty ones, odd values."""
    rows = []
    for c in range(60):
        if c % 7 == 3:
            continue
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"text {t} {c % 3 if t > 1 else 0} é") for t in range(c % 11 + 1)]
    rows += [(-3, 0, "user", "x"), (-5, 0, "system", "x"), (-5, 1, "user", "y")]
    rows += [(1000, t, "user", f"{t}") for t in range(300)] + [(1002, t, "user", f"{t}") for t in range(200)]
    rows += [(2001, None, None, None), (2001, None, "b", ""), (2001, 5, "a", "t"), (2001, 5, "a", "t"), (None, 0, "user", "no id"), (2006, 0, "", "")]
    return rows


@pytest.mark.parametrize("heavy,shard", [(None, 1 << 15), (2, 10), (5, 40), (10 ** 9, 1)])
def test_as_brute_force(spark, heavy, shard):
    frame = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string").selectExpr(
        "*", "turn as depth", "text as digest", "'x' as own").repartition(5)
    got = prefix_trie.nodes(spark, prefix_trie.rebuilt(frame), heavy, shard)
    assert rows_of(got) == brute(conversations())


def test_query_as_brute_force(spark):
    from tests.conftest import SF
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op12_prefix_trie"](spark, SF)) == brute(rows)


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.nodes(spark, prefix_trie.rebuilt(none)).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 9, 5000):
        digests = rng.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        names = prefix_trie.PerfectHash(digests)
        assert sorted(names.slots.tolist()) == list(range(n))
        assert names.find(digests).tolist() == names.slots.tolist()
        assert (names.find(rng.integers(0, 1 << 63, (50, 2)).astype(np.uint64)) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.PerfectHash(np.zeros((2, 2), np.uint64))


def test_equal_first_halves_get_slots():
    digests = np.column_stack([np.full(100, 7, np.uint64), np.arange(100, dtype=np.uint64)])
    assert sorted(prefix_trie.PerfectHash(digests).slots.tolist()) == list(range(100))
