"""Parentheses, tries and rebuilt conversations against plain loops."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from palaver.llm import tries
from tests.conftest import rows

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def balanced(rng, n):
    bits, depth = [], 0
    while len(bits) + depth < 2 * n:
        if depth and rng.random() < 0.47:
            bits.append(0)
            depth -= 1
        else:
            bits.append(1)
            depth += 1
    return bits + [0] * depth


@pytest.mark.parametrize("seed", range(4))
def test_closing_parentheses(seed):
    rng = random.Random(seed)
    shapes = [balanced(rng, rng.choice([1, 3, 40, 900, 5000])) for _ in range(8)] + [[1] * 700 + [0] * 700, [1] + [1, 0] * 900 + [0]]
    for bits in shapes:
        stack, want = [], {}
        for i, bit in enumerate(bits):
            if bit:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(np.array(bits))
        found = tries.Parentheses(np.array(bits, np.uint8)).find_close(opens)
        assert found.tolist() == [want[i] for i in opens.tolist()]


def slow(turns):
    """``turns``: conv_id, turn, role, text."""
    by = {}
    for c, turn, role, text in turns:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [(r, t) for _, _, r, t in sorted(own)] for c, own in by.items()}
    made = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = original.get(c - int(np.fmod(c, 5)), [])
        made[c] = tuple(base[:h] + own[h:])
    nodes = {}
    for c, path in made.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        ends = sorted(c for c in members if len(made[c]) == len(path))
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        leaves = sum(1 for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(kids), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, n):
    rng = random.Random(seed)
    out = []
    shared = [(rng.choice(["user", "assistant"]), rng.choice(["hi", "", "é", "go on " * 30])) for _ in range(12)]
    for c in rng.sample(range(-20, 3 * n), n):
        kind = rng.random()
        size = rng.choice([1, 2, 3, 5, 8, 12])
        if kind < 0.5:
            turns = shared[:size]
        elif kind < 0.8:
            turns = shared[: size // 2] + [("user", f"own {rng.randint(0, 3)}") for _ in range(size - size // 2)]
        else:
            turns = [(rng.choice(["user", None]), rng.choice(["hi", None, f"x{c}"])) for _ in range(size)]
        out += [(c, i, *t) for i, t in enumerate(turns)]
    return out


def frame(spark, turns):
    return spark.createDataFrame([(*t, 1, "p") for t in turns], "conv_id long, turn long, role string, text string, depth int, path string").repartition(3)


@pytest.mark.parametrize("shard_nodes", [1, 30, tries.SHARD_NODES])
def test_nodes_are_the_brute_force(spark, shard_nodes):
    turns = conversations(1, 140)
    got = rows(tries.prefix_trie(tries.rebuilt(tries.turn_paths(frame(spark, turns))), shard_nodes), *COLUMNS)
    assert got == slow(turns)


def test_odd_conversations(spark):
    turns = [
        (7, 0, "user", "only"),  # its family's first is absent, its checksum takes more turns than there are
        (10, None, "user", "first"), (10, 0, "user", "second"), (10, 0, "user", "second"), (10, 1, None, None),
        (11, 0, "user", "x" * 200_000), (12, 5, "b", "tie"), (12, 5, "a", "tie"), (12, 5, "a", "tiddle"), (None, 0, "user", "nobody"),
        (13, 0, "us", "er:x"), (14, 0, "user", ":x"), (-4, 0, "user", "q"), (-5, 0, "user", "q"),
        *[(200, i, "user", f"t{i}") for i in range(300)], *[(201, i, "user", f"t{i}") for i in range(280)],
    ]
    assert rows(tries.prefix_trie(tries.rebuilt(tries.turn_paths(frame(spark, turns)))), *COLUMNS) == slow(turns)
    assert zlib.crc32(b"7") % 9 > 0


def test_a_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(tries, "PIECE_IDS", 7)
    paths = spark.range(0, 500, 1, 6).selectExpr("id AS conv_id", "IF(id % 50 = 0, array(named_struct('digest', binary('a'), 'size', 2L)), array()) AS path")
    got = rows(tries.prefix_trie(paths), "depth", "n_convs", "saved_tokens", "ends_sha256")
    ends = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got == [(0, 500, 18, ends(i for i in range(500) if i % 50)), (1, 10, 18, ends(range(0, 500, 50)))]


def test_levels_shrink_until_one_shard_is_left(spark):
    paths = spark.range(0, 3000, 1, 5).selectExpr(
        "id AS conv_id", "transform(sequence(0, 4), i -> named_struct('digest', substring(unhex(sha2(string(id % (40 * (i + 1))), 256)), 1, 16), 'size', 1L)) AS path"
    )
    one = rows(tries.prefix_trie(paths), *COLUMNS)
    assert rows(tries.prefix_trie(paths, shard_nodes=50), *COLUMNS) == one
    assert sum(r[1] == 0 for r in one) == 1 and one[0][3] == 3000


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = tries.prefix_trie(tries.rebuilt(tries.turn_paths(empty)))
    assert found.collect() == [] and found.columns == list(COLUMNS)


def test_query_against_sql(spark):
    from checks.compare import compare, connect

    folder = "/root/testdata/sf0.001"
    fine, note = compare(spark, connect(folder), "op13_prefix_trie", tries.op13_prefix_trie, tries.OP13_SQL, folder)
    assert fine, note
