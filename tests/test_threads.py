import math
import random

import pytest
from pyspark.sql import functions as F

from palaver.operators import threads
from tests.conftest import at, rows

END = "\n--- thread ends ---\n"


def forest(seed, size=120, roots=6):
    """Random trees: some wide, one deep, with negative scores and equal times."""
    rnd = random.Random(seed)
    made = []
    for n in range(size):
        parent = None if n < roots else (n - 1 if n % 3 == 0 else rnd.randrange(n))
        made.append(
            {
                "id": f"n{n}",
                "parent_id": "t3_s" if parent is None else f"t1_n{parent}",
                "score": rnd.randint(-9, 9),
                "author": rnd.choice(["ann", "bo", "cy"]),
                "created_utc": at(f"2024-03-01 12:{rnd.randrange(60):02d}:00"),
                "body": rnd.choice(["", "one", "one\ntwo", "a\r\nb\n", "long " * 30]),
            }
        )
    rnd.shuffle(made)
    return made


class Tree:
    """The same trees by plain recursion."""

    def __init__(self, made):
        self.by_id = {r["id"]: r for r in made}
        self.children = {i: [] for i in self.by_id}
        self.roots = []
        for r in made:
            if r["parent_id"].startswith("t3_"):
                self.roots.append(r["id"])
            else:
                self.children[r["parent_id"][3:]].append(r["id"])
        for kids in self.children.values():
            kids.sort(key=lambda i: (self.by_id[i]["created_utc"], i))

    def walk(self, ident, depth=0):
        yield ident, depth
        for child in self.children[ident]:
            yield from self.walk(child, depth + 1)

    def average(self, ident):
        kids = self.children[ident]
        return math.floor((self.by_id[ident]["score"] + sum(map(self.average, kids))) / (len(kids) + 1))


@pytest.fixture(scope="module", params=[1, 2])
def case(request, make):
    made = forest(request.param)
    comments = make(made)
    nodes = threads.resolve(
        threads.with_text_length(comments).withColumn("body_length", F.char_length("body")),
        carry=("author", "score", "created_utc", "body_length", "text_length", "indents"),
    ).nodes
    return Tree(made), comments, nodes


def test_roots_and_depths(case):
    tree, _, nodes = case
    want = sorted((i, r, d) for r in tree.roots for i, d in tree.walk(r))
    assert sorted((r["id"], r["root"], r["depth"]) for r in nodes.collect()) == want


def test_reading_order(case):
    tree, _, nodes = case
    got = {(r["root"], r["position"]): r["id"] for r in threads.reading_order(nodes).collect()}
    want = {(r, n): i for r in tree.roots for n, (i, _) in enumerate(tree.walk(r), start=1)}
    assert got == want


def test_recursive_average_takes_the_floor_at_every_level(case):
    tree, _, nodes = case
    got = {r["id"]: r["average"] for r in threads.recursive_average(nodes).collect()}
    assert got == {i: tree.average(i) for i in tree.by_id}


def test_recursive_average_of_a_table(spark):
    # worked by hand: e = 4; d = floor((-3 + 4) / 2) = 0; c = -8; b = floor((5 - 8 + 0) / 3) = -1; a = floor((2 - 1) / 2) = 0
    made = [("a", None, 2), ("b", "a", 5), ("c", "b", -8), ("d", "b", -3), ("e", "d", 4)]
    nodes = spark.createDataFrame([(i, p, "a", 0, s) for i, p, s in made], "id string, parent string, root string, depth int, score int")
    assert rows(threads.recursive_average(nodes), "id", "average") == [("a", 0), ("b", -1), ("c", -8), ("d", 0), ("e", 4)]


def test_long_chains_and_wide_comments(spark):
    """A chain of 2,000 comments, one of whose comments has 100,000 further replies."""
    rnd = random.Random(8)
    scores = [rnd.randint(-1000, 1000) for _ in range(2000)]
    chain = spark.createDataFrame(
        [(f"c{n}", f"c{n - 1}" if n else None, "c0", n, s) for n, s in enumerate(scores)],
        "id string, parent string, root string, depth int, score int",
    )
    star = spark.range(100_000).select(
        F.concat(F.lit("s"), "id").alias("id"), F.lit("c5").alias("parent"), F.lit("c0").alias("root"),
        F.lit(6).alias("depth"), (F.col("id") % 7).cast("int").alias("score"),
    )
    got = {r["id"]: r["average"] for r in threads.recursive_average(chain.union(star)).where("id like 'c%'").collect()}
    below = None
    for n in range(1999, -1, -1):
        total, parts = scores[n] + (below or 0), 1 + (below is not None)
        if n == 5:
            total, parts = total + sum(i % 7 for i in range(100_000)), parts + 100_000
        below = total // parts
        assert got[f"c{n}"] == below, n
    sizes = {r["id"]: r["size"] for r in threads.subtree_sizes(chain.union(star)).where("id in ('c0', 'c5', 'c6', 's1')").collect()}
    assert sizes == {"c0": 102_000, "c5": 101_995, "c6": 1994, "s1": 1}


THREADS = {
    "x": (
        "--- 2024-03-01T12:30 UTC ---\nann (3):first\nline\n"
        " bo (-1):\n"
        "  cy (0):  deep\n\n--- thread ends ---\n"
        "\n--- thread ends ---\n"
        " ann (2): later\n more\n\n--- thread ends ---\n"
        "\n--- thread ends ---\n"
    ),
    "y": "--- 2024-03-01T12:00 UTC ---\nbo (7):\n\n--- thread ends ---\n",
}


def test_text_and_its_size(make):
    comments = make(
        [
            {"id": "x4", "parent_id": "t1_x", "author": "ann", "score": 2, "body": "later\nmore", "created_utc": at("2024-03-01 12:50:00")},
            {"id": "x", "parent_id": "t3_s", "author": "ann", "score": 3, "body": "first\nline", "created_utc": at("2024-03-01 12:30:00")},
            {"id": "x3", "parent_id": "t1_x2", "author": "cy", "score": 0, "body": "deep", "created_utc": at("2024-03-01 13:30:00")},
            {"id": "x2", "parent_id": "t1_x", "author": "bo", "score": -1, "body": "", "created_utc": at("2024-03-01 12:40:00")},
            {"id": "y", "parent_id": "t3_s", "author": "bo", "score": 7, "body": "", "created_utc": at("2024-03-01 12:00:00")},
        ]
    )
    nodes = threads.resolve(threads.with_text_length(comments), carry=("created_utc", "text_length", "indents")).nodes
    got = {r["root"]: r["text"] for r in threads.thread_texts(nodes, comments, nodes).collect()}
    assert got == THREADS
    tokens = {r["root"]: r["tokens"] for r in threads.thread_tokens(nodes).collect()}
    assert tokens == {r: math.ceil(len(t) / 4) for r, t in THREADS.items()}


def test_pieces_are_numbered_without_gaps_and_give_the_text(case):
    tree, comments, nodes = case
    pieces = threads.thread_pieces(threads.in_order(nodes), comments).collect()
    whole = {r["root"]: r["text"] for r in threads.thread_texts(nodes, comments, nodes).collect()}
    tokens = {r["root"]: r["tokens"] for r in threads.thread_tokens(nodes).collect()}
    for root in tree.roots:
        own = sorted((p["piece"], p["text"], p["id"]) for p in pieces if p["root"] == root)
        assert [p[0] for p in own] == list(range(1, 2 * len(list(tree.walk(root))) + 1))
        assert "".join(p[1] for p in own) == whole[root]
        assert [p[2] for p in own if p[1] != END] == [i for i, _ in tree.walk(root)]
        assert tokens[root] == math.ceil(len(whole[root]) / 4)


def test_rollup(case):
    tree, _, nodes = case
    got = {r["root"]: (r["comments"], r["size"], r["min_score"], r["max_score"]) for r in threads.rollup(nodes).collect()}
    for root in tree.roots:
        members = [tree.by_id[i] for i, _ in tree.walk(root)]
        scores = [m["score"] for m in members]
        assert got[root] == (len(members), sum(len(m["body"]) for m in members), min(scores), max(scores))


def test_threads_of_comments_and_people(case):
    tree, _, nodes = case
    root = max(tree.roots, key=lambda r: len(list(tree.walk(r))))
    members = sorted(i for i, _ in tree.walk(root))
    assert [r[0] for r in rows(threads.thread_of(nodes, members[-1]), "id")] == members
    chosen = nodes.where(F.col("id").isin(members[0], members[-1]))
    assert rows(threads.touched_threads(nodes, (), chosen), "root") == [(root,)]
    assert [r[0] for r in rows(threads.threads_touching(nodes, chosen), "id")] == members
    got = {(r["author"], r["root"]) for r in threads.touched_threads(nodes, ("author",)).collect()}
    assert got == {(tree.by_id[i]["author"], r) for r in tree.roots for i, _ in tree.walk(r)}
    asked = [(root, members[0]), (root, "nowhere"), ("x", members[0])]
    pairs = nodes.sparkSession.createDataFrame(asked, "root string, id string")
    assert rows(threads.contains(nodes, pairs), "root", "id", "contained") == sorted(
        [(root, members[0], True), (root, "nowhere", False), ("x", members[0], False)], key=repr
    )


def test_ranked_threads(case):
    tree, _, nodes = case
    got = rows(threads.ranked_threads(threads.recursive_average(nodes)), "position", "root", "average")
    want = sorted(((r, tree.average(r)) for r in tree.roots), key=lambda x: (-x[1], x[0]))
    assert got == [(n, *x) for n, x in enumerate(want, start=1)]


def test_comments_without_a_root_say_why(make):
    links = {"a": None, "b": "", "c": "zz_1", "d": "t1_gone", "e": "t1_d", "f": "t1_e", "g": "t1_f", "g2": "t1_g",
             "h": "t1_i", "i": "t1_h", "j": "t1_i", "k": "t1_k", "l": "t1_a", "m": "t1_l", "ok": "t3_s", "ok2": "t1_ok"}
    found = threads.resolve(make([{"id": i, "parent_id": p} for i, p in links.items()]))
    reasons = {r["id"]: r["reason"] for r in found.orphans.collect()}
    assert reasons == {
        "a": "no parent", "b": "no parent", "l": "no parent", "m": "no parent", "c": "malformed parent",
        "d": "unknown parent", "e": "unknown parent", "f": "unknown parent", "g": "unknown parent", "g2": "unknown parent",
        "h": "cycle", "i": "cycle", "j": "cycle", "k": "cycle",
    }
    assert rows(found.nodes, "id", "depth") == [("ok", 0), ("ok2", 1)]


def test_a_deep_chain_and_a_hot_comment(make):
    chain = [{"id": f"c{n}", "parent_id": f"t1_c{n - 1}" if n else "t3_s"} for n in range(70)]
    hot = [{"id": f"h{n}", "parent_id": "t1_c1"} for n in range(500)]
    found = threads.resolve(make(chain + hot), carry=("score",))
    depths = {r["id"]: r["depth"] for r in found.nodes.collect()}
    assert len(depths) == 570 and depths["c69"] == 69 and depths["h7"] == 2
    assert found.orphans.count() == 0


def test_nothing_in_gives_nothing_out(make):
    empty = make([{}]).where("false")
    found = threads.resolve(empty, carry=("score",))
    assert found.nodes.count() == found.orphans.count() == 0
    assert threads.recursive_average(found.nodes).count() == 0


def test_budget_drops_the_lowest_ranked(spark):
    table = spark.createDataFrame(
        [
            ("ann", "r1", 5, 40), ("ann", "r2", 9, 30), ("ann", "r3", 5, 20), ("ann", "r4", 1, 5),
            ("bo", "r1", 5, 40), ("cy", "r9", 5, 90),
        ],
        "author string, root string, average bigint, tokens bigint",
    )
    got = threads.budgeted_prefix(table, ["author"], limit=100, share=0.8)
    assert rows(got, "author", "root", "running_tokens") == [("ann", "r1", 70), ("ann", "r2", 30), ("bo", "r1", 40)]
    drawn = threads.sampled_threads(table.where("author <> 'bo'"), seed=1, limit=100, share=0.85)
    again = threads.sampled_threads(table.where("author <> 'bo'"), seed=2, limit=100, share=0.85)
    assert rows(drawn, "root") == [("r1",), ("r2",), ("r3",), ("r4",)]
    assert rows(drawn, "position") == [(1,), (2,), (3,), (4,)]
    assert rows(drawn, "position", "root") != rows(again, "position", "root")


def test_comments_of_submissions(make):
    comments = make([{"id": "a", "parent_id": "t3_s1"}, {"id": "b", "parent_id": "t1_a"}, {"id": "c", "parent_id": "t3_s2"}])
    subs = comments.sparkSession.createDataFrame([("s1",)], "id string")
    got = threads.comments_of_submissions(threads.resolve(comments).nodes, comments, subs)
    assert rows(got, "submission", "root", "id") == [("s1", "a", "a"), ("s1", "a", "b")]
