"""Figures of any part of a thread, containment and nested JSON against plain recursion."""

import json
import random

import pytest
from pyspark.sql import functions as F

from palaver.operators import threads
from tests.conftest import rows
from tests.test_threads import Tree, forest


@pytest.fixture(scope="module")
def case(make):
    made = forest(5)
    made.append({"id": 'q"x', "parent_id": "t3_s", "score": 0, "author": 'a"b\\', "created_utc": made[0]["created_utc"], "body": 'say "no"\t\x01'})
    made.append({"id": "under", "parent_id": 't1_q"x', "score": -3, "author": "bo", "created_utc": made[0]["created_utc"], "body": "é🌻"})
    comments = make(made)
    nodes = threads.resolve(comments.withColumn("body_length", F.char_length("body")), carry=("score", "created_utc", "body_length")).nodes
    return Tree(made), comments, nodes


def test_figures_of_every_subtree(case):
    tree, _, nodes = case
    want = []
    for root in tree.roots:
        for ident, _ in tree.walk(root):
            below = list(tree.walk(ident))
            scores = [tree.by_id[i]["score"] for i, _ in below]
            size = sum(len(tree.by_id[i]["body"]) for i, _ in below)
            want.append((ident, root, len(below), max(d for _, d in below), size, min(scores), max(scores)))
    got = rows(threads.subtree_rollup(nodes), "id", "root", "comments", "levels", "size", "min_score", "max_score")
    assert got == sorted(want, key=repr)


def chain_and_star(spark):
    chain = spark.range(600).selectExpr(
        "concat('c', id) AS id", "IF(id = 0, null, concat('c', id - 1)) AS parent", "'c0' AS root", "cast(id AS int) AS depth",
        "cast(id % 13 AS int) AS score", "cast(id AS int) AS body_length", "timestamp_seconds(id) AS created_utc",
    )
    star = spark.range(50_000).selectExpr(
        "concat('s', id) AS id", "'c5' AS parent", "'c0' AS root", "6 AS depth", "cast(-1 - id % 7 AS int) AS score", "1 AS body_length",
        "timestamp_seconds(id) AS created_utc",
    )
    return chain.union(star)


def test_a_chain_and_a_star(spark):
    nodes = chain_and_star(spark)
    got = {r["id"]: tuple(r)[2:] for r in threads.subtree_rollup(nodes).where("id in ('c0', 'c5', 'c6', 'c599', 's7')").collect()}
    total = sum(range(600))
    assert got == {
        "c0": (50_600, 599, total + 50_000, -7, 12), "c5": (50_595, 594, total - 10 + 50_000, -7, 12),
        "c6": (594, 593, total - 15, 0, 12), "c599": (1, 0, 599, 1, 1), "s7": (1, 0, 1, -1, -1),
    }


def test_finished_comments_leave_the_rounds(spark):
    # 50,000 comments at depth 6 of a chain of 600: from the fourth round on only the chain climbs
    written = []
    whole = threads.materialise

    def counted(df, label, *rest):
        out = whole(df, label, *rest)
        written.append((label, out.count() if label != "places" else out.where("climbing").count()))
        return out

    threads.materialise = counted
    try:
        threads.in_order(chain_and_star(spark)).count()
    finally:
        threads.materialise = whole
    for label in ("figures", "places"):
        sizes = [n for name, n in written if name == label]
        assert len(sizes) > 8 and max(sizes[4:]) <= 600, (label, sizes)


def test_no_round_of_averages_joins_on_null(spark):
    nodes = chain_and_star(spark).select("id", "parent", "root", "depth", "score").where("depth < 40")
    state = threads.materialise(
        nodes.selectExpr("id", "parent", "root", "depth", "cast(score AS bigint) AS total", "1L AS count", "null AS target",
                         "null AS add", "null AS parts", "null AS value", "null AS step", "null AS average")
        .selectExpr("id", "parent", "root", "depth", "total", "count", "cast(target AS string) target", *[f"cast({c} AS bigint) {c}" for c in ("add", "parts", "value", "step", "average")]),
        "state",
    )
    plan = threads._lengthened(state.where("target is not null"), state.where("average is not null"), -7, 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(target" in plan


def test_contains_by_intervals(case):
    tree, comments, nodes = case
    below = {(top, i) for root in tree.roots for top, _ in tree.walk(root) for i, _ in tree.walk(top)}
    rnd = random.Random(3)
    names = [*tree.by_id, "nobody"]
    asked = [(rnd.choice(names), rnd.choice(names)) for _ in range(400)] + rnd.sample(sorted(below), 60)
    pairs = comments.sparkSession.createDataFrame(asked, "top string, id string")
    got = rows(threads.subtree_contains(threads.in_order(nodes), pairs), "top", "id", "contained")
    assert got == sorted(((t, i, (t, i) in below) for t, i in asked), key=repr)


@pytest.mark.parametrize("slim", [False, True])
def test_nested_json_is_the_recursive_form(case, slim):
    tree, comments, nodes = case

    def shown(ident):
        r = tree.by_id[ident]
        if slim:
            return {"author": r["author"], "body": r["body"], "score": r["score"]}
        return {
            "author": r["author"], "author_flair_text": None, "score": r["score"], "id": ident, "permalink": paths[ident], "body": r["body"],
            "created_utc": r["created_utc"].timestamp(), "parent_id": r["parent_id"],
        }

    def nested(ident, parent=None):
        kids = [nested(c, ident) for c in tree.children[ident]]
        out = {"comment": shown(ident)}
        if parent or not slim:
            out["parent"] = parent
        if kids or not slim:
            out["children"] = kids
        return out

    paths = {r["id"]: r["permalink"] for r in comments.collect()}
    pieces = threads.nested_pieces(threads.in_order(nodes), nodes, comments, slim).collect()
    assert len(pieces) == len(tree.by_id)
    for root in tree.roots:
        text = "".join(r["text"] for r in sorted((r for r in pieces if r["root"] == root), key=lambda r: r["position"]))
        assert json.loads(text) == nested(root)
