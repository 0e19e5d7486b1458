"""Phrases and proximity against loops over all windows."""

import random
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from palaver.llm import decontamination
from palaver.llm import decontamination as d
from tests.conftest import rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(item)
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for window, owners in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= {str(o) for o in owners if o is not None}
        out.append((key, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    left = spark.createDataFrame([(*x, 1, "s") for x in docs], "doc_id long, text string, segment int, item string")
    right = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, window int")
    found = d.contamination(left, right).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found), key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "the", "é", "日", "x1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 13, 14, 20])))) for i in range(12)]
    items += [(3, "again the same id"), (None, "no id a B the é 日 x1 a a a a a a"), (20, None), (21, "!?")]
    docs = []
    for i in range(40):
        parts = [rng.choice([rng.choice(items)[1] or "", " ".join(rng.choice(vocabulary) for _ in range(9))]) for _ in range(rng.randint(0, 4))]
        docs.append((i, " , ".join(parts)))
    docs += [(5, docs[5][1]), (None, "a B the"), (50, None), (51, ""), (52, "the " * 3000)]
    return docs, items


def test_phrases(spark, monkeypatch):
    for seed in (1, 2):
        docs, items = case(seed)
        assert got(spark, docs, items) == slow(docs, items)


def test_small_segments_and_blocks(spark, monkeypatch):
    docs, items = case(3)
    monkeypatch.setattr(d.build_index, "__defaults__", ("doc_id", "text", 50))
    monkeypatch.setattr(d.matches, "__defaults__", (26, 7))
    assert got(spark, docs, items) == slow(docs, items)


def test_proximity(spark):
    docs = [(1, "alpha " + "w " * 20 + "omega"), (2, "alpha " + "w " * 30 + "omega"), (3, "omega alpha"), (4, "alpha"), (5, "alpha omega")]
    items = [(9, "alpha omega")]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    found = d.contamination(left, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: (r["items"], r["near_items"]) for r in found} == {
        1: ([], ["9"]), 2: ([], []), 3: ([], ["9"]), 4: ([], []), 5: (["9"], [])}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert d.contamination(none, items).collect() == []
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_hit"], r["contaminated"]) for r in d.contamination(docs, empty).collect()] == [(0, False)]


def test_positions_followed_in_small_parts(spark, monkeypatch):
    common = "the of and to a in is it you that he was for on are " * 40
    docs = spark.createDataFrame([(1, common), (2, "x " + common), (3, "y z")], "doc_id long, text string")
    items = spark.createDataFrame([(1, common[:300]), (2, "y")], "item_id long, text string")
    columns = ("doc_id", "n_words", "n_hit", "items", "near_items", "contaminated")
    whole = rows(decontamination.contamination(docs, items), *columns)
    lookup = decontamination.Lookup([" ".join(common.split()[i : i + 13]) for i in range(15)])
    segment = decontamination._segment([docs.select("doc_id").limit(1).toArrow().column(0).combine_chunks()], [common.encode().split()], 0)
    part = lambda c: segment.column(c)[0].values
    order = lookup.rarest_first({})
    args = (lookup, order, 26, part("words"), *(part(c).to_numpy() for c in ("ends", "positions", "starts", "counts")))
    near, phrases = decontamination._intersect(*args)
    monkeypatch.setattr(decontamination, "ANCHORS", 7)
    again = decontamination._intersect(*args)
    assert again[0] == near and {d: sorted(p) for d, p in again[1].items()} == {d: sorted(p) for d, p in phrases.items()}
    assert len(phrases[0]) > 500 and whole[0][2] == 600


def test_few_segments_share_a_row_group(spark):
    """Ninety segments of 30,000 words were one row group, held whole in writing and in reading."""
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(29_999)), lambda w: w * 7919 + F.col("id")))
    docs = spark.range(0, 90, 1, 1).select(F.col("id").alias("doc_id"), words.alias("text"))
    index = decontamination.build_index(docs, segment_words=30_000)
    groups = []
    for path in index.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file://")).metadata
        groups += [meta.row_group(g) for g in range(meta.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 90
    assert len(groups) > 2 and max(g.total_byte_size for g in groups) < 12 << 20
    assert index.select(F.explode(F.arrays_zip("keys", "counts")).alias("d")).select("d.*").distinct().count() == 90


def test_matches_are_never_broadcast(spark):
    """What is exploded from matches is larger than Spark takes it for; the list of windows may be broadcast, they may not."""
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x a b c"), (3, "c b a")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "a b c"), ("j", "b c d"), (None, "a b c")], "item_id string, text string")
    found = decontamination.contamination(docs, items)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["near_items"]) for r in found.collect()}
    assert got == {1: (4, ["i", "j"], []), 2: (3, ["i"], []), 3: (0, [], ["i"])}
