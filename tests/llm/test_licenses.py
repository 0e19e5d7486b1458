"""Blocks, the set-similarity join and places against plain loops."""

import random
import re

import pytest

from palaver.llm import licenses
from palaver.llm.licenses import Template
from tests.conftest import rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {ord(c): c.lower() for c in licenses.CAPITALS}
COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def slow(text, templates=licenses.TEMPLATES, threshold=80, stride=licenses.STRIDE):
    words = WORD.findall((text or "").translate(LOWER))
    longest = max(len(t.text.split()) for t in templates)
    places, base, labels, score = [], set(), set(), 0.0
    for t in templates:
        sequence, held = t.text.split(), set(t.text.split())
        if t.exact:
            at = [i for i in range(len(words)) if words[i : i + len(sequence)] == sequence]
            places += at
            if at:
                base.add(t.label), labels.add(t.label)
                score = 1.0
            continue
        for first in range(0, len(words), stride):
            part = len(held & set(words[first : first + stride + longest - 1])) / len(held)
            if part * 100 >= threshold - 1e-9:
                labels.add(t.label)
                score = max(score, part)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score,
    )


def texts(seed, n):
    rng = random.Random(seed)
    pieces = [t.text for t in licenses.TEMPLATES] + ["under", "the", "mit", "license", "CC BY-NC", "Apache License, Version 2.0", "lorem", "été", "日本", "\x00", "\x7f", "\n\n"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 30)):
            piece = rng.choice(pieces).split(" ")
            piece = [w for w in piece if rng.random() > 0.08]
            if rng.random() < 0.3:
                rng.shuffle(piece)
            words += [w.upper() if rng.random() < 0.1 else w for w in piece] + ["filler"] * rng.choice([0, 0, 1, 5, 40])
        out.append("".join(w + rng.choice([" ", " ", ", ", "-", "\n"]) for w in words))
    return out


@pytest.fixture(scope="module")
def documents(spark):
    made = [None, "", " \n.,", "Under the MIT license", "under  the, MIT--license under the mit license", "x" * 100_000, "a " * 200_000 + "cc by nc"]
    made += ["w " * 62 + "under the mit license " + "w " * 70, "w " * 63 + "cc by nc cc by nc", "K license İ UNDER THE MIT LICENSE"]
    return made + texts(1, 250)


def test_scan_is_the_brute_force(spark, documents):
    ids = [None if i % 50 == 3 else i // 2 for i in range(len(documents))]  # ids repeat, some are null
    docs = spark.createDataFrame(
        [(i, t, 1, "r", "k") for i, t in zip(ids, documents)], "doc_id long, text string, n_words int, row string, key string"
    ).repartition(7)
    got = rows(licenses.scan(docs), "doc_id", *COLUMNS)
    assert got == sorted(((i, *slow(t)) for i, t in zip(ids, documents)), key=repr)


@pytest.mark.parametrize("threshold", [50, 80, 95])
def test_other_templates_and_thresholds(spark, threshold):
    templates = (
        Template("a", "one two three four five six seven eight nine ten"), Template("b", "two two three x y"),
        Template("c", "one one two", True), Template("d", "ten"),
    )
    rng = random.Random(threshold)
    names = "one two three four five six seven eight nine ten x y z w v".split()
    made = [" ".join(rng.choice(names) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = rows(licenses.scan(docs, templates, threshold, stride=8), "doc_id", *COLUMNS)
    assert got == sorted(((i, *slow(t, templates, threshold, 8)) for i, t in enumerate(made)), key=repr)


def test_pairs_come_once_and_rare_words_first(spark, documents):
    docs = spark.createDataFrame(list(enumerate(documents)), "doc_id long, text string")
    stored = licenses.blocks(docs)
    found = licenses.matches(stored)
    pairs = rows(found, "row", "block", "template")
    assert len(pairs) == len(set(pairs)) > 100
    order = licenses.word_order(stored)
    assert order.index("noncommercial") < order.index("license") and len(order) == len(set(order))


def test_native_plan_and_bounded_broadcast(spark):
    docs = spark.createDataFrame([(1, "under the mit license")], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_against_sql(spark):
    from checks.compare import compare, connect

    folder = "/root/testdata/sf0.001"
    fine, note = compare(spark, connect(folder), "op12_licenses", licenses.op12_licenses, licenses.OP12_SQL, folder)
    assert fine, note
