"""Measurements against plain loops, and policies and ablations from bits."""

import random
import re

from palaver.llm import rules
from tests.conftest import rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), len(lines),
        sum("A" <= c <= "Z" for c in text),
    )


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["a", "b", "C", "dé", "日本", "#*", "|", "\n", "\n\n", " ", "\t", "\x0b", "\x1f", " ", "same line here\n", "x y z v w "]
    return ["".join(rng.choice(parts) + rng.choice([" ", " ", ""]) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_measurements():
    for text in ["", " \n", "a b c d e a b c d e", "a " * 9, *texts(1, 400)]:
        assert rules.measure_text(text.encode()) == slow(text), text


def test_ledger_of_nulls_repeats_and_clashing_columns(spark):
    made = [(1, None), (1, None), (None, "word " * 12), (3, "a b c d e f g h i j k l"), (4, "A" * 50 + " b" * 10), (5, "x" * 200_000)]
    docs = spark.createDataFrame([(i, t, 7, "q") for i, t in made], "doc_id long, text string, n_words int, fail_bits string")
    got = rows(rules.ledger(docs), "doc_id", *rules.MEASURES, "fail_bits")
    want = []
    for i, t in made:
        m = slow(t) if len(t or "") < 1000 else (1, 200_000, 0, 0, 0, 1, 0)
        n, chars, symbols, dup, rep, lines, caps = m
        bits = (n < 10) | (100 * rep > 20 * n) << 1 | (100 * symbols > 5 * chars) << 2 | (100 * dup > 50 * lines) << 3 | (100 * caps > 40 * chars) << 4
        want.append((i, *m, bits))
    assert got == sorted(want, key=repr)


def test_ablations(spark):
    bits = [0, 1, 1, 2, 3, 4, 16, 17, 28]
    frame = spark.createDataFrame([(b,) for b in bits], "fail_bits long")
    got = {(r["policy"], r["rule"]): r for r in rules.ablations(frame).collect()}
    for policy in rules.POLICIES:
        mask = policy.mask(rules.RULES)
        for rule in rules.RULES:
            if rule.name not in policy.rules:
                assert (policy.version, rule.name) not in got
                continue
            row, bit = got[policy.version, rule.name], 1 << rule.bit
            assert row["n_kept"] == sum(not b & mask for b in bits)
            assert row["n_kept_without"] == sum(not b & mask & ~bit for b in bits)
            assert row["n_failed_alone"] == sum(b & mask == bit for b in bits)


def test_empty_table(spark):
    assert rules.ledger(spark.createDataFrame([], "doc_id long, text string")).collect() == []
