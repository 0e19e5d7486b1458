"""Fingerprints against a loop over bits, and classes against all pairs."""

import random

import numpy as np
import xxhash

from palaver.llm import simhash


def slow_fingerprint(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    size = min(shingle, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + size]).encode(), seed=42).intdigest() for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(fps):
    found = list(range(len(fps)))

    def root(i):
        while found[i] != i:
            i = found[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                found[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def test_golay_code_is_perfect():
    errors = simhash.golay_errors()
    assert len(set(errors.tolist())) == 2048
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000)
    code = words ^ errors[simhash._syndrome(words)]
    assert not simhash._syndrome(code).any()
    assert (np.bitwise_count(words ^ code) <= 3).all()


def test_fingerprints():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 5, 9, 60, 400):
        text = "".join(rng.choice(["A", "bé", "日", " ", "\n", "\t ", " "]) + rng.choice(["x", " "]) for _ in range(n))
        assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def test_every_pair_within_four_bits_shares_a_bucket():
    rng = random.Random(7)
    a = [rng.getrandbits(64) for _ in range(1500)]
    b = [x ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4))) for x in a]
    at, keys = simhash.bucket_keys(np.array(a, np.uint64).view(np.int64), False)
    to, probes = simhash.bucket_keys(np.array(b, np.uint64).view(np.int64), True)
    stored, asked = {}, {}
    for i, k in zip(at.tolist(), keys.tolist()):
        stored.setdefault(i, set()).add(k)
    for i, k in zip(to.tolist(), probes.tolist()):
        asked.setdefault(i, set()).add(k)
    assert all(stored[i] & asked[i] for i in range(len(a)))


def test_classes_of_dense_and_chained_fingerprints(spark):
    rng = random.Random(11)
    fps = [0, 1, 15, 31, 2**63]
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(40):  # a dense group and a chain away from it
            fps.append(x ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 3))))
        for _ in range(8):
            x ^= sum(1 << i for i in rng.sample(range(64), 4))
            fps.append(x)
    fps = list(dict.fromkeys(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    got = dict(simhash.fingerprint_classes(spark.createDataFrame([(x,) for x in signed], "fp long")).collect())
    want = slow_classes(fps)
    groups = lambda labels: sorted(sorted(signed[i] for i in range(len(fps)) if labels[i] == c) for c in set(labels))
    assert groups([got[x] for x in signed]) == groups(want)


def test_rows_with_nulls_and_repeats(spark):
    rows = [(5, None), (4, ""), (9, " \n"), (None, "one two"), (7, "one two"), (7, "one two"), (None, "a lonely text of some words here")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, class int")
    got = sorted(((r["doc_id"], r["component_id"], r["fingerprint"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    two, lonely = (f"{slow_fingerprint(t):016x}" for t in ("one two", "a lonely text of some words here"))
    zero = "0" * 16
    want = [(5, 4, zero), (4, 4, zero), (9, 4, zero), (None, 7, two), (7, 7, two), (7, 7, two), (None, None, lonely)]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_against_all_pairs(spark):
    got = {r["doc_id"]: r for r in simhash.op3_simhash(spark, "/root/testdata/sf0.001").collect()}
    docs = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    ids = sorted(docs)
    fps = [slow_fingerprint(docs[i]) for i in ids]
    labels = slow_classes(fps)
    least = {}
    for i, c in zip(ids, labels):
        least[c] = min(i, least.get(c, i))
    assert {i: (f"{f:016x}", least[c]) for i, f, c in zip(ids, fps, labels)} == {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()}


def test_keys_are_never_broadcast(spark, monkeypatch):
    """A fingerprint has about 80 keys, which Spark's estimate of their size does not see: it took 600 MB of them for less than 10."""
    plans = []
    classes = simhash.classes

    def seen(links, *rest):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return classes(links, *rest)

    monkeypatch.setattr(simhash, "classes", seen)
    docs = spark.createDataFrame([(i, f"some words of text {i % 7} and more of them") for i in range(20)], "doc_id long, text string")
    found = simhash.near_duplicates(docs)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and not any("Broadcast" in p for p in plans)
    by = {}
    for r in found.collect():
        by.setdefault(r["fingerprint"], set()).add(r["component_id"])
    assert len(by) <= 7 and all(len(x) == 1 for x in by.values())
