"""Classifier and language model: held-out quality, exact word statistics, and odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from palaver.llm import mixing, quality
from tests.conftest import rows

SF = "/root/testdata/sf0.01"


def test_attention_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality.FIGURES)).astype(np.float32) for n in (1, 4, 2, 5, 3, 2)]
    labels = np.array([0, 1, 0, 1, 1, 0])
    loose, tight = quality.train(bags, labels, rounds=1), quality.train(bags, labels, rounds=200)
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    loss = lambda m: -np.mean(np.log(np.where(labels == 1, p := m.forward(np.concatenate(bags), starts)["p"], 1 - p)))
    assert loss(tight) < 0.1 * loss(loose)


def test_one_bad_passage_is_weighed():
    good, bad = "plain words of some length here " * 40, "### $$$ *** &&& %%% " * 40
    shown = quality.passages(good.encode()), quality.passages(bad.encode())
    model = quality.train([shown[0]] * 20 + [shown[1]] * 20, np.array([1] * 20 + [0] * 20))
    assert model.scores([good.encode()])[0] > 0.9 > 0.1 > model.scores([bad.encode()])[0]


def test_held_out_accuracy(spark):
    scored = {r["doc_id"]: r for r in quality.op4_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(scored) == docs
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(scored[r["doc_id"]]["held_out"] for r in held)
    assert np.mean([scored[r["doc_id"]]["predicted"] == r["quality"] for r in held]) > 0.95


def test_odd_rows_of_the_classifier(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "", 5), (3, "a b", 5), (3, "a b", 5), (4, "w " * 50_000, 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, None), (3, 0, None), (9, 1, 1), (4, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    found = quality.score(docs, model, out="_s")
    assert found.columns == ["doc_id", "text", "score", "_s"] and found.where("_s between 0 and 1").count() == 5
    assert quality.keep_good(docs, model).columns == docs.columns
    none = labels.where("false")
    assert quality.fit(docs, none).constant == 0.5
    assert quality.fit(docs, labels.where("doc_id = 1")).constant == 1.0
    assert quality.score(docs.where("false"), model, out="_s").count() == 0


def slow_base(made, learned):
    tokens = [(t or "").encode().lower().split() for _, t in made]
    taught = [x for x, l in zip(tokens, learned) if l]
    counts = Counter(w for x in taught for w in x)
    n, v = sum(counts.values()) + len(taught), len(counts) + bool(taught)
    floor = n + (v + 1)
    out = []
    for (i, _), x in zip(made, tokens):
        base = sum(math.log10((counts[w] + 1) / floor) for w in x) + math.log10((len(taught) + 1) / floor)
        out.append((i, len(x) + 1, sum(counts[w] > 0 for w in x) + bool(taught), n, round(base, 6)))
    return sorted(out, key=repr)


def test_word_statistics_with_odd_rows(spark, monkeypatch):
    rng = random.Random(2)
    made = [(i, " ".join(rng.choice(["A", "a", "bé", "日", "c\x0bd"]) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    made += [(None, "null id"), (70, None), (71, ""), (72, " \n"), (5, "again"), (5, "again"), (73, "long " * 3000)]
    monkeypatch.setattr(mixing, "SEGMENT_TOKENS", 100)
    docs = spark.createDataFrame([(*r, "k", 1) for r in made], "doc_id long, text string, key string, learned int")
    got = mixing.scores(docs, quality.remainder("doc_id", 7) != 2).collect()
    learned = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for i, _ in made]
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=repr) == slow_base(made, learned)
    assert all(r["score"] < 0 for r in got)
    assert mixing.scores(docs.where("false"), quality.remainder("doc_id", 7) != 2).count() == 0
    alone = mixing.scores(docs.where("doc_id = 71"), quality.remainder("doc_id", 7) > 9).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in alone] == [(1, 0, 0)]


def slow_cost(model, text):
    """The same predictor, bit by bit."""
    symbols = [0] * 5 + list(text) + [mixing.END]
    array = np.array(symbols, np.uint16)
    weights, total, kept = model.weights.astype(np.float64).copy(), 0.0, []
    for at in range(5, len(symbols)):
        if (at - 5) % mixing.STRETCH == 0:
            weights = model.weights.astype(np.float64).copy()
        s = symbols[at]
        context = mixing.contexts(array, np.array([at]))
        for k in range(int(model.code.length[s])):
            place = int(model.code.start[s]) + k
            node, bit = model.code.node[place : place + 1], int(model.code.bit[place])
            x = np.array([model.odds[mixing.slots(o, c, node)[0]] / mixing.SCALE for o, c in enumerate(context)] + [1.0])
            gate = min(k, mixing.GATES // 2 - 1) + (symbols[at - 1] > 32) * (mixing.GATES // 2)
            z = float(x @ weights[gate])
            p = 1 / (1 + math.exp(-z))
            total += math.log10(p if bit else 1 - p)
            weights[gate] = weights[gate] + mixing.RATE * (bit - p) * x
    return total


def test_scores_are_those_of_a_bit_by_bit_predictor(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["the ", "and ", "ing ", "é", "\n", "xq"]) for _ in range(n)) for n in (1, 40, 200, 900)]
    docs = spark.createDataFrame([(t,) for t in texts * 3], "text string")
    model = mixing.fit(docs)
    samples = [t.encode() for t in texts] + [b"", b"zz\x00\xff", b"the and " * 300]
    found = model.costs(samples)[0]
    for text, score in zip(samples, found):
        assert abs(score - slow_cost(model, text)) < 1e-3 * abs(score) + 1e-3
    assert np.allclose(found, [model.costs([t])[0][0] for t in samples], rtol=1e-5)


def test_held_out_texts_cost_little(spark):
    got = [r for r in mixing.op5_mixing(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    texts = dict(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect())
    size = sum(len((texts[r["doc_id"]] or "").encode()) for r in got)
    assert -sum(r["score"] for r in got) * math.log2(10) / size < 2.6


def test_every_context_of_every_text_is_counted_apart(spark):
    rng = random.Random(5)
    texts = [bytes(rng.randrange(32, 127) for _ in range(rng.randint(0, 300))) for _ in range(120)]
    model = mixing.fit(spark.createDataFrame([(t.decode(),) for t in texts], "text string").repartition(3))
    counts = Counter()
    for t in texts:
        s = [0] * 5 + list(t) + [mixing.END]
        for at in range(5, len(s)):
            for k in range(int(model.code.length[s[at]])):
                place = int(model.code.start[s[at]]) + k
                for o, n in enumerate(mixing.ORDERS):
                    counts[o, tuple(s[at - n : at]), int(model.code.node[place]), int(model.code.bit[place])] += 1
    steps = {k[:3] for k in counts}
    assert len(model.odds.keys) == len(steps) > 100_000
    for o, context, node in rng.sample(sorted(steps), 3000):
        number = np.array([sum(x << 8 * i for i, x in enumerate(reversed(context)))], np.uint64)
        zero, one = (counts[o, context, node, b] for b in (0, 1))
        found = model.odds[mixing.slots(o, number, np.array([node], np.uint32))][0]
        assert found == np.clip(np.rint(math.log((one + 0.4) / (zero + 0.4)) * mixing.SCALE), -127, 127)
    assert model.odds[mixing.slots(2, np.array([1 << 39], np.uint64), np.array([3], np.uint32))][0] == 0


def test_code_and_first_weights_come_from_all_texts_of_any_length(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["the ", "and ", "ing ", "xq"]) for _ in range(4000)) for _ in range(6)]
    assert min(map(len, texts)) > 8192
    model = mixing.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    counts = np.bincount(np.frombuffer("".join(texts).encode(), np.uint8), minlength=mixing.END + 1)
    counts[mixing.END] = len(texts)
    assert model.code.length.tolist() == mixing.Code(counts).length.tolist()
    assert model.code.length[ord(" ")] < model.code.length[0]
    assert abs(model.weights[0, :3] - 0.35).max() > 0.01


def test_no_path_is_longer_than_there_are_gates():
    code = mixing.Code(np.array([int(1.7**min(i, 80)) for i in range(mixing.END + 1)]))
    assert max(code.length) <= mixing.GATES // 2 and sum(2.0 ** -code.length) == 1


def test_weights_run_through_the_whole_text(spark, monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["the ", "and ", "ing ", "\n"]) for _ in range(n)) for n in (10, 400)]
    model = mixing.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    samples = [bytes(rng.choice(b"qzxv and") for _ in range(n)) for n in (5000, 3000, 0, 17)]
    found = model.costs(samples)[0]
    monkeypatch.setattr(mixing, "STRETCH", 1 << 40)
    assert np.allclose(found, [slow_cost(model, t) for t in samples], rtol=1e-4)
    monkeypatch.setattr(mixing, "TOGETHER", 64)
    monkeypatch.setattr(mixing, "LANES", 3)
    assert np.allclose(found, model.costs(samples)[0], rtol=1e-6)


def test_words_and_sums_of_a_segment_are_those_of_plain_python():
    rng = random.Random(8)
    texts = [b"", b" \n", b" A  b\x0bB\x1cd\x85 \x00e\x0c", "É日 ÀB x".encode()]
    texts += [bytes(rng.choice(b" \t\n\x0b\x0c\r\x1c\x1f aAbZz\xc3\xa9") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    split = [t.lower().split() for t in texts]
    words, sizes = mixing.words_of(texts)
    numbers, distinct = mixing.numbered(words)
    flat = [w for x in split for w in x]
    assert sizes.tolist() == [len(x) for x in split] and distinct == list(dict.fromkeys(flat))
    assert [distinct[i] for i in numbers] == flat
    keys = [rng.choice([0, 7, (1 << 51) - 1, rng.randrange(1 << 51)]) for _ in range(500)]
    counts = [rng.choice([0, 1, 8191, 8192, 1 << 31]) for _ in keys]
    plain = Counter()
    for k, c in zip(keys, counts):
        plain[k] += c
    found, total = mixing.summed(np.array(keys, np.uint64), np.array(counts, np.int64))
    assert list(zip(found.tolist(), total.tolist())) == sorted(plain.items())


def test_texts_left_over_are_scored_as_in_step(spark, monkeypatch):
    rng = random.Random(9)
    texts = ["".join(rng.choice(["the ", "and ", "ing ", "\n"]) for _ in range(n)) for n in (10, 400)]
    model = mixing.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    samples = [bytes(rng.choice(b"qzxv and") for _ in range(n)) for n in (3000, 900, 900, 0, 17, 300)]
    found = []
    for few in (0, 1, 4, 9):
        monkeypatch.setattr(mixing, "FEW", few)
        found.append(model.costs(samples)[0])
    assert np.allclose(found, found[0], rtol=1e-5)
