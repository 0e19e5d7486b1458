"""Personal data and secrets against plain regular expressions, and odd rows."""

import hashlib
import random
import re

import pytest

from palaver.llm import pii, secrets
from tests.conftest import rows

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def strict(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))) or (
                kind == "card" and 14 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 10 <= len(d) <= 15):
                found.append((m.start(), rank, kind, m.end()))
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(found)]


def made(seed):
    rng = random.Random(seed)
    parts = ["a@b.c", "x.y%z+1@mail-1.example.com", "_d@e.f", "@", ".", "1.2.3.4", "256.1.1.1", "007.08.9.0001", "4111 1111 1111 1111",
             "4111111111111111", "4111111111111112", "+1 (374) 555-8639", "+12", "+1 2 3 4 5 6 7 8 9 0", "-", " ", "é", "👩‍🚀", "5", "12", "\n", "word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    return texts + [None, "", "9" * 20_000, "a" * 50_000 + "@", ("1-" * 5000) + "1", "+1" + "(" * 20_000]


def test_strict_spans_of_odd_texts(spark):
    texts = made(3)
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in zip(ids, texts)], "doc_id long, text string, kind string, row int")
    found = pii.personal_data(docs).collect()
    written = lambda spans: ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)
    assert sorted((str(r["doc_id"]), written(r["base"])) for r in found) == sorted((str(i), ",".join(strict(t or ""))) for i, t in zip(ids, texts))
    for r in found:
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}


def test_trees_add_numbers_of_the_wide_shapes(spark):
    rng = random.Random(1)
    digit = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
    texts = [f"call phone +1 ({digit(3)}) 555-{digit(4)} or mail x{i}@mail.example.com, not {digit(5)} 7.7.7.999" for i in range(60)]
    texts += [f"call phone ({digit(3)}) 555-{digit(4)} now"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.personal_data(docs)
    extra = [r for r in found.collect() if r["doc_id"] >= 60]
    assert all(len(r["base"]) == 0 for r in extra)
    kinds = {s["kind"] for r in extra for s in r["spans"]}
    assert kinds <= {"phone"}
    clean = dict(pii.redact(docs, found).collect())
    assert all("@" not in clean[i] and "+1" not in clean[i] for i in range(60))


def test_nothing_is_added_without_a_model(spark):
    texts = ["a.b@example.org", "and cd [at] example [dot] org"]
    found = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(s["kind"] for r in found for s in r["spans"]) == ["email"]
    assert all(r["spans"] == r["base"] for r in found)


def test_query(spark):
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    got = pii.op7_pii(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        want = strict(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(x.startswith(k) for x in want) for k in BASE]
        assert set(want) <= set(r["spans"].split(",")) | {""}


HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


def test_secrets_are_found_and_others_left(spark):
    rng = random.Random(2)
    key = lambda n, a="0123456789abcdef": "".join(rng.choice(a) for _ in range(n))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    texts = [f'some words token = "{key(40)}" more words' for _ in range(25)]
    texts += [f"é here password={key(18)} there" for _ in range(25)]
    texts += [f"the AKIA{key(16, upper)} of it" for _ in range(25)]
    plain = [f"order number {key(16, '0123456789')} was sent" for _ in range(25)] + ["a-very-long-hyphenated-word-2-of-many-parts here"] * 25
    plain += ['token = "example-value-0000-changeme" in a sample'] * 10
    docs = spark.createDataFrame(list(enumerate(texts + plain)), "doc_id long, text string")
    found = secrets.scan(docs)
    counts = {r["doc_id"]: len(r["secrets"]) for r in found.collect()}
    assert all(counts[i] == 1 for i in range(len(texts)))
    assert not any(counts[i] for i in range(len(texts), len(texts + plain)))
    clean = dict(secrets.redact(docs, found).collect())
    assert clean[0].startswith('some words token = "[SECRET]" more') and clean[26].startswith("é here password=[SECRET] there")
    assert all(clean[i] == t for i, t in enumerate(texts + plain) if i >= len(texts))


def test_odd_rows_of_secrets(spark):
    texts = [None, "", f'token = "{HEX}"', f'token = "{HEX}"', "plain", "7" * 30_000, "=" * 10_000, f'x token = "{HEX}"']
    ids = [1, 2, 3, 3, None, 6, 7, None]
    docs = spark.createDataFrame([(i, t, "m", "d") for i, t in zip(ids, texts)], "doc_id long, text string, match string, digest string")
    found = secrets.scan(docs)
    assert found.count() == len(texts)
    clean = secrets.redact(docs, found)
    assert clean.columns == docs.columns and clean.count() == len(texts)
    assert secrets.scan(docs.where("false")).count() == 0


NAME = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer)"
RUN = "[A-Za-z0-9+/_-]"


def slow_candidates(text):
    """``start: (end, match, before, after)``, values over tokens."""
    out = {}
    for m in re.finditer(rf"(?<!{RUN}){RUN}{{16,}}={{0,2}}", text):
        run = m[0].rstrip("=")
        if re.search("[0-9]", run) or re.search("[a-z].*[A-Z]", run):
            out[m.start(), m.end()] = m[0]
    at = 0
    while m := re.compile(r"""[=:]\x20{0,3}["']?[A-Za-z0-9+/_.!@#$%^&*-]{4,}""").search(text, at):
        at = m.end()
        sign = re.match(r"""[=:] {0,3}["']?""", m[0])[0]
        if re.search(NAME + r"""[a-z0-9_-]*["']? {0,3}\Z""", text[max(0, m.start() - 32) : m.start()].lower()):
            out[m.start() + len(sign), m.end()] = m[0][len(sign) :]
    return out


def test_candidates_are_those_of_plain_loops(spark):
    rng = random.Random(8)
    parts = ["token", "DB_PASSWORD_PROD", "api-key", "=", ": ", ' = "', "'", "a" * 70 + "9", "abcdefghABCDEFGH", "Abcdefghijklmnopqrst", "x7", "-", "/", " ",
             "\n", "é", "ghp_" + "a1" * 18, "1234567890123456", "hunter2", "==", "Bearer", "word", "q" * 200 + "Z" * 3]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(250)] + [None, "", "b" * 90_000 + "1", "=" * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.located(docs, secrets.PATTERNS, "doc_id", "text", {"path": secrets.F.lit("")})
    kept = secrets.values_only(secrets.candidates(found, "path")).join(found.select("row", "key"), "row")
    got = sorted((r["key"], r["start"], r["end"], r["match"]) for r in kept.collect())
    want = sorted((i, s, e, m) for i, t in enumerate(texts) for (s, e), m in slow_candidates(t or "").items())
    assert got == want and len(want) > 200
    counts = {r["doc_id"]: r["n_candidates"] for r in secrets.scan(docs).collect()}
    assert counts == {i: len(slow_candidates(t or "")) for i, t in enumerate(texts)}


def test_query_of_secrets(spark):
    table = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = secrets.op8_secrets(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(table)
    planted = re.compile(r"\b[0-9a-f]{40}\b")
    right = wrong = missed = 0
    for r in got:
        text = table[r["doc_id"]]["text"] or ""
        held = slow_candidates(text)
        assert r["n_candidates"] == len(held)
        spans = [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s]
        assert len(spans) == r["n_secrets"] and spans == sorted(spans)
        keys = {(m.start(), m.end()) for m in planted.finditer(text)}
        right, wrong, missed = right + len(keys & set(spans)), wrong + len(set(spans) - keys), missed + len(keys - set(spans))
    assert right > 0 and missed == 0 and wrong <= right // 10, (right, wrong, missed)


@pytest.mark.parametrize("name", ["pii", "secrets"])
def test_no_python_in_the_plan(spark, name):
    query = {"pii": pii.op7_pii, "secrets": secrets.op8_secrets}[name]
    plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
