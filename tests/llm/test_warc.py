"""Round trips through archives whose payloads hold the magic, and whole forged records."""

import base64
import hashlib
import random

import pytest

from palaver.llm import warc
from palaver.session import fresh_path

FORGED = warc.record("response", "666", "http://evil", "<p>forged</p>", "00" * 20, None, "1970-01-01T00:00:00Z")


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    count = {}
    for _, _, h in rows:
        count[h or ""] = count.get(h or "", 0) + 1
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = count[h or ""] > 1 and first.get(h or "", i) != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
                    first[h or ""] if again else None))
    return sorted(out, key=str)


def through(spark, rows):
    path = fresh_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    found = warc.resolved(warc.read_archives(spark, path, with_payload=False)).collect()
    number = lambda x: int(x) if x else None
    return sorted(((number(r["ident"]), r["payload_bytes"], r["payload_digest"], r["type"], number(r["refers_to"])) for r in found), key=str)


@pytest.mark.parametrize("block", ["128m", "700b"])
def test_round_trip(spark, block):
    rng = random.Random(4)
    parts = [warc.MAGIC, FORGED, FORGED + "\r\n\r\n" + FORGED, "\r\n\r\n", "é日", "text", "WARC/1.0", "\r\n", "Content-Length: 9\r\n", "x" * 900]
    rows = [(i, f"http://e/{i}\nWARC/1.0\r\nx", "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (7, "same id", "other"), (None, "u", "lonely"), (None, "u", ""), (None, None, None)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert through(spark, rows) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_payloads_come_back_whole(spark):
    rows = [(1, "u", "a" + FORGED + "b" + warc.MAGIC), (2, "u", "plain é"), (3, "u", ""), (4, "u", "plain é")]
    path = fresh_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = {r["ident"]: (r["type"], bytes(r["payload"]).decode()) for r in warc.read_archives(spark, path).collect()}
    assert got == {"1": ("response", rows[0][2]), "2": ("response", "plain é"), "3": ("response", ""), "4": ("revisit", "")}


def test_chain_does_not_reach_records_after_a_broken_one(spark):
    path = fresh_path(spark, "warc-test")
    good = [warc.record("response", str(i), None, "p", "00" * 20, None, "d") for i in range(4)]
    bad = good[2].replace("Content-Length: ", "Content-Length: 9")
    spark.createDataFrame([(x,) for x in (good[0], good[1], bad, good[3])], "r string").coalesce(1).write.option(
        "lineSep", warc.SEPARATOR
    ).text(path)
    assert sorted(r["ident"] for r in warc.read_archives(spark, path, with_payload=False).collect()) == ["0", "1"]


def test_empty_table(spark):
    assert through(spark, []) == []


def test_ids_that_repeat_with_other_payloads(spark):
    rows = [(1, "u", "AAAA"), (1, "u", "BB"), (2, "u", "AAAA"), (3, "u", "BB")]
    path = fresh_path(spark, "warc-test")
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, sha1 string, first string")
    warc.write_archives(pages, path)
    found = warc.resolved(warc.read_archives(spark, path, with_payload=False)).collect()
    sha = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    got = sorted((r["ident"], r["payload_bytes"], r["payload_digest"], r["type"], r["refers_to"]) for r in found)
    assert got == sorted([("1", 4, sha("AAAA"), "response", None), ("1", 2, sha("BB"), "response", None),
                          ("2", 4, sha("AAAA"), "revisit", "1"), ("3", 2, sha("BB"), "revisit", "1")])


def test_small_payloads_are_not_revisits(spark):
    path = fresh_path(spark, "warc-test")
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path, least_bytes=3)
    assert {r["ident"]: r["type"] for r in warc.read_archives(spark, path, with_payload=False).collect()} == {
        "1": "response", "2": "response", "3": "response", "4": "revisit"}


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()
    got = sorted((tuple(r) for r in warc.op6_warc(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == expected([tuple(r) for r in rows])
