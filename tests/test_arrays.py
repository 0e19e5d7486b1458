"""Large JSON arrays cut anywhere against a parse of the whole."""

import json
import random

import pytest

from palaver.sources import arrays, tables
from tests.conftest import rows


@pytest.fixture(scope="module")
def cut(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "700")
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    return session


def objects(seed, n):
    rnd = random.Random(seed)
    parts = ["}", "{", "[", "]", '"', "\\", "\\\\", '\\"', "},{", '"}, {"', "\n", "é🌻", "a", ", ", '{"id": "x"}', "\t\x01", "word "]
    made = []
    for i in range(n):
        body = "".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 5, 40, 400])))
        row = {"id": f"c{i}", "author": rnd.choice(["ann", "}", '"', ""]), "body": body, "score": rnd.randint(-5, 5), "created_utc": 1.5 + i}
        if rnd.random() < 0.2:
            row["more"] = {"deep": [{"a": {}}, [], {"}": "{"}], "x": [1, [2]]}
        if rnd.random() < 0.2:
            row["embedding"] = [0.5, 1.0]
        made.append(row)
    return made


@pytest.mark.parametrize("form", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_elements_of_arrays_cut_anywhere(cut, tmp_path, form):
    days = [objects(1, 150), objects(2, 40), [], [{"id": "only"}]]
    for n, day in enumerate(days):
        (tmp_path / f"day{n}.json").write_text(json.dumps(day, **form), encoding="utf-8")
    found = arrays.elements(cut, f"{tmp_path}/*.json").collect()
    for n, day in enumerate(days):
        got = sorted((json.loads(r["element"]) for r in found if r["file"].endswith(f"day{n}.json")), key=lambda r: r["id"])
        assert got == sorted(day, key=lambda r: r["id"])


def test_many_tasks_read_one_file(cut, spark, tmp_path):
    (tmp_path / "comments.json").write_text(json.dumps(objects(3, 300)))
    pieces = cut.read.option("lineSep", "}").text(str(tmp_path))
    assert pieces.rdd.getNumPartitions() > 20
    whole, split = tables.read_json_arrays(spark, str(tmp_path)), tables.read_split_arrays(cut, str(tmp_path))
    assert split.schema == whole.schema
    columns = ("id", "author", "body", "score", "created_utc")
    assert rows(split, *columns) == rows(whole, *columns) and whole.count() == 300


def test_only_split_elements_are_gathered(cut, tmp_path):
    flat = [{"id": f"c{n}", "body": "plain " * 20} for n in range(200)]
    (tmp_path / "a.json").write_text(json.dumps([*flat, {"id": "odd", "body": "a } b"}]))
    held = []
    whole = arrays.running_total

    def counted(df, *rest):
        held.append(df.count())
        return whole(df, *rest)

    arrays.running_total = counted
    try:
        assert arrays.elements(cut, str(tmp_path)).count() == 201
    finally:
        arrays.running_total = whole
    assert held == [3]  # the two pieces of one element, and the end of the array


def test_text_of_whole_elements_is_neither_stored_nor_moved(cut, tmp_path, monkeypatch):
    flat = [{"id": f"c{n}", "body": "plain " * 20} for n in range(200)]
    (tmp_path / "a.json").write_text(json.dumps([*flat, {"id": "odd", "body": "a } b"}]))
    stored = {}
    keep = arrays.materialise

    def noted(df, label, *rest):
        stored[label] = keep(df, label, *rest)
        return stored[label]

    monkeypatch.setattr(arrays, "materialise", noted)
    found = arrays.elements(cut, str(tmp_path))
    assert sorted(json.loads(r["element"])["id"] for r in found.collect()) == sorted([f"c{n}" for n in range(200)] + ["odd"])
    with_text = {label: df.count() for label, df in stored.items() if "piece" in df.columns}
    assert with_text == {"array-pieces": 3}  # the two pieces of one element, and the end of the array
