"""Tables in parts: commits, what they read, and what stays."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.operators import boards
from palaver.operators.clean import latest_by_id
from palaver.session import file_system, fresh_path, shared_dir
from palaver.sources import tables
from palaver.sources.parts import Parts
from tests.conftest import at, rows
from tests.test_streaming import garble

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("dt_date", T.DateType())])


def frame(spark, made):
    return spark.createDataFrame([(i, n, dt.date(2024, 3, d)) for i, n, d in made], SCHEMA)


def test_commits_are_made_once(spark, tmp_path):
    table = Parts(spark, str(tmp_path), SCHEMA)
    assert table.version() is None and table.latest() is None and table.read().collect() == []
    assert table.append(frame(spark, [("a", 1, 1), ("b", 2, 2)]), 4)
    assert not table.append(frame(spark, [("a", 1, 1)]), 4) and not table.merge(frame(spark, [("a", 1, 1)]), 3, lambda x: x)
    assert table.append(frame(spark, [("c", 3, 2)]), 5)
    assert rows(table.read(), "id", "n") == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(table.parts(), "dt_date", "version", "rows") == [(dt.date(2024, 3, 1), 4, 1), (dt.date(2024, 3, 2), 4, 1), (dt.date(2024, 3, 2), 5, 1)]
    assert table.latest() == dt.date(2024, 3, 2)


def test_a_merge_replaces_the_parts_it_touches(spark, tmp_path):
    table = Parts(spark, str(tmp_path), SCHEMA)
    newest = lambda both: latest_by_id(both, ["n"])
    table.merge(frame(spark, [("a", 1, 1), ("b", 1, 1), ("c", 1, 2)]), 0, newest)
    garble(tmp_path, lambda name: name.endswith("01"))
    table.merge(frame(spark, [("a", 2, 1), ("d", 2, 1)]), 1, newest)
    assert rows(table.read([dt.date(2024, 3, 1)]), "id", "n") == [("a", 2), ("b", 1), ("d", 2)]
    table.replace(frame(spark, [("x", 0, 2)]), 2)
    assert rows(table.read(), "id", "n") == [("a", 2), ("b", 1), ("d", 2), ("x", 0)]


def test_a_commit_that_is_not_whole_does_not_count(spark, tmp_path):
    table = Parts(spark, str(tmp_path), SCHEMA)
    table.append(frame(spark, [("a", 1, 1)]), 0)
    table.append(frame(spark, [("b", 1, 1)]), 1)
    (tmp_path / "parts" / "version=1" / "_SUCCESS").unlink()
    assert rows(table.read(), "id") == [("a",)]
    assert table.append(frame(spark, [("b", 1, 1)]), 1)
    assert rows(table.read(), "id") == [("a",), ("b",)]


def test_replaced_data_goes_two_commits_later(spark, tmp_path):
    table = Parts(spark, str(tmp_path), SCHEMA)
    for n in range(5):
        table.replace(frame(spark, [("a", n, 1)] + [("b", n, 2)] * (n == 0)), n)
    assert table.versions() == [3, 4]
    held = sorted(str(p.relative_to(tmp_path / "data")) for p in (tmp_path / "data").glob("version=*/dt_date=*"))
    assert held == ["version=0/dt_date=2024-03-02", "version=3/dt_date=2024-03-01", "version=4/dt_date=2024-03-01"]
    assert rows(table.read(), "id", "n") == [("a", 4), ("b", 0)]


def test_the_latest_day_needs_no_scan_of_all_days(make, spark, tmp_path):
    comments = make([{"id": f"x{d}", "created_utc": at(f"2024-03-{d:02d} 12:00:00")} for d in range(1, 9)])
    table = tables.comment_table(spark, str(tmp_path), comments.schema)
    tables.insert(comments, table, 0, ["created_utc"])
    found = tables.of_days(table[0].read(), latest=tables.latest_day(table[0].parts()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # the table itself is scanned for the day found, the days are found in their list
    whole = [line for line in scans if "permalink" in line]
    assert len(whole) == 1 and len(scans) > 1
    assert "dt_date" in whole[0].split("PartitionFilters:")[1].split("]")[0]
    garble(tmp_path / "comments", lambda name: name.endswith("08"))
    assert rows(found, "id") == [("x8",)]
    assert rows(table[0].parts(), "dt_date", "rows", "first")[0] == (dt.date(2024, 3, 1), 1, dt.datetime(2024, 3, 1, 12))


def test_an_insert_meets_its_days_and_buckets_only(make, spark, tmp_path):
    stored = make([{"id": f"s{n}", "score": n, "created_utc": at(f"2024-03-{1 + n % 6:02d} 12:00:00")} for n in range(60)])
    table = tables.comment_table(spark, str(tmp_path), stored.schema)
    tables.insert(stored, table, 0, ["created_utc"])
    garble(table[1].path, lambda name: name.startswith("slot=2024-03-02"))
    garble(table[0].path, lambda name: False)
    more = make([{"id": i, "score": s, "created_utc": at("2024-03-02 12:00:00")} for i, s in (("s1", -1), ("new", 0), ("new", 5), ("s7", 9))])
    for _ in range(2):
        tables.insert(more, table, 1, ["score"], falsy_as_null=True)
    added = [r for r in table[0].parts().collect() if r["version"] == 1]
    assert [(r["dt_date"], r["rows"]) for r in added] == [(dt.date(2024, 3, 2), 1)]
    new = table[0]._read([(dt.date(2024, 3, 2), 1)])
    assert rows(new, "id", "score") == [("new", None)]


def test_rolling_census(make):
    days = {"ann": (1, 2, 9), "bo": (3,), "cy": (3, 20)}
    made = [{"author": a, "created_utc": at(f"2024-03-{d:02d} 12:00:00"), "author_flair_text": ":x: Y" if (a, d) == ("ann", 2) else None}
            for a, of in days.items() for d in of for _ in range(2)]
    got = rows(boards.rolling_census(make(made), 7), "dt_date", "accounts", "users")
    pairs = {(r["author"], r["author_flair_text"], r["created_utc"].day) for r in made}
    want = []
    for end in range(1, 21):
        near = [(a, f) for a, f, d in pairs if end - 7 < d <= end]
        want.append((dt.date(2024, 3, end), len({a for a, _ in near}), len(set(near))))
    assert got == sorted(want, key=repr)
    assert boards.rolling_census(make(made).where(F.lit(False))).collect() == []


def test_known_parts_are_written_once_and_combined_only_with_old_rows(spark, tmp_path):
    table, combined = Parts(spark, str(tmp_path), SCHEMA), []

    def newest(both):
        combined.append(1)
        return latest_by_id(both, ["n"])

    days = [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    copies = _copies(spark, "batch")
    assert table.merge(frame(spark, [("a", 1, 1), ("b", 1, 2)]), 0, newest, days) and combined == []
    assert table.merge(frame(spark, [("c", 1, 3)]), 1, newest, [dt.date(2024, 3, 3)]) and combined == []
    assert table.merge(frame(spark, [("a", 2, 1), ("d", 1, 4)]), 2, newest, [days[0], dt.date(2024, 3, 4)]) and combined == [1]
    assert rows(table.read(), "id", "n") == [("a", 2), ("b", 1), ("c", 1), ("d", 1)]
    assert _copies(spark, "batch") == copies


def test_an_insert_stores_no_copy_of_its_bodies(spark, make):
    given = make([{"id": "a", "created_utc": at("2024-03-01 12:00:00")}, {"id": "b", "created_utc": at("2024-03-02 12:00:00")}])
    more = make([{"id": "a", "body": "late"}, {"id": "c", "body": "new"}, {"id": "c", "body": "later", "created_utc": at("2024-03-01 13:00:00")}])
    table = tables.comment_table(spark, fresh_path(spark, "insert-test"), given.schema)
    before = _copies(spark, "inserted") | _copies(spark, "to-insert")
    tables.insert(given, table, 0, ["created_utc"])
    tables.insert(more, table, 1, ["created_utc"])
    assert rows(table[0].read(), "id", "body") == [("a", "some words"), ("b", "some words"), ("c", "new")]
    assert rows(table[1].read(), "id") == [("a",), ("b",), ("c",)]
    made = (_copies(spark, "inserted") | _copies(spark, "to-insert")) - before
    assert all(set(spark.read.parquet(path).columns) == {"id", "slot"} for path in made)


def _copies(spark, label):
    """Tables of that label below the shared folder."""
    fs, pattern = file_system(spark, f"{shared_dir(spark)}/palaver/{spark.sparkContext.applicationId}/{label}-*")
    return {s.getPath().toString() for s in fs.globStatus(pattern) or ()}
