import datetime as dt
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from palaver import session
from palaver.plans import daily, loading
from palaver.sources import tables
from palaver.streaming import jobs
from tests.conftest import at, rows


def three_days(make):
    return make(
        [
            {"id": "a", "created_utc": at("2024-03-01 12:00:00.123456")},
            {"id": "b", "created_utc": at("2024-03-02 06:59:59")},
            {"id": "c", "created_utc": at("2024-03-02 07:00:00"), "score": 0, "author": ""},
            {"id": "d", "created_utc": at("2024-03-04 12:00:00")},
        ]
    )


def test_days_are_pruned_and_replaced_one_by_one(make, spark, tmp_path):
    path = str(tmp_path / "table")
    tables.write_days(three_days(make), path)
    stored = tables.read_days(spark, path)
    assert rows(stored, "id", "dt_date") == [
        ("a", dt.date(2024, 3, 1)), ("b", dt.date(2024, 3, 1)), ("c", dt.date(2024, 3, 2)), ("d", dt.date(2024, 3, 4)),
    ]
    assert rows(tables.of_days(stored), "id") == [("d",)]
    assert rows(tables.of_days(stored, dt.date(2024, 3, 2)), "id") == [("c",)]
    assert rows(tables.of_days(stored, [dt.date(2024, 3, 3), dt.date(2024, 3, 1)]), "id") == [("a",), ("b",)]
    assert rows(tables.last_days(stored, 3), "id") == [("c",), ("d",)]
    assert rows(tables.last_days(stored, 0, dt.date(2024, 3, 1)), "id") == [("a",), ("b",)]
    plan = tables.of_days(stored, dt.date(2024, 3, 2)).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt_date" in plan and "body" not in plan
    tables.write_days(make([{"id": "new", "created_utc": at("2024-03-02 12:00:00")}]), path)
    assert rows(tables.read_days(spark, path), "id") == [("a",), ("b",), ("d",), ("new",)]


def test_json_days_keep_every_field(make, spark, tmp_path):
    path = str(tmp_path / "json")
    tables.write_json_days(three_days(make), path)
    back = tables.read_json_days(spark, path)
    assert rows(back, "id", "dt_date", "created_utc", "score", "author") == rows(
        three_days(make), "id", "dt_date", "created_utc", "score", "author"
    )


def test_json_arrays_of_several_days(spark, tmp_path):
    row = {"author": "ann", "author_flair_text": None, "score": 3, "id": "a", "permalink": "/p", "body": "x\ny",
           "created_utc": 1709294400.5, "parent_id": "t3_s", "embedding": [], "embedding_model": None}
    for day, ids in (("2024-03-01", "ab"), ("2024-03-02", "c")):
        (tmp_path / day).mkdir()
        (tmp_path / day / "comments.json").write_text(json.dumps([{**row, "id": i} for i in ids], indent=1))
    got = tables.read_json_arrays(spark, f"{tmp_path}/2024-03-*/comments.json")
    assert rows(got, "id") == [("a",), ("b",), ("c",)]
    first = got.select(F.unix_micros("created_utc").alias("t"), "body", "author_flair_text").first()
    assert tuple(first) == (1709294400500000, "x\ny", None)
    text = spark.createDataFrame([(json.dumps(row),)], "line string")
    assert rows(tables.from_json_column(text, "line"), "id", "score") == [("a", 3)]


def test_stored_rows_win_on_insert(make, spark, tmp_path):
    path = str(tmp_path / "inserted")
    tables.write_days(make([{"id": "a", "score": 7}]), path)
    again = make([{"id": "a", "score": 1, "permalink": "2"}, {"id": "b", "score": 5, "permalink": "1"},
                  {"id": "b", "score": 6, "permalink": "0"}, {"id": "c", "score": 0, "author": ""}])
    tables.insert_new(again, path, ["permalink"], falsy_as_null=True)
    got = tables.read_days(spark, path)
    assert rows(got, "id", "score", "author") == [("a", 7, "ann"), ("b", 6, "ann"), ("c", None, None)]
    tables.insert_new(again, path, ["permalink"])
    assert tables.read_days(spark, path).count() == 3


def test_a_harvest_replaces_its_days(make, spark, tmp_path):
    path = str(tmp_path / "harvest")
    day = dt.date(2024, 3, 1)
    snapshot = make(
        [
            {"id": "a", "score": 1},
            {"id": "a", "score": 2, "permalink": "/z"},
            {"id": "gone", "author": None, "score": 9},
            {"id": "late", "created_utc": at("2024-03-02 07:00:01")},
            {"id": "edge", "created_utc": at("2024-03-02 07:00:00")},
        ]
    ).withColumn("dt_date", F.lit(day))
    for _ in range(2):
        loading.harvest(snapshot, path, ["permalink"])
    got = tables.read_days(spark, path)
    assert rows(got, "id", "author", "score") == [("a", "ann", 2), ("edge", "ann", 1), ("gone", "", 0)]
    assert got.where(F.col("dt_date") != day).count() == 0


def test_a_stored_day_is_loaded_once(make, spark, tmp_path):
    archive, path = tmp_path / "archive", str(tmp_path / "loaded")
    tables.write_days(make([{"id": "old", "created_utc": at("2024-02-01 12:00:00")}]), path)
    (archive / "2024-03-01").mkdir(parents=True)
    row = {"author": "ann", "score": 0, "permalink": "/p", "body": "", "created_utc": 1709294400, "parent_id": "t3_s"}
    (archive / "2024-03-01" / "comments.json").write_text(json.dumps([{**row, "id": "a"}, {**row, "id": "old"}]))
    for _ in range(2):
        loading.load_day(spark, str(archive), dt.date(2024, 3, 1), path)
    assert rows(tables.read_days(spark, path), "id", "score", "body") == [("a", None, None), ("old", 1, "some words")]


def test_written_tables_go_to_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    kept = session.materialise(spark.range(3).toDF("n"), "probe")
    assert kept.count() == 3 and all(f.startswith(f"file://{named}/palaver/") for f in kept.inputFiles())


def test_a_cluster_must_name_the_shared_folder():
    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn", "applicationId": "app"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_reports_are_written_per_metric(make, spark, tmp_path):
    report = daily.full_report(three_days(make))
    daily.write_report(report, str(tmp_path), "json")
    best = spark.read.json(str(tmp_path / "upvoted_comments"))
    assert rows(best, "id", "created_utc") == [("a", 1709294400.123456), ("b", 1709362799.0), ("d", 1709553600.0)]
    assert spark.read.json(str(tmp_path / "hourly_spammiest")).count() == 3
    assert set(report) == {p.name for p in tmp_path.iterdir()}


def test_release_deletes_what_the_application_has_written(spark, tmp_path, monkeypatch):
    from palaver import session

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    session.materialise(spark.range(3), "gone").count()
    assert list(tmp_path.glob("palaver/*/gone-*"))
    session.release(spark)
    assert not list(tmp_path.glob("palaver/*"))


def test_stored_days_are_compressed(make, spark, tmp_path):
    comments = three_days(make)
    tables.write_json_days(comments, str(tmp_path / "json"))
    tables.write_days(comments, str(tmp_path / "days"))
    tables.comment_table(spark, str(tmp_path / "parts"), comments.schema)[0].append(comments, 0)
    jobs.snapshot_table(spark, str(tmp_path / "snapshots"), comments.schema).append(comments.withColumn("batch", F.lit(0).cast("long")), 0)
    ends = {"json": ".json.gz", "days": ".zstd.parquet", "parts/comments/data": ".zstd.parquet", "snapshots/data": ".zstd.parquet"}
    for folder, end in ends.items():
        names = [p.name for p in (tmp_path / folder).rglob("part-*")]
        assert len(names) >= 3 and all(name.endswith(end) for name in names)
    assert rows(tables.read_json_days(spark, str(tmp_path / "json")), "id") == [("a",), ("b",), ("c",), ("d",)]


def test_report_bodies_move_once_and_are_stored_densely(spark, make, tmp_path):
    """The list of all comments was joined with bodies in hand, dealt by day after that, and stored with Snappy."""
    comments = three_days(make)
    bodies = comments.select(F.col("id").alias("body_id"), "body")
    asked = []

    def complete(rows):
        asked.append(rows.columns)
        return rows.join(bodies, F.col("id") == F.col("body_id")).drop("body_id")

    report = daily.full_report(comments, comments.drop("body"), complete)
    assert len(asked) == 1 and "body" not in asked[0]
    plain = daily.full_report(comments)
    for name, frame in plain.items():
        assert sorted(map(str, report[name].select(frame.columns).collect())) == sorted(map(str, frame.collect())), name
    daily.write_report(report, str(tmp_path / "r"))
    files = list((tmp_path / "r" / "upvoted_comments").rglob("*.parquet"))
    assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)
