import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from palaver.operators import users
from palaver.sources.parts import bucket, slot
from palaver.streaming import jobs
from tests.conftest import at, rows


def drop(frame, folder, name):
    frame.coalesce(1).write.parquet(f"{folder}/{name}")


def stream_of(spark, schema, folder):
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(folder)


def test_ingested_snapshots_keep_the_last_version(make, spark, tmp_path):
    source, table, marks = (str(tmp_path / n) for n in ("in", "table", "marks"))
    first = make([{"id": f"s{n}", "score": n} for n in range(6)]).withColumn("ingest_ts", F.lit(1))
    second = make([{"id": f"s{n}", "score": 10 + n} for n in range(3, 9)]).withColumn("ingest_ts", F.lit(2))
    drop(first.union(first), source, "one")
    drop(second, source, "two")
    for _ in range(2):  # the second run has nothing left to do
        jobs.finish(jobs.ingest_snapshots(stream_of(spark, first.schema, source), table, marks))
    got = jobs.read_latest(jobs.snapshot_table(spark, table, first.schema))
    want = [(f"s{n}", n if n < 3 else 10 + n) for n in range(9)]
    assert rows(got, "id", "score") == want


def test_hourly_counts_once_per_id_however_late(make, spark, tmp_path):
    source, table, marks = (str(tmp_path / n) for n in ("in", "table", "marks"))
    times = {"a": "08:05", "b": "08:50", "c": "09:10", "d": "11:30", "e": "12:00"}
    frame = make([{"id": i, "created_utc": at(f"2024-03-01 {t}:00")} for i, t in times.items()])
    tomorrow = make([{"id": "new", "created_utc": at("2024-03-03 08:00:00")}])
    drop(frame.where("id > 'b'").union(tomorrow), source, "one")
    drop(frame.union(frame), source, "two")  # a and b arrive when later hours have been seen
    stream = jobs.drop_late(stream_of(spark, frame.schema, source), F.lit(dt.date(2024, 3, 1)))
    for _ in range(2):
        jobs.finish(jobs.ingest_sightings(stream, table, marks))
    start = int(at("2024-03-01 08:00:00").timestamp())
    got = rows(jobs.hourly_counts(spark, table), "hour", "comment_count")
    assert got == [(start, 2), (start + 3600, 1), (start + 3 * 3600, 1), (start + 4 * 3600, 1)]


def test_requests_are_answered_once_while_fresh(make, spark, tmp_path):
    source, results, marks = (str(tmp_path / n) for n in ("in", "results", "marks"))
    comments = make([{"author": a, "score": s} for a, s in (("ann", 4), ("ann", 8), ("bo", 1))])
    schema = "username string, requester_comment_id string, days int"
    day, now = F.lit(dt.date(2024, 3, 1)), F.lit(at("2024-03-01 20:00:00"))
    drop(spark.createDataFrame([("ann", "q1", 7), ("ann", "q1", 7), ("nobody", "q1", 7)], schema), source, "one")

    def run():
        jobs.finish(jobs.answer_requests(stream_of(spark, schema, source), comments, day, day, now, results, marks))
        return jobs.read_answers(spark, results)

    assert rows(run(), "username", "requester_comment_id", "average_score") == [("ann", "q1", 6.0)]
    drop(spark.createDataFrame([("ann", "q2", 7), ("bo", "q3", 7), ("ann", "q4", 30)], schema), source, "two")
    assert rows(run(), "username", "requester_comment_id", "average_score") == [
        ("ann", "q1", 6.0), ("ann", "q4", 6.0), ("bo", "q3", 1.0),
    ]
    batch = users.user_results(comments, spark.createDataFrame([("ann", "q4", 30)], schema), day, day)
    assert rows(run().where("days = 30"), "max_comments", "top_score") == rows(batch, "max_comments", "top_score")


def garble(folder, keep):
    """Make all data files below ``folder`` unreadable but those in folders that ``keep`` accepts."""
    for file in Path(folder).glob("data/version=*/*/*.parquet"):
        if not keep(file.parent.name):
            file.write_bytes(b"not a table" * 10)
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def test_a_batch_touches_its_days_only(make, spark, tmp_path):
    source, table, marks = (str(tmp_path / n) for n in ("in", "table", "marks"))
    first = make([{"id": f"s{n}", "score": n, "created_utc": at(f"2024-03-{1 + n:02d} 12:00:00")} for n in range(9)]).withColumn("ingest_ts", F.lit(1))
    drop(first, source, "one")
    jobs.finish(jobs.ingest_snapshots(stream_of(spark, first.schema, source), table, marks))
    garble(table, lambda name: name == "dt_date=2024-03-03")
    second = make([{"id": "s2", "score": 50, "created_utc": at("2024-03-03 12:00:00")}, {"id": "new", "created_utc": at("2024-03-20 12:00:00")}])
    drop(second.withColumn("ingest_ts", F.lit(2)), source, "two")
    jobs.finish(jobs.ingest_snapshots(stream_of(spark, first.schema, source), table, marks))
    store = jobs.snapshot_table(spark, table, first.schema)
    days = [dt.date(2024, 3, 3), dt.date(2024, 3, 20)]
    assert rows(jobs.read_latest(store, days), "id", "score") == [("new", 1), ("s2", 50)]
    assert store.latest() == days[1] and store.versions() == [0, 1]


def test_a_sighting_meets_the_ids_of_its_buckets_only(make, spark, tmp_path):
    source, table, marks = (str(tmp_path / n) for n in ("in", "table", "marks"))
    frame = make([{"id": f"s{n}", "created_utc": at(f"2024-03-{1 + n % 5:02d} 12:{n % 60:02d}:00")} for n in range(200)])
    drop(frame, source, "one")
    jobs.finish(jobs.ingest_sightings(stream_of(spark, frame.schema, source), table, marks))
    ledger, counts = jobs.sightings(spark, table)
    again = frame.where("id IN ('s7', 's12')").withColumn("id", F.col("id"))
    mine = {r[0] for r in again.select(slot(F.col("dt_date"), F.col("id"))).collect()}
    garble(ledger.path, lambda name: name.split("=")[1] in mine)
    garble(counts.path, lambda name: name == "dt_date=2024-03-03")
    drop(again, source, "two")
    for _ in range(2):
        jobs.finish(jobs.ingest_sightings(stream_of(spark, frame.schema, source), table, marks))
    assert counts.read([dt.date(2024, 3, 3)]).agg(F.sum("comment_count")).first()[0] == 40
    assert len(mine) == 2


def test_a_batch_that_ended_between_its_two_commits_counts_once(make, spark, tmp_path):
    table = str(tmp_path / "table")
    frame = make([{"id": f"s{n}"} for n in range(5)])
    ledger, counts = jobs.sightings(spark, table)
    source, marks = str(tmp_path / "in"), str(tmp_path / "marks")
    drop(frame, source, "one")
    counted = frame.select(F.lit(1).cast("long").alias("hour"), "author", F.lit(5).cast("long").alias("comment_count"), "dt_date").limit(1)
    counts.append(counted, 0)  # as if the run had ended here
    jobs.finish(jobs.ingest_sightings(stream_of(spark, frame.schema, source), table, marks))
    assert jobs.hourly_counts(spark, table).agg(F.sum("comment_count")).first()[0] == 5
    assert ledger.read().count() == 5


def test_requests_read_the_buckets_of_their_keys(make, spark, tmp_path):
    source, results, marks = (str(tmp_path / n) for n in ("in", "results", "marks"))
    comments = make([{"author": f"u{n}", "score": n} for n in range(40)])
    schema = "username string, requester_comment_id string, days int"
    day, now = F.lit(dt.date(2024, 3, 1)), F.lit(at("2024-03-01 20:00:00"))
    drop(spark.createDataFrame([(f"u{n}", "q", 7) for n in range(40)], schema), source, "one")

    def run(when):
        jobs.finish(jobs.answer_requests(stream_of(spark, schema_of(schema, spark), source), comments, day, day, when, results, marks))

    run(now)
    store = jobs.answers(spark, results)
    mine = spark.createDataFrame([("u3-week",)], "k string").select(bucket(F.col("k"), jobs.ANSWER_BUCKETS)).first()[0]
    before = store.read([mine]).count()
    garble(results, lambda name: name == f"bucket={mine}")
    drop(spark.createDataFrame([("u3", "again", 7)], schema), source, "two")
    run(F.lit(at("2024-03-05 20:00:00")))  # the stored answer is stale by then
    kept = rows(store.read([mine]).where("username = 'u3'"), "requester_comment_id", "batch")
    assert kept == [("again", 1)] and store.read([mine]).count() == before


def schema_of(text, spark):
    return spark.createDataFrame([], text).schema
