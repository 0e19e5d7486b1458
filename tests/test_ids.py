from pyspark.sql import functions as F

from palaver.operators import clean
from tests.conftest import rows


def test_one_version_per_id_even_with_many_copies(spark):
    copies = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("i"), F.col("id") % 100)).alias("id"),
        F.col("id").alias("ingest_ts"),
    )
    last, first = clean.latest_by_id(copies, ["ingest_ts"]), clean.first_by_id(copies, ["ingest_ts"])
    assert last.count() == first.count() == 101
    assert rows(last.where("id = 'hot'"), "ingest_ts") == [(4998,)]
    assert rows(first.where("id = 'hot'"), "ingest_ts") == [(0,)]


def test_lookups_and_intersections(make):
    frame = make([{"id": i} for i in ("a", "b", "b2", "c")])
    ids = frame.where("id in ('a', 'c')").select("id").union(frame.sparkSession.createDataFrame([("zz",)], "id string"))
    assert rows(clean.by_ids(frame, ids), "id") == [("a",), ("c",)]
    assert rows(clean.common_ids(frame.union(frame), ids), "id") == [("a",), ("c",)]


def test_only_missing_parents_are_filled(make):
    frame = make([{"id": "a", "parent_id": None}, {"id": "b", "parent_id": "t1_q"}, {"id": "c", "parent_id": ""}])
    lookup = frame.sparkSession.createDataFrame([("a", "t3_s"), ("b", "t3_other")], "id string, parent_id string")
    assert rows(clean.fill_parents(frame, lookup), "id", "parent_id") == [("a", "t3_s"), ("b", "t1_q"), ("c", None)]


def test_one_of_several_parents_is_filled(make):
    frame = make([{"id": "a", "parent_id": None}, {"id": "b", "parent_id": None}])
    lookup = frame.sparkSession.createDataFrame([("a", "t3_z"), ("a", "t3_s"), ("a", None)], "id string, parent_id string")
    assert rows(clean.fill_parents(frame, lookup), "id", "parent_id") == [("a", "t3_s"), ("b", None)]


def test_author_filter(make):
    frame = make([{"id": "a"}, {"id": "b", "author": "bo"}, {"id": "c", "author": "cy"}])
    wanted = frame.where("author <> 'cy'").select("author")
    assert rows(clean.of_authors(frame, wanted.union(wanted)), "id") == [("a",), ("b",)]


def test_fetch_without_broadcast(make, spark):
    frame = make([{"id": f"f{n}", "body": "b" * n} for n in range(50)])
    winners = frame.where("id in ('f3', 'f7')").select("id", F.lit(1).alias("place"))
    want = [("f3", "bbb", 1), ("f7", "bbbbbbb", 1)]
    assert rows(clean.fetch(frame, winners, ["id"]), "id", "body", "place") == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = clean.fetch(frame, winners, ["id"])
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
        assert rows(shuffled, "id", "body", "place") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
