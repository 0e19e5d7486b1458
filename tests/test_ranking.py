from collections import defaultdict

from pyspark.sql import functions as F

from palaver.operators.ranking import running_total, top_k


def test_running_total_spreads_a_hot_group(spark):
    table = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        (F.col("id") * 7919 % 1000).alias("rank"),
        F.col("id"),
        (F.col("id") % 11).alias("v"),
    ).repartition(8)
    got = running_total(table, ["g"], ["rank", "id"], "v", [False, True]).collect()
    groups = defaultdict(list)
    for r in got:
        groups[r["g"]].append(r)
    assert len(got) == 6000
    for members in groups.values():
        total = 0
        for r in sorted(members, key=lambda r: (-r["rank"], r["id"])):
            total += r["v"]
            assert r["running"] == total


def test_running_total_works_on_several_pieces_of_one_group(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.range(4000).select(F.lit("only").alias("g"), F.col("id"), F.lit(1).alias("v"))
        got = running_total(table, ["g"], ["id"], "v", [True])
        assert got.where("running <> id + 1").count() == 0
        ungrouped = running_total(table, [], ["id"], "v", [True])
        assert ungrouped.where("running <> id + 1").count() == 0 and ungrouped.count() == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_top_k_by_group_and_overall(spark):
    table = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), ("a", 2)], "g string, v int")
    best = top_k(table, ["g"], [F.desc("v")], 2).collect()
    assert sorted((r["g"], r["v"], r["position"]) for r in best) == [("a", 2, 2), ("a", 3, 1), ("b", 2, 1)]
    assert [(r["v"], r["position"]) for r in top_k(table, [], [F.desc("v")], 1).collect()] == [(3, 1)]
