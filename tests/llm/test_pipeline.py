"""The pipeline's stages take effect, and each works on what the stage before it kept."""

from pyspark.sql import functions as F

import corpus_pipeline as p
from palaver.llm import quality, simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in p.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, kept, SF).collect(), docs.schema)
        assert after.columns == docs.columns, name
        ids = {r["doc_id"] for r in after.collect()}
        assert ids <= {r["doc_id"] for r in kept.collect()}
        if name == "near_duplicates":
            classes = simhash.near_duplicates(kept).collect()
            assert ids == {r["component_id"] for r in classes}
        if name == "quality_classifier":
            model = quality.fitted(spark, SF, docs)
            good = {r["doc_id"] for r in quality.score(docs, model).where("score >= 0.3").collect()}
            assert ids == good
        kept = after
    last = p.STAGES[-1][1](spark, kept, SF)
    assert last.count() == kept.count()
    whole = p.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, last.collect()))


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None), (1, None), (None, ""), (None, "one two three"), (2, "one two three"), (3, "w " * 30_000), (4, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"')]
    docs = spark.createDataFrame([(i, t, "en", None, None, "x", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, score string, gone int")
    for frame in (docs, docs.where("false")):
        for name, stage in p.STAGES[:-1]:
            after = stage(spark, frame, SF)
            assert after.columns == docs.columns, name
            assert after.count() <= frame.count()
        assert p.STAGES[-1][1](spark, frame, SF).count() == frame.count()


def test_rows_that_share_an_id_are_judged_each_by_its_text(spark):
    words = lambda seed: " ".join(f"{seed}{n}" for n in range(60))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first()["text"]
    made = [(5, words("a")), (5, words("b")), (9, words("b").upper()), (None, words("c")), (None, words("c")), (7, words("a")), (8, item), (8, words("d")), (None, item)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(made)], "doc_id long, text string, n int").repartition(3)
    once = p.near_duplicates(spark, docs, SF)
    assert once.columns == docs.columns
    classes = {}
    for r in once.collect():
        classes.setdefault(r["text"].split(" ")[0].lower(), []).append(r["doc_id"])
    assert classes["a0"] == [5] and classes["b0"] == [5] and classes["c0"] == [None] and len(classes[item.split(" ")[0].lower()]) == 1
    clean = p.benchmark_decontamination(spark, docs, SF)
    assert sorted(r["n"] for r in clean.collect()) == [0, 1, 2, 3, 4, 5, 7]


def test_rows_to_leave_out_are_sized_by_their_values(spark):
    """Stored names of 100,000 rows took a third of their bytes, so millions passed for a small table."""
    gone = spark.range(100_000).select(F.struct(F.lit(7).cast("long").alias("file"), F.col("id").alias("at")).alias("row"))
    rows = gone.union(spark.createDataFrame([((8, 1),)], gone.schema)).withColumnRenamed("row", "name")
    left = p._without(rows.withColumn("text", F.lit("t")), gone, "name")
    assert [tuple(r) for r in left.collect()] == [("t",)]
    plan = left._jdf.queryExecution().optimizedPlan()
    while plan.children().size() == 1:
        plan = plan.children().apply(0)
    assert int(plan.children().apply(1).stats().sizeInBytes()) >= 16 * 100_000
