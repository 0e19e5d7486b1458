"""Activity and winners by hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palaver.operators.boards import DAY
from palaver.operators.clean import enrich
from palaver.session import materialise

HOUR = 3600


def activity(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Comments per hour without gaps, also scaled to 0..1; NULL where all hours are equal.

    Only the hour counts are joined and spread, never comments. Whether any hour is empty
    follows from the number of hours seen, so the scale needs no window.
    """
    source = "hour" if "hour" in comments.columns else "created_utc"
    counts = enrich(comments.select(*by, source))
    # a row per hour at most, needed twice: written, so that the comments are scanned once
    hours = materialise(counts.groupBy(*by, "hour").agg(F.count("*").alias("comments")), "hours")
    bounds = hours.groupBy(*by).agg(
        F.min("hour").alias("_from"),
        F.max("hour").alias("_to"),
        F.count("*").alias("_seen"),
        F.min("comments").alias("_least"),
        F.max("comments").alias("_most"),
    )
    full = (F.col("_to") - F.col("_from")) / HOUR + 1 == F.col("_seen")
    least = F.when(full, F.col("_least")).otherwise(F.lit(0))
    grid = bounds.select(
        *by,
        F.explode(F.sequence("_from", "_to", F.lit(HOUR).cast("bigint"))).alias("hour"),
        least.alias("_least"),
        "_most",
    )
    filled = grid.join(hours, [*by, "hour"], "left").withColumn("comments", F.coalesce("comments", F.lit(0)))
    norm = (F.col("comments") - F.col("_least")) / F.nullif(F.col("_most") - F.col("_least"), F.lit(0))
    return filled.select(*by, "hour", "comments", norm.alias("norm_count")).orderBy(*by, "hour")


def hourly_wordiest(comments: DataFrame) -> DataFrame:
    """Most words per hour; all authors who share the maximum."""
    words = enrich(comments).groupBy("hour", "author").agg(F.sum("word_count").alias("word_count"))
    rank = F.rank().over(Window.partitionBy("hour").orderBy(F.desc("word_count")))
    return words.withColumn("_rank", rank).where("_rank <= 1").drop("_rank")


def hourly_spammiest(comments: DataFrame) -> DataFrame:
    """Most comments per hour; of several authors the first by name."""
    counts = enrich(comments).groupBy("hour", "author").agg(F.count("*").alias("comment_count"))
    rank = F.row_number().over(Window.partitionBy("hour").orderBy(F.desc("comment_count"), F.asc("author")))
    return counts.withColumn("_rank", rank).where("_rank <= 1").drop("_rank")
