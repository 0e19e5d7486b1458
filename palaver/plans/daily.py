"""The daily report: every metric of every day from one pass over the bodies."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palaver.fixed import DAY_START_HOUR, SHORT_EMOJI, SHORT_LIST
from palaver.functions.text import flair_label
from palaver.functions.times import thread_day
from palaver.operators import boards, hourly
from palaver.operators.clean import clean, drop_blank, drop_excluded, narrow
from palaver.operators.ranking import top_k
from palaver.session import materialise
from palaver.sources.tables import COMPRESSION, encode


def enriched(comments: DataFrame) -> DataFrame:
    """Comments of people, with word counts and emoji but without bodies, as a written table.

    This is the one scan of the bodies; the metrics read this far smaller table.
    """
    return materialise(narrow(drop_excluded(comments)), "enriched", ["dt_date"])


def _rows(df: DataFrame, metrics: dict[str, Column], name: Column, detail: Column) -> DataFrame:
    """Long form: one row per metric, whose values become doubles."""
    pairs = [F.struct(F.lit(m).alias("metric"), value.cast("double").alias("value")) for m, value in metrics.items()]
    long = df.select(
        "dt_date", name.cast("string").alias("name"), detail.cast("string").alias("detail"), F.inline(F.array(*pairs))
    )
    return long.select("dt_date", "metric", "name", "detail", "value")


def _ranked(table: DataFrame) -> DataFrame:
    """The leaderboards, cut to their length by one window over day and metric."""
    none = F.lit(None)
    author, flair = F.col("author"), F.col("author_flair_text")
    authors = table.groupBy("dt_date", "author").agg(
        F.sum("word_count").alias("words"),
        F.sum("score").alias("score"),
        F.sum(F.size("emoji")).alias("emoji"),
    )
    pairs = boards.author_flair_counts(table).join(authors, ["dt_date", "author"])
    per_comment = lambda total: F.bround(F.col(total) / F.col("comment_count"), 1)
    entries = [
        _rows(
            authors,
            {
                "wordiest_overall": F.col("words"),
                "upvoted_redditors": F.col("score"),
                "emoji_spammers": F.col("emoji"),
            },
            author,
            none,
        ),
        _rows(
            pairs,
            {
                "wordiest": per_comment("words"),
                "best_redditors": per_comment("score"),
                "spammiest": F.col("comment_count"),
            },
            author,
            flair,
        ),
        _rows(boards.emoji_uses(table), {"top_emoji": F.col("uses")}, F.col("emoji"), none),
        _rows(table, {"upvoted_comments": F.col("score")}, F.col("id"), none),
    ]
    best = top_k(
        reduce(DataFrame.unionByName, entries),
        ["dt_date", "metric"],
        [F.desc("value"), F.asc("name"), F.asc("detail")],
        SHORT_EMOJI,
    )
    kept = F.when(F.col("metric") == "top_emoji", SHORT_EMOJI).otherwise(SHORT_LIST)
    return best.where(F.col("position") <= kept).withColumn("position", F.col("position").cast("bigint"))


def _hour_number() -> Column:
    """Number of an hour in its thread day, from 1."""
    day_start = F.unix_seconds(F.col("dt_date").cast("timestamp")) + DAY_START_HOUR * 3600
    return ((F.col("hour") - day_start) / 3600 + 1).cast("bigint")


def _hourly(table: DataFrame) -> DataFrame:
    """Activity, and the winners of every hour from one aggregate of hour and author."""
    hour, none = F.col("hour"), F.lit(None)
    # thread days begin on a full hour, so an hour lies in one day
    counts = table.groupBy("dt_date", "hour", "author").agg(
        F.sum("word_count").alias("words"), F.count("*").alias("comments")
    )
    entries = _rows(
        counts, {"hourly_wordiest": F.col("words"), "hourly_spammiest": F.col("comments")}, hour, F.col("author")
    )
    # words keep everyone at the maximum, comments the first by name
    tie = F.when(F.col("metric") == "hourly_spammiest", F.col("detail"))
    place = F.rank().over(Window.partitionBy("dt_date", "name", "metric").orderBy(F.desc("value"), tie))
    winners = entries.withColumn("_place", place).where("_place <= 1").drop("_place")
    active = _rows(hourly.activity(table), {"activity": F.col("norm_count")}, hour, none)
    both = active.unionByName(winners).withColumn("hour", F.col("name").cast("bigint"))
    return both.withColumn("position", _hour_number()).drop("hour")


def _totals(table: DataFrame, people: DataFrame) -> DataFrame:
    """Flairs, users and blank comments."""
    none = F.lit(None)
    labelled = boards.users(people).withColumn("flair", flair_label(F.col("author_flair_text")))
    per_flair = labelled.groupBy("dt_date", "flair").agg(F.count("*").alias("n"))
    bare = F.when(F.col("flair") == "", F.col("n")).otherwise(F.lit(0))
    users = per_flair.groupBy("dt_date").agg(F.sum("n").alias("unique_users"), F.sum(bare).alias("unflaired"))
    blank = boards.bad_counts(table)
    parts = [
        _rows(per_flair.where("flair <> ''"), {"flair_population": F.col("n")}, F.col("flair"), none),
        _rows(users, {c: F.col(c) for c in ("unique_users", "unflaired")}, none, none),
        _rows(blank, {c: F.col(c) for c in ("deleted", "removed", "other_blank")}, none, none),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("position", none.cast("bigint"))


def short_report(comments: DataFrame) -> DataFrame:
    """The truncated lists, hourly lists and totals of every day in long form.

    Lists keep their first three entries and emoji their first 150; hourly lists are whole.
    """
    table = enriched(comments)
    people = drop_blank(table)
    parts = [_ranked(people), _hourly(people), _totals(table, people)]
    return reduce(DataFrame.unionByName, parts)


def _with_day(hours: DataFrame) -> DataFrame:
    # thread days begin on a full hour, so an hour lies in one day
    return hours.withColumn("dt_date", thread_day(F.timestamp_seconds("hour")))


def full_report(
    comments: DataFrame, bare: DataFrame | None = None, complete: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> dict[str, DataFrame]:
    """Every metric of every day, whole and sorted, by name. ``bare`` and ``complete`` as in ``boards.upvoted_comments``."""
    table = enriched(comments)
    people = drop_blank(table)
    return {
        "bad_counts": boards.bad_counts(table),
        "spammiest": boards.spammiest(people),
        "wordiest_overall": boards.wordiest_overall(people),
        "wordiest": boards.wordiest_average(people),
        "upvoted_comments": boards.upvoted_comments(clean(comments), bare=None if bare is None else clean(bare), complete=complete),
        "upvoted_redditors": boards.most_upvoted(people),
        "best_redditors": boards.best_average(people),
        "activity": hourly.activity(people),
        "hourly_wordiest": _with_day(hourly.hourly_wordiest(people)),
        "hourly_spammiest": _with_day(hourly.hourly_spammiest(people)),
        "emoji_spammers": boards.emoji_spammers(people),
        "top_emoji": boards.top_emoji(people),
        "user_totals": boards.user_totals(people),
        "flair_population": boards.flair_population(people),
    }


#: Metrics without an order of their own.
_UNSORTED = ("bad_counts", "hourly_wordiest", "hourly_spammiest", "user_totals", "upvoted_comments")

#: What a stored metric says in long form: the name and detail of an entry, and its values by metric.
_LONG = {
    "bad_counts": (None, None, {c: c for c in ("deleted", "removed", "other_blank")}),
    "spammiest": ("author", "author_flair_text", {"spammiest": "comment_count"}),
    "wordiest_overall": ("author", None, {"wordiest_overall": "word_count"}),
    "wordiest": ("author", "author_flair_text", {"wordiest": "avg_words"}),
    "upvoted_comments": ("id", "body", {"upvoted_comments": "score", "upvoted_position": "position"}),
    "upvoted_redditors": ("author", None, {"upvoted_redditors": "score"}),
    "best_redditors": ("author", None, {"best_redditors": "avg_score"}),
    "activity": ("hour", None, {"activity": "norm_count"}),
    "hourly_wordiest": ("hour", "author", {"hourly_wordiest": "word_count"}),
    "hourly_spammiest": ("hour", "author", {"hourly_spammiest": "comment_count"}),
    "emoji_spammers": ("author", None, {"emoji_spammers": "emoji_count"}),
    "top_emoji": ("emoji", None, {"top_emoji": "uses"}),
    "user_totals": (None, None, {c: c for c in ("unique_users", "unflaired", "flair_kinds")}),
    "flair_population": ("flair", None, {"flair_population": "redditors"}),
}


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """All metrics that ``write_report`` has stored as Parquet, in long form."""
    column = lambda c: F.lit(None) if c is None else F.col(c)
    frames = [
        _rows(spark.read.parquet(f"{path}/{name}"), {m: F.col(c) for m, c in values.items()}, column(entry), column(detail))
        for name, (entry, detail, values) in _LONG.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def write_report(report: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """One table per metric below ``path``, replacing the days the report covers.

    In JSON, times are epoch seconds. Frames sorted by day keep their order and lie in few files a day as they
    are; the others are spread by day first.
    """
    for name, frame in report.items():
        frame = encode(frame) if fmt == "json" and "created_utc" in frame.columns else frame
        frame = frame.hint("rebalance", "dt_date") if name in _UNSORTED else frame
        kept = {"partitionOverwriteMode": "dynamic", **COMPRESSION.get(fmt, {})}
        frame.write.mode("overwrite").options(**kept).partitionBy("dt_date").format(fmt).save(f"{path}/{name}")
