"""Row filters, normalisation, de-duplication and derived columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palaver.fixed import DELETED_BODY, EXCLUDED_AUTHORS, REMOVED_BODY, THREAD_TITLES
from palaver.functions.emoji import emoji_list
from palaver.functions.text import word_count
from palaver.functions.times import day_end, hour_start
from palaver.session import materialise


def drop_excluded(comments: DataFrame, authors: Sequence[str] = tuple(EXCLUDED_AUTHORS)) -> DataFrame:
    """Without the comments of bots."""
    return comments.where(~F.col("author").isin(*authors))


def drop_blank(comments: DataFrame) -> DataFrame:
    """Without the comments whose author is gone."""
    return comments.where(F.col("author") != "")


def clean(comments: DataFrame, authors: Sequence[str] = tuple(EXCLUDED_AUTHORS)) -> DataFrame:
    return drop_blank(drop_excluded(comments, authors))


def enrich(comments: DataFrame) -> DataFrame:
    """Add word count, emoji and the hour, where the columns they need are there and they are not."""
    derived = {
        "word_count": ("body", word_count),
        "emoji": ("body", emoji_list),
        "hour": ("created_utc", hour_start),
    }
    return comments.withColumns(
        {
            name: make(F.col(source))
            for name, (source, make) in derived.items()
            if name not in comments.columns and source in comments.columns
        }
    )


def explode_once(rows: DataFrame, keep: Sequence[str], items: Column, name: str) -> DataFrame:
    """One row per item of an array that is costly to make.

    A plain ``explode`` adds a filter on the size of the array, which makes the array again.
    """
    return rows.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def narrow(comments: DataFrame) -> DataFrame:
    """All that the daily metrics need, without the bodies, which are most of the bytes."""
    body = F.col("body")
    blanked = F.when(body.isin(DELETED_BODY, REMOVED_BODY), body)
    return enrich(comments).select(
        "id", "dt_date", "hour", "author", "author_flair_text", "score", "word_count", "emoji", blanked.alias("blanked")
    )


def normalise_blank(comments: DataFrame) -> DataFrame:
    """Comments without an author get author ``""``, flair ``""`` and score 0."""
    gone = F.col("author").isNull() | (F.col("author") == "")
    return comments.withColumns(
        {
            "author": F.when(gone, F.lit("")).otherwise(F.col("author")),
            "author_flair_text": F.when(gone, F.lit("")).otherwise(F.col("author_flair_text")),
            "score": F.when(gone, F.lit(0)).otherwise(F.col("score")),
        }
    )


def before_day_end(comments: DataFrame, day: Column) -> DataFrame:
    """Without comments newer than the end of the thread ``day``; the end itself belongs to it."""
    return comments.where(F.col("created_utc") <= day_end(day))


def is_daily_thread(title: Column, author: Column, allowed_authors: Iterable[str]) -> Column:
    """True for a submission that is a daily thread: a known title by an allowed author."""
    return F.lower(title).rlike("|".join(THREAD_TITLES)) & author.isin(*allowed_authors)


def submissions_of(submissions: DataFrame, day: Column, allowed_authors: Iterable[str]) -> DataFrame:
    """The daily threads submitted on a UTC date."""
    return submissions.where(
        is_daily_thread(F.col("title"), F.col("author"), allowed_authors) & (F.to_date("created_utc") == day)
    )


def by_author(comments: DataFrame, author: str) -> DataFrame:
    return comments.where(F.col("author") == author)


def by_ids(comments: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is listed; unknown ids give nothing."""
    return comments.join(ids.select("id"), "id", "left_semi")


def fetch(comments: DataFrame, winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The whole rows of comments that ``winners`` names by ``keys``, with the winners' other columns.

    The winners are written first. Their true size is then known when the join is planned: if it
    is below the broadcast threshold, the comments are scanned but not shuffled, bodies and all;
    beyond it, the join is a shuffle as any other. Where days are keys, only the days from the
    winners' first to their last are scanned.
    """
    stored = materialise(winners, "winners")
    if "dt_date" in keys:
        first, last = (stored.select(f("dt_date")).scalar() for f in (F.min, F.max))
        comments = comments.where(F.col("dt_date").between(first, last))
    return comments.join(stored, list(keys))


def of_authors(comments: DataFrame, authors: DataFrame) -> DataFrame:
    """Comments by the listed authors. The list is written first, so the planner knows its size."""
    return comments.join(materialise(authors.select("author").distinct(), "authors"), "author", "left_semi")


def common_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ids that occur on both sides, once each."""
    return left.select("id").intersect(right.select("id"))


def _one_per_id(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    # The rank limit runs before the shuffle too, so many copies of one id stay few rows per task.
    rank = F.row_number().over(Window.partitionBy("id").orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank <= 1").drop("_rank")


def latest_by_id(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The last version of each id; ``order`` must not tie between versions."""
    return _one_per_id(rows, [F.desc(c) for c in order])


def first_by_id(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first version of each id."""
    return _one_per_id(rows, [F.asc(c) for c in order])


def fill_parents(comments: DataFrame, lookup: DataFrame) -> DataFrame:
    """Missing parents are taken from ``lookup(id, parent_id)``; others stay as they are.

    Of several parents found for an id the smallest counts. Only rows that miss one are joined, so
    the others are not moved.
    """
    known = lookup.where("parent_id is not null and parent_id <> ''")
    found = known.groupBy("id").agg(F.min("parent_id").alias("_found"))
    missing = F.col("parent_id").isNull() | (F.col("parent_id") == "")
    lost = comments.where(missing).join(found, "id", "left")
    filled = lost.withColumn("parent_id", F.col("_found")).select(comments.columns)
    return comments.where(~missing).unionByName(filled)
