"""Leaderboards and counts. Every metric is computed per value of ``by``, by default per day.

All take comments that have passed ``clean`` unless said otherwise, raw or enriched, and
pre-aggregate before they shuffle, so a busy author or day costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palaver.fixed import DELETED_BODY, REMOVED_BODY
from palaver.functions.emoji import has_pointing_emoji
from palaver.functions.text import flair_label, mute_ping
from palaver.operators.clean import enrich, explode_once, fetch
from palaver.operators.ranking import running_total, top_k

DAY = ("dt_date",)


def _sorted(df: DataFrame, by: Sequence[str], *order: Column) -> DataFrame:
    return df.orderBy(*by, *order)


# -- the unsorted frames several metrics share ------------------------------------------------


def author_words(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    return enrich(comments).groupBy(*by, "author").agg(F.sum("word_count").alias("word_count"))


def author_scores(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    return comments.groupBy(*by, "author").agg(F.sum("score").alias("score"))


def author_flair_counts(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Comments per author and flair; rows without a flair are not counted."""
    flaired = comments.where(F.col("author_flair_text").isNotNull())
    return flaired.groupBy(*by, "author", "author_flair_text").agg(F.count("*").alias("comment_count"))


def author_emoji(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    counted = enrich(comments).withColumn("_n", F.size("emoji").cast("bigint"))
    return counted.groupBy(*by, "author").agg(F.sum("_n").alias("emoji_count"))


def emoji_uses(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    exploded = explode_once(enrich(comments), by, F.col("emoji"), "emoji")
    return exploded.groupBy(*by, "emoji").agg(F.count("*").alias("uses"))


def users(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Distinct pairs of author and flair: an author with two flairs is two users."""
    return comments.select(*by, "author", "author_flair_text").distinct()


def words_per_comment(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    words, counts = author_words(comments, by), author_flair_counts(comments, by)
    average = F.bround(F.col("word_count") / F.col("comment_count"), 1)
    return words.join(counts, [*by, "author"]).select(*by, "author", "author_flair_text", average.alias("avg_words"))


def average_scores(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    scores, counts = author_scores(comments, by), author_flair_counts(comments, by)
    average = F.bround(F.col("score") / F.col("comment_count"), 1)
    return scores.join(counts, [*by, "author"]).select(*by, "author", "author_flair_text", average.alias("avg_score"))


# -- the metrics ------------------------------------------------------------------------------


def bad_counts(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Deleted, removed and otherwise blank comments. Takes comments from ``drop_excluded``."""
    body = F.col("blanked" if "blanked" in comments.columns else "body")
    return comments.groupBy(*by).agg(
        F.count_if(body == DELETED_BODY).alias("deleted"),
        F.count_if(body == REMOVED_BODY).alias("removed"),
        F.count_if(F.col("author") == "").alias("other_blank"),
    )


def wordiest_overall(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    return _sorted(author_words(comments, by), by, F.desc("word_count"), F.asc("author"))


def wordiest_average(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Words per comment. Authors without any flair are left out; several flairs give several rows."""
    return _sorted(
        words_per_comment(comments, by), by, F.desc("avg_words"), F.asc("author"), F.asc("author_flair_text")
    )


def most_upvoted(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    return _sorted(author_scores(comments, by), by, F.desc("score"), F.asc("author"))


def best_average(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Score per comment, one row per author and flair."""
    rows = average_scores(comments, by)
    return _sorted(rows, by, F.desc("avg_score"), F.asc("author"), F.asc("author_flair_text")).drop("author_flair_text")


def spammiest(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    return _sorted(
        author_flair_counts(comments, by), by, F.desc("comment_count"), F.asc("author"), F.asc("author_flair_text")
    )


def emoji_spammers(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    return _sorted(author_emoji(comments, by), by, F.desc("emoji_count"), F.asc("author"))


def top_emoji(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    return _sorted(emoji_uses(comments, by), by, F.desc("uses"), F.asc("emoji"))


def pointing_emoji(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Comments with a pointing emoji per author."""
    pointing = comments.where(has_pointing_emoji(F.col("body")))
    counts = pointing.groupBy(*by, "author").agg(F.count("*").alias("meme_count"))
    return _sorted(counts, by, F.desc("meme_count"), F.asc("author"))


def flair_population(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Users per flair label; the label ``""`` stands for users without a flair."""
    labelled = users(comments, by).withColumn("flair", flair_label(F.col("author_flair_text")))
    counts = labelled.groupBy(*by, "flair").agg(F.count("*").alias("redditors"))
    return _sorted(counts, by, F.desc("redditors"), F.asc("flair"))


def user_totals(comments: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Users, users without a flair, and number of different flairs."""
    label = flair_label(F.col("author_flair_text"))
    per_label = users(comments, by).groupBy(*by, label.alias("flair")).agg(F.count("*").alias("n"))
    return per_label.groupBy(*by).agg(
        F.sum("n").alias("unique_users"),
        F.coalesce(F.sum(F.when(F.col("flair") == "", F.col("n"))), F.lit(0)).alias("unflaired"),
        F.count_if(F.col("flair") != "").alias("flair_kinds"),
    )


def weekly_census(comments: DataFrame) -> DataFrame:
    """Accounts and the three most worn flairs of the comments given (a week of them)."""
    labelled = users(comments, ()).withColumn("flair", flair_label(F.col("author_flair_text")))
    flairs = labelled.where("flair <> ''").groupBy("flair").agg(F.count("*").alias("n"))
    top = top_k(flairs, (), [F.desc("n"), F.asc("flair")], 3)
    accounts = comments.select("author").distinct().agg(F.count("*").alias("n"))
    return accounts.select(F.lit("accounts").alias("name"), "n", F.lit(0).alias("position")).unionByName(
        top.select(F.col("flair").alias("name"), "n", "position")
    )


def rolling_census(comments: DataFrame, days: int = 7) -> DataFrame:
    """``dt_date, accounts, users``: authors, and pairs of author and flair, of the ``days`` days that end at each day.

    For all end days at once, from the first day with comments to the last. Someone counts from each of their days on
    for ``days`` days, or until their next one, where they count anew. Such a stretch adds one where it begins and takes
    one where it ends; the running sum of those changes, a row a day, is the census.
    """
    people = comments.select("dt_date", "author", "author_flair_text").distinct()
    changes = _stretches(people.select("dt_date", "author").distinct(), ["author"], days, "accounts").unionByName(
        _stretches(people, ["author", "author_flair_text"], days, "users"), allowMissingColumns=True
    )
    per_day = changes.groupBy("day").agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("accounts", "users")])
    ends = comments.agg(F.min("dt_date").alias("_first"), F.max("dt_date").alias("_last")).where("_first is not null")
    calendar = ends.select(F.explode(F.sequence("_first", "_last")).alias("dt_date"))
    so_far = Window.orderBy("dt_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per calendar day
    joined = calendar.join(per_day, F.col("dt_date") == F.col("day"), "left")
    return joined.select("dt_date", *[F.sum(F.coalesce(c, F.lit(0))).over(so_far).alias(c) for c in ("accounts", "users")])


def _stretches(people: DataFrame, who: Sequence[str], days: int, name: str) -> DataFrame:
    """``day`` and by how much the number of people changes there."""
    following = F.lead("dt_date").over(Window.partitionBy(*who).orderBy("dt_date"))
    until = people.withColumn("_until", F.least(F.date_add("dt_date", days), following))
    both = F.array(F.struct(F.col("dt_date").alias("day"), F.lit(1).alias(name)), F.struct(F.col("_until").alias("day"), F.lit(-1).alias(name)))
    return until.select(F.inline(both)).groupBy("day").agg(F.sum(name).alias(name))


def upvoted_comments(
    comments: DataFrame,
    by: Sequence[str] = DAY,
    k: int | None = None,
    bare: DataFrame | None = None,
    complete: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Comments by score with pings muted and their ``position``; with ``k`` only the first of each group.

    The ranking runs without bodies, which are read again for the rows it names. Where bodies are stored apart, ``bare`` has
    the comments without them, and ``complete`` adds them to the ranked rows, so that no body is moved.
    """
    order = [F.desc("score"), F.asc("id")]
    if k is None:
        ones = comments.select(*by, "id", "score", F.lit(1).cast("bigint").alias("_one"))
        placed = running_total(ones, by, ["score", "id"], "_one", [False, True], "position").select(*by, "id", "position")
    else:
        placed = top_k(comments.select(*by, "id", "score"), by, order, k).drop("score")
    rows = complete(fetch(comments if bare is None else bare, placed, [*by, "id"])).withColumn("body", mute_ping(F.col("body")))
    return rows if k is None else _sorted(rows, by, F.asc("position"))
