import datetime as dt

from pyspark.sql import functions as F

from palaver.operators import boards, clean, hourly
from palaver.plans import daily
from tests.conftest import at, rows

DAY = dt.date(2024, 3, 1)


def hour(text):
    return at(f"2024-03-01 {text}:10:00")


def sample(make):
    return make(
        [
            {"author": "ann", "author_flair_text": ":a: One", "score": 5, "body": "a b c"},
            {"author": "ann", "author_flair_text": ":a: One", "score": 0, "body": "a 🌻"},
            {"author": "ann", "author_flair_text": ":b: Two", "score": 0, "body": "a b"},
            {"author": "bo", "author_flair_text": None, "score": 9, "body": "x " * 9 + "👉"},
            {"author": "cy", "author_flair_text": "", "score": -3, "body": "hey !PING"},
            {"author": "AutoModerator", "author_flair_text": ":a: One", "score": 99, "body": "[removed]"},
            {"author": "", "author_flair_text": "", "score": 0, "body": "[deleted]"},
            {"author": "", "author_flair_text": "", "score": 0, "body": "[removed]"},
            {"author": "dee", "author_flair_text": None, "score": 0, "body": "[deleted]"},
        ]
    )


def test_bad_counts_are_rows_without_bots(make):
    got = boards.bad_counts(clean.drop_excluded(sample(make)))
    assert rows(got, "dt_date", "deleted", "removed", "other_blank") == [(DAY, 2, 1, 2)]


def test_totals_per_author(make):
    kept = clean.clean(sample(make))
    assert rows(boards.wordiest_overall(kept), "author", "word_count") == [("ann", 7), ("bo", 10), ("cy", 2), ("dee", 1)]
    assert rows(boards.most_upvoted(kept), "author", "score") == [("ann", 5), ("bo", 9), ("cy", -3), ("dee", 0)]
    assert [r["author"] for r in boards.most_upvoted(kept).collect()] == ["bo", "ann", "dee", "cy"]
    assert rows(boards.emoji_spammers(kept), "author", "emoji_count") == [("ann", 1), ("bo", 1), ("cy", 0), ("dee", 0)]


def test_authors_without_flair_leave_the_averages(make):
    kept = clean.clean(sample(make))
    assert rows(boards.spammiest(kept), "author", "author_flair_text", "comment_count") == [
        ("ann", ":a: One", 2), ("ann", ":b: Two", 1), ("cy", "", 1),
    ]
    # one row per flair, each over that flair's number of comments
    assert rows(boards.wordiest_average(kept), "author", "author_flair_text", "avg_words") == [
        ("ann", ":a: One", 3.5), ("ann", ":b: Two", 7.0), ("cy", "", 2.0),
    ]
    assert rows(boards.best_average(kept), "author", "avg_score") == [("ann", 2.5), ("ann", 5.0), ("cy", -3.0)]


def test_averages_round_half_to_even(make):
    frame = make([{"author_flair_text": "f", "score": s} for s in (1, 0, 0, 0)])
    assert rows(boards.best_average(frame), "avg_score") == [(0.2,)]


def test_users_are_pairs_of_author_and_flair(make):
    kept = clean.clean(sample(make))
    assert rows(boards.user_totals(kept), "unique_users", "unflaired", "flair_kinds") == [(5, 3, 2)]
    assert rows(boards.flair_population(kept), "flair", "redditors") == [("", 3), ("One", 1), ("Two", 1)]


def test_everyone_flaired_gives_zero_unflaired(make):
    frame = make([{"author_flair_text": ":a: One"}])
    assert rows(boards.user_totals(frame), "unflaired") == [(0,)]


def test_top_and_pointing_emoji(make):
    kept = clean.clean(sample(make))
    assert rows(boards.top_emoji(kept), "emoji", "uses") == [("🌻", 1), ("👉", 1)]
    assert rows(boards.pointing_emoji(kept), "author", "meme_count") == [("bo", 1)]


def test_upvoted_comments_are_muted_and_limited(make):
    kept = clean.clean(sample(make))
    placed = sorted((r["position"], r["score"]) for r in boards.upvoted_comments(kept).collect())
    assert placed == [(1, 9), (2, 5), (3, 0), (4, 0), (5, 0), (6, -3)]
    best = boards.upvoted_comments(kept, k=2).collect()
    assert [(r["position"], r["author"]) for r in best] == [(1, "bo"), (2, "ann")]
    assert "hey *ping" in [r["body"] for r in boards.upvoted_comments(kept).collect()]


def test_weekly_census(make):
    got = boards.weekly_census(clean.clean(sample(make)))
    assert rows(got, "position", "name", "n") == [(0, "accounts", 4), (1, "One", 1), (2, "Two", 1)]


def test_activity_fills_empty_hours(make):
    frame = make([{"created_utc": hour(h)} for h in ("08", "08", "08", "11", "12", "12")])
    got = hourly.activity(frame).collect()
    assert [r["comments"] for r in got] == [3, 0, 0, 1, 2]
    assert [round(r["norm_count"], 3) for r in got] == [1.0, 0.0, 0.0, 0.333, 0.667]


def test_activity_without_gaps_scales_from_the_least(make):
    frame = make([{"created_utc": hour(h)} for h in ("08", "08", "08", "09")])
    assert [r["norm_count"] for r in hourly.activity(frame).collect()] == [1.0, 0.0]


def test_flat_activity_has_no_scale(make):
    frame = make([{"created_utc": hour(h)} for h in ("08", "09")])
    assert [r["norm_count"] for r in hourly.activity(frame).collect()] == [None, None]


def test_hourly_winners(make):
    frame = make(
        [
            {"author": "bo", "created_utc": hour("08"), "body": "a b c"},
            {"author": "ann", "created_utc": hour("08"), "body": "d e f"},
            {"author": "cy", "created_utc": hour("08"), "body": "x"},
            {"author": "cy", "created_utc": hour("09"), "body": "x"},
        ]
    )
    assert rows(hourly.hourly_wordiest(frame), "author", "word_count") == [("ann", 3), ("bo", 3), ("cy", 1)]
    assert rows(hourly.hourly_spammiest(frame), "author", "comment_count") == [("ann", 1), ("cy", 1)]


def test_metrics_agree_on_raw_and_enriched_rows(make):
    raw = sample(make)
    table = clean.drop_blank(daily.enriched(raw))
    kept = clean.clean(raw)
    for metric in (boards.wordiest_overall, boards.emoji_spammers, boards.top_emoji, hourly.activity, hourly.hourly_wordiest):
        assert metric(table).collect() == metric(kept).collect()


def test_rank_limits_run_before_the_shuffle(make):
    plan = hourly.hourly_spammiest(sample(make))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_blank_comments_and_day_end(make):
    frame = make([{"author": None, "score": 4, "author_flair_text": "f", "body": "b"}, {"author": "ann"}])
    got = rows(clean.normalise_blank(frame), "author", "author_flair_text", "score", "body")
    assert got == [("", "", 0, "b"), ("ann", None, 1, "some words")]
    edge = make([{"id": i, "created_utc": at(t)} for i, t in
                 (("in", "2024-03-02 06:59:59"), ("edge", "2024-03-02 07:00:00"), ("out", "2024-03-02 07:00:01"))])
    assert rows(clean.before_day_end(edge, F.lit(DAY)), "id") == [("edge",), ("in",)]


def test_daily_threads(spark):
    subs = spark.createDataFrame(
        [
            ("a", "Daily Discussion THREAD", "mod", at("2024-03-01 07:00:00")),
            ("b", "Thunderdome!", "joe", at("2024-03-01 08:00:00")),
            ("c", "Dôme du Tonnerre", "mod", at("2024-03-01 23:59:00")),
            ("d", "discussion thread", "mod", at("2024-03-02 00:00:00")),
            ("e", "cats", "mod", at("2024-03-01 07:00:00")),
        ],
        "id string, title string, author string, created_utc timestamp",
    )
    assert rows(clean.submissions_of(subs, F.lit(DAY), ["mod"]), "id") == [("a",), ("c",)]


def test_report_parts(make):
    report = daily.full_report(sample(make))
    assert rows(report["bad_counts"], "deleted", "removed", "other_blank") == [(2, 1, 2)]
    short = daily.short_report(sample(make))
    best = rows(short.where("metric = 'upvoted_redditors'"), "position", "name", "value")
    assert best == [(1, "bo", 9.0), (2, "ann", 5.0), (3, "dee", 0.0)]
