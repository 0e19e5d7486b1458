import datetime as dt

import pytest
from pyspark.sql import functions as F

from palaver.functions import emoji, text, times
from tests.conftest import at


@pytest.mark.parametrize("body, n", [("", 1), ("one", 1), ("two words", 2), ("a  b", 3), ("a\nb", 1), (" x ", 3)])
def test_word_count_counts_spaces(value, body, n):
    assert value(text.word_count, body) == n


@pytest.mark.parametrize(
    "body, found",
    [
        ("plain text #1 *2 30", []),
        ("a 🌻🌻 b", ["🌻", "🌻"]),
        ("👩‍🚀☝️", ["👩‍🚀", "☝️"]),
        ("🇨🇦🇩🇪", ["🇨🇦", "🇩🇪"]),
        ("👍🏽x", ["👍🏽"]),
        ("1️⃣#️⃣", ["1️⃣", "#️⃣"]),
        ("🏴󠁧󠁢󠁥󠁮󠁧󠁿!", ["🏴󠁧󠁢󠁥󠁮󠁧󠁿"]),
        ("é ü – → 漢", []),
        ("🌻🏽", ["🌻", "🏽"]),
        ("👨‍👩‍👧‍👦 ❤️‍🔥", ["👨‍👩‍👧‍👦", "❤️‍🔥"]),
        ("©", ["©"]),
    ],
)
def test_emoji_list(value, body, found):
    assert value(emoji.emoji_list, body) == found


@pytest.mark.parametrize(
    "flair, label",
    [
        (None, ""),
        ("", ""),
        ("plain", ""),
        (":code: Label", "Label"),
        (":a: :b: Label two", "Label two"),
        (":ünï: Über", "Über"),
        (":code:Label", ""),
        (":code: ", ""),
    ],
)
def test_flair_label_is_after_the_last_code(value, flair, label):
    assert value(text.flair_label, flair) == label


def test_pings_are_muted_in_any_case(value):
    assert value(text.mute_ping, "!PING A !ping b !Ping") == "*ping A *ping b *ping"


@pytest.mark.parametrize(
    "body, plain",
    [
        ("# Head\n> quote **bold** `x`", "head\nquote bold x"),
        ("see [this](http://a.b/c) and https://x.y/z?q=1 now", "see this and  now"),
        ("I can't, won't; it's THEIR'S don’t we're", "i cannot, will not; it is their's do not we are"),
        ("1. first\n- second", "first\nsecond"),
    ],
)
def test_clean_text(value, body, plain):
    assert value(text.clean_text, body) == plain


def test_phrases_break_at_punctuation_and_stopwords(value):
    found = value(text.candidate_phrases, "zoning reform of big cities, rent control! ox to " + "x" * 40 + " tall towers")
    assert found == ["zoning reform", "big cities", "rent control", "tall towers"]


@pytest.mark.parametrize("phrase", ["u.s. senate", "it's 3rd-rate", "ÉCOLE élan", "ßtart", "a1b c"])
def test_title_case_is_that_of_python(value, phrase):
    assert value(text.title_case, phrase) == phrase.title()


def test_clean_chunk_keeps_words_of_middle_length(value):
    assert value(text.clean_chunk, "the big up zoning " + "y" * 40 + " reform") == "big zoning reform"


@pytest.mark.parametrize(
    "chunk, score",
    [
        (("zoning reform", "NP", "SBJ", 2, 1, "reform"), 3.5),
        (("zoning reform", "VP", None, 0, 0, "reform"), 0.0),
        (("big thing", "NP", "OBJ", 1, 1, "thing"), 0.0),
        (("shipping reform", "NP", "OBJ", 1, 1, "reform"), 0.0),
        (("tall", "ADJP", None, 1, 0, "tall"), 1.5),
    ],
)
def test_chunk_score(spark, chunk, score):
    frame = spark.createDataFrame([chunk], "t string, k string, r string, n int, m int, h string")
    assert frame.select(text.chunk_score(*[F.col(c) for c in "tkrnmh"]).alias("s")).first()["s"] == score


def test_preview_cuts_long_bodies_and_quotes_lines(value):
    assert value(text.preview, "a\nb") == "a\n\n> b"
    assert value(text.preview, "x" * 141) == "x" * 140 + "..."
    assert value(text.preview, "x" * 140) == "x" * 140


@pytest.mark.parametrize("norm, size", [(0.0, 1), (1.0, 16), (0.1, 2), (0.5, 8)])
def test_activity_bar(value, norm, size):
    assert value(text.activity_bar, norm, "double") == "█" * size


def test_token_estimate_rounds_up(value):
    assert [value(text.token_estimate, n, "bigint") for n in (0, 1, 4, 5)] == [0, 1, 1, 2]


@pytest.mark.parametrize(
    "body, lines", [("a\nb\n", "a\nb"), ("a\r\nb", "a\nb"), ("a b\x0bc", "a\nb\nc"), ("a\n\n", "a\n"), ("", "")]
)
def test_body_lines_are_those_of_splitlines(value, body, lines):
    assert value(text.body_lines, body) == lines == "\n".join(body.splitlines())


def test_quoted_forms(spark):
    frame = spark.createDataFrame(
        [(at("2024-03-01 12:30:00"), "ann", None, "hi"), (at("2024-03-01 12:30:00.25"), "bo", ":x: Y", "ho")],
        "created timestamp, author string, flair string, body string",
    )
    cols = [F.col(c) for c in ("created", "author", "flair", "body")]
    got = frame.select(text.prompt_string(*cols).alias("p"), text.embedding_string(*cols[1:]).alias("e")).collect()
    assert got[0]["p"] == "At 2024-03-01T12:30:00, ann (None) wrote:\nhi"
    assert got[1]["p"] == "At 2024-03-01T12:30:00.250000, bo (:x: Y) wrote:\nho"
    assert got[1]["e"] == "@bo (:x: Y)\nho"


@pytest.mark.parametrize(
    "moment, day", [("2024-03-02 06:59:59", 1), ("2024-03-02 07:00:00", 2), ("2024-03-02 07:00:01", 2)]
)
def test_thread_day_begins_at_seven(value, moment, day):
    assert value(times.thread_day, at(moment), "timestamp") == dt.date(2024, 3, day)


def test_hours_of_the_clock_change_stay_apart(value):
    first, second = at("2024-11-03 05:30:00"), at("2024-11-03 06:30:00")
    assert value(times.wall_time, first, "timestamp") == value(times.wall_time, second, "timestamp")
    gap = value(times.hour_start, second, "timestamp") - value(times.hour_start, first, "timestamp")
    assert gap == 3600
    assert value(times.hour_start, first, "timestamp") == int(at("2024-11-03 05:00:00").timestamp())


def test_wall_day_follows_the_eastern_zone(value):
    assert value(times.wall_day, at("2024-01-02 04:59:00"), "timestamp") == dt.date(2024, 1, 1)
    assert value(times.wall_day, at("2024-07-02 04:01:00"), "timestamp") == dt.date(2024, 7, 2)


def test_friendly_day(value):
    today = F.lit(dt.date(2024, 3, 8))
    named = [value(lambda d: times.friendly_day(d, today), dt.date(2024, 3, n), "date") for n in (8, 7, 6)]
    assert named == ["today", "yesterday", "on Wednesday"]


def test_span_and_result_key(spark):
    frame = spark.createDataFrame([(1,), (7,), (30,), (31,), (3,)], "days int")
    span = times.span_label(F.col("days"))
    got = frame.select(span.alias("s"), times.result_key(F.lit("ann"), span).alias("k")).collect()
    assert [r["s"] for r in got] == ["day", "week", "month", "all time", None]
    assert got[3]["k"] == "ann-all_time"


def test_target_and_first_day(value):
    assert times.target_day(at("2024-03-08 03:00:00"), 1) == dt.date(2024, 3, 7)
    latest = dt.date(2024, 3, 8)
    for days, first in ((0, 8), (1, 8), (7, 2)):
        assert value(lambda d, n=days: times.first_day(d, F.lit(n)), latest, "date") == dt.date(2024, 3, first)
