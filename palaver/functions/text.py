"""Text expressions: counting, cleaning, previews and phrase scores."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from palaver.fixed import (
    BOT_TRIGGERS, CHUNK_TYPES, COMMON_WORDS, EMBEDDING_FORM, FLAIR_PATTERN, NO_FLAIR, PROMPT_FORM, STOPWORDS,
)

# Line breaks as text editors and terminals know them, and those of them that are not "\\n".
LINE_BREAK = "(?:\\r\\n|[\\n\\r\\x0B\\f\\x1C\\x1D\\x1E\\x{85}\\x{2028}\\x{2029}])"
ODD_BREAK = "[\\r\\x0B\\f\\x1C\\x1D\\x1E\\x{85}\\x{2028}\\x{2029}]"

# Markdown and URLs, in the order they are removed. The link text is kept. Each rule is a text
# that must occur for it to apply (none: always), a pattern and its replacement.
MARKUP = [
    ("](", "!?\\[([^\\]\\[]*)\\]\\([^)]*\\)", "$1"),
    ("http", "https?://\\S+", ""),
    ("", "(?m)^[ \\t]*(?:#{1,6}|>+|[-+*]|[0-9]+\\.)[ \\t]+", ""),
    ("*", "[*]+", ""),
    ("`", "`+", ""),
]

# English contractions, applied to lower-case text with straight apostrophes.
CONTRACTIONS = [
    ("can't", "\\bcan't\\b", "cannot"),
    ("won't", "\\bwon't\\b", "will not"),
    ("shan't", "\\bshan't\\b", "shall not"),
    ("let's", "\\blet's\\b", "let us"),
    ("n't", "n't\\b", " not"),
    ("'re", "'re\\b", " are"),
    ("'ve", "'ve\\b", " have"),
    ("'ll", "'ll\\b", " will"),
    ("'d", "'d\\b", " would"),
    ("i'm", "\\bi'm\\b", "i am"),
    ("'s", "\\b(it|that|what|he|she|there|here|who|where|when|how)'s\\b", "$1 is"),
]

JUNK_WORDS = COMMON_WORDS + STOPWORDS + BOT_TRIGGERS


def word_count(body: Column) -> Column:
    """Spaces plus one: line breaks do not separate words, double spaces count twice."""
    return (F.char_length(body) - F.char_length(F.replace(body, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def flair_label(flair: Column) -> Column:
    """Flair text without its emoji codes; empty when it has none."""
    return F.coalesce(F.regexp_extract(flair, FLAIR_PATTERN, 2), F.lit(""))


def mute_ping(body: Column) -> Column:
    """``!ping`` in any case becomes ``*ping`` so that a copy calls nobody."""
    return F.regexp_replace(body, "(?i)!ping", "*ping")


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), lambda once: use(once)), 1)


def _apply(text: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Replace by each rule in turn; looking for its fixed text first is far cheaper than the pattern."""
    for needed, pattern, new in rules:
        swap = lambda t, pattern=pattern, new=new: F.regexp_replace(t, pattern, new)
        guarded = lambda t, needed=needed, swap=swap: F.when(F.contains(t, F.lit(needed)), swap(t)).otherwise(t)
        text = _bind(text, guarded) if needed else swap(text)
    return text


def clean_text(body: Column) -> Column:
    """Text without markdown and URLs, in lower case, contractions written out."""
    plain = F.replace(F.lower(_apply(body, MARKUP)), F.lit("’"), F.lit("'"))
    return _bind(plain, lambda t: F.when(F.contains(t, F.lit("'")), _apply(t, CONTRACTIONS)).otherwise(t))


def keepable_word(word: Column) -> Column:
    """Words of 3 to 39 characters that are not stopwords."""
    size = F.char_length(word)
    return (size > 2) & (size < 40) & ~word.isin(STOPWORDS)


def clean_chunk(chunk: Column) -> Column:
    """The kept words of a phrase, joined by single spaces."""
    return F.array_join(F.filter(F.split(chunk, " "), keepable_word), " ")


def candidate_phrases(text: Column) -> Column:
    """Runs of kept words between punctuation and stopwords, as an array."""
    spaced = F.regexp_replace(text, "[^\\p{L}\\p{N} ]+", " | ")
    marked = F.transform(F.split(spaced, " "), lambda w: F.when(w.isin(STOPWORDS), F.lit("|")).otherwise(w))
    kept = F.filter(marked, lambda w: (w == "|") | F.char_length(w).between(3, 39))
    runs = F.transform(F.split(F.array_join(kept, " "), "\\|"), lambda run: F.trim(run))
    return F.filter(runs, lambda p: p != "")


def names_bot(text: Column) -> Column:
    """True where a bot's trigger phrase occurs in the text."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in BOT_TRIGGERS])


def chunk_score(text: Column, kind: Column, role: Column, relations: Column, modifiers: Column, head: Column) -> Column:
    """Score of an annotated phrase; zero for junk heads and calls to a bot."""
    score = (
        relations / F.lit(2.0)
        + F.when(kind.isin(CHUNK_TYPES), 1.0).otherwise(0.0)
        + F.when(role.isNotNull(), 1.0).otherwise(0.0)
        + F.when(modifiers > 0, 0.5).otherwise(0.0)
    )
    return F.when(head.isin(JUNK_WORDS) | names_bot(text), F.lit(0.0)).otherwise(score)


def title_case(text: Column) -> Column:
    """A capital after every non-letter, small letters elsewhere."""
    runs = F.regexp_extract_all(text, F.lit("(\\p{L}+|\\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def token_estimate(length: Column) -> Column:
    """About four characters to a token."""
    return F.ceil(length / 4).cast("bigint")


def preview(body: Column, size: int = 140) -> Column:
    """Start of a body as a quotation; whole where it is short."""
    shown = F.when(F.char_length(body) > size, F.concat(F.left(body, F.lit(size)), F.lit("..."))).otherwise(body)
    return F.replace(shown, F.lit("\n"), F.lit("\n\n> "))


def activity_bar(norm: Column) -> Column:
    """A bar of 1 to 16 blocks for an activity between 0 and 1."""
    return F.repeat(F.lit("█"), F.bround(norm * 15 + 1).cast("int"))


def body_lines(body: Column) -> Column:
    """A body with plain line breaks and none at the end."""
    plain = F.when(body.rlike(ODD_BREAK), F.regexp_replace(body, LINE_BREAK, "\n")).otherwise(body)
    return F.when(F.endswith(plain, F.lit("\n")), F.left(plain, F.char_length(plain) - 1)).otherwise(plain)


def prompt_string(created: Column, author: Column, flair: Column, body: Column) -> Column:
    """One comment as it is quoted in a prompt."""
    return F.format_string(PROMPT_FORM, iso_time(created), author, F.coalesce(flair, F.lit(NO_FLAIR)), body)


def embedding_string(author: Column, flair: Column, body: Column) -> Column:
    """One comment as it is handed to an embedding model."""
    return F.format_string(EMBEDDING_FORM, author, F.coalesce(flair, F.lit(NO_FLAIR)), body)


def iso_time(created: Column) -> Column:
    """ISO 8601 time; microseconds only where there are any."""
    whole = F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss")
    exact = F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.pmod(F.unix_micros(created), F.lit(1000000)) == 0, whole).otherwise(exact)
