"""Emoji as one regular expression that Java and RE2 read the same way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palaver.fixed import EMOJI_POINTS, MODIFIER_BASE_POINTS, POINTING_EMOJI


def _char_class(points: str) -> str:
    spans = [p.split("-") for p in points.split()]
    return "[" + "".join("-".join(f"\\x{{{end}}}" for end in span) for span in spans) + "]"


_BASE = _char_class(EMOJI_POINTS)
_MODIFIER_BASE = _char_class(MODIFIER_BASE_POINTS)
_SKIN = "[\\x{1F3FB}-\\x{1F3FF}]"
_TAGS = "(?:[\\x{E0020}-\\x{E007E}]+\\x{E007F})?"
_UNIT = f"(?:{_MODIFIER_BASE}{_SKIN}|{_BASE}\\x{{FE0F}}?{_TAGS})"

# A flag pair, a keycap, or emoji joined by zero-width joiners; each counts once.
EMOJI_PATTERN = (
    f"(?:[\\x{{1F1E6}}-\\x{{1F1FF}}]{{2}}|[0-9#*]\\x{{FE0F}}?\\x{{20E3}}|{_UNIT}(?:\\x{{200D}}{_UNIT})*)"
)


# Every emoji starts with one of these, and hardly any other character is. Looking ahead for
# them spares the long classes above at each letter of a text.
_MAY_START = "(?=[0-9#*\\x{A9}\\x{AE}\\x{203C}-\\x{3299}\\x{1F004}-\\x{1FAFF}])"


def emoji_list(body: Column) -> Column:
    """The emoji of a text in order. Pure ASCII text cannot hold one and skips the search."""
    found = F.regexp_extract_all(body, F.lit(_MAY_START + EMOJI_PATTERN), F.lit(0))
    return F.when(F.octet_length(body) > F.char_length(body), found).otherwise(F.array().cast("array<string>"))


def has_pointing_emoji(body: Column) -> Column:
    return body.rlike("|".join(POINTING_EMOJI))
