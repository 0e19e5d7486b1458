"""Word lists, names, phrases and limits that results depend on."""

# --- fixed values: accounts left out of every statistic. The caller adds the accounts that
# post its own reports.
EXCLUDED_AUTHORS = [
    "jobautomator", "AutoModerator", "EmojifierBot", "EmojifierBotv2", "groupbot",
    "ShiversifyBot", "sorobucksbot",
]

# --- fixed values: phrases in the title of a daily thread, lower case
THREAD_TITLES = ["discussion thread", "thunderdome", "dôme du tonnerre", "elefantenrunde"]

# --- fixed values: the thread day starts at this UTC hour
DAY_START_HOUR = 7

# --- fixed values: zone of the wall-clock days in user statistics
WALL_ZONE = "America/New_York"

# --- fixed values: bodies of blanked comments
DELETED_BODY = "[deleted]"
REMOVED_BODY = "[removed]"

# --- fixed values: token limit of a text selection, and the shares of it that may be used
MAX_TOKENS = 128000
PREFIX_SHARE = 0.8
SAMPLE_SHARE = 0.85

# --- fixed values: text after the last ":code: " of a flair; only a line feed ends the line
FLAIR_PATTERN = "(?dU)^.*(:[-\\w]+:)\\s(.*)"

# --- fixed values: what stands before a thread as text and after each comment's last descendant
THREAD_HEADER = ("--- ", "yyyy-MM-dd'T'HH:mm", " UTC ---\n")
END_MARKER = "\n--- thread ends ---\n"

# --- fixed values: a comment as it is quoted in a prompt (time, author, flair, body), and as it is handed to an
# embedding model (author, flair, body); NO_FLAIR stands for a missing flair
PROMPT_FORM = "At %s, %s (%s) wrote:\n%s"
EMBEDDING_FORM = "@%s (%s)\n%s"
NO_FLAIR = "None"

# --- fixed values: list lengths of the short report
SHORT_LIST = 3
SHORT_EMOJI = 150

# --- fixed values: last rank of each keyword band
KEYWORD_BANDS = [10, 30, 60, 120, 180, 240]

# --- fixed values: seconds a stored user result stays fresh, by requested days
FRESH_SECONDS = 24 * 60 * 60
FRESH_SECONDS_ONE_DAY = 60 * 60
FRESH_SECONDS_OVER_30_DAYS = 7 * 24 * 60 * 60

# --- fixed values: pointing emoji
POINTING_EMOJI = ["👆", "👉", "👇", "👈", "☝️"]

# --- fixed values: phrase types that score
CHUNK_TYPES = ["NP", "ADJP"]

# --- fixed values: phrases that call a bot
BOT_TRIGGERS = ["malarkey level", "magic goolsball", "ping"]

# --- fixed values: words too common to be keywords
COMMON_WORDS = [
    "friend", "yes", "no", "difference", "couple", "type", "discussion", "users", "system",
    "replies", "theory", "eyes", "matter", "etc", "etc.", "area", "place", "places", "image",
    "rest", "days", "picture", "number", "guy", "guys", "others", "posts", "times", "head",
    "support", "issues", "issue", "account", "end", "line", "group", "anybody", "think", "none",
    "side", "dt", "people", "comment", "everyone", "someone", "nothing", "something", "please",
    "anyone", "time", "sub", "lot", "day", "country", "shit", "fuck", "thing", "good",
    "question", "questions", "group list", "way", "things", "one", "can", "moto", "ping",
    "anything", "reddit", "today", "man", "point", "life", "kind", "need", "name", "stuff",
    "nobody", "part", "comments", "everything", "sense", "post", "lots", "sort", "bunch", "tbh",
    "count", "box", "half", "clue", "level", "ton", "somebody", "user", "thread", "word", "dog",
    "thanks", "week", "problem", "dude", "years", "bit", "try", "ones", "article", "members",
    "remember", "fine", "story", "words", "take", "news", "cars", "dems", "hours", "minutes",
    "list", "topic",
]

# --- fixed values: English stopwords
STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now",
]

# --- fixed values: code points with the Unicode property Emoji, without digits, # * and the
# regional indicators, which are emoji only in pairs or keycaps (hexadecimal, single or range)
EMOJI_POINTS = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2
25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A
262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697
2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1
26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721
2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935
2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E
1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397
1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570
1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4
1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2
1F6D5-1F6D9 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A
1F93C-1F945 1F947-1F9FF 1FA70-1FA7C 1FA80-1FAC6 1FAC8 1FACC-1FADD 1FADF-1FAEB 1FAEF-1FAFA
"""

# --- fixed values: code points with the Unicode property Emoji_Modifier_Base
MODIFIER_BASE_POINTS = """
261D 26F9 270A-270D 1F385 1F3C2-1F3C4 1F3C7 1F3CA-1F3CC 1F442-1F443 1F446-1F450 1F466-1F478
1F47C 1F481-1F483 1F485-1F487 1F48F 1F491 1F4AA 1F574-1F575 1F57A 1F590 1F595-1F596 1F645-1F647
1F64B-1F64F 1F6A3 1F6B4-1F6B6 1F6C0 1F6CC 1F90C 1F90F 1F918-1F91F 1F926 1F930-1F939 1F93C-1F93E
1F977 1F9B5-1F9B6 1F9B8-1F9B9 1F9BB 1F9CD-1F9CF 1F9D1-1F9DD 1FAC3-1FAC5 1FAF0-1FAFA
"""
