"""The queries as SQL for DuckDB, to check the Spark results against.

Written from the meaning of each query, independently of how Spark computes it: windows where
Spark aggregates, recursion where Spark doubles pointers, filled calendars where Spark divides
by the distance. Each statement starts with the comments as common table expressions.
"""

from __future__ import annotations

import re

from palaver.fixed import (
    BOT_TRIGGERS,
    CHUNK_TYPES,
    COMMON_WORDS,
    EXCLUDED_AUTHORS,
    POINTING_EMOJI,
    STOPWORDS,
)
from palaver.functions.emoji import EMOJI_PATTERN
from palaver.functions.text import CONTRACTIONS, JUNK_WORDS, MARKUP

COMMENTS = """
comments AS (
  SELECT 'c' || e.event_id AS id, e.event_id AS n,
    CASE WHEN e.event_id % 97 = 0 THEN '' WHEN e.event_id % 89 = 0 THEN 'AutoModerator' ELSE 'user_' || e.user_id END AS author,
    CASE WHEN e.event_id % 97 = 0 THEN '' WHEN e.user_id % 7 = 0 THEN NULL WHEN e.user_id % 7 = 1 THEN 'plain flair'
         WHEN e.user_id % 5 = 0 AND e.event_type = 'signup' THEN ':star: Switched'
         ELSE ':flag-x' || (e.user_id % 7) || ': Group ' || (e.user_id % 7) END AS author_flair_text,
    CASE WHEN e.event_id % 97 = 0 THEN 0 ELSE CAST(floor(e.value / 10) AS INT) - 5 END AS score,
    '/r/x/c' || e.event_id AS permalink,
    CASE WHEN e.event_id % 194 = 0 THEN '[deleted]' WHEN e.event_id % 97 = 0 THEN '[removed]'
      ELSE d.text
        || CASE WHEN e.event_id % 5 = 0 THEN ' 🌻🌻' WHEN e.event_id % 11 = 0 THEN ' 👩‍🚀 ☝️' WHEN e.event_id % 13 = 0 THEN ' 🇨🇦 👍🏽'
                WHEN e.event_id % 23 = 0 THEN ' 1️⃣👉🏴󠁧󠁢󠁥󠁮󠁧󠁿' ELSE '' END
        || CASE WHEN e.event_id % 17 = 0 THEN ' !PING GROUP' ELSE '' END
        || CASE WHEN e.event_id % 19 = 0 THEN ' [it''s here](https://ex.org/a) https://ex.org/b' ELSE '' END END AS body,
    e.ts AS created_utc,
    CASE WHEN e.event_id % 16 = 0 THEN 't3_s' || (e.event_id % 7)
         ELSE 't1_c' || (e.event_id - e.event_id % 16 + CAST(floor((e.event_id % 16 - 1) / 2) AS BIGINT)) END AS parent_id,
    CAST(e.ts - INTERVAL 7 HOURS AS DATE) AS dt_date
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
)"""


#: The comments without their bodies, and so without the documents.
NARROW = re.sub(r"CASE WHEN e.event_id % 194.*?END END AS body", "NULL AS body", COMMENTS, flags=re.S).replace(
    "FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)", "FROM events e"
)


def _list(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


CLEAN = f"""
kept AS (SELECT * FROM comments WHERE author NOT IN ({_list(EXCLUDED_AUTHORS)})),
clean AS (
  SELECT *, length(body) - length(replace(body, ' ', '')) + 1 AS words,
    CAST(epoch(date_trunc('hour', created_utc)) AS BIGINT) AS hour
  FROM kept WHERE author <> ''
)"""

EMOJI = f"""
emoji AS (
  SELECT id, dt_date, author, unnest(regexp_extract_all(body, '{EMOJI_PATTERN}')) AS emoji FROM clean
)"""

LABEL = r"coalesce(regexp_extract({0}, '^.*(:[-\w]+:)\s(.*)', 2), '')"
EASTERN_DAY = "CAST(timezone('America/New_York', timezone('UTC', created_utc)) AS DATE)"

# trees from the roots down; one row per comment that has a root
TREE = """
tree AS (
  SELECT id, CAST(NULL AS VARCHAR) AS parent, id AS root, 0 AS depth, author, score, body, created_utc, dt_date,
    [{'t': epoch_us(created_utc), 'id': id}] AS path
  FROM comments WHERE parent_id LIKE 't3\\_%' ESCAPE '\\'
  UNION ALL
  SELECT c.id, t.id, t.root, t.depth + 1, c.author, c.score, c.body, c.created_utc, c.dt_date,
    list_append(t.path, {'t': epoch_us(c.created_utc), 'id': c.id})
  FROM tree t JOIN comments c ON c.parent_id = 't1_' || t.id
)"""

CONVERSATIONS = """
comments AS (
  SELECT 'm' || conv_id || '_' || turn AS id, role AS author, CAST(length(text) % 11 - 4 AS INT) AS score, text AS body,
    make_timestamp(CAST(turn AS BIGINT) * 60000000) AS created_utc,
    CASE WHEN turn = 0 THEN 't3_v' || conv_id ELSE 't1_m' || conv_id || '_' || (turn - 1) END AS parent_id,
    CAST(NULL AS DATE) AS dt_date
  FROM conversations
)"""


def _averages(levels: int) -> str:
    """The recursive average, level by level from the deepest."""
    parts = [f"lvl{levels} AS (SELECT id, parent, root, depth, CAST(score AS BIGINT) AS average FROM tree WHERE depth = {levels})"]
    for depth in range(levels - 1, -1, -1):
        parts.append(
            f"lvl{depth} AS (SELECT t.id, t.parent, t.root, t.depth, "
            "CAST(floor((t.score + coalesce(k.s, 0)) / (coalesce(k.n, 0) + 1)) AS BIGINT) AS average "
            f"FROM tree t LEFT JOIN (SELECT parent, sum(average) AS s, count(*) AS n FROM lvl{depth + 1} GROUP BY parent) k "
            f"ON k.parent = t.id WHERE t.depth = {depth})"
        )
    parts.append("averages AS (" + " UNION ALL ".join(f"SELECT * FROM lvl{d}" for d in range(levels + 1)) + ")")
    return ",\n".join(parts)


# event trees are heaps of 16 comments, conversations have at most 8 turns
AVERAGES = _averages(4)
CONVERSATION_AVERAGES = _averages(8)

NODE_TEXT = r"""
CASE WHEN depth = 0 THEN '--- ' || strftime(created_utc, '%Y-%m-%dT%H:%M') || ' UTC ---' || chr(10) ELSE '' END
  || repeat(' ', depth) || author || ' (' || score || '):'
  || CASE WHEN body = '' THEN '' ELSE array_to_string(list_transform(
       string_split_regex(regexp_replace(body, '(?:\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{85}\x{2028}\x{2029}])\z', ''),
                          '(?:\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{85}\x{2028}\x{2029}])'),
       lambda line: repeat(' ', depth) || line), chr(10)) END
  || chr(10)"""
END_MARKER = "chr(10) || '--- thread ends ---' || chr(10)"

PIECES = f"""
pieces AS (
  SELECT root, id, depth, path AS place, {NODE_TEXT} AS text FROM tree
  UNION ALL
  SELECT root, id, depth, list_append(path, {{'t': 9223372036854775807, 'id': ''}}), {END_MARKER} FROM tree
),
tokens AS (SELECT root, CAST(ceil(sum(length(text)) / 4) AS BIGINT) AS tokens FROM pieces GROUP BY root)"""


def _replaced(text: str, rules: list[tuple[str, str, str]]) -> str:
    for _, pattern, new in rules:
        pattern, new = pattern.replace("'", "''"), new.replace("$1", "\\1")
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return text


def _clean_text(column: str) -> str:
    lowered = f"replace(lower({_replaced(column, MARKUP)}), '’', '''')"
    return _replaced(lowered, CONTRACTIONS)


def _phrases(text: str) -> str:
    words = rf"string_split_regex(regexp_replace({text}, '[^\p{{L}}\p{{N}} ]+', ' | ', 'g'), ' +')"
    kept = (
        f"list_filter(list_transform({words}, lambda w: CASE WHEN w IN ({_list(STOPWORDS)}) THEN '|' ELSE w END), "
        "lambda w: w = '|' OR (length(w) > 2 AND length(w) < 40))"
    )
    return rf"list_filter(string_split_regex(array_to_string({kept}, ' '), ' *\|[| ]*'), lambda p: p <> '')"


def _names_bot(column: str) -> str:
    return "(" + " OR ".join(f"contains({column}, '{t}')" for t in BOT_TRIGGERS) + ")"


def _title(column: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({column}, '\p{{L}}+|\P{{L}}+'), "
        "lambda r: replace(upper(r[1]), 'ẞ', 'Ss') || lower(r[2:])), '')"
    )


KEYWORDS = f"""
phrases AS (SELECT dt_date, unnest({_phrases(_clean_text('body'))}) AS keyword FROM kept),
scored AS (
  SELECT dt_date, keyword, sum(CAST(len(string_split(keyword, ' ')) AS DOUBLE)) AS score FROM phrases
  WHERE string_split(keyword, ' ')[-1] NOT IN ({_list(JUNK_WORDS)}) AND NOT {_names_bot('keyword')}
    AND len(string_split(keyword, ' ')) > 1 AND keyword NOT IN ({_list(COMMON_WORDS)})
  GROUP BY ALL HAVING sum(len(string_split(keyword, ' '))) > 3
)"""

CHUNKS = f"""
found AS (SELECT doc_id, unnest({_phrases(_clean_text('text'))}) AS text FROM documents),
chunks AS (
  SELECT doc_id, text, len(string_split(text, ' ')) AS words, length(text) AS size,
    CASE len(string_split(text, ' ')) % 3 WHEN 0 THEN 'VP' WHEN 1 THEN 'NP' ELSE 'ADJP' END AS type,
    CASE WHEN length(text) % 2 = 0 THEN 'SBJ' END AS role
  FROM found
),
scored AS (
  SELECT array_to_string(list_filter(string_split(text, ' '),
           lambda w: length(w) > 2 AND length(w) < 40 AND w NOT IN ({_list(STOPWORDS)})), ' ') AS keyword,
    CASE WHEN string_split(text, ' ')[-1] IN ({_list(JUNK_WORDS)}) OR {_names_bot('text')} THEN 0.0
         ELSE CAST((size % 3) / 2.0 + CASE WHEN type IN ({_list(CHUNK_TYPES)}) THEN 1 ELSE 0 END
              + CASE WHEN role IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN words > 1 THEN 0.5 ELSE 0 END AS DOUBLE) END AS score
  FROM chunks
)"""

REQUESTS = """
asking AS (SELECT author, min(id) AS first_id, CAST(substr(author, 6) AS BIGINT) AS num FROM comments
           WHERE author LIKE 'user\\_%' ESCAPE '\\' GROUP BY author),
requests AS (
  SELECT username, first_id AS requester_comment_id, [1, 7, 30, 31, 3][num % 5 + 1] AS days
  FROM (SELECT *, unnest([author, author || '_absent']) AS username FROM asking)
),
latest AS (SELECT max(dt_date) AS day FROM comments)"""

SPAN = "CASE WHEN days = 1 THEN 'day' WHEN days = 7 THEN 'week' WHEN days = 30 THEN 'month' WHEN days > 30 THEN 'all time' ELSE 'week' END"
RESULT_KEY = f"username || '-' || replace({SPAN}, ' ', '_')"


def _friendly(day: str, today: str) -> str:
    return f"CASE date_diff('day', {day}, {today}) WHEN 0 THEN 'today' WHEN 1 THEN 'yesterday' ELSE 'on ' || dayname({day}) END"


def _overall() -> str:
    """The figures over all users of each span."""
    return f"""
spans AS (SELECT DISTINCT days FROM requests),
everyone AS (SELECT days, c.*, length(body) - length(replace(body, ' ', '')) + 1 AS words, {EASTERN_DAY} AS wall
         FROM spans CROSS JOIN latest l JOIN comments c ON c.dt_date BETWEEN l.day - CAST(days - 1 AS INT) AND l.day),
pairs AS (SELECT days, author, wall, count(*) AS n FROM everyone GROUP BY ALL),
all_best AS (SELECT days, body, score, permalink FROM everyone
         QUALIFY row_number() OVER (PARTITION BY days ORDER BY score DESC, id) = 1),
overall AS (
  SELECT days, p.max_comments, p.mean_comments, f.max_words, f.mean_words, f.average_score,
    all_best.body AS top_body, all_best.score AS top_score, all_best.permalink AS top_permalink
  FROM (SELECT days, max(n) AS max_comments, avg(n) AS mean_comments FROM pairs GROUP BY days) p
  JOIN (SELECT days, max(words) AS max_words, avg(words) AS mean_words, avg(score) AS average_score FROM everyone GROUP BY days) f
    USING (days) JOIN all_best USING (days)
)"""


def _user_results(extra: str = "") -> str:
    """Requests answered one by one: every comment of the span, and a filled calendar for the mean."""
    return f"""
mine AS (
  SELECT r.username, r.requester_comment_id, r.days, c.id, c.score, c.body, c.permalink,
    length(c.body) - length(replace(c.body, ' ', '')) + 1 AS words, {EASTERN_DAY} AS wall
  FROM (SELECT DISTINCT * FROM requests) r CROSS JOIN latest l JOIN comments c ON c.author = r.username
    AND c.dt_date BETWEEN l.day - CAST(r.days - 1 AS INT) AND l.day
),
edges AS (SELECT username, requester_comment_id, days, min(wall) AS a, max(wall) AS b FROM mine GROUP BY ALL),
calendar AS (SELECT * EXCLUDE (a, b), CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS wall FROM edges),
counts AS (
  SELECT k.username, k.requester_comment_id, k.days, k.wall, count(m.id) AS n
  FROM calendar k LEFT JOIN mine m USING (username, requester_comment_id, days, wall) GROUP BY ALL
),
per_day AS (
  SELECT username, requester_comment_id, days, max(n) AS max_comments, avg(n) AS mean_comments,
    arg_min(wall, (-n, wall)) AS max_date FROM counts GROUP BY ALL
),
figures AS (
  SELECT username, requester_comment_id, days, max(words) AS max_words, avg(words) AS mean_words, avg(score) AS average_score
  FROM mine GROUP BY ALL
),
best AS (
  SELECT username, requester_comment_id, days, body AS top_body, score AS top_score, permalink AS top_permalink FROM mine
  QUALIFY row_number() OVER (PARTITION BY username, requester_comment_id, days ORDER BY score DESC, id) = 1
),
answers AS (
  SELECT username, requester_comment_id, days, {SPAN} AS span, {RESULT_KEY} AS result_key, max_comments, mean_comments,
    {_friendly('max_date', 'l.day')} AS max_day, max_words, mean_words, average_score, top_body, top_score, top_permalink
  FROM per_day JOIN figures USING (username, requester_comment_id, days) JOIN best USING (username, requester_comment_id, days)
  CROSS JOIN latest l
)"""


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(parts) + "\n"


ACTIVITY = """
spans AS (SELECT {by}, min(hour) AS a, max(hour) AS b FROM clean GROUP BY ALL),
grid AS (SELECT {by}, unnest(generate_series(a, b, 3600)) AS hour FROM spans),
filled AS (SELECT g.{by}, g.hour, count(c.id) AS comments FROM grid g LEFT JOIN clean c ON c.{by} = g.{by} AND c.hour = g.hour GROUP BY ALL),
activity AS (
  SELECT *, (comments - min(comments) OVER w) / nullif(max(comments) OVER w - min(comments) OVER w, 0) AS norm_count
  FROM filled WINDOW w AS (PARTITION BY {by})
)"""


def _full_report() -> str:
    """Every list of the short report, whole, and what only the full one has."""
    long = re.sub(r"position <= \d+", "true", _short_report())
    label = LABEL.format("author_flair_text")
    start, _, lists = long.partition("\n\n  SELECT dt_date, 'wordiest_overall'")
    rows = f"SELECT dt_date, 'wordiest_overall'{lists}"
    return f"""{start}
, listed AS ({rows}),
users AS (SELECT DISTINCT dt_date, author, author_flair_text, {label} AS label FROM clean)
SELECT dt_date, metric, name, CASE WHEN metric <> 'best_redditors' THEN detail END AS detail, value FROM listed
WHERE metric <> 'upvoted_comments' AND metric <> 'flair_population'
UNION ALL SELECT dt_date, m, id, regexp_replace(body, '(?i)!ping', '*ping', 'g'), CAST(v AS DOUBLE) FROM (
  SELECT *, unnest(['upvoted_comments', 'upvoted_position']) AS m, unnest([score, place]) AS v FROM (
    SELECT *, row_number() OVER (PARTITION BY dt_date ORDER BY score DESC, id) AS place FROM clean))
UNION ALL SELECT dt_date, 'flair_population', label, NULL, CAST(count(*) AS DOUBLE) FROM users GROUP BY dt_date, label
UNION ALL SELECT dt_date, 'flair_kinds', NULL, NULL, CAST(count(DISTINCT label) FILTER (label <> '') AS DOUBLE) FROM users GROUP BY dt_date"""


def _short_report() -> str:
    day_hour = "(hour - CAST(epoch(dt_date) AS BIGINT) - 25200) // 3600 + 1"
    hour_day = "CAST(make_timestamp((hour - 25200) * 1000000) AS DATE)"

    def board(metric: str, source: str, name: str, detail: str, value: str, k: int = 3) -> str:
        ties = name if detail == "NULL" else f"{name}, {detail}"
        return f"""
  SELECT dt_date, '{metric}' AS metric, position, {name} AS name, CAST({detail} AS VARCHAR) AS detail, CAST({value} AS DOUBLE) AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY dt_date ORDER BY {value} DESC, {ties}) AS position FROM ({source}))
  WHERE position <= {k}"""

    pairs = "SELECT dt_date, author, author_flair_text, count(*) AS n FROM clean WHERE author_flair_text IS NOT NULL GROUP BY ALL"

    def per_comment(column: str) -> str:
        return (
            "SELECT dt_date, author, author_flair_text, round_even(s / n, 1) AS v "
            f"FROM (SELECT dt_date, author, sum({column}) AS s FROM clean GROUP BY ALL) JOIN ({pairs}) USING (dt_date, author)"
        )

    users = f"SELECT DISTINCT dt_date, author, author_flair_text, {LABEL.format('author_flair_text')} AS label FROM clean"
    parts = [
        board("wordiest_overall", "SELECT dt_date, author, sum(words) AS v FROM clean GROUP BY ALL", "author", "NULL", "v"),
        board("wordiest", per_comment("words"), "author", "author_flair_text", "v"),
        board("upvoted_redditors", "SELECT dt_date, author, sum(score) AS v FROM clean GROUP BY ALL", "author", "NULL", "v"),
        board("best_redditors", per_comment("score"), "author", "author_flair_text", "v"),
        board("spammiest", pairs, "author", "author_flair_text", "n"),
        board(
            "emoji_spammers",
            "SELECT c.dt_date, c.author, count(e.emoji) AS v FROM clean c LEFT JOIN emoji e ON e.id = c.id GROUP BY ALL",
            "author", "NULL", "v",
        ),
        board("top_emoji", "SELECT dt_date, emoji, count(*) AS v FROM emoji GROUP BY ALL", "emoji", "NULL", "v", 150),
        board("upvoted_comments", "SELECT dt_date, id, score FROM clean", "id", "NULL", "score"),
        f"SELECT dt_date, 'activity', {day_hour}, CAST(hour AS VARCHAR), NULL, norm_count FROM activity",
        f"""SELECT {hour_day} AS dt_date, 'hourly_wordiest', {day_hour}, CAST(hour AS VARCHAR), author, CAST(v AS DOUBLE)
            FROM (SELECT {hour_day} AS dt_date, hour, author, sum(words) AS v FROM clean GROUP BY ALL)
            QUALIFY v = max(v) OVER (PARTITION BY hour)""",
        f"""SELECT {hour_day} AS dt_date, 'hourly_spammiest', {day_hour}, CAST(hour AS VARCHAR), author, CAST(v AS DOUBLE)
            FROM (SELECT {hour_day} AS dt_date, hour, author, count(*) AS v FROM clean GROUP BY ALL)
            QUALIFY row_number() OVER (PARTITION BY hour ORDER BY v DESC, author) = 1""",
        f"SELECT dt_date, 'flair_population', NULL, label, NULL, CAST(count(*) AS DOUBLE) FROM ({users}) WHERE label <> '' GROUP BY dt_date, label",
        "SELECT dt_date, 'deleted', NULL, NULL, NULL, CAST(count(*) FILTER (body = '[deleted]') AS DOUBLE) FROM kept GROUP BY dt_date",
        "SELECT dt_date, 'removed', NULL, NULL, NULL, CAST(count(*) FILTER (body = '[removed]') AS DOUBLE) FROM kept GROUP BY dt_date",
        "SELECT dt_date, 'other_blank', NULL, NULL, NULL, CAST(count(*) FILTER (author = '') AS DOUBLE) FROM kept GROUP BY dt_date",
        f"SELECT dt_date, 'unique_users', NULL, NULL, NULL, CAST(count(*) AS DOUBLE) FROM ({users}) GROUP BY dt_date",
        f"SELECT dt_date, 'unflaired', NULL, NULL, NULL, CAST(count(*) FILTER (label = '') AS DOUBLE) FROM ({users}) GROUP BY dt_date",
    ]
    return _with(COMMENTS, CLEAN, EMOJI, ACTIVITY.format(by="dt_date")) + "\nUNION ALL\n".join(parts)


def _nested_json(slim: bool) -> str:
    """Endings by the difference to the next comment's depth."""
    text = lambda c: f"'\"{c}\":' || coalesce(CAST(to_json({c}) AS VARCHAR), 'null')"
    stamp = "'\"created_utc\":' || CAST(epoch_us(created_utc) // 1000000 AS VARCHAR) || '.' || lpad(CAST(epoch_us(created_utc) % 1000000 AS VARCHAR), 6, '0')"
    if slim:
        shown = [text(c) for c in ("author", "body", "score")]
        opening = """CASE WHEN parent IS NULL THEN '' ELSE ', "parent": ' || CAST(to_json(parent) AS VARCHAR) END
            || CASE WHEN below > depth THEN ', "children": [' ELSE '}' || repeat(']}', depth - below) END"""
    else:
        shown = [text(c) for c in ("id", "author", "author_flair_text", "score", "permalink", "body")] + [stamp, text("parent_id")]
        opening = """', "parent": ' || coalesce(CAST(to_json(parent) AS VARCHAR), 'null') || ', "children": ['
            || CASE WHEN below > depth THEN '' ELSE ']}' || repeat(']}', depth - below) END"""
    fields = " || ',' || ".join(shown)
    return (
        _with(COMMENTS, TREE, recursive=True)
        + f""", told AS (SELECT t.*, c.author_flair_text, c.permalink, c.parent_id FROM tree t JOIN comments c ON c.id = t.id),
        placed AS (SELECT *, row_number() OVER w AS position, lead(depth) OVER w AS next_depth,
          coalesce(lead(depth) OVER w, 0) AS below FROM told WINDOW w AS (PARTITION BY root ORDER BY path))
        SELECT root, position, id, '{{"comment": {{' || {fields} || '}}' || {opening}
          || CASE WHEN next_depth IS NOT NULL AND below <= depth THEN ', ' ELSE '' END AS text FROM placed"""
    )


def oracles() -> dict[str, str]:
    base = _with(COMMENTS, CLEAN)
    emoji = _with(COMMENTS, CLEAN, EMOJI)
    tree = _with(COMMENTS, TREE, recursive=True)
    pieces = _with(COMMENTS, TREE, PIECES, recursive=True)
    sized = _with(COMMENTS, TREE, PIECES, AVERAGES, CLEAN, recursive=True)
    label = LABEL.format("author_flair_text")
    pairs = "SELECT dt_date, author, author_flair_text, count(*) AS n FROM clean WHERE author_flair_text IS NOT NULL GROUP BY ALL"
    versions = """
versions AS (
  SELECT * REPLACE (score + CASE v WHEN 2 THEN 100 ELSE 0 END AS score), v AS ingest_ts
  FROM (SELECT *, unnest([1, 2]) AS v FROM comments) WHERE v = 1 OR score % 2 = 0
)"""
    broken = """
broken AS (
  SELECT id, n, CASE WHEN n % 211 = 5 THEN NULL WHEN n % 223 = 7 THEN 'x9_bad' WHEN n % 227 = 9 THEN 't1_missing'
    WHEN n % 160 = 0 THEN 't1_c' || (n + 1) ELSE parent_id END AS parent_id
  FROM comments
),
heads AS (
  SELECT id, parent_id, CASE WHEN parent_id IS NULL THEN 'no parent' WHEN parent_id LIKE 't3%' THEN 'root'
    WHEN parent_id NOT LIKE 't1%' THEN 'malformed parent' WHEN substr(parent_id, 4) NOT IN (SELECT id FROM broken) THEN 'unknown parent' END AS reason
  FROM broken
),
reached AS (
  SELECT id, parent_id, reason FROM heads WHERE reason IS NOT NULL
  UNION ALL
  SELECT h.id, h.parent_id, r.reason FROM reached r JOIN heads h ON h.parent_id = 't1_' || r.id WHERE h.reason IS NULL
)"""
    buckets = """
edges AS (SELECT author, min(b) AS lo, max(b) AS hi FROM bucketed GROUP BY author),
grid AS (SELECT author, unnest(generate_series(lo, hi, {step})) AS b FROM edges),
counts AS (SELECT g.author, g.b, count(k.id) AS n FROM grid g LEFT JOIN bucketed k ON k.author = g.author AND k.b = g.b GROUP BY ALL)
SELECT author, max(n) AS max_comments, avg(n) AS mean_comments, {peak} FROM counts GROUP BY author"""
    harvested = (_with(COMMENTS, versions)
        + """, found AS (SELECT * REPLACE (dt_date - CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END AS dt_date) FROM versions)
             SELECT CAST(dt_date AS DATE) AS dt_date, id, author, CASE WHEN author = '' THEN '' ELSE author_flair_text END AS author_flair_text,
               CASE WHEN author = '' THEN 0 ELSE score END AS score, length(body) AS body_length
             FROM found WHERE created_utc <= CAST(dt_date + 1 AS TIMESTAMP) + INTERVAL 7 HOURS
             QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingest_ts DESC) = 1""")
    return {
        "bad_counts": base
        + """SELECT dt_date, count(*) FILTER (body = '[deleted]') AS deleted, count(*) FILTER (body = '[removed]') AS removed,
             count(*) FILTER (author = '') AS other_blank FROM kept GROUP BY dt_date""",
        "wordiest_overall": base + "SELECT dt_date, author, CAST(sum(words) AS BIGINT) AS word_count FROM clean GROUP BY ALL",
        "wordiest_avg": base
        + f"""SELECT dt_date, author, author_flair_text, round_even(w / n, 1) AS avg_words
              FROM (SELECT dt_date, author, sum(words) AS w FROM clean GROUP BY ALL) JOIN ({pairs}) USING (dt_date, author)""",
        "upvoted_redditors": base + "SELECT dt_date, author, CAST(sum(score) AS BIGINT) AS score FROM clean GROUP BY ALL",
        "spammiest": base
        + """SELECT dt_date, author, author_flair_text, count(*) AS comment_count FROM clean
             WHERE author_flair_text IS NOT NULL GROUP BY ALL""",
        "best_redditors": base
        + f"""SELECT dt_date, author, round_even(s / n, 1) AS avg_score
              FROM (SELECT dt_date, author, sum(score) AS s FROM clean GROUP BY ALL) JOIN ({pairs}) USING (dt_date, author)""",
        "emoji_spammers": emoji
        + """SELECT c.dt_date, c.author, count(e.emoji) AS emoji_count FROM clean c LEFT JOIN emoji e ON e.id = c.id GROUP BY ALL""",
        "top_emoji": emoji + "SELECT dt_date, emoji, count(*) AS uses FROM emoji GROUP BY ALL",
        "pointing_emoji": base
        + "SELECT dt_date, author, count(*) AS meme_count FROM clean WHERE "
        + f"regexp_matches(body, '{'|'.join(POINTING_EMOJI)}') GROUP BY ALL",
        "flair_population": base
        + f"""SELECT dt_date, label AS flair, count(*) AS redditors
              FROM (SELECT DISTINCT dt_date, author, author_flair_text, {label} AS label FROM clean) GROUP BY ALL""",
        "unique_users": base
        + f"""SELECT dt_date, count(*) AS unique_users, count(*) FILTER (label = '') AS unflaired,
              count(DISTINCT label) FILTER (label <> '') AS flair_kinds
              FROM (SELECT DISTINCT dt_date, author, author_flair_text, {label} AS label FROM clean) GROUP BY dt_date""",
        "weekly_census": base
        + f""", week AS (SELECT * FROM clean WHERE dt_date > (SELECT max(dt_date) FROM clean) - 7)
              SELECT 'accounts' AS name, count(DISTINCT author) AS n, 0 AS position FROM week
              UNION ALL
              SELECT label, count(*), CAST(row_number() OVER (ORDER BY count(*) DESC, label) AS INT)
              FROM (SELECT DISTINCT author, author_flair_text, {label} AS label FROM week) WHERE label <> '' GROUP BY label
              QUALIFY row_number() OVER (ORDER BY count(*) DESC, label) <= 3""",
        "rolling_census": base
        + """, ends AS (SELECT min(dt_date) AS a, max(dt_date) AS b FROM clean),
             calendar AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM ends)
             SELECT day AS dt_date, count(DISTINCT author) AS accounts, count(DISTINCT {'a': author, 'f': author_flair_text}) AS users
             FROM calendar LEFT JOIN clean ON dt_date BETWEEN day - 6 AND day GROUP BY day""",
        "upvoted_comments": base
        + """SELECT dt_date, row_number() OVER (PARTITION BY dt_date ORDER BY score DESC, id) AS position, id, author, score, permalink,
               regexp_replace(body, '(?i)!ping', '*ping', 'g') AS body FROM clean""",
        "top_comments": base
        + """, ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY dt_date ORDER BY score DESC, id) AS INT) AS position FROM clean),
             muted AS (SELECT *, regexp_replace(body, '(?i)!ping', '*ping', 'g') AS b FROM ranked WHERE position <= 3)
             SELECT dt_date, position, id, author, score,
               replace(CASE WHEN length(b) > 140 THEN substring(b, 1, 140) || '...' ELSE b END, chr(10), chr(10) || chr(10) || '> ') AS quote
             FROM muted""",
        "short_stats": _short_report(),
        "full_stats": _full_report(),
        "emoji_bands": emoji
        + """, uses AS (SELECT dt_date, emoji, count(*) AS uses FROM emoji GROUP BY ALL),
             shown AS (SELECT *, CAST(row_number() OVER (PARTITION BY dt_date ORDER BY uses DESC, emoji) AS INT) AS position FROM uses
                       QUALIFY row_number() OVER (PARTITION BY dt_date ORDER BY uses DESC, emoji) <= 150),
             sized AS (SELECT *, count(*) OVER (PARTITION BY dt_date) AS size FROM shown)
             SELECT dt_date, position, CASE WHEN position = 1 THEN 1 WHEN position <= floor(size / 10) THEN 2
               WHEN position <= floor(size * 3 / 10) THEN 3 END AS band, emoji, uses FROM sized""",
        "activity": _with(COMMENTS, CLEAN, ACTIVITY.format(by="dt_date"))
        + "SELECT dt_date, hour, comments, norm_count FROM activity",
        "user_activity": _with(
            COMMENTS, CLEAN, "keyed AS (SELECT *, author || '|' || dt_date AS k FROM clean)",
            ACTIVITY.format(by="k").replace("FROM clean", "FROM keyed").replace("JOIN clean", "JOIN keyed"),
        )
        + "SELECT split_part(k, '|', 1) AS author, CAST(split_part(k, '|', 2) AS DATE) AS dt_date, hour, comments, norm_count FROM activity",
        "activity_bars": _with(COMMENTS, CLEAN, ACTIVITY.format(by="dt_date"))
        + """SELECT dt_date, hour, repeat('█', CAST(round_even(norm_count * 15 + 1, 0) AS INT)) AS bar FROM activity
             QUALIFY hour < max(hour) OVER (PARTITION BY dt_date)""",
        "hourly_wordiest": base
        + """SELECT * FROM (SELECT hour, author, CAST(sum(words) AS BIGINT) AS word_count FROM clean GROUP BY ALL)
             QUALIFY word_count = max(word_count) OVER (PARTITION BY hour)""",
        "hourly_spammiest": base
        + """SELECT * FROM (SELECT hour, author, count(*) AS comment_count FROM clean GROUP BY ALL)
             QUALIFY row_number() OVER (PARTITION BY hour ORDER BY comment_count DESC, author) = 1""",
        "comments_per_day": _with(COMMENTS)
        + f", bucketed AS (SELECT author, id, CAST(date_diff('day', DATE '1970-01-01', {EASTERN_DAY}) AS BIGINT) AS b FROM comments),"
        + buckets.format(step=1, peak="DATE '1970-01-01' + CAST(arg_min(b, (-n, b)) AS INT) AS max_day"),
        "comments_per_hour": _with(COMMENTS)
        + ", bucketed AS (SELECT author, id, CAST(epoch(date_trunc('hour', created_utc)) AS BIGINT) AS b FROM comments),"
        + buckets.format(step=3600, peak="arg_min(b, (-n, b)) AS max_hour"),
        "comments_per_user_day": _with(COMMENTS)
        + f"""SELECT max(n) AS max_comments, avg(n) AS mean_comments
              FROM (SELECT author, {EASTERN_DAY} AS d, count(*) AS n FROM comments GROUP BY ALL)""",
        "words_and_score": _with(COMMENTS)
        + """SELECT author, max(w) AS max_words, avg(w) AS mean_words, avg(score) AS average_score
             FROM (SELECT author, score, length(body) - length(replace(body, ' ', '')) + 1 AS w FROM comments) GROUP BY author""",
        "top_comment": _with(COMMENTS)
        + """SELECT author, body, score, permalink FROM comments
             QUALIFY row_number() OVER (PARTITION BY author ORDER BY score DESC, id) = 1""",
        "user_summary": _with(COMMENTS, REQUESTS, _user_results()) + "SELECT * FROM answers",
        "overall_stats": _with(COMMENTS, REQUESTS, _overall()) + "SELECT * FROM overall",
        "stale_requests": _with(COMMENTS, REQUESTS)
        + f""", written AS (SELECT author AS username, max(created_utc) AS written_at FROM comments GROUP BY author),
             stored AS (SELECT {RESULT_KEY} AS result_key, written_at FROM requests JOIN written USING (username))
             SELECT r.*, {RESULT_KEY.replace('username', 'r.username').replace('days', 'r.days')} AS result_key FROM requests r
             WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.result_key = {RESULT_KEY.replace('username', 'r.username').replace('days', 'r.days')}
               AND floor(epoch((SELECT max(created_utc) FROM comments))) - floor(epoch(s.written_at))
                 < CASE WHEN r.days = 1 THEN 3600 WHEN r.days > 30 THEN 604800 ELSE 86400 END)""",
        "last_week": _with(COMMENTS) + "SELECT dt_date, id FROM comments WHERE dt_date > (SELECT max(dt_date) FROM comments) - 7",
        "latest_day": _with(COMMENTS)
        + "SELECT dt_date, id, author, score FROM comments WHERE dt_date = (SELECT max(dt_date) FROM comments)",
        "latest_by_id": _with(COMMENTS, versions)
        + """SELECT id, score, ingest_ts, length(body) AS body_length FROM versions
             QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingest_ts DESC) = 1""",
        "insert_new": _with(NARROW, versions)
        + """SELECT v.id, nullif(v.author, '') AS author, nullif(v.author_flair_text, '') AS author_flair_text, nullif(v.score, 0) AS score,
               v.dt_date
             FROM versions v LEFT JOIN (SELECT id FROM comments WHERE score < 0) stored ON stored.id = v.id
             WHERE v.ingest_ts = 1 AND stored.id IS NULL""",
        "json_days": _with(COMMENTS)
        + """SELECT dt_date, id, author, author_flair_text, score, epoch_us(created_utc) AS created_micros, length(body) AS body_length
             FROM comments""",
        "before_day_end": _with(COMMENTS)
        + """SELECT id, dt_date FROM comments
             WHERE created_utc <= CAST(dt_date - CAST(n % 2 AS INT) + 1 AS TIMESTAMP) + INTERVAL 7 HOURS""",
        "harvested": harvested,
        "normalised_blank": _with(COMMENTS)
        + """SELECT id, CASE WHEN gone THEN '' ELSE author END AS author, CASE WHEN gone THEN '' ELSE author_flair_text END AS author_flair_text,
               CASE WHEN gone THEN 0 ELSE score END AS score
             FROM (SELECT *, author IN ('', 'AutoModerator') AS gone FROM comments)""",
        "ids_of_author_and_day": _with(COMMENTS)
        + """SELECT id FROM comments WHERE author_flair_text <> ''
             INTERSECT SELECT id FROM comments WHERE dt_date = (SELECT max(dt_date) FROM comments)""",
        "by_ids": _with(NARROW)
        + """SELECT c.id, c.author, c.score FROM comments c
             JOIN (SELECT DISTINCT substr(parent_id, 4) AS id FROM comments WHERE parent_id LIKE 't1%') p ON p.id = c.id""",
        "user_days": _with(NARROW)
        + "SELECT dt_date, id, score FROM comments WHERE author = 'user_3' AND dt_date = (SELECT max(dt_date) FROM comments)",
        "day_offset": _with(NARROW)
        + "SELECT dt_date, id FROM comments WHERE dt_date = (SELECT CAST(max(created_utc) AS DATE) FROM comments) - 2",
        "json_array_days": _with(COMMENTS)
        + """SELECT dt_date, id, author, author_flair_text, score, epoch_us(created_utc) AS created_micros, length(body) AS body_length
             FROM comments""",
        "json_array_splits": _with(COMMENTS)
        + """SELECT dt_date, id, author, author_flair_text, score, epoch_us(created_utc) AS created_micros, length(body) AS body_length
             FROM comments""",
        "loaded_days": _with(COMMENTS)
        + """SELECT dt_date, id, CASE WHEN score < 0 THEN author ELSE nullif(author, '') END AS author,
               CASE WHEN score < 0 THEN -100 ELSE nullif(score, 0) END AS score, length(body) AS body_length FROM comments""",
        "one_thread": tree + "SELECT id, parent, root, depth FROM tree WHERE root = (SELECT root FROM tree WHERE id = 'c21')",
        "request_threads": _with(COMMENTS, TREE, PIECES, AVERAGES, REQUESTS, recursive=True)
        + """, mine AS (SELECT DISTINCT r.username, r.days, t.root FROM requests r CROSS JOIN latest l
               JOIN tree t ON t.author = r.username AND t.dt_date BETWEEN l.day - CAST(r.days - 1 AS INT) AND l.day),
             ranked AS (SELECT m.username, m.days, m.root, a.average, k.tokens,
                 CAST(sum(k.tokens) OVER (PARTITION BY m.username, m.days ORDER BY a.average DESC, m.root ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_tokens
               FROM mine m JOIN averages a ON a.id = m.root JOIN tokens k ON k.root = m.root)
             SELECT *, row_number() OVER (PARTITION BY username, days ORDER BY average DESC, root) AS position FROM ranked
             WHERE running_tokens <= 102400""",
        "subtree_rollup": tree
        + """, above AS (SELECT unnest(path).id AS top, root, depth, score, body FROM tree)
             SELECT a.top AS id, any_value(a.root) AS root, count(*) AS comments, max(a.depth) - min(a.depth) AS levels,
               CAST(sum(length(a.body)) AS BIGINT) AS size, min(a.score) AS min_score, max(a.score) AS max_score FROM above a GROUP BY a.top""",
        "subtree_contains": tree
        + """, asked AS (SELECT id, path, unnest(list_append(list_transform([0, 1, 2], lambda b: 'c' || (CAST(substr(id, 2) AS BIGINT) - b)), 'nobody')) AS top
               FROM tree)
             SELECT top, id, list_contains(list_transform(path, lambda p: p.id), top) AS contained FROM asked""",
        "thread_json": _nested_json(False),
        "thread_json_slim": _nested_json(True),
        "user_result": _with(COMMENTS, REQUESTS, _user_results(), _overall())
        + """SELECT a.* EXCLUDE (top_body), o.max_comments AS all_max_comments, o.mean_comments AS all_mean_comments,
               o.max_words AS all_max_words, o.mean_words AS all_mean_words, o.average_score AS all_average_score,
               o.top_score AS all_top_score, o.top_permalink AS all_top_permalink
             FROM answers a JOIN overall o ON o.days = a.days""",
        "parents_filled": _with(COMMENTS)
        + "SELECT id, CASE WHEN n % 23 = 0 AND n % 46 <> 0 THEN NULL ELSE parent_id END AS parent_id FROM comments",
        "quoted_comments": _with(COMMENTS)
        + """SELECT id, 'At ' || CASE WHEN epoch_us(created_utc) % 1000000 = 0 THEN strftime(created_utc, '%Y-%m-%dT%H:%M:%S')
                 ELSE strftime(created_utc, '%Y-%m-%dT%H:%M:%S.%f') END
               || ', ' || author || ' (' || coalesce(author_flair_text, 'None') || ') wrote:' || chr(10) || body AS prompt,
               '@' || author || ' (' || coalesce(author_flair_text, 'None') || ')' || chr(10) || body AS embedding_input
             FROM comments""",
        "thread_roots": tree + "SELECT id, parent, root, depth FROM tree",
        "thread_orphans": _with(COMMENTS, broken, recursive=True)
        + """SELECT h.id, CASE WHEN h.parent_id LIKE 't1%' THEN substr(h.parent_id, 4) END AS parent, coalesce(r.reason, 'cycle') AS reason
             FROM heads h LEFT JOIN reached r ON r.id = h.id WHERE r.reason IS DISTINCT FROM 'root'""",
        "thread_rollup": tree
        + """SELECT root, count(*) AS comments, max(depth) AS max_depth, CAST(sum(length(body)) AS BIGINT) AS size,
               min(score) AS min_score, max(score) AS max_score FROM tree GROUP BY root""",
        "conversation_threads": _with(CONVERSATIONS, TREE, recursive=True)
        + """SELECT root, count(*) AS comments, max(depth) AS max_depth, CAST(sum(length(body)) AS BIGINT) AS size,
               min(score) AS min_score, max(score) AS max_score FROM tree GROUP BY root""",
        "thread_avg": _with(COMMENTS, TREE, AVERAGES, recursive=True) + "SELECT id, root, depth, average FROM averages",
        "conversation_avg": _with(CONVERSATIONS, TREE, CONVERSATION_AVERAGES, recursive=True)
        + "SELECT id, root, depth, average FROM averages",
        "ranked_threads": _with(COMMENTS, TREE, AVERAGES, recursive=True) + "SELECT root, average, row_number() OVER (ORDER BY average DESC, root) AS position FROM averages WHERE depth = 0",
        "user_threads": tree + "SELECT DISTINCT author, dt_date, root FROM tree",
        "latest_day_threads": tree
        + """SELECT root, id, depth FROM tree
             WHERE root IN (SELECT root FROM tree WHERE dt_date = (SELECT max(dt_date) FROM comments))""",
        "thread_contains": tree
        + """, asked AS (SELECT 'c' || (CAST(substr(id, 2) AS BIGINT) + 1) AS id, root FROM tree)
             SELECT a.root, a.id, coalesce(t.root = a.root, false) AS contained FROM asked a LEFT JOIN tree t ON t.id = a.id""",
        "thread_order": tree
        + "SELECT root, row_number() OVER (PARTITION BY root ORDER BY path) AS position, id, depth FROM tree",
        "thread_rows": tree + "SELECT root, parent, depth, id, author, score, length(body) AS body_length FROM tree",
        "thread_text": pieces
        + "SELECT root, id, depth, row_number() OVER (PARTITION BY root ORDER BY place) AS piece, text FROM pieces",
        "budgeted_threads": sized
        + """, mine AS (SELECT DISTINCT c.author, t.root FROM clean c JOIN tree t ON t.id = c.id),
             ranked AS (SELECT m.author, m.root, a.average, k.tokens,
                 CAST(sum(k.tokens) OVER (PARTITION BY m.author ORDER BY a.average DESC, m.root ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_tokens
               FROM mine m JOIN averages a ON a.id = m.root JOIN tokens k ON k.root = m.root)
             SELECT * FROM ranked WHERE running_tokens <= 102400""",
        "budgeted_thread_text": sized
        + """, chosen AS (SELECT a.root, sum(k.tokens) OVER (ORDER BY a.average DESC, a.root ROWS UNBOUNDED PRECEDING) AS running
               FROM averages a JOIN tokens k ON k.root = a.root WHERE a.depth = 0)
             SELECT root, string_agg(text, '' ORDER BY place) AS text FROM pieces
             WHERE root IN (SELECT root FROM chosen WHERE running <= 102400) GROUP BY root""",
        "sampled_threads": pieces + "SELECT row_number() OVER (ORDER BY md5(root || '-7'), root) AS position, root, tokens FROM tokens WHERE tokens <= 108800",
        "thread_submissions": tree
        + """, made AS (SELECT substr(parent_id, 4) AS id, min(created_utc) AS created_utc FROM comments WHERE parent_id LIKE 't3%' GROUP BY 1),
             chosen AS (SELECT id FROM made WHERE id IN ('s0', 's1', 's2')
                        AND CAST(created_utc AS DATE) = (SELECT CAST(min(created_utc) AS DATE) FROM made))
             SELECT substr(c.parent_id, 4) AS submission, t.root, t.id FROM tree t JOIN comments c ON c.id = t.root
             WHERE substr(c.parent_id, 4) IN (SELECT id FROM chosen)""",
        "keyword_scores": _with(COMMENTS, CLEAN, KEYWORDS) + f"SELECT dt_date, {_title('keyword')} AS keyword, score FROM scored",
        "keyword_bands": _with(COMMENTS, CLEAN, KEYWORDS)
        + f""", ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY dt_date ORDER BY score DESC, keyword) AS INT) AS position FROM scored)
              SELECT dt_date, position, CASE WHEN position <= 10 THEN 1 WHEN position <= 30 THEN 2 WHEN position <= 60 THEN 3
                WHEN position <= 120 THEN 4 WHEN position <= 180 THEN 5 ELSE 6 END AS band, {_title('keyword')} AS keyword, score
              FROM ranked WHERE position <= 240""",
        "chunk_scores": _with(CHUNKS)
        + f"""SELECT {_title('keyword')} AS keyword, sum(score) AS score FROM scored
              WHERE score > 1 AND keyword <> '' AND keyword NOT IN ({_list(COMMON_WORDS)}) GROUP BY scored.keyword HAVING sum(score) > 3""",
        "clean_texts": _with(COMMENTS) + f"SELECT id, {_clean_text('body')} AS plain FROM comments",
        "stream_hourly": base + "SELECT hour, author, count(*) AS comment_count FROM clean GROUP BY ALL",
        "stream_late": base
        + """SELECT hour, author, count(*) AS comment_count FROM clean
             WHERE created_utc <= CAST(dt_date - CAST(n % 2 AS INT) + 1 AS TIMESTAMP) + INTERVAL 7 HOURS GROUP BY ALL""",
        "stream_harvested": harvested,
        "stream_latest": _with(COMMENTS, versions)
        + """SELECT id, score, length(body) AS body_length FROM versions
             QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingest_ts DESC) = 1""",
        "stream_requests": _with(COMMENTS)
        + """, latest AS (SELECT max(dt_date) AS day FROM comments),
             requests AS (SELECT DISTINCT 'user_' || user_id AS username, 'c' || (user_id % 3) AS requester_comment_id, 7 AS days
                          FROM events WHERE event_type = 'signup'),"""
        + _user_results()
        + "SELECT username, days, span, max_comments, mean_comments, max_words, top_score FROM answers",
    }
