"""Reply trees: roots, depths and reading order by pointer doubling, and figures over trees.

A tree is never gathered into one row or one task. It stays as rows ``(id, parent, root, depth)``;
the place of a comment in its thread's reading order is a number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.fixed import END_MARKER, MAX_TOKENS, PREFIX_SHARE, SAMPLE_SHARE, THREAD_HEADER
from palaver.functions.text import body_lines, token_estimate
from palaver.operators.ranking import running_total
from palaver.session import fresh_path, materialise

SETTLED, OPEN, ORPHAN = "settled", "open", "orphan"
UNKNOWN = "unknown parent"


@dataclass(frozen=True)
class Forest:
    """``nodes``: comments with root, parent, depth. ``orphans``: those without a root, and why."""

    nodes: DataFrame
    orphans: DataFrame


def _start(comments: DataFrame, carry: Sequence[str]) -> DataFrame:
    prefix, rest = F.left("parent_id", F.lit(3)), F.substr("parent_id", F.lit(4))
    top, reply = prefix == "t3_", prefix == "t1_"
    malformed = F.when(F.col("parent_id").isNull() | (F.col("parent_id") == ""), F.lit("no parent")).otherwise(
        F.lit("malformed parent")
    )
    return comments.select(
        "id",
        F.when(reply, rest).alias("parent"),
        F.when(top, F.lit(SETTLED)).when(reply, F.lit(OPEN)).otherwise(F.lit(ORPHAN)).alias("status"),
        # while open: the ancestor reached so far and the steps to it; once settled: root and depth
        F.when(top, F.col("id")).when(reply, rest).alias("root"),
        F.when(top, F.lit(0)).otherwise(F.lit(1)).alias("depth"),
        F.when(~(top | reply) | F.col("parent_id").isNull(), malformed).alias("reason"),
        *carry,
    )


def _advance(open_rows: DataFrame, known: DataFrame, carry: Sequence[str], how: str) -> DataFrame:
    """Replace the ancestor reached by what that ancestor has reached."""
    target = known.select(
        F.col("id").alias("_id"),
        F.col("status").alias("_status"),
        F.col("root").alias("_root"),
        F.col("depth").alias("_depth"),
        F.col("reason").alias("_reason"),
    )
    joined = open_rows.join(target, F.col("root") == F.col("_id"), how)
    return joined.select(
        "id",
        "parent",
        F.coalesce("_status", F.lit(ORPHAN)).alias("status"),
        F.col("_root").alias("root"),
        (F.col("depth") + F.col("_depth")).alias("depth"),
        F.coalesce("_reason", F.when(F.col("_id").isNull(), F.lit(UNKNOWN))).alias("reason"),
        *carry,
    )


def resolve(comments: DataFrame, carry: Sequence[str] = ()) -> Forest:
    """Root and depth of every comment; ``carry`` names columns to keep along.

    Each round doubles the distance climbed, so a tree of depth d takes about log2(d) joins.
    Only rows that have not arrived climb. Rows that have arrived are written once and from then
    on only looked up by id, so a root with very many comments is no hot key. A hot comment in
    between is split by the skew join, since the side looked up has one row per id. Each round
    settles at least one row that can be settled; when none is, the rest lie on cycles.
    """
    spark = comments.sparkSession
    base = fresh_path(spark, "threads")

    def write(rows: DataFrame, name: str) -> DataFrame:
        rows.write.partitionBy("status").parquet(f"{base}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{base}/{name}")

    def with_status(tables: Sequence[DataFrame], status: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [t.where(F.col("status") == status) for t in tables])

    # the comments are scanned once, here; the rounds work on this narrow table
    start = write(_start(comments, carry), "start")
    # the first round also finds the parents that do not exist
    replies = start.where(F.col("status") == OPEN)
    rounds = [start.where(F.col("status") != OPEN)]
    rounds.append(write(_advance(replies, start, carry, "left"), "round-1"))
    still_open = rounds[-1].where(F.col("status") == OPEN)
    # a missing parent is an end of the climb as well: whoever points at it later finds it here
    missing = (
        rounds[-1]
        .where((F.col("status") == ORPHAN) & (F.col("reason") == UNKNOWN))
        .select(F.col("parent").alias("id"), "status", "root", "depth", "reason")
        .dropDuplicates(["id"])
    )
    left = still_open.count()
    while left:
        done = [with_status(rounds, SETTLED), with_status(rounds, ORPHAN)]
        ends = [t.select(missing.columns) for t in (*done, still_open)]
        known = reduce(DataFrame.unionByName, [*ends, missing])
        rounds.append(write(_advance(still_open, known, carry, "inner"), f"round-{len(rounds)}"))
        still_open = rounds[-1].where(F.col("status") == OPEN)
        before, left = left, still_open.count()
        if left == before:
            break

    columns = ["id", "parent", "root", "depth", *carry]
    nodes = with_status(rounds, SETTLED).select(*columns)
    orphans = with_status(rounds, ORPHAN).select("id", "parent", "reason")
    cycles = still_open.select("id", "parent", F.lit("cycle").alias("reason"))
    return Forest(nodes, orphans.unionByName(cycles))


def thread_of(nodes: DataFrame, comment_id: str) -> DataFrame:
    """All comments of the thread that holds a comment."""
    return nodes.join(nodes.where(F.col("id") == comment_id).select("root"), "root", "left_semi")


def touched_threads(nodes: DataFrame, by: Sequence[str], matching: DataFrame | None = None) -> DataFrame:
    """Each thread that a comment lies in, once per value of ``by``, columns the nodes carry.

    With ``matching`` only its comments count; those without a thread are skipped.
    """
    rows = nodes if matching is None else nodes.join(matching.select("id"), "id", "left_semi")
    return rows.select(*by, "root").distinct()


def threads_touching(nodes: DataFrame, matching: DataFrame) -> DataFrame:
    """All comments of the threads that a matching comment lies in."""
    return nodes.join(touched_threads(nodes, (), matching), "root", "left_semi")


def contains(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """For pairs ``(root, id)`` whether the comment lies in the thread of that root."""
    found = nodes.select("id", F.col("root").alias("_root"))
    return pairs.join(found, "id", "left").select(
        "root", "id", F.coalesce(F.col("_root") == F.col("root"), F.lit(False)).alias("contained")
    )


def rollup(nodes: DataFrame) -> DataFrame:
    """Comments, depth, characters and score range per thread; needs ``score, body_length``."""
    return nodes.groupBy("root").agg(
        F.count("*").alias("comments"),
        F.max("depth").alias("max_depth"),
        F.sum("body_length").cast("bigint").alias("size"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
    )


def recursive_average(nodes: DataFrame) -> DataFrame:
    """``floor((score + averages of the children) / (children + 1))``, the floor taken at every level.

    Works by contraction, not level by level. In each round comments without open children are
    finished and added to their parents, and chains of comments with one open child are shortened:
    such a comment's average is a function of the child's, and two functions in a row are one. So
    the number of rounds follows the logarithm of the number of comments, however deep a thread
    is. Children are summed per parent before they are joined, so a parent with very many is one row.

    Scores lie between ``low`` and ``high``, and so do averages. ``x -> floor((add + x) / parts)`` is
    kept as it is while ``parts`` is below that range; beyond it takes two values at most, and is
    kept as ``value``, plus one from ``step`` on. No number grows with the depth.
    """
    rows = materialise(nodes.select("id", "parent", "root", "depth", F.col("score").cast("bigint")), "average-rows")
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    low, high = low or 0, high or 0
    size = high - low + 1
    children = rows.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("_n"))
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in _FUNCTION.items()]
    state = materialise(
        rows.join(children, "id", "left").select(
            "id", "parent", "root", "depth", F.col("score").alias("total"), (F.coalesce("_n", F.lit(0)) + 1).alias("count"),
            *empty, F.lit(None).cast("bigint").alias("average"),
        ),
        "average",
    )
    done: list[DataFrame] = []
    while True:
        still = state.where("average is null")
        fresh = state.where("average is not null")
        done.append(fresh.select("id", "parent", "root", "depth", "average"))
        if not still.limit(1).count():
            return reduce(DataFrame.unionByName, done)
        state = materialise(_contract(still, fresh, low, size), "average")


#: A chain's lower end, and the average of its upper end as a function of the lower end's.
_FUNCTION = {"target": "string", "add": "bigint", "parts": "bigint", "value": "bigint", "step": "bigint"}


def _contract(still: DataFrame, fresh: DataFrame, low: int, size: int) -> DataFrame:
    """One round: ``still`` are the open comments, ``fresh`` those finished in the round before.

    Only comments that begin a chain have a target and look it up; only the others gather their children.
    """
    return _lengthened(still.where("target is not null"), fresh, low, size).unionByName(
        _gathered(still.where("target is null"), still, fresh, low, size)
    )


def _applied(x: Column) -> Column:
    stepped = F.col("value") + F.coalesce(x >= F.col("step"), F.lit(False)).cast("bigint")
    return F.when(F.col("value").isNotNull(), stepped).otherwise(_floor_div(F.col("add") + x, F.col("parts")))


def _lengthened(chained: DataFrame, fresh: DataFrame, low: int, size: int) -> DataFrame:
    """Chains whose end is finished now are finished; the others take over the chain of their target."""
    ended = fresh.select(F.col("id").alias("target"), F.col("average").alias("_x"))
    now = chained.join(ended, "target", "left").withColumn("_now", F.when(F.col("_x").isNotNull(), _applied(F.col("_x"))))
    lookup = now.select(
        F.col("id").alias("_id"), F.col("_now").alias("_average"), *[F.col(c).alias(f"_{c}") for c in _FUNCTION]
    )
    rows = now.join(lookup, F.col("target") == F.col("_id"), "left")
    x = F.col("_average")
    longer = F.col("_now").isNull() & x.isNull() & F.col("_target").isNotNull()
    new = _composed(low, size)
    return rows.select(
        "id", "parent", "root", "depth", "total", "count",
        F.when(longer, F.col("_target")).otherwise(F.col("target")).alias("target"),
        *[F.when(longer, new[name]).otherwise(F.col(name)).alias(name) for name in ("add", "parts", "value", "step")],
        F.coalesce("_now", F.when(x.isNotNull(), _applied(x))).alias("average"),
    )


def _gathered(plain: DataFrame, still: DataFrame, fresh: DataFrame, low: int, size: int) -> DataFrame:
    """Finished children are added; comments without open children are finished, those with one begin a chain."""
    sums = fresh.groupBy(F.col("parent").alias("id")).agg(F.sum("average").alias("_sum"))
    open_children = still.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("_open"), F.min("id").alias("_only"))
    children = open_children.join(sums, "id", "full")
    total = F.col("total") + F.coalesce("_sum", F.lit(0))
    leaf, begins = F.col("_open").isNull(), F.col("_open") == 1
    start = _settled(total, F.col("count"), low, size)
    return plain.join(children, "id", "left").select(
        "id", "parent", "root", "depth", total.alias("total"), "count", F.when(begins, F.col("_only")).alias("target"),
        *[F.when(begins, start[name]).alias(name) for name in ("add", "parts", "value", "step")],
        F.when(leaf, _floor_div(total, F.col("count"))).alias("average"),
    )


def _settled(add: Column, parts: Column, low: int, size: int) -> dict[str, Column]:
    """``x -> floor((add + x) / parts)`` for x from ``low`` on, in the form that does not grow."""
    none = F.lit(None).cast("bigint")
    large = parts >= size
    value = _floor_div(add + low, parts)
    return {
        "add": F.when(~large, add),
        "parts": F.when(~large, parts),
        "value": F.when(large, value).otherwise(none),
        "step": F.when(large, (value + 1) * parts - add).otherwise(none),
    }


def _composed(low: int, size: int) -> dict[str, Column]:
    """The function of a row after the function of the row that its target is, whose columns begin with ``_``."""
    add, parts, value, step = (F.col(c) for c in ("add", "parts", "value", "step"))
    add2, parts2, value2, step2 = (F.col(c) for c in ("_add", "_parts", "_value", "_step"))
    two, two2 = value.isNotNull(), value2.isNotNull()

    def outer(y: Column) -> Column:
        return F.when(two, value + F.coalesce(y >= step, F.lit(False)).cast("bigint")).otherwise(_floor_div(add + y, parts))

    # both as they are: floor((add + floor((add2 + x) / parts2)) / parts) has one sum and one divisor
    plain = _settled(add * parts2 + add2, parts * parts2, low, size)
    # the lower one has two values: so has the whole, and steps where the lower one does, or nowhere
    below, above = outer(value2), outer(value2 + 1)
    return {
        "add": F.when(~two & ~two2, plain["add"]),
        "parts": F.when(~two & ~two2, plain["parts"]),
        "value": F.when(two2, below).when(two, value).otherwise(plain["value"]),
        "step": F.when(two2, F.when(above > below, step2)).when(two, step * parts2 - add2).otherwise(plain["step"]),
    }


def _floor_div(total: Column, parts: Column) -> Column:
    # pmod is never negative, so the difference divides without a rest
    return ((total - F.pmod(total, parts)) / parts).cast("bigint")


def ranked_threads(averages: DataFrame) -> DataFrame:
    """Threads by the average of their root, with their ``position``, best first."""
    roots = averages.where("depth = 0").select("root", "average", F.lit(1).cast("bigint").alias("_one"))
    return running_total(roots, [], ["average", "root"], "_one", [False, True], "position").drop("_one")


# -- threads as text --------------------------------------------------------------------------


def node_text(depth: Column, created: Column, author: Column, score: Column, body: Column) -> Column:
    """One comment as text, indented by depth; a thread's first comment has a header line."""
    indent = F.repeat(F.lit(" "), depth)
    lines = F.concat(indent, F.replace(body_lines(body), F.lit("\n"), F.concat(F.lit("\n"), indent)))
    text = F.when(body == "", F.lit("")).otherwise(lines)
    before, minutes, after = THREAD_HEADER
    header = F.when(depth == 0, F.concat(F.lit(before), F.date_format(created, minutes), F.lit(after))).otherwise(F.lit(""))
    return F.concat(header, indent, author, F.lit(" ("), score.cast("string"), F.lit("):"), text, F.lit("\n"))


_HEADER_LENGTH = len(THREAD_HEADER[0]) + len("2000-01-01T00:00") + len(THREAD_HEADER[2])


def with_text_length(comments: DataFrame) -> DataFrame:
    """Add ``text_length``, the length of a comment's text at depth 0, and ``indents``, what each depth adds."""
    lines = body_lines(F.col("body"))
    breaks = F.char_length(lines) - F.char_length(F.replace(lines, F.lit("\n"), F.lit("")))
    frame = F.char_length("author") + F.char_length(F.col("score").cast("string")) + len(" ():\n")
    return comments.withColumns(
        {
            "text_length": (frame + F.char_length(lines)).cast("bigint"),
            "indents": F.when(F.col("body") == "", 1).otherwise(breaks + 2).cast("bigint"),
        }
    )


#: Adds bodies to rows of comments; see ``thread_pieces``.
Complete = Callable[[DataFrame], DataFrame]


def thread_pieces(placed: DataFrame, texts: DataFrame, complete: Complete | None = None) -> DataFrame:
    """Two rows per comment: its text, and the end marker that follows its last descendant.

    Sorted by ``root, piece`` and joined without separators they are the threads as text.
    ``placed`` is from ``in_order``, ``texts`` has the columns ``id, author, score, body, created_utc``. Where bodies
    are stored apart, ``texts`` has the comments without them, and ``complete`` adds them to the placed rows, so that no
    body is moved.
    """
    slim = texts if complete else texts.select("id", "author", "score", "body", "created_utc")
    joined = slim.join(placed.select("id", "root", "depth", "position", "size"), "id")
    joined = complete(joined) if complete else joined
    written = node_text(F.col("depth"), F.col("created_utc"), F.col("author"), F.col("score"), F.col("body"))
    # before a comment come all earlier ones, and the ends of those that are not above it
    own = 2 * F.col("position") - 1 - F.col("depth")
    last = F.col("position") + F.col("size") - 1
    pieces = F.array(
        F.struct(own.alias("piece"), written.alias("text")),
        F.struct((2 * last - F.col("depth")).alias("piece"), F.lit(END_MARKER).alias("text")),
    )
    return joined.select("root", "id", "depth", F.explode(pieces).alias("_p")).select(
        "root", "id", "depth", "_p.piece", "_p.text"
    )


def thread_rows(nodes: DataFrame, comments: DataFrame, columns: Sequence[str] = ("author", "body", "score")) -> DataFrame:
    """Threads as flat rows, the form in which nested trees are exchanged.

    Each row names its root, parent and depth; the named columns of the comment come along.
    """
    return nodes.select("root", "parent", "depth", "id").join(comments.select("id", *columns), "id")


def subtree_figures(
    nodes: DataFrame, sums: Sequence[str] = (), least: Sequence[str] = (), most: Sequence[str] = ()
) -> DataFrame:
    """``nodes`` with ``size``, the comments at and below each, and ``sum_``, ``min_`` and ``max_`` of the named columns over them.

    By pointer doubling: a comment that has counted its next 2^k levels is added to the ancestor
    2^k levels up, which then has counted twice as many. What is added is written once and summed up at
    the end; only comments that have an ancestor so far up take part in a round.
    """
    figures = {"size": F.sum} | {f"sum_{c}": F.sum for c in sums} | {f"min_{c}": F.min for c in least} | {f"max_{c}": F.max for c in most}
    own = [F.lit(1).cast("bigint").alias("size")]
    own += [F.col(c).cast("bigint").alias(f"{kind}_{c}") for kind, names in (("sum", sums), ("min", least), ("max", most)) for c in names]
    start = materialise(nodes.select("id", F.col("parent").alias("up"), *own), "figures")
    parts, counting = [start.drop("up")], start.where("up is not null")
    while counting.limit(1).count():
        added = materialise(counting.groupBy(F.col("up").alias("id")).agg(*[f(c).alias(c) for c, f in figures.items()]), "figures-added")
        parts.append(added)
        # those whose ancestor has none so far up have told all they count
        above = counting.select(F.col("id").alias("up"), F.col("up").alias("_up"))
        more = added.select("id", *[F.col(c).alias(f"_{c}") for c in figures])
        both = {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) if f is F.sum else (F.least if f is F.min else F.greatest)(c, f"_{c}") for c, f in figures.items()}
        further = counting.join(above, "up").join(more, "id", "left")
        counting = materialise(further.select("id", F.col("_up").alias("up"), *[x.alias(c) for c, x in both.items()]), "figures")
    whole = reduce(DataFrame.unionByName, parts).groupBy("id").agg(*[f(c).alias(c) for c, f in figures.items()])
    return nodes.join(whole, "id")


def subtree_sizes(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``size``, the comments at and below each."""
    return subtree_figures(nodes)


def in_order(nodes: DataFrame) -> DataFrame:
    """``root, id, depth, position, size``: the place of each comment in its thread, each before its replies.

    ``nodes`` carries ``created_utc``; siblings go by time, then id. A comment stands behind its
    parent and the subtrees of its earlier siblings. Those distances are added up to the root by
    pointer doubling, so a row holds numbers only, however deep it lies, and the running totals
    over siblings are made of range-partitioned pieces, so a comment with very many replies is spread.
    Comments that have reached their root are written once and from then on only looked up.
    """
    sized = materialise(
        subtree_sizes(nodes.select("id", "parent", "root", "depth", "created_utc")).withColumn(
            "_under", F.coalesce("parent", F.concat(F.lit("\x01"), "root"))
        ),
        "sized",
    )
    behind = running_total(sized, ["_under"], ["created_utc", "id"], "size", [True, True], "_running")
    places = behind.select("id", F.col("parent").alias("up"), (F.col("_running") - F.col("size") + 1).alias("position"))

    def stored(rows: DataFrame) -> DataFrame:
        return materialise(rows.withColumn("climbing", F.col("up").isNotNull()), "places", ["climbing"])

    rounds = [stored(places)]
    while rounds[-1].where("climbing").limit(1).count():
        climbing = rounds[-1].where("climbing").drop("climbing")
        known = reduce(DataFrame.unionByName, [t.where("not climbing").drop("climbing") for t in rounds] + [climbing])
        above = known.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("position").alias("_more"))
        rounds.append(
            stored(climbing.join(above, "up").select("id", F.col("_up").alias("up"), (F.col("position") + F.col("_more")).alias("position")))
        )
    placed = reduce(DataFrame.unionByName, [t.where("not climbing").select("id", "position") for t in rounds])
    return sized.join(placed, "id").select("root", "id", "depth", "position", "size")


def subtree_rollup(nodes: DataFrame) -> DataFrame:
    """As ``rollup``, for the part of a thread that begins at each comment; needs ``score, body_length``."""
    found = subtree_figures(nodes.select("id", "parent", "root", "depth", "score", "body_length"), ["body_length"], ["score"], ["score", "depth"])
    return found.select(
        "id", "root", F.col("size").alias("comments"), (F.col("max_depth") - F.col("depth")).cast("int").alias("levels"),
        F.col("sum_body_length").alias("size"), F.col("min_score").cast("int").alias("min_score"), F.col("max_score").cast("int").alias("max_score"),
    )


def subtree_contains(placed: DataFrame, pairs: DataFrame) -> DataFrame:
    """For pairs ``(top, id)`` whether the comment lies at or below ``top``; unknown ids lie nowhere.

    ``placed`` is from ``in_order``: what lies below a comment are the positions that follow its own.
    """
    top = placed.select(F.col("id").alias("top"), F.col("root").alias("_root"), F.col("position").alias("_first"), F.col("size").alias("_size"))
    below = placed.select("id", F.col("root").alias("_own_root"), F.col("position").alias("_position"))
    inside = (F.col("_root") == F.col("_own_root")) & F.col("_position").between(F.col("_first"), F.col("_first") + F.col("_size") - 1)
    return pairs.select("top", "id").join(top, "top", "left").join(below, "id", "left").select(
        "top", "id", F.coalesce(inside, F.lit(False)).alias("contained")
    )


def nested_pieces(
    placed: DataFrame, nodes: DataFrame, comments: DataFrame, slim: bool = False, complete: Complete | None = None
) -> DataFrame:
    """``root, position, id, text``: threads as nested JSON, one piece per comment.

    Joined in order of ``position`` the pieces of a thread are one object: the comment, its parent's id and
    its children. A piece is the opening of a comment and, if it is the last of some subtrees, their endings, so no
    row holds a thread. The ``slim`` form has author, body and score, and leaves out missing parents and children.
    ``complete`` is that of ``thread_pieces``.
    """
    last = (F.col("position") + F.col("size") - 1).alias("position")
    # what ends at a place: the comment there, and those above it whose subtree it is the last of
    bare, listed = F.count_if(F.col("size") == 1), F.count_if(F.col("size") > 1)
    ends = placed.groupBy("root", last).agg(bare.alias("_bare"), listed.alias("_listed"))
    total = placed.where("depth = 0").select("root", F.col("size").alias("_total"))
    whole = complete(comments) if complete else comments
    columns = ["author", "body", "score"] if slim else [c for c in whole.columns if c != "dt_date"]
    shown = [
        (F.unix_micros(c) / F.lit(1000000)).cast("decimal(20,6)").alias(c) if kind == "timestamp" else F.col(c)
        for c, kind in whole.select(*columns).dtypes
    ]
    comment = F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}).alias("_comment")
    found = placed.join(nodes.select("id", "parent"), "id").join(ends, ["root", "position"], "left").join(total, "root")
    if complete:
        rows = complete(comments.join(found, "id")).select("*", comment)
    else:
        rows = found.join(comments.select("id", comment), "id")
    quoted = F.to_json(F.array("parent"))
    parent = F.substr(quoted, F.lit(2), F.char_length(quoted) - 2)
    if slim:
        above = F.when(F.col("parent").isNotNull(), F.concat(F.lit(', "parent": '), parent)).otherwise(F.lit(""))
        opening = F.concat(above, F.when(F.col("size") > 1, F.lit(', "children": [')).otherwise(F.lit("")))
        ending = F.concat(F.repeat(F.lit("}"), F.coalesce("_bare", F.lit(0)).cast("int")), F.repeat(F.lit("]}"), F.coalesce("_listed", F.lit(0)).cast("int")))
    else:
        opening = F.concat(F.lit(', "parent": '), parent, F.lit(', "children": ['))
        ending = F.repeat(F.lit("]}"), F.coalesce(F.col("_bare") + F.col("_listed"), F.lit(0)).cast("int"))
    comma = F.when((ending != "") & (F.col("position") < F.col("_total")), F.lit(", ")).otherwise(F.lit(""))
    return rows.select(
        "root", "position", "id", F.concat(F.lit('{"comment": '), "_comment", opening, ending, comma).alias("text")
    )


def reading_order(nodes: DataFrame) -> DataFrame:
    """Position of each comment in its thread, from 1, each comment before its replies."""
    return in_order(nodes).select("root", "position", "id", "depth")


def thread_tokens(nodes: DataFrame) -> DataFrame:
    """Estimated tokens of each thread's text; needs the columns of ``with_text_length``.

    The length follows from the depth and two numbers per comment, so no body is moved.
    """
    header = F.when(F.col("depth") == 0, _HEADER_LENGTH).otherwise(0)
    own = F.col("text_length") + F.col("depth") * F.col("indents") + header + len(END_MARKER)
    return nodes.groupBy("root").agg(F.sum(own).alias("_length")).select(
        "root", token_estimate(F.col("_length")).alias("tokens")
    )


def budgeted_prefix(
    threads: DataFrame, by: Sequence[str], limit: int = MAX_TOKENS, share: float = PREFIX_SHARE
) -> DataFrame:
    """The best threads of each group that fit together; the lowest ranked are dropped first.

    ``threads`` has ``root, average, tokens``.
    """
    summed = running_total(threads, by, ["average", "root"], "tokens", [False, True], "running_tokens")
    return summed.where(F.col("running_tokens") <= int(limit * share))


def sampled_threads(threads: DataFrame, seed: int, limit: int = MAX_TOKENS, share: float = SAMPLE_SHARE) -> DataFrame:
    """Every thread that fits on its own, with its ``position`` in a random order that ``seed`` fixes."""
    fitting = threads.where(F.col("tokens") <= int(limit * share))
    drawn = fitting.withColumns({"draw": F.md5(F.concat("root", F.lit(f"-{seed}"))), "_one": F.lit(1).cast("bigint")})
    return running_total(drawn, [], ["draw", "root"], "_one", [True, True], "position").drop("_one")


def thread_texts(nodes: DataFrame, texts: DataFrame, chosen: DataFrame, complete: Complete | None = None) -> DataFrame:
    """Whole text of the chosen threads, one row each; ``complete`` is that of ``thread_pieces``.

    Only for threads that passed a token budget, which bounds the text gathered in a row.
    """
    kept = nodes.join(chosen.select("root").distinct(), "root", "left_semi")
    parts = F.array_sort(F.collect_list(F.struct("piece", "text")))
    gathered = thread_pieces(in_order(kept), texts, complete).groupBy("root").agg(parts.alias("_parts"))
    return gathered.select("root", F.array_join(F.transform("_parts", lambda p: p["text"]), "").alias("text"))


def comments_of_submissions(nodes: DataFrame, comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """All comments below the given submissions, replies included."""
    tops = comments.where(F.col("parent_id").startswith("t3_")).select(
        F.col("id").alias("root"), F.substr("parent_id", F.lit(4)).alias("submission")
    )
    chosen = tops.join(submissions.select(F.col("id").alias("submission")), "submission", "left_semi")
    return nodes.select("id", "root").join(chosen, "root").select("submission", "root", "id")
