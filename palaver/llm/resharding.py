"""Resharding by minimum-cost flow.

Rows lie in old shards and are to lie in ``n_shards`` new ones whose row counts differ by one at
most, with as few bytes moved as possible; a row that stays in the shard of its old number costs
nothing, any other costs its size. Which rows leave a shard follows from how many do: the lightest. So the rows of an
old shard, lightest first, are cut where its quota can end: those that leave in any case, the one that stays if the
shard gets one of the extra places, and those that stay. The flow from these parts to the new shards is solved on
the driver over their counts and bytes: at most three parts an old shard, each with an arc to its own shard and one to a hub
that leads to all shards, whatever the number of rows. The one row that is open is a part of its own, so what the flow pays for it
is its size, and the bytes moved are the fewest there can be. Ranks inside old shards come from range-partitioned
pieces, so no shard or size is held in one task. ``rewrite`` carries the plan out: places are found without the texts, which are
then moved to their places by row, and only the shards whose content changes are written.

A null text has size 1, like an empty one. Rows with null or repeated ids are rows like any other
and get a place each. An empty table gives an empty result. Columns of other names are ignored
unless they are carried.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import numbered, table
from palaver.operators.ranking import running_total
from palaver.session import fresh_path, materialise

#: More old shards than this are refused: the flow is solved on the driver.
MAX_OLD_SHARDS = 4096


@dataclass
class Arc:
    to: int
    room: int
    cost: int
    back: int


class Network:
    """Minimum-cost flow by shortest augmenting paths with node potentials."""

    def __init__(self, nodes: int):
        self.arcs: list[list[Arc]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, room: int, cost: int = 0) -> Arc:
        arc = Arc(b, room, cost, len(self.arcs[b]))
        self.arcs[b].append(Arc(a, 0, -cost, len(self.arcs[a])))
        self.arcs[a].append(arc)
        return arc

    def solve(self, source: int, sink: int) -> tuple[int, int]:
        """Send as much as possible as cheaply as possible; amount and cost."""
        n, amount, paid = len(self.arcs), 0, 0
        potential = [0] * n
        while True:
            far = [None] * n
            came: list[tuple[int, Arc] | None] = [None] * n
            far[source], queue = 0, [(0, source)]
            while queue:
                d, u = heapq.heappop(queue)
                if d > far[u]:
                    continue
                for arc in self.arcs[u]:
                    if arc.room:
                        to = d + arc.cost + potential[u] - potential[arc.to]
                        if far[arc.to] is None or to < far[arc.to]:
                            far[arc.to], came[arc.to] = to, (u, arc)
                            heapq.heappush(queue, (to, arc.to))
            if far[sink] is None:
                return amount, paid
            reach = max(d for d in far if d is not None)
            potential = [p + (reach if d is None else d) for p, d in zip(potential, far, strict=True)]
            path, v = [], sink
            while v != source:
                u, arc = came[v]
                path.append(arc)
                v = u
            sent = min(arc.room for arc in path)
            for arc in path:
                arc.room -= sent
                self.arcs[arc.to][arc.back].room += sent
                paid += sent * arc.cost
            amount += sent


@dataclass(frozen=True)
class Move:
    """Rows ``first`` to ``last`` (from 1, lightest first) of an old shard go to ``shard``, at slots from ``slot``."""

    old_shard: int
    shard: int
    first: int
    last: int
    slot: int


def bounds(counts: dict[int, int], n_shards: int) -> list[tuple[int, int, int]]:
    """``(old_shard, leave, stay)``: ranks up to ``leave`` leave in any case, those after ``stay`` need not.

    Between the two is the row that a place more would keep, or none.
    """
    each = sum(counts.values()) // n_shards
    room = lambda old: each if old < n_shards else -1
    return [(old, max(0, n - room(old) - 1), max(0, n - max(0, room(old)))) for old, n in sorted(counts.items())]


def plan_moves(parts: Sequence[tuple[int, int, int, int]], n_shards: int) -> list[Move]:
    """The cheapest moves for parts ``(old_shard, part, rows, bytes)`` of the old shards, cut at ``bounds``.

    Every shard gets ``rows // n_shards`` rows and some one more; which ones is part of the solution.
    """
    parts = sorted(parts)
    rows = sum(p[2] for p in parts)
    each, extra = divmod(rows, n_shards)
    hub = 1 + len(parts)
    shard_at, more = hub + 1, hub + 1 + n_shards
    net = Network(more + 2)
    sink = more + 1
    out: dict[int, list[Arc]] = {}
    count_of: dict[int, int] = {}
    for i, (old, _, count, size) in enumerate(parts):
        net.add(0, 1 + i, count)
        count_of[old] = count_of.get(old, 0) + count
        if old < n_shards:
            net.add(1 + i, shard_at + old, count)
        out.setdefault(old, []).append(net.add(1 + i, hub, count, -(-size // count)))
    into = [net.add(hub, shard_at + j, rows) for j in range(n_shards)]
    for j in range(n_shards):
        net.add(shard_at + j, sink, each)
        net.add(shard_at + j, more, 1)
    net.add(more, sink, extra)
    amount, _ = net.solve(0, sink)
    assert amount == rows
    open_places = [[j, rows - arc.room] for j, arc in enumerate(into) if arc.room < rows]
    moves, filled, at_place = [], [0] * n_shards, 0

    def move(old: int, shard: int, first: int, count: int) -> None:
        moves.append(Move(old, shard, first, first + count - 1, filled[shard]))
        filled[shard] += count

    left = {old: sum(net.arcs[arc.to][arc.back].room for arc in arcs) for old, arcs in out.items()}
    for old, leaving in sorted(left.items()):
        if count_of[old] > leaving:
            move(old, old, leaving + 1, count_of[old] - leaving)
        first = 1
        while first <= leaving:  # the lightest rows fill the places that the hub leads to
            place = open_places[at_place]
            taken = min(place[1], leaving - first + 1)
            move(old, place[0], first, taken)
            first, place[1] = first + taken, place[1] - taken
            at_place += not place[1]
    return moves


def size_of(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def crc_of(text: str) -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")))


def reshard(
    docs: DataFrame, old_shard: Column, n_shards: int, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()
) -> tuple[DataFrame, list[Move]]:
    """Every row with ``size, old_shard, shard, slot`` (and the columns in ``carry``), and the plan behind them."""
    spark = docs.sparkSession
    rows = materialise(
        docs.select(
            F.col(key).alias("key"),
            size_of(text).alias("size"),
            crc_of(text).alias("crc"),
            old_shard.cast("int").alias("old_shard"),
            F.monotonically_increasing_id().alias("row"),
            F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(1).alias("carried"),
        ),
        "reshard",
    )
    counts = rows.groupBy("old_shard").agg(F.count("*").alias("n"))
    if counts.count() > MAX_OLD_SHARDS:
        raise ValueError(f"more than {MAX_OLD_SHARDS} old shards")
    ranked = running_total(
        rows.withColumn("one", F.lit(1).cast("long")), ["old_shard"], ["size", "key", "row"], "one", [True, True, True], "rank"
    )
    # one row an old shard
    cuts = spark.createDataFrame(bounds(dict(map(tuple, counts.collect())), n_shards), "old_shard int, leave long, stay long")
    part = F.when(F.col("rank") <= F.col("leave"), 0).when(F.col("rank") <= F.col("stay"), 1).otherwise(2)
    parts = ranked.join(F.broadcast(cuts), "old_shard").groupBy("old_shard", part.alias("part")).agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes")
    )
    moves = plan_moves([tuple(r) for r in parts.collect()], n_shards)
    plan = spark.createDataFrame(
        [(m.old_shard, m.shard, m.first, m.last, m.slot) for m in moves],
        "old_shard int, shard int, first long, last long, at long",
    )
    # the plan has at most (2 * old shards + new shards) rows, both bounded
    placed = ranked.join(F.broadcast(plan), "old_shard").where(F.col("rank").between(F.col("first"), F.col("last")))
    return (
        placed.select(
            F.col("key").alias(key),
            "size",
            F.col("crc").alias("text_crc32"),
            "old_shard",
            "shard",
            (F.col("at") + F.col("rank") - F.col("first")).alias("slot"),
            *([F.col("carried")] if carry else []),
        ),
        moves,
    )


def affected(moves: Sequence[Move]) -> set[int]:
    """New shards whose content differs from the old shard of that number."""
    return {s for m in moves if m.shard != m.old_shard for s in (m.shard, m.old_shard)}


def _rewritten(
    docs: DataFrame, old_shard: Column, n_shards: int, path: str, key: str, text: str
) -> tuple[DataFrame, list[int]]:
    """Write the shards whose content changes below ``path``; the places of all rows, and the numbers written."""
    rows, name = numbered(docs, "reshard-docs")
    if rows.groupBy(name).count().where("count > 1").limit(1).count():  # made of rows that are read, several of each
        rows, name = numbered(materialise(docs, "reshard-docs"), "reshard-docs")
    placed, moves = reshard(rows, old_shard, n_shards, key, text, [name])
    placed = materialise(placed, "reshard-places")
    changed = sorted(s for s in affected(moves) if s < n_shards)
    to = placed.where(F.col("shard").isin(changed)).select(F.col(f"carried.{name}").alias("_row"), "shard", "slot")
    whole = rows.select(F.col(name).alias("_row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried"))
    # texts are moved once: every task writes what it has of each shard; dealing them by shard first would take their size on disk again
    (
        whole.join(to, "_row")
        .select("shard", "slot", "carried")
        .write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", compression="zstd")
        .partitionBy("shard")
        .parquet(path)
    )
    return placed, changed


def rewrite(docs: DataFrame, old_shard: Column, n_shards: int, path: str, key: str = "doc_id", text: str = "text") -> list[int]:
    """Write the shards whose content changes below ``path``, as ``shard=N``; the others' files stay as they are.

    Returns the numbers written. Old shards beyond the new ones are emptied, so they are not written.
    """
    return _rewritten(docs, old_shard, n_shards, path, key, text)[1]


def op10_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 12 shards by source, one of which holds a third of the rows, to 16 of equal row counts.

    The shards that change are written, and their rows are given as they lie there; those of the others as they are placed.
    """
    docs = table(spark, sf_dir, "documents")
    old = lambda source: F.pmod(F.crc32(F.coalesce(F.col(source), F.lit(""))), F.lit(12)).cast("int")
    path = fresh_path(spark, "resharded")
    placed, changed = _rewritten(docs, old("source"), 16, path, "doc_id", "text")
    kind = T.StructType([T.StructField("slot", T.LongType()), T.StructField("carried", docs.schema), T.StructField("shard", T.IntegerType())])
    written = spark.read.schema(kind).parquet(path).select(
        F.col("carried.doc_id").alias("doc_id"),
        size_of("carried.text").alias("size"),
        crc_of("carried.text").alias("text_crc32"),
        old("carried.source").alias("old_shard"),
        "shard",
        "slot",
    )
    stay = placed.where(~F.col("shard").isin(changed)).select(written.columns)
    return written.unionByName(stay).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )
