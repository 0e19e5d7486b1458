"""A trie of conversation prefixes as balanced parentheses.

Conversations become sequences of turn digests; equal sequences are counted together first. The sequences are
range-partitioned and sorted, so that those with a common prefix are neighbours. A shard, a run of
neighbours of bounded size, writes its part of the trie as parentheses, one pair a node in the order of a
walk. Blocks keep their smallest excess (open less closed parentheses), with a tree of minima above, which finds the
parenthesis that closes a node and so delimits its subtree. The rank of leaf pairs ``()`` up to both
ends gives the leaves in between, and cumulative sums in walking order give members and savings.

Only the paths of a shard's first and last sequence, its spines, can go on in its neighbours. All
other nodes are finished in their shard. A spine carries for each node what hangs below it in finished
subtrees, and spines are sequences again: they are sorted, sharded and merged by the same code,
with at most two for each shard before, until one shard is left. No shard, task or driver ever holds the
trie.

The ids of the conversations that end at a node are hashed as one text. Their list is cut into pieces, made in
parallel; the digest of a node's pieces is one sequential stream of bytes, which holds a piece at a time.

A digest has 16 bytes of SHA-256 and stands for its turn. A conversation is one row of digests
(24 bytes a turn, whatever the texts), so one of ten million turns takes 240 MB of a task.

Null roles and texts are empty. Turns of equal number (null is the smallest) go by role, the beginning of the
text, and digest; repeated rows stay repeated turns. Rows without a conversation id belong to no conversation and are left
out. Very long texts are read once, for their digest. An empty table gives no nodes, not even a root.
Further columns play no part.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import table
from palaver.session import materialise

#: Parentheses in a block.
BLOCK = 64
#: Nodes after which a shard ends, at about 150 bytes each, if it has ``SHARD_SEQUENCES`` sequences.
SHARD_NODES = 1 << 18
SHARD_SEQUENCES = 8
#: Ids in a piece of a list to be hashed.
PIECE_IDS = 8192
DIGEST = 16
NOBODY = np.iinfo(np.int64).max

_PATH = "array<struct<digest binary, size long>>"
_CARRIED = "array<struct<members long, first long, children long, leaves long, saved long, ending binary>>"
_NODE = (
    "kind string, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    f"depth int, parent_path binary, node_path binary, ending binary, path {_PATH}, carried {_CARRIED}"
)


class Parentheses:
    """Balanced parentheses (1 opens, 0 closes) with a range min-max tree over blocks of excess."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        size = -(-len(bits) // BLOCK) * BLOCK
        self.padded = np.full(size, NOBODY)
        self.padded[: len(bits)] = self.excess
        self.minima = [self.padded.reshape(-1, BLOCK).min(axis=1)]
        while len(self.minima[-1]) > 1:
            if len(self.minima[-1]) % 2:
                self.minima[-1] = np.append(self.minima[-1], NOBODY)
            self.minima.append(self.minima[-1].reshape(-1, 2).min(axis=1))

    def _scan(self, start: np.ndarray, target: np.ndarray, found: np.ndarray, rows: np.ndarray) -> None:
        """For ``rows``, the first position from ``start`` on, in the same block, with at most ``target`` excess."""
        at, block = start[rows], start[rows] // BLOCK
        while len(rows):
            inside = at < np.minimum((block + 1) * BLOCK, len(self.padded))
            rows, at, block = rows[inside], at[inside], block[inside]
            hit = self.padded[at] <= target[rows]
            found[rows[hit]] = at[hit]
            rows, at, block = rows[~hit], at[~hit] + 1, block[~hit]

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The position of the parenthesis that closes each of ``opens``."""
        target = self.excess[opens] - 1
        found = np.full(len(opens), -1)
        after = opens + 1
        same = np.flatnonzero(after // BLOCK == opens // BLOCK)
        self._scan(after, target, found, same)
        rows = np.flatnonzero(found < 0)
        node, block = opens // BLOCK, np.full(len(opens), -1)
        for level, minima in enumerate(self.minima):
            if not len(rows):
                break
            beside = np.minimum(node[rows] + 1, len(minima) - 1)
            turn = (node[rows] % 2 == 0) & (beside > node[rows]) & (minima[beside] <= target[rows])
            down, at = rows[turn], beside[turn]
            for lower in reversed(self.minima[:level]):
                at = 2 * at
                at += lower[at] > target[down]
            block[down] = at
            rows = rows[~turn]
            node[rows] //= 2
        far = np.flatnonzero(block >= 0)
        self._scan(block * BLOCK, target, found, far)
        return found


def _longs(n: int = 0) -> array:
    return array("q", bytes(8 * n))


@dataclass
class _Shard:
    """Nodes in walking order, and the path to the last one."""

    depth: array = field(default_factory=_longs)
    parent: array = field(default_factory=_longs)
    size: array = field(default_factory=_longs)
    members: array = field(default_factory=_longs)
    first: array = field(default_factory=_longs)
    children: array = field(default_factory=_longs)
    leaves: array = field(default_factory=_longs)
    saved: array = field(default_factory=_longs)
    bits: bytearray = field(default_factory=bytearray)
    digest: list[bytes] = field(default_factory=list)
    endings: dict[int, bytes] = field(default_factory=dict)
    stack: list[int] = field(default_factory=list)
    path: list[bytes] = field(default_factory=list)
    first_path: list[bytes] = field(default_factory=list)
    sequences: int = 0

    def _open(self, digest: bytes, size: int) -> None:
        self.digest.append(digest)
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.depth.append(len(self.stack))
        self.stack.append(len(self.size))
        self.size.append(size)
        for column in (self.members, self.children, self.leaves, self.saved):
            column.append(0)
        self.first.append(NOBODY)
        self.bits.append(1)

    def _close(self) -> None:
        node = self.stack.pop()
        if self.stack and self.first[node] < self.first[self.stack[-1]]:
            self.first[self.stack[-1]] = self.first[node]
        self.bits.append(0)

    def add(self, path: list[bytes], sizes: list[int], ends: int, first: int | None, ending: bytes | None, carried: list[dict] | None) -> None:
        """The next sequence in order."""
        if not self.stack:
            self._open(b"", 0)
        shared = 0
        for a, b in zip(path, self.path):
            if a != b:
                break
            shared += 1
        while len(self.stack) > shared + 1:
            self._close()
        for digest, size in zip(path[shared:], sizes[shared:]):
            self._open(digest, size)
        node = self.stack[-1]
        if ends:
            self.members[node] += ends
            self.first[node] = min(self.first[node], first)
            self.endings[node] = ending
        for node, more in zip(self.stack, carried or ()):
            self.members[node] += more["members"]
            self.first[node] = min(self.first[node], more["first"])
            self.children[node] += more["children"]
            self.leaves[node] += more["leaves"]
            self.saved[node] += more["saved"]
            if more["ending"] is not None:
                self.endings[node] = more["ending"]
        if not self.sequences:
            self.first_path = path
        self.path = path
        self.sequences += 1

    def finish(self, last: bool, named: bool) -> Iterator[pa.RecordBatch]:
        """The finished nodes, all of them if this is the ``last`` shard, and the spines.

        Nodes that were on a spine before are ``named`` by the digest of their path.
        """
        final = list(self.stack)
        while self.stack:
            self._close()
        n = len(self.size)
        bits = np.frombuffer(bytes(self.bits), np.uint8)
        column = {c: np.frombuffer(getattr(self, c), np.int64) for c in ("depth", "parent", "size", "members", "first", "children", "leaves", "saved")}
        parens = Parentheses(bits)
        opens = np.flatnonzero(bits)
        closes = parens.find_close(opens)
        begin, end = np.arange(n), np.arange(n) + (closes - opens + 1) // 2

        def below(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[end] - total[begin]

        parent = column["parent"]
        children = np.bincount(parent[1:], minlength=n) + column["children"]
        members = below(column["members"])
        # a pair () without finished children elsewhere is a leaf; its rank is counted up to both ends
        pairs = np.zeros(len(bits), np.int64)
        pairs[opens] = (np.append(bits[1:], 0)[opens] == 0) & (column["children"] == 0)
        rank = np.cumsum(pairs)
        leaves = rank[closes] - rank[opens] + pairs[opens] + below(column["leaves"])
        saved = below((members - 1) * column["size"] + column["saved"])

        # the nodes along the first sequence are the first ones made
        spine = np.zeros(n, bool)
        if not last:
            spine[: len(self.first_path) + 1] = True
            spine[final] = True
        names: dict[int, bytes] = {}
        if named or not last:
            for node in range(n) if named else np.flatnonzero(spine).tolist():
                names[node] = hashlib.sha256(names[parent[node]] + self.digest[node]).digest()[:DIGEST] if node else b""

        done = np.flatnonzero(~spine)
        above = parent[done]
        hangs = (above >= 0) & spine[np.maximum(above, 0)]
        listed = done.tolist()
        if listed:
            yield _batch(
                len(listed),
                conv_id=column["first"][done],
                depth=column["depth"][done].astype(np.int32),
                parent_conv_id=pa.array(column["first"][np.maximum(above, 0)], mask=hangs | (above < 0)),
                parent_path=pa.array([names[a] if h else None for a, h in zip(above.tolist(), hangs.tolist())], pa.binary()),
                node_path=pa.array([names[i] if named else None for i in listed], pa.binary()),
                n_convs=members[done],
                n_children=children[done],
                n_leaves=leaves[done],
                saved_tokens=saved[done],
                ending=pa.array([self.endings.get(i) for i in listed], pa.binary()),
            )
        if last:
            return
        # what hangs below a spine node in finished subtrees, and its own members
        hanging, where = done[hangs], above[hangs]
        sums = {"members": (column["members"], members), "leaves": (column["leaves"], leaves), "saved": (column["saved"], saved),
                "children": (column["children"], np.ones(n, np.int64))}
        carried = {}
        for name, (own, whole) in sums.items():
            carried[name] = own.copy()
            np.add.at(carried[name], where, whole[hanging])
        nothing = {"members": 0, "first": NOBODY, "children": 0, "leaves": 0, "saved": 0, "ending": None}
        told: set[int] = set()
        paths, extras = [], []
        for path, nodes in ((self.first_path, range(len(self.first_path) + 1)), (self.path, final)):
            paths.append([{"digest": d, "size": int(column["size"][i])} for d, i in zip(path, list(nodes)[1:])])
            extras.append([
                nothing if i in told else {
                    "first": int(column["first"][i]), "ending": self.endings.get(i), **{name: int(values[i]) for name, values in carried.items()},
                }
                for i in nodes
            ])
            told.update(nodes)
        yield _batch(2, path=pa.array(paths, _TYPES["path"]), carried=pa.array(extras, _TYPES["carried"]))


_TYPES = {
    **{c: pa.int64() for c in ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")},
    "depth": pa.int32(),
    **{c: pa.binary() for c in ("parent_path", "node_path", "ending")},
    "path": pa.list_(pa.struct([("digest", pa.binary()), ("size", pa.int64())])),
    "carried": pa.list_(
        pa.struct([*[(c, pa.int64()) for c in ("members", "first", "children", "leaves", "saved")], ("ending", pa.binary())])
    ),
}


def _batch(n: int, **columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    """Rows with the given columns, null in all others; rows with a path are spines."""
    kind = pa.array(["spine" if "path" in columns else "node"] * n)
    filled = [pa.array(columns[c]) if c in columns else pa.nulls(n, t) for c, t in _TYPES.items()]
    return pa.RecordBatch.from_arrays([kind, *[x if x.type == t else x.cast(t) for x, t in zip(filled, _TYPES.values())]], ["kind", *_TYPES])


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple]:
    path = batch.column("path")
    inner = path.flatten()
    digests, sizes = inner.field("digest").to_pylist(), inner.field("size").to_pylist()
    rest = [batch.column(c).to_pylist() for c in ("ends", "first", "ending", "carried")]
    at = 0
    for i, size in enumerate(path.value_lengths().to_pylist()):
        yield (digests[at : at + size], sizes[at : at + size], *[column[i] for column in rest])
        at += size


def _level(sequences: DataFrame, shards: int | None, last: bool, named: bool, shard_nodes: int) -> DataFrame:
    """Finished nodes and spines of all shards, stored by kind. ``shards`` is the number of ranges, at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for sequence in _sequences(batch):
                shard.add(*sequence)
                if not last and len(shard.size) >= shard_nodes and shard.sequences >= SHARD_SEQUENCES:
                    yield from shard.finish(last, named)
                    shard = _Shard()
        if shard.sequences:
            yield from shard.finish(last, named)

    key = F.col("path.digest")
    ranged = sequences.repartitionByRange(*([shards] if shards else []), key)
    ranged = sequences.coalesce(1) if last else ranged
    found = ranged.sortWithinPartitions(key).mapInArrow(run, _NODE)
    return materialise(found, "trie", ["kind"])


def trie(sequences: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """All nodes: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ending``.

    ``sequences`` has distinct ``path``s with the number of conversations that ``ends`` there, the
    ``first`` of them, and an ``ending`` to name them by.
    """
    stored: list[DataFrame] = []
    level = sequences.withColumn("carried", F.lit(None).cast(_CARRIED))
    shards: int | None = None
    last = named = False
    while True:
        found = _level(level, shards, last, named, shard_nodes)
        stored.append(found.where("kind = 'node'"))
        if last:
            break
        spines = found.where("kind = 'spine'").select(
            "path", F.lit(0).cast("long").alias("ends"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("binary").alias("ending"), "carried"
        )
        size = spines.agg(F.count("*").alias("rows"), F.sum(F.size("path") + 1).alias("nodes")).first()
        if not size["rows"]:
            break
        level, named = spines, True
        # ranges and shards have enough sequences that each level has far fewer than the one before
        few = 2 * SHARD_SEQUENCES
        last = size["nodes"] <= shard_nodes or size["rows"] <= few
        shards = max(1, min(-(-size["nodes"] // shard_nodes), size["rows"] // few))
    nodes = stored[0]
    for more in stored[1:]:
        nodes = nodes.unionByName(more)
    nodes = nodes.drop("kind", "path", "carried")
    # parents on a spine were not finished when their children were; the others have keys of their own, so none is hot
    merged = nodes.where("node_path is not null").select(F.col("node_path").alias("_path"), F.col("conv_id").alias("_parent"))
    at = F.coalesce("parent_path", F.encode(F.concat_ws("/", "conv_id", "depth"), "utf-8"))
    joined = nodes.withColumn("_at", at).join(merged, F.col("_at") == F.col("_path"), "left")
    return joined.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent")).drop(
        "_at", "_path", "_parent", "parent_path", "node_path"
    )


def list_digests(members: DataFrame, name: str = "ending", ident: str = "conv_id") -> DataFrame:
    """``name, digest``: SHA-256, in hex, of the ids with each name in ascending order, joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[bytes, int, str]] = []
        ids: list[str] = []
        of = None

        def cut() -> None:
            nonlocal number, ids
            held.append((of, number, ",".join(ids)))
            number, ids = number + 1, []

        def told() -> pa.RecordBatch:
            names, numbers, texts = zip(*held)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array([part] * len(names), pa.int32()), pa.array(numbers, pa.int64()), pa.array(texts)],
                ["name", "part", "number", "ids"],
            )

        for batch in batches:
            for key, ident in zip(batch.column("name").to_pylist(), batch.column("id").to_pylist()):
                if ids and (key != of or len(ids) == PIECE_IDS):
                    cut()
                    if len(held) == 1024:
                        yield told()
                of = key
                ids.append(str(ident))
        if ids:
            cut()
        if held:
            yield told()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, state = None, None
        for batch in batches:
            names, found = [], []
            for key, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if state is not None and key == of:
                    state.update(b",")
                else:
                    if state is not None:
                        names.append(of)
                        found.append(state.hexdigest())
                    of, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], [name, "digest"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([of], pa.binary()), pa.array([state.hexdigest()])], [name, "digest"])

    slim = members.select(F.col(name).alias("name"), F.col(ident).alias("id"))
    ranged = slim.repartitionByRange("name", "id").sortWithinPartitions("name", "id")
    cut = materialise(ranged.mapInArrow(pieces, "name binary, part int, number long, ids string"), "list-pieces")
    # a name's pieces are one stream, as its hash is; a piece has thousands of ids
    whole = cut.repartition("name").sortWithinPartitions("name", "part", "number").drop("part", "number")
    return whole.mapInArrow(digests, f"{name} binary, digest string")


# -- conversations ----------------------------------------------------------------------------


def _digest(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, DIGEST)


def turn_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, path``: the turns of each conversation in order, as digests of role and text with the bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role keeps role and text apart
    digest = _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(
        F.col("turn").isNotNull().alias("placed"), "turn", role.alias("role"), F.left(text, F.lit(40)).alias("start"),
        digest.alias("digest"), F.octet_length(text).cast("long").alias("size"),
    )
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    listed = F.array_sort(F.collect_list("turn"))
    return turns.groupBy("conv_id").agg(listed.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("path")
    )


def rebuilt(paths: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation after the first turns of its family's first one, as many as its id's checksum says."""
    stored = materialise(paths, "turn-paths")
    none = F.array().cast(_PATH)
    head = stored.select(F.col("conv_id").alias("_base"), F.slice("path", 1, heads - 1).alias("_head"))
    n = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    own = F.slice("path", n + 1, F.greatest(F.size("path") - n, F.lit(0)))
    joined = stored.join(head, F.col("conv_id") - F.col("conv_id") % family == F.col("_base"), "left")
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("_head", none), F.lit(1), n), own).alias("path"))


def prefix_trie(paths: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The nodes of ``trie`` for ``conv_id, path`` rows, with the digest of the list of conversations that end there."""
    whole = F.sha2(F.array_join(F.transform("path", lambda p: F.hex(p["digest"])), ""), 256)
    members = materialise(paths.select("conv_id", "path", F.substring(F.unhex(whole), 1, DIGEST).alias("ending")), "sequences")
    # counted without the paths; one member then lends its own
    groups = members.groupBy(F.col("ending").alias("_ending")).agg(F.count("*").alias("ends"), F.min("conv_id").alias("first"))
    distinct = members.join(groups, F.col("conv_id") == F.col("first")).select("path", "ends", "first", "ending")
    nodes = trie(distinct, shard_nodes)
    digests = list_digests(members).withColumnRenamed("ending", "_ending")
    at = F.coalesce("ending", F.encode(F.concat_ws("/", "conv_id", "depth"), "utf-8"))
    joined = nodes.withColumn("_at", at).join(digests, F.col("_at") == F.col("_ending"), "left")
    return joined.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of rebuilt conversations."""
    return prefix_trie(rebuilt(turn_paths(table(spark, sf_dir, "conversations"))))


#: Every prefix as a list of turns; subtrees by naming all prefixes of each node.
OP13_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS turns, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
    4294967295) % 9 AS h
  FROM turns GROUP BY conv_id
),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
),
prefixes AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT min(conv_id) AS conv_id, depth, turns[1:depth] AS path, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = len(turns)), '') AS ends
  FROM prefixes GROUP BY depth, turns[1:depth]
),
children AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
figured AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children, CASE WHEN nodes.depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(nodes.path[nodes.depth].text) END AS saved
  FROM nodes LEFT JOIN children ON children.depth = nodes.depth AND children.path = nodes.path
),
named AS (SELECT figured.*, unnest(range(0, depth + 1)) AS up FROM figured),
below AS (
  SELECT up AS depth, path[1:up] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM named GROUP BY up, path[1:up]
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM figured f JOIN below b ON b.depth = f.depth AND b.path = f.path
LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.path = f.path[1:f.depth - 1]"""
