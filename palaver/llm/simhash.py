"""Near duplicates by SimHash, with Golay codes as fuzzy hashes.

A fingerprint has a bit for each bit that more than half of the hashes of a text's shingles have.
Two fingerprints are linked where they differ in at most four bits; a document's class is the
smallest id that links lead to.

All fingerprints within four bits are found by keys that they must share. A fingerprint has three
segments (22, 21 and 21 bits), each a word of the perfect binary Golay code (23, 12) whose missing
bits are zero: every word is within three bits of one codeword, whose index is its key. Two words
that differ in one bit need not share that key, but the key of one is always among the keys of the
other and its one-bit neighbours, of which there are about five. Four errors over three segments
leave either a segment without error, or two segments with one error each. So two linked
fingerprints share either a whole segment, or, for two of the segments, the key of one and a
neighbour key of the other. Both meet in a join, and their bits are compared.

Equal fingerprints are one node from the start, so exact copies cost one row each. Inside a bucket
of many near copies, every member is first compared with one member of its bucket only; pairs are
formed afterwards, and only in buckets that still hold more than one class.

Keys are many times the fingerprints they are made of, which Spark's estimate of their size does not see. So joins of keys, and
of tables with a row per fingerprint, are told to shuffle both sides; nothing that grows with the rows is broadcast.

Texts that are null, empty or without words have the fingerprint zero, which is linked like any
other. Ids are never joined: rows with a null id get the class of their fingerprint like others
(null only where no member has an id), and repeated rows get a row each. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import column_bytes, give_back, slices, table
from palaver.session import materialise

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: First bit and number of bits of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fixed value: the generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY = 0b110001110101


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64 majority bits over the hashes of all shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - width])).tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key`` and ``fp``, the fingerprint as a signed long, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(x, shingle) for x in column_bytes(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found.view(np.int64))], ["key", "fp"])

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    return slim.mapInArrow(run, f"key {kind}, fp long").withColumnRenamed("key", key)


@lru_cache(1)
def golay_errors() -> np.ndarray:
    """The error pattern of at most three bits for each of the 2048 syndromes."""
    errors = np.zeros(2048, np.int64)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            errors[_syndrome(np.array([word]))[0]] = word
    return errors


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    return rest


@lru_cache(1)
def _unit_syndromes() -> np.ndarray:
    return _syndrome(1 << np.arange(23, dtype=np.int64))


def codeword_index(words: np.ndarray, syndromes: np.ndarray | None = None) -> np.ndarray:
    """The number of the codeword next to each word: its upper twelve bits."""
    found = _syndrome(words) if syndromes is None else syndromes
    return (words ^ golay_errors()[found]) >> 11


def near_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """Codeword numbers of each word and its one-bit neighbours, sorted, one row per word; repeats are -1."""
    syndromes = _syndrome(words)
    flips = np.concatenate(([0], 1 << np.arange(bits, dtype=np.int64)))
    moved = np.concatenate(([0], _unit_syndromes()[:bits]))
    found = np.sort(codeword_index(words[:, None] ^ flips, syndromes[:, None] ^ moved), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def bucket_keys(fps: np.ndarray, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(position, key)``: what fingerprints are stored under, or with ``probe`` looked up by.

    A key holds its kind in the upper bits: a whole segment, or a pair of codeword numbers.
    """
    bits = fps.view(np.uint64)
    parts = [((bits >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    at, keys = [], []
    everyone = np.arange(len(fps))
    for kind, part in enumerate(parts):
        at.append(everyone)
        keys.append(kind << 24 | part)
    near = [near_indices(p, n) if probe else codeword_index(p)[:, None] for p, (_, n) in zip(parts, SEGMENTS, strict=True)]
    for kind, (a, b) in enumerate(combinations(range(3), 2), start=3):
        both = np.where((near[a][:, :, None] >= 0) & (near[b][:, None, :] >= 0), near[a][:, :, None] << 12 | near[b][:, None, :], -1)
        row, i, j = np.nonzero(both >= 0)
        at.append(row)
        keys.append(kind << 24 | both[row, i, j])
    return np.concatenate(at), np.concatenate(keys)


def buckets(nodes: DataFrame, probe: bool) -> DataFrame:
    """Rows ``key, fp, class`` for nodes ``fp, class``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1 << 12):
                batch = whole.slice(i, 1 << 12)
                at, keys = bucket_keys(batch.column("fp").to_numpy(zero_copy_only=False).copy(), probe)
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), batch.column("fp").take(rows), batch.column("class").take(rows)], ["key", "fp", "class"]
                )
        give_back()

    return nodes.select("fp", "class").mapInArrow(run, "key long, fp long, class long")


def linked(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def classes(links: DataFrame, label: str = "links") -> DataFrame:
    """``node, class`` for the nodes of ``links`` (``a, b``): the smallest node that links lead to.

    Every round hangs larger neighbours on the smallest one (first among all neighbours, then among
    the smaller ones), until nothing changes: about log2(n) rounds. Minima are aggregated before
    any shuffle, and each is joined back as one row per node, so a hub is never held in one task.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        edges = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
        hung = edges.join(lowest, "a")
        edges = materialise(
            hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            label,
        )
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("class")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("class")).distinct()
            )
        before = now


def relabel(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Nodes ``fp, class`` with each class replaced by the class it belongs to in ``found``."""
    renamed = found.select(F.col("node").alias("class"), F.col("class").alias("into"))
    return nodes.join(renamed, "class", "left").select("fp", F.coalesce("into", "class").alias("class"))


def fingerprint_classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, class`` for distinct fingerprints ``fp``: classes of those linked through one another."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the segments cover at most four differing bits")
    nodes = fps.select("fp", F.col("fp").alias("class"))
    # near every bucket's first and last member: one comparison a row, however large the bucket
    stored = buckets(nodes, False).where(F.col("key") < 3 << 24)
    ends = stored.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    stars = stored.join(ends.where("low <> high").hint("merge"), "key").select(
        "fp", F.explode(F.array("low", "high")).alias("end")
    )
    first = classes(stars.where(linked("fp", "end", max_bits)).select(F.col("fp").alias("a"), F.col("end").alias("b")))
    nodes = materialise(relabel(nodes, first), "simhash-nodes")
    # Pairs of different classes only: a probe meets each other class of its bucket, and then its
    # members. Bits in which all members agree are the least that any of them can differ in, so a
    # class whose members all lie too far away is passed over.
    stored, probes = buckets(nodes, False), buckets(nodes, True)
    members = stored.select("key", F.col("fp").alias("other_fp"), F.col("class").alias("other"))
    in_bucket = members.groupBy("key", "other").agg(F.bit_and("other_fp").alias("all"), F.bit_or("other_fp").alias("any"))
    fp = F.col("fp")
    least = F.bit_count((F.col("all").bitwiseAND(F.bitwise_not(fp))).bitwiseOR(fp.bitwiseAND(F.bitwise_not("any"))))
    meets = probes.join(in_bucket.hint("merge"), "key").where((F.col("class") != F.col("other")) & (least <= max_bits))
    found = meets.select("key", "fp", "class", "other").join(members.hint("merge"), ["key", "other"])
    pairs = found.where(linked("fp", "other_fp", max_bits))
    second = classes(pairs.select(F.col("class").alias("a"), F.col("other").alias("b")))
    return relabel(nodes, second)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """Every row's ``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key of its class."""
    rows = materialise(
        fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text", shingle), "simhash"
    )
    fps = materialise(rows.groupBy("fp").agg(F.min("key").alias("least")), "simhash-fps")
    found = fingerprint_classes(fps.select("fp"), max_bits).join(fps.hint("merge"), "fp")
    least = found.groupBy("class").agg(F.min("least").alias("component_id"))
    by_fp = materialise(found.select("fp", "class").join(least, "class").select("fp", "component_id"), "simhash-classes")
    return rows.join(by_fp.hint("merge"), "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
