"""Benchmark decontamination by a distributed positional inverted index.

Documents are gathered into segments of a bounded number of words. A segment is one row of the
stored index: its documents, its words, and for each word the sorted list of positions at which it
stands. A document lies in one segment, so lists are intersected inside a segment and nothing is
shuffled, however often a word or passage occurs.

A benchmark item asks for each of its windows of 13 consecutive words (or for itself, if shorter).
Per segment, a window's lists are shifted by the word's offset and intersected from the word that
is rarest in the corpus: what remains are exact phrases. The same lists without shifting give
proximity matches: documents where every word of the window stands within ``slop`` words of its
rarest word. Windows are looked up in blocks of bounded size, so the benchmark may be large.

Null and empty texts have no words; items without words ask for nothing. Repeated rows are
documents of their own. Items that repeat an id count as one item; a null item id is left out of
the list of items. A very long text is a segment of its own. Further columns play no part. Empty tables give empty results,
or documents without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palaver.llm.common import column_bytes, give_back, slices, table
from palaver.session import fresh_path, materialise

WINDOW = 13
#: Words in a segment, unless one document has more.
SEGMENT_WORDS = 200_000
#: Positions that are followed at once; a common word of many windows has far more.
ANCHORS = 1 << 17
#: A segment is a large row. Row groups and pages are closed by their bytes after any row, where Parquet would look at every
#: hundredth only and keep that many segments in hand, in writing and in reading.
INDEX_OPTIONS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1"}
#: Windows that tasks look up at once; more are looked up in further passes.
BLOCK_WINDOWS = 100_000

_KEEP = frozenset([*b"0123456789", *b"abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)])
_FOLD = bytes(c if c in _KEEP else 32 for c in bytes(range(256)).lower())


def words_of(text: bytes) -> list[bytes]:
    """Words of letters, digits and everything beyond ASCII, A-Z in lower case."""
    return text.translate(_FOLD).split()


def _segment(keys: list[pa.Array], texts: list[list[bytes]], number: int) -> pa.RecordBatch:
    """One index row. Between documents a position stays free, so that no phrase runs across."""
    numbers: dict[bytes, int] = {}
    counts = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(counts + 1)[:-1]))
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(counts.sum()))
    positions = np.arange(len(ids)) + np.repeat(np.arange(len(texts)), counts)
    order = np.argsort(ids, kind="stable")
    ends = np.cumsum(np.bincount(ids, minlength=len(numbers)))
    lists = [
        pa.concat_arrays(keys),
        pa.array(starts.astype(np.int32)),
        pa.array(counts.astype(np.int32)),
        pa.array(list(numbers), pa.binary()),
        pa.array(ends.astype(np.int32)),
        pa.array(positions[order].astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]],
        ["segment", "keys", "starts", "counts", "words", "ends", "positions"],
    )


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The postings of all words of all documents, stored in the shared folder; one row per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        keys: list[pa.Array] = []
        texts: list[list[bytes]] = []
        size = 0
        for batch in slices(batches, "text"):
            for i, text_ in enumerate(column_bytes(batch, "text")):
                found = words_of(text_)
                if texts and size + len(found) + 1 > segment_words:
                    yield _segment(keys, texts, number)
                    number, keys, texts, size = number + 1, [], [], 0
                keys.append(batch.column("key").slice(i, 1))
                texts.append(found)
                size += len(found) + 1
        if texts:
            yield _segment(keys, texts, number)

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    schema = (
        f"segment long, keys array<{kind}>, starts array<int>, counts array<int>, "
        "words array<binary>, ends array<int>, positions array<int>"
    )
    path = fresh_path(docs.sparkSession, "postings")
    found = slim.mapInArrow(run, schema)
    found.write.options(**INDEX_OPTIONS).parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def windows_of(items: DataFrame, key: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """``window`` (its words, joined by spaces) and ``item``, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for i, text_ in enumerate(column_bytes(batch, "text")):
                found = words_of(text_)
                last = max(1, len(found) - width + 1) if found else 0
                windows = sorted({b" ".join(found[j : j + width]).decode() for j in range(last)})
                rows = pa.array(np.full(len(windows), i))
                yield pa.RecordBatch.from_arrays([pa.array(windows, pa.string()), batch.column("item").take(rows)], ["window", "item"])

    slim = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "window string, item string").distinct()


class Lookup:
    """A block of windows as word numbers, and the postings of a segment under those numbers."""

    def __init__(self, windows: list[str]):
        self.windows = windows
        numbers: dict[bytes, int] = {}
        words = [[numbers.setdefault(w, len(numbers)) for w in x.encode().split(b" ")] for x in windows]
        self.words = list(numbers)
        self.known = pa.array(self.words, pa.binary())
        self.widths = np.array([len(w) for w in words], np.int64)
        #: Word numbers by window and offset, -1 behind the end of a shorter window.
        self.matrix = np.full((len(windows), self.widths.max(initial=1)), -1)
        for i, w in enumerate(words):
            self.matrix[i, : len(w)] = w

    def counts(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places in a segment's list of words that the block knows, and their numbers."""
        found = pa.compute.index_in(words, self.known)
        places = np.nonzero(found.is_valid().to_numpy(zero_copy_only=False))[0]
        return places, found.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)

    def rarest_first(self, frequency: dict[str, int]) -> np.ndarray:
        """Offsets of every window, those of rare words first; -1 behind the end."""
        key = sorted(range(len(self.words)), key=lambda i: (frequency.get(self.words[i].decode(), 0), self.words[i]))
        rank = np.empty(len(key) + 1, np.int64)
        rank[key] = np.arange(len(key))
        rank[-1] = len(key)  # what stands for no word comes last
        order = np.argsort(rank[self.matrix], axis=1, kind="stable")
        return np.where(np.arange(order.shape[1]) < self.widths[:, None], order, -1)


def _frequencies(index: DataFrame, windows: list[str]) -> dict[str, int]:
    """How often each word of the windows occurs in the corpus. The result is no larger than the windows are."""
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value)
        total = np.zeros(len(lookup.words), np.int64)
        for batch in batches:
            for words, ends in zip(batch.column("words"), batch.column("ends"), strict=True):
                places, numbers = lookup.counts(words.values)
                total[numbers] += np.diff(ends.values.to_numpy(), prepend=0)[places]
        seen = np.nonzero(total)[0]
        names = [lookup.words[i].decode() for i in seen]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(total[seen])], ["word", "n"])
        give_back()

    counted = index.select("words", "ends").mapInArrow(run, "word string, n long")
    return dict(tuple(r) for r in counted.groupBy("word").agg(F.sum("n")).collect())


def search(index: DataFrame, windows: list[str], slop: int = 2 * WINDOW) -> DataFrame:
    """Documents with matches, by ``segment`` and ``place`` in it: phrases, their word spans, and near windows."""
    context = index.sparkSession.sparkContext
    frequency = _frequencies(index, windows)
    shared = context.broadcast((windows, frequency))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, counts = shared.value
        lookup = Lookup(asked)
        order = lookup.rarest_first(counts)
        for batch in batches:
            for row in range(batch.num_rows):
                part = lambda c: batch.column(c)[row].values  # noqa: B023
                near, phrases = _intersect(
                    lookup, order, slop, part("words"), *(part(c).to_numpy() for c in ("ends", "positions", "starts", "counts"))
                )
                if near:
                    yield _matches(batch.column("segment")[row].as_py(), near, phrases, asked)
        give_back()

    schema = "segment long, place int, spans array<struct<first:int,last:int>>, phrases array<string>, near array<string>"
    return index.select("segment", "starts", "counts", "words", "ends", "positions").mapInArrow(run, schema)


def _intersect(
    lookup: Lookup, order: np.ndarray, slop: int, words: pa.Array, ends: np.ndarray, positions: np.ndarray,
    starts: np.ndarray, sizes: np.ndarray,
) -> tuple[dict[int, set[int]], dict[int, list[tuple[int, int, int]]]]:
    """Windows near each other's words, and phrases ``(first, last, window)``, by document of one segment.

    All windows at once: the lists of the known words are one sorted array of (word, position), so
    an intersection is a binary search for the shifted positions that are left.
    """
    places, numbers = lookup.counts(words)
    first, last = np.zeros(len(lookup.words) + 1, np.int64), np.zeros(len(lookup.words) + 1, np.int64)
    by_number = np.argsort(numbers)
    places, numbers = places[by_number], numbers[by_number]
    lengths = np.diff(ends, prepend=0)[places].astype(np.int64)
    last[numbers] = np.cumsum(lengths)
    first[numbers] = last[numbers] - lengths
    last[-1] = 1  # no word: never absent
    alive = np.nonzero(((last - first)[lookup.matrix] > 0).all(axis=1))[0]
    if not len(alive):
        return {}, {}
    begin = (ends[places] - lengths).astype(np.int64)
    taken = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    far = np.int64(1) << 32
    lists = np.repeat(numbers, lengths) * far + positions[taken]
    # every position of every window's rarest word, a bounded number at a time
    anchor = lookup.matrix[alive, order[alive, 0]]
    n = last[anchor] - first[anchor]
    until = np.cumsum(n)
    near: dict[int, set[int]] = {}
    phrases: dict[int, list[tuple[int, int, int]]] = {}
    for start in range(0, int(until[-1]), ANCHORS):
        number = np.arange(start, min(start + ANCHORS, int(until[-1])))
        asked = np.searchsorted(until, number, "right")
        window = alive[asked]
        at = lists[first[anchor[asked]] + number - (until - n)[asked]] % far
        begin = at - order[window, 0]
        doc = np.searchsorted(starts, at, "right") - 1
        low, high = np.maximum(at - slop, starts[doc]), np.minimum(at + slop, starts[doc] + sizes[doc] - 1)
        exact = np.ones(len(at), bool)
        for r in range(1, order.shape[1]):
            o = order[window, r]
            word = lookup.matrix[window, o]
            more = o >= 0
            hit = np.searchsorted(lists, word * far + low)
            close = ~more | ((hit < len(lists)) & (lists[np.minimum(hit, len(lists) - 1)] <= word * far + high))
            window, begin, doc, low, high, exact, word, o, more = (
                x[close] for x in (window, begin, doc, low, high, exact, word, o, more)
            )
            wanted = word * far + begin + o
            hit = np.searchsorted(lists, wanted)
            exact &= ~more | ((hit < len(lists)) & (lists[np.minimum(hit, len(lists) - 1)] == wanted))
        offset = begin - starts[doc]
        for d, w, p, e in zip(doc.tolist(), window.tolist(), offset.tolist(), exact.tolist(), strict=True):
            near.setdefault(d, set()).add(w)
            if e:
                phrases.setdefault(d, []).append((p, p + int(lookup.widths[w]), w))
    return near, phrases


def _matches(segment: int, near: dict, phrases: dict, windows: list[str]) -> pa.RecordBatch:
    places = sorted(near)
    spans = []
    for d in places:
        merged: list[dict] = []
        for a, b, _ in sorted(phrases.get(d, ())):
            if merged and a <= merged[-1]["last"]:
                merged[-1]["last"] = max(b, merged[-1]["last"])
            else:
                merged.append({"first": a, "last": b})
        spans.append(merged)
    exact = [{i for _, _, i in phrases.get(d, ())} for d in places]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([segment] * len(places)),
            pa.array(places, pa.int32()),
            pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
            pa.array([[windows[i] for i in sorted(x)] for x in exact], pa.list_(pa.string())),
            pa.array([[windows[i] for i in sorted(near[d] - x)] for d, x in zip(places, exact, strict=True)], pa.list_(pa.string())),
        ],
        ["segment", "place", "spans", "phrases", "near"],
    )


def matches(index: DataFrame, windows: DataFrame, slop: int = 2 * WINDOW, block: int = BLOCK_WINDOWS) -> DataFrame:
    """``search`` over all windows, one pass over the index for each block of about ``block`` windows."""
    asked = materialise(windows.select("window").distinct(), "windows")
    n_blocks = -(-asked.count() // block) or 1
    found = None
    for b in range(n_blocks):
        part = asked.where(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == b)
        rows = search(index, [r["window"] for r in part.collect()], slop)
        found = rows if found is None else found.union(rows)
    return found


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """Every document's ``n_words``, hit words, items with exact phrases, and items with proximity matches only."""
    index = build_index(docs, key, text)
    windows = materialise(windows_of(items, item, "text"), "windows")
    found = materialise(matches(index, windows), "matches")
    row = ["segment", "place"]
    spans = found.select(*row, F.inline("spans"))
    earlier = Window.partitionBy(*row).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("last") - F.greatest("first", F.coalesce(F.max("last").over(earlier), F.lit(0))))
    hit = spans.select(*row, fresh.alias("fresh")).groupBy(*row).agg(F.sum("fresh").alias("n_hit"))
    asked = found.select(*row, F.explode("phrases").alias("window"), F.lit(True).alias("exact")).union(
        found.select(*row, F.explode("near").alias("window"), F.lit(False).alias("exact"))
    )
    # every window asked for is listed; a left join can only broadcast the list, not the exploded matches, which Spark sizes too low
    by_item = asked.join(windows, "window", "left").groupBy(*row, "item").agg(F.max("exact").alias("exact"))
    listed = by_item.groupBy(*row).agg(
        F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"),
        F.sort_array(F.collect_list(F.when(~F.col("exact"), F.col("item")))).alias("near_items"),
    )
    every = index.select("segment", F.posexplode(F.arrays_zip("keys", "counts")).alias("place", "doc"))
    none = F.array().cast("array<string>")
    return (
        every.join(hit, row, "left")
        .join(listed, row, "left")
        .select(
            F.col("doc.keys").alias(key),
            F.col("doc.counts").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("near_items", none).alias("near_items"),
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
        F.size("near_items").cast("long").alias("n_near_items"),
    )


#: Windows and words as joined text; phrases by equality, proximity by the positions around the rarest word.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 12], ' ') AS k, least(len(ws), 13) AS n
       FROM b, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS u(i) WHERE len(ws) > 0),
dw AS (SELECT doc_id, i, array_to_string(ws[i:i + n - 1], ' ') AS k, n
       FROM d, (SELECT DISTINCT n FROM bw) AS sizes, unnest(range(1, len(ws) - n + 2)) AS u(i) WHERE len(ws) >= n),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
hw AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(0, n)) AS u(j) GROUP BY doc_id),
it AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hits GROUP BY doc_id),
p AS (SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS w FROM d),
f AS (SELECT w, count(*) AS n FROM p GROUP BY w),
bt AS (SELECT k, unnest(list_distinct(string_split(k, ' '))) AS w FROM (SELECT DISTINCT k FROM bw)),
ranked AS (SELECT k, bt.w, row_number() OVER (PARTITION BY k ORDER BY coalesce(f.n, 0), bt.w) AS r, count(*) OVER (PARTITION BY k) AS need
           FROM bt LEFT JOIN f ON f.w = bt.w),
anchors AS (SELECT ranked.k, ranked.need, p.doc_id, p.pos FROM ranked JOIN p ON p.w = ranked.w WHERE r = 1),
around AS (SELECT a.k, a.need, a.doc_id, a.pos, a.pos + j AS at FROM anchors a, unnest(range(-26, 27)) AS u(j)),
found AS (SELECT around.k, around.doc_id, around.pos FROM around JOIN p ON p.doc_id = around.doc_id AND p.pos = around.at
          JOIN bt ON bt.k = around.k AND bt.w = p.w GROUP BY around.k, around.need, around.doc_id, around.pos
          HAVING count(DISTINCT p.w) = around.need),
ni AS (SELECT doc_id, count(DISTINCT item_id) AS n FROM (SELECT DISTINCT found.doc_id, bw.item_id FROM found JOIN bw ON bw.k = found.k
       EXCEPT SELECT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(hw.n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(hw.n_hit, 0) > 0 AND 20 * coalesce(hw.n_hit, 0) >= len(ws) AS contaminated, coalesce(ni.n, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id LEFT JOIN ni ON ni.doc_id = d.doc_id
"""
