"""Language-model scores by online logistic context mixing, beside a smoothed unigram score.

A text is coded byte by byte, with an end behind the last, along the path of a binary code (a
Huffman code, so that frequent bytes take few steps). At every step several predictors, each with
counts of bits after the preceding 1, 3 or 5 bytes at that node of the path, give the odds of the
next bit. Their log odds are added under weights picked by a gate (depth in the path, and whether a
word has begun); the weights follow the coding error of every bit as the text goes on, from its
first byte to its last. The sum of the logarithms of all probabilities is the score; divided by the
bytes it gives bits per byte.

What is counted covers all training texts. Contexts go by a hash to buckets, which keep the whole context as
check bits, so an unseen context never takes another's odds. Texts are cut into segments; a segment's distinct
pairs of longest context and next symbol go to buckets by a hash of the last three bytes, so that the counts of
both longer orders follow there from the same pairs. They are counted over all segments, and the odds of the bits
taken along their paths come back to the segments that asked. There are as many buckets as the pairs asked for
need. Of the shortest order there are at most 256 * 257 pairs, whatever the corpus; its counts are broadcast. A
context that no training text has gives even odds. The binary code comes from the counts of all bytes and ends.

The weights that every text starts from are fitted in the buckets to all training occurrences, each against the
counts without itself (a context seen once says nothing about its own next byte): some Newton steps a bucket, the
buckets' results joined by their curvatures.

Word counts are exact: tasks number the words of a segment in order of appearance, the distinct words of all
segments are counted together, and the counts go back to their segments, where the words are numbered again.

A null text is an empty one: an end and nothing else. Rows are never joined by id, so repeated ids
are scored each; a null id counts as empty text in the split, so its row is learned from. Without
training texts every step has even odds and no word is known. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import math
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import column_bytes, give_back, slices, table
from palaver.llm.quality import remainder
from palaver.session import materialise

ORDERS = (1, 3, 5)
END = 256
GATES = 64
#: Bytes after which the weights start again from those of the model: never, within a text.
STRETCH = 1 << 62
#: Bytes that are coded together, in step, and texts.
TOGETHER, LANES = 1 << 17, 1 << 12
#: Symbols whose pairs are sorted together.
COUNTED = 1 << 20
#: Texts that are not worth a call of numpy a step: those left go on one by one.
FEW = 4
RATE = 0.02
#: Log odds are kept as whole numbers of 1/16.
SCALE = 16.0
#: Bytes of text, and words, whose contexts and words are looked up together.
SEGMENT_BYTES = 12 << 20
#: Pairs and words that are asked of one bucket, about, over all segments.
BUCKET_PAIRS = 1 << 20
BUCKET_WORDS = 1 << 19
#: Newton steps for the first weights, and how firmly they are held to those of :func:`first_weights`.
FITTING, HELD = 6, 4.0
SEGMENT_TOKENS = 4_000_000


def huffman(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """The path of every symbol: ``(node, bit)`` from the root."""
    heap = [(int(n) + 1, i, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        children.append((a[2], b[2]))
        new = len(counts) + len(children) - 1
        heapq.heappush(heap, (a[0] + b[0], new, new))
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    open_ = [(heap[0][2], [])]
    while open_:
        node, path = open_.pop()
        if node < len(counts):
            paths[node] = path
        else:
            inner = node - len(counts)
            open_ += [(child, [*path, (inner, bit)]) for bit, child in enumerate(children[inner])]
    return paths


class Code:
    """The paths of all symbols in flat arrays."""

    def __init__(self, counts: np.ndarray):
        paths = huffman(counts)
        while max(map(len, paths)) > GATES // 2:  # every step of a byte has a gate of its own
            counts = counts // 2
            paths = huffman(counts)
        self.length = np.array([len(p) for p in paths], np.int32)
        self.start = (np.cumsum(self.length) - self.length).astype(np.int32)
        self.node = np.array([n for p in paths for n, _ in p], np.uint32)
        self.bit = np.array([b for p in paths for _, b in p], np.uint8)
        self.sign = (self.bit * 2).astype(np.int8) - np.int8(1)
        self.depth = np.concatenate([np.arange(len(p)) for p in paths]).astype(np.int32)


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with their ends as one array of symbols, zeros between them, and where each begins."""
    gap = max(ORDERS)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.cumsum(sizes + gap) - sizes
    symbols = np.zeros(int(sizes.sum()) + gap * len(texts), np.uint16)
    for t, b in zip(texts, begin.tolist(), strict=True):
        symbols[b : b + len(t)] = np.frombuffer(t, np.uint8)
        symbols[b + len(t)] = END
    return symbols, begin


def contexts(symbols: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The symbols before each place as one number, for every order."""
    found, h = [], np.zeros(len(at), np.uint64)
    for back in range(1, max(ORDERS) + 1):
        h = h | symbols[at - back].astype(np.uint64) << np.uint64(8 * (back - 1))
        if back in ORDERS:
            found.append(h)
    return found


def last_pairs(symbols: np.ndarray, begin: int, end: int) -> np.ndarray:
    """The longest context and the symbol at each place from ``begin`` to ``end``, as one number; nothing but zeros precedes the first."""
    pairs = symbols[begin:end].astype(np.uint64)
    for back in range(1, max(ORDERS) + 1):
        skip = max(0, back - begin)
        pairs[skip:] |= symbols[begin + skip - back : end - back].astype(np.uint64) << np.uint64(8 * back + 1)
    return pairs


def slots(order: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The numbers under which the odds of steps are kept; different steps have different ones."""
    return np.uint64(order << 48) | context << np.uint64(8) | node.astype(np.uint64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, of at most 51 bits, in order, and the sum of the counts of each."""
    if not len(keys):
        return keys, counts
    # counts lie below the keys they belong to, which sorts several times faster than an order of the keys; large ones are added behind
    room, width = np.uint64((1 << 13) - 1), np.uint64(13)
    large = np.flatnonzero(counts > int(room))
    both = keys.astype(np.uint64) << width | np.where(counts > int(room), 0, counts).astype(np.uint64)
    both.sort()
    found = both >> width
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    found, total = found[first], np.add.reduceat((both & room).astype(np.int64), first)
    np.add.at(total, np.searchsorted(found, keys[large].astype(np.uint64)), counts[large])
    return found.astype(keys.dtype), total


def pairs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of longest context and symbol, and how often each comes."""
    symbols, begin = laid_out(texts)
    text = np.ones(len(symbols), bool)
    text[begin[:, None] - np.arange(1, max(ORDERS) + 1)] = False
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i in range(0, len(symbols), COUNTED):
        pairs = last_pairs(symbols, i, min(len(symbols), i + COUNTED))
        k, c = np.unique(pairs[text[i : i + COUNTED]], return_counts=True)
        keys.append(k)
        counts.append(c)
    return (keys[1], counts[1]) if len(keys) == 2 else summed(np.concatenate(keys), np.concatenate(counts))


def shorter(pairs: np.ndarray, order: int) -> np.ndarray:
    """The pairs with contexts of another order, marked with it."""
    mask = np.uint64((1 << 8 * ORDERS[order]) - 1)
    return np.uint64(order << 49) | (pairs >> np.uint64(9) & mask) << np.uint64(9) | pairs & np.uint64(511)


def spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``start``, ``start + 1``, ... of ``n`` places each, one after another."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def path_steps(code: Code, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps of every marked pair, and of all steps the slot and the bit."""
    symbol = (pairs & np.uint64(511)).astype(np.int64)
    n = code.length[symbol].astype(np.int64)
    place = spans(code.start[symbol].astype(np.int64), n)
    slot = np.repeat(pairs >> np.uint64(9) << np.uint64(8), n) | code.node[place].astype(np.uint64)
    return n, slot, code.bit[place]


def bucket_order(pairs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of pairs by bucket, the buckets in it, and where each begins and, behind the last, ends."""
    h = (pairs >> np.uint64(9) & np.uint64(0xFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(24)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return order, found, np.append(first, len(pairs))


class Odds:
    """Log odds of a one by slot, in units of 1 / SCALE; zero where nothing was learned."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __getitem__(self, slot: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(np.shape(slot), np.int8)
        at = np.minimum(np.searchsorted(self.keys, slot), len(self.keys) - 1)
        return np.where(self.keys[at] == slot, self.values[at], np.int8(0))


class Paths:
    """The steps of all pairs of a segment: log odds of the bit taken by each order and a constant, moved as one element."""

    def __init__(self, code: Code, first: np.ndarray, pairs: np.ndarray, odds: np.ndarray):
        """``first``: :func:`first_order`; ``odds``: those of the longer orders at the steps of the sorted ``pairs``."""
        self.pairs = pairs
        symbol = (pairs & np.uint64(511)).astype(np.int64)
        n = code.length[symbol].astype(np.int64)
        self.start = np.cumsum(n) - n
        self.n = n.astype(np.int8)
        # the gate of the first step, by whether a word has begun
        self.gate = ((pairs >> np.uint64(9) & np.uint64(255)) > 32) * np.int8(GATES // 2)
        place = spans(code.start[symbol].astype(np.int64), n)
        rows = np.empty((len(place), len(ORDERS) + 1), np.int8)
        rows[:, 0] = first[np.repeat((pairs >> np.uint64(9) & np.uint64(255)).astype(np.int64), n), place]
        rows[:, 1:-1] = odds.reshape(-1, len(ORDERS) - 1)
        rows[:, -1] = code.sign[place] * np.int8(SCALE)
        self.rows = rows.view(np.uint32).ravel()
        self.shift = np.uint64(64 - max(1, int(4 * len(self.pairs)).bit_length()))
        self.likely = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.likely[self._hash(self.pairs)] = np.arange(len(self.pairs))

    def _hash(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """The places of pairs of the segment."""
        at = self.likely.take(self._hash(pairs))
        other = np.flatnonzero(self.pairs.take(at) != pairs)
        at[other] = np.searchsorted(self.pairs, pairs[other])
        return at


def coded(paths: Paths, weights: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Log10 probability of each text."""
    score = np.zeros(len(texts))
    longest = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for i in range(0, len(longest), LANES):
        some = longest[i : i + LANES]
        score[some] = _in_step(paths, weights, [texts[j] for j in some])
    return score


def _in_step(paths: Paths, start: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """:func:`coded` for texts in falling order of length: all first symbols, all second symbols, ..."""
    symbols, first = laid_out(texts)
    # the place among the pairs of every symbol; between texts, of none
    pairs = np.empty(len(symbols), np.int32)
    for i in range(0, len(symbols), TOGETHER):
        pairs[i : i + TOGETHER] = paths.find(last_pairs(symbols, i, min(len(symbols), i + TOGETHER)))
    del symbols
    size = np.array([len(t) + 1 for t in texts], np.int64)
    # inputs are left as whole numbers of 1 / SCALE, and weights are those of whole numbers
    rate = np.float32(RATE / SCALE**2)
    weights = np.tile(start / np.float32(SCALE), (len(texts), 1))
    # the four weights of a gate are moved as one 16-byte element, which is several times faster
    whole = weights.view(np.complex128).ravel()
    score = np.zeros(len(texts))
    one, least, width = np.float32(1), np.exp(np.float32(-20)), len(ORDERS) + 1
    # when few are left, each goes on alone from here
    alone = min(FEW, len(texts))
    t, end = 0, int(size[alone]) if alone < len(texts) else 0
    while t < end:
        # the texts still going on are the longest ones
        span = max(1, min(end - t, TOGETHER // int(np.searchsorted(-size, -t))))
        going = np.searchsorted(-size, -np.arange(t + 1, t + span + 1), "right")
        lane = np.arange(int(going.sum())) - np.repeat(np.cumsum(going) - going, going)
        at = first[lane] + t + np.repeat(np.arange(span), going)
        pair = pairs.take(at).astype(np.int64)
        n = paths.n.take(pair).astype(np.int64)
        ends = np.cumsum(n)
        step = np.arange(int(ends[-1]))
        row = np.repeat(paths.start.take(pair) - (ends - n), n)
        row += step
        # the steps of a byte have gates one after another
        unit = np.repeat(lane * GATES + paths.gate.take(pair) - (ends - n), n)
        unit += step
        x = paths.rows.take(row).view(np.int8).astype(np.float32)
        odds = np.empty(len(row), np.float32)
        last = 0
        # operations run over flat arrays: over rows of four numpy takes a call a row
        for stop in ends[np.cumsum(going) - 1].tolist():
            u, r, z = unit[last:stop], x[last * width : stop * width], odds[last:stop]
            held = whole.take(u)
            w = held.view(np.float32)
            terms = (r * w).view(np.complex64)
            half = (terms[::2] + terms[1::2]).view(np.float32)
            # the odds of the bit taken; 1 / (1 + odds) was missing from its probability
            np.exp(np.add(half[::2], half[1::2], out=z), out=z)
            w += r * (rate / (z + one)).repeat(width)
            whole[u] = held
            last = stop
        # one over the probability, and the sum of its logarithms up to the end of each byte
        unlikely = np.divide(one, np.maximum(odds, least, out=odds), out=odds)
        unlikely += one
        cost = np.cumsum(np.log(unlikely, out=unlikely), dtype=np.float64).take(ends - 1)
        score -= np.bincount(lane, np.diff(cost, prepend=0), minlength=len(texts))
        t += span
    for i in range(alone):
        gates = weights[i * GATES : (i + 1) * GATES].tolist()
        for a in range(int(first[i]) + end, int(first[i] + size[i]), TOGETHER):
            score[i] -= _one_by_one(paths, gates, pairs[a : min(a + TOGETHER, int(first[i] + size[i]))])
    return score / np.log(10)


def _one_by_one(paths: Paths, gates: list[list[float]], pair: np.ndarray) -> float:
    """The logarithm of one over the probability of symbols of one text in turn; moves its weights on."""
    n = paths.n[pair].astype(np.int64)
    rows = paths.rows[spans(paths.start[pair], n)].view(np.int8).reshape(-1, len(ORDERS) + 1)
    unit = spans(paths.gate[pair].astype(np.int64), n)
    all_odds, exp, rate = [], math.exp, RATE / SCALE**2
    for a, b, c, d, u in zip(*rows.T.tolist(), unit.tolist(), strict=True):
        e, f, g, h = gates[u]
        z = a * e + b * f + c * g + d * h
        odds = exp(z if z < 700.0 else 700.0)
        wrong = rate / (1.0 + odds)
        gates[u] = (e + a * wrong, f + b * wrong, g + c * wrong, h + d * wrong)
        all_odds.append(odds)
    return float(np.log(1 + 1 / np.maximum(all_odds, np.exp(-20.0))).sum())


@dataclass
class Model:
    """All that was learned, in one process: for small corpora. :func:`scores` leaves the odds where they were counted."""

    code: Code
    odds: Odds
    #: Weights by gate: one for each order, and a constant.
    weights: np.ndarray

    def costs(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each text, and bits per byte."""
        pairs, _ = pairs_of(texts)
        sign, odds = None, []
        for o in range(len(ORDERS)):
            n, slot, bit = path_steps(self.code, shorter(pairs, o))
            sign = bit.astype(np.int8) * np.int8(2) - np.int8(1)
            odds.append(self.odds[slot] * sign)
        first = np.zeros((256, len(self.code.node)), np.int8)
        symbol = (pairs & np.uint64(511)).astype(np.int64)
        place = spans(self.code.start[symbol].astype(np.int64), n)
        first[np.repeat((pairs >> np.uint64(9) & np.uint64(255)).astype(np.int64), n), place] = odds[0]
        score = coded(Paths(self.code, first, pairs, np.column_stack(odds[1:])), self.weights, texts)
        return score, -score * np.log2(10) / np.maximum([len(t) for t in texts], 1)


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, which compress well."""
    return np.diff(keys, prepend=np.uint64(0)).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint64), dtype=np.uint64)


def squeezed(data: bytes) -> bytes:
    """Compressed by zstd, behind the size."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def opened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def segment_texts(batch: pa.RecordBatch, i: int) -> list[bytes]:
    data, ends = opened(batch.column("texts")[i].as_py()), _listed(batch, "ends", i).to_pylist()
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, in lower case, and how many each text has."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_binary()).view(pa.large_string())))
    each, ends = found.flatten(), found.value_lengths().to_numpy(zero_copy_only=False)
    # white space at an end of a text has an empty word beside it
    words = pc.not_equal(pc.binary_length(each), 0)
    before = np.concatenate([[0], np.cumsum(words.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(ends)
    return each.filter(words), np.diff(before[ends], prepend=0)


def numbered(words: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """The number of every word, and the distinct words, both in order of appearance."""
    found = words.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary.view(pa.large_binary()).to_pylist()


def numbering() -> dict[bytes, int]:
    """Numbers words that are looked up in it, in order of appearance."""
    return defaultdict(itertools.count().__next__)


def _listed(batch: pa.RecordBatch, name: str, i: int) -> pa.Array:
    return batch.column(name)[i].values


def read(docs: DataFrame) -> DataFrame:
    """``key``, ``learned`` and ``text`` in segments: one row with the texts, the pairs in them, their counts in training texts, those of pairs of the shortest order, and the words in order of appearance with theirs."""
    most_words = SEGMENT_TOKENS

    def row(segment: int, keys: list, learned: list, texts: list, pairs: list, words: list, lengths: list) -> pa.RecordBatch:
        found, counts = summed(*(np.concatenate(x) for x in zip(*pairs, strict=True)))
        first = (found & np.uint64((1 << 17) - 1)).astype(np.int64)  # one byte and the symbol behind it
        first, times = summed(first[counts > 0], counts[counts > 0])
        lists = [pa.concat_arrays(keys), pa.array(learned, pa.bool_()), pa.array(np.cumsum([len(t) for t in texts], dtype=np.int64)), pa.array(first), pa.array(times)]
        numbers, words = numbered(pa.concat_arrays(words))
        numbers = numbers[np.repeat(np.array(learned, bool), np.concatenate(lengths))]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
        return pa.RecordBatch.from_arrays(
            [pa.array([segment]), pa.array([len(found)]), pa.array([len(words)]), *lists, *(pa.array([squeezed(x)], pa.binary()) for x in (b"".join(texts), packed(found), counts.astype(np.uint32).tobytes(), b" ".join(words), np.bincount(numbers, minlength=len(words)).astype(np.uint32).tobytes()))],
            ["segment", "n", "n_words", "keys", "learned", "ends", "first", "times", "texts", "pairs", "counts", "words", "taught"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, size, tokens = TaskContext.get().partitionId() << 32, 0, 0
        keys, learned, texts, pairs, words, lengths = [], [], [], [], [], []
        for batch in slices(batches, "text", SEGMENT_BYTES // 16):
            data, taught = column_bytes(batch, "text"), batch.column("learned").to_pylist()
            keys.append(batch.column("key"))
            learned += taught
            texts += data
            for l in (True, False):
                k, c = pairs_of([x for x, y in zip(data, taught, strict=True) if y == l])
                pairs.append((k, c if l else np.zeros_like(c)))
            split, n = words_of(data)
            words.append(split)
            lengths.append(n)
            tokens += len(split)
            size += sum(len(x) + 64 for x in data)
            if size >= SEGMENT_BYTES or tokens >= most_words:
                yield row(segment, keys, learned, texts, pairs, words, lengths)
                segment, size, tokens = segment + 1, 0, 0
                keys, learned, texts, pairs, words, lengths = [], [], [], [], [], []
        if texts:
            yield row(segment, keys, learned, texts, pairs, words, lengths)

    kind = docs.schema["key"].dataType.simpleString()
    schema = f"segment long, n long, n_words long, keys array<{kind}>, learned array<boolean>, ends array<long>, first array<long>, times array<long>, texts binary, pairs binary, counts binary, words binary, taught binary"
    return materialise(docs.select("key", "learned", "text").mapInArrow(run, schema), "lm-texts")


def first_counts(segments: DataFrame) -> np.ndarray:
    """How often each symbol follows each byte in training texts."""
    counts = np.zeros((256, 512), np.int64)
    each = segments.select(F.explode(F.arrays_zip("first", "times")).alias("f"))
    for r in each.groupBy(F.col("f.first").alias("pair")).agg(F.sum("f.times").alias("n")).collect():
        counts[r["pair"] >> 9, r["pair"] & 511] = r["n"]
    return counts[:, : END + 1]


def code_of(first: np.ndarray) -> Code:
    """The binary code by the counts of all bytes and ends of training texts."""
    return Code(first.sum(axis=0))


def log_odds(taken: np.ndarray, other: np.ndarray) -> np.ndarray:
    """In units of 1 / SCALE, by the counts of a bit and of the other bit."""
    return np.clip(np.rint(np.log((taken + 0.4) / (other + 0.4)) * SCALE), -127, 127).astype(np.int8)


def step_counts(keys: np.ndarray, counts: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """By the counts of distinct marked pairs: at every step of each, how often its bit was taken there, and how often the other."""
    n, slot, bit = path_steps(code, keys)
    slot, which = np.unique(slot, return_inverse=True)
    times = np.repeat(counts, n).astype(np.float64)
    one = np.bincount(which, times * bit, minlength=len(slot))
    zero = (np.bincount(which, times, minlength=len(slot)) - one)[which]
    one = one[which]
    return np.where(bit, one, zero), np.where(bit, zero, one)


def first_steps(first: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """:func:`step_counts` of the shortest order, by byte and place of the code."""
    symbol = np.repeat(np.arange(END + 1), code.length)
    nodes = int(code.node.max()) + 1
    total, one = (np.zeros((len(first), nodes)) for _ in range(2))
    for j, (s, node, bit) in enumerate(zip(symbol.tolist(), code.node.tolist(), code.bit.tolist(), strict=True)):
        total[:, node] += first[:, s]
        if bit:
            one[:, node] += first[:, s]
    one, total = one[:, code.node], total[:, code.node]
    return np.where(code.bit, one, total - one), np.where(code.bit, total - one, one)


def first_order(first: np.ndarray, code: Code) -> np.ndarray:
    """Log odds of the shortest order for the bits taken, by byte and place of the code."""
    return log_odds(*first_steps(first, code))


def first_weights() -> np.ndarray:
    start = np.full((GATES, len(ORDERS) + 1), 0.35, np.float32)
    start[:, -1] = 0
    return start


def curvature(gate: np.ndarray, x: np.ndarray, times: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By gate, the slope and the curvature of the cost of bits with inputs ``x`` that came so many ``times``."""
    wrong = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", x, weights[gate]), -30, 30)))
    width = x.shape[1]
    slope, bend = np.empty((GATES, width)), np.empty((GATES, width, width))
    sharp = times * wrong * (1 - wrong)
    for i in range(width):
        slope[:, i] = np.bincount(gate, times * wrong * x[:, i], minlength=GATES)
        for j in range(i + 1):
            bend[:, i, j] = bend[:, j, i] = np.bincount(gate, sharp * x[:, i] * x[:, j], minlength=GATES)
    return slope, bend


def fitted(gate: np.ndarray, x: np.ndarray, times: np.ndarray) -> np.ndarray:
    """By gate, the curvature at the best weights, flat, and its product with them."""
    weights, begin = first_weights().astype(np.float64), first_weights().astype(np.float64)
    hold = HELD * np.eye(x.shape[1])
    for _ in range(FITTING):
        slope, bend = curvature(gate, x, times, weights)
        step = np.linalg.solve(bend + hold, (slope - HELD * (weights - begin))[:, :, None])[:, :, 0]
        weights = weights + np.clip(step, -0.5, 0.5)
    _, bend = curvature(gate, x, times, weights)
    return np.concatenate([bend.reshape(GATES, -1), np.einsum("gij,gj->gi", bend, weights)], axis=1)


def bucket_number(segments: DataFrame, column: str, each: int) -> int:
    """As many as what is asked for needs; small corpora are spread over some tasks."""
    return max(32, -(-(segments.agg(F.sum(column)).first()[0] or 0) // each))


def by_bucket(answer: Callable, columns: list[str]) -> Callable:
    """``answer`` to the rows of each bucket, which come one bucket after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = -1, []
        for batch in batches:
            for b, *row in zip(*(batch.column(x).to_pylist() for x in ("bucket", "segment", *columns)), strict=True):
                if b != now and rows:
                    yield answer(now, rows)
                    rows = []
                now = b
                rows.append(tuple(row))
        if rows:
            yield answer(now, rows)
        give_back()

    return run


def gather(segments: DataFrame, first: np.ndarray, code: Code, buckets: int, whole: bool = False) -> DataFrame:
    """The odds of the longer orders along the paths of the pairs of each ``segment`` and ``bucket``, by the counts over all segments.

    Each bucket adds a row without segment, of what :func:`fitted` finds there. With ``whole``, it has also all
    slots and their odds.
    """
    shared = segments.sparkSession.sparkContext.broadcast((code, *first_steps(first, code)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs, counts = unpacked(opened(batch.column("pairs")[i].as_py())), np.frombuffer(opened(batch.column("counts")[i].as_py()), np.uint32)
                order, full, cuts = bucket_order(pairs, buckets)
                pairs, counts = pairs[order], counts[order]
                parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("segment")[i].as_py()] * len(full), pa.int64()), pa.array(full, pa.int64()),
                        pa.array([squeezed(packed(pairs[a:b])) for a, b in parts], pa.binary()),
                        pa.array([squeezed(counts[a:b].tobytes()) for a, b in parts], pa.binary()),
                    ],
                    ["segment", "bucket", "pairs", "counts"],
                )

    def answer(bucket: int, rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        code, taken, other = shared.value
        asked = [unpacked(opened(p)) for _, p, _ in rows]
        counts = np.concatenate([np.frombuffer(opened(c), np.uint32) for _, _, c in rows]).astype(np.int64)
        keys, counts = summed(np.concatenate(asked), counts)
        symbol = (keys & np.uint64(511)).astype(np.int64)
        n = code.length[symbol].astype(np.int64)
        start, place = np.cumsum(n) - n, spans(code.start[symbol].astype(np.int64), n)
        byte = np.repeat((keys >> np.uint64(9) & np.uint64(255)).astype(np.int64), n)
        steps = [(taken[byte, place], other[byte, place])]
        slots_, odds_ = [], []
        for o in range(1, len(ORDERS)):
            marked, times = summed(shorter(keys, o), counts)
            found = step_counts(marked, times, code)
            length = code.length[(marked & np.uint64(511)).astype(np.int64)].astype(np.int64)
            along = spans((np.cumsum(length) - length)[np.searchsorted(marked, shorter(keys, o))], n)
            steps.append(tuple(x[along] for x in found))
            if whole:
                _, slot, bit = path_steps(code, marked)
                slot, once = np.unique(slot, return_index=True)
                slots_.append(slot)
                odds_.append((log_odds(*found) * (bit.astype(np.int8) * np.int8(2) - np.int8(1)))[once])
        seen = np.flatnonzero(np.repeat(counts, n))
        times = np.repeat(counts, n)[seen].astype(np.float64)
        x = np.column_stack([*(log_odds(a[seen] - 1, b[seen]) / SCALE for a, b in steps), code.sign[place[seen]]])
        gate = code.depth[place[seen]] + (byte[seen] > 32) * (GATES // 2)
        odds = np.column_stack([log_odds(*s) for s in steps[1:]])
        at = [np.searchsorted(keys, q) for q in asked]
        answers = [squeezed(odds[spans(start[q], n[q])].tobytes()) for q in at]
        return pa.RecordBatch.from_arrays(
            [pa.array([*(s for s, _, _ in rows), None], pa.int64()), pa.array([bucket] * (len(rows) + 1), pa.int64()),
             pa.array([None] * len(rows) + [b"".join(q.tobytes() for q in slots_)], pa.binary()),
             pa.array([*answers, b"".join(q.tobytes() for q in odds_)], pa.binary()),
             pa.array([None] * len(rows) + [fitted(gate, x, times).ravel().tolist()], pa.list_(pa.float64()))],
            ["segment", "bucket", "slots", "odds", "fitted"],
        )

    asked = segments.select("segment", "pairs", "counts").mapInArrow(ask, "segment long, bucket long, pairs binary, counts binary")
    schema = "segment long, bucket long, slots binary, odds binary, fitted array<double>"
    return materialise(asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(by_bucket(answer, ["pairs", "counts"]), schema), "lm-odds")


def looked_up(segments: DataFrame, found: DataFrame) -> DataFrame:
    """The segments with the odds of their steps."""
    found = found.where("segment is not null").groupBy("segment").agg(F.collect_list(F.struct("bucket", "odds")).alias("found"))
    return segments.select("segment", "keys", "ends", "texts", "pairs").join(found, "segment")


def segment_paths(batch: pa.RecordBatch, i: int, code: Code, first: np.ndarray, buckets: int) -> Paths:
    pairs = unpacked(opened(batch.column("pairs")[i].as_py()))
    found = _listed(batch, "found", i)
    by_bucket = sorted(zip(found.field("bucket").to_pylist(), found.field("odds").to_pylist(), strict=True))
    order, _, _ = bucket_order(pairs, buckets)
    n = code.length[(pairs & np.uint64(511)).astype(np.int64)].astype(np.int64)
    odds = np.empty((int(n.sum()), len(ORDERS) - 1), np.int8)
    odds[spans((np.cumsum(n) - n)[order], n[order])] = np.frombuffer(b"".join(opened(o) for _, o in by_bucket), np.int8).reshape(-1, len(ORDERS) - 1)
    return Paths(code, first, pairs, odds)


def weights_of(found: DataFrame) -> np.ndarray:
    """The weights to start from: the buckets' best ones, joined by their curvatures."""
    width = len(ORDERS) + 1
    total = np.zeros(GATES * width * (width + 1))
    each = found.where("fitted is not null").select(F.posexplode("fitted").alias("place", "x"))
    for r in each.groupBy("place").agg(F.sum("x").alias("x")).collect():
        total[r["place"]] = r["x"]
    total = total.reshape(GATES, -1)
    bend, pull = total[:, : width * width].reshape(GATES, width, width), total[:, width * width :]
    begin = first_weights().astype(np.float64)
    return np.linalg.solve(bend + HELD * np.eye(width), (pull + HELD * begin)[:, :, None])[:, :, 0].astype(np.float32)


def fit(docs: DataFrame) -> Model:
    """A model of the texts of ``docs`` (``text``), gathered into this process."""
    segments = read(docs.select(F.lit(0).alias("key"), F.lit(True).alias("learned"), F.coalesce("text", F.lit("")).alias("text")))
    first = first_counts(segments)
    code = code_of(first)
    found = gather(segments, first, code, bucket_number(segments, "n", BUCKET_PAIRS), whole=True)
    parts = found.where("segment is null").select("slots", "odds").collect()
    keys, odds = (np.frombuffer(b"".join(r[c] for r in parts), kind) for c, kind in (("slots", np.uint64), ("odds", np.int8)))
    byte, symbol = np.nonzero(first)
    _, slot, bit = path_steps(code, (byte << 9 | symbol).astype(np.uint64))
    place = spans(code.start[symbol].astype(np.int64), code.length[symbol].astype(np.int64))
    along = first_order(first, code)[np.repeat(byte, code.length[symbol]), place] * code.sign[place]
    slot, once = np.unique(slot, return_index=True)
    return Model(code, Odds(np.concatenate([slot, keys]), np.concatenate([along[once], odds])), weights_of(found))


def word_order(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of words by bucket, the buckets in it, and where each begins and, behind the last, ends."""
    bucket = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % buckets
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return order, found, np.append(first, len(words))


def word_counts(segments: DataFrame, buckets: int) -> DataFrame:
    """The counts in training texts of the words of each ``segment`` and ``bucket``, and per bucket, in a row without segment, their sum and how many are known.

    A segment asks for each of its words once, so a word comes at most once a segment.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, taught = opened(batch.column("words")[i].as_py()).split(), np.frombuffer(opened(batch.column("taught")[i].as_py()), np.uint32)
                order, full, cuts = word_order(words, buckets)
                parts = [order[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("segment")[i].as_py()] * len(full), pa.int64()), pa.array(full, pa.int64()),
                        pa.array([squeezed(b" ".join([words[k] for k in part.tolist()])) for part in parts], pa.binary()),
                        pa.array([squeezed(taught[part].tobytes()) for part in parts], pa.binary()),
                    ],
                    ["segment", "bucket", "words", "taught"],
                )

    def answer(bucket: int, rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        numbers = numbering()
        asked = []
        for _, words, _ in rows:
            split = opened(words).split()
            asked.append(np.fromiter(map(numbers.__getitem__, split), np.int64, len(split)))
        counts = np.zeros(len(numbers), np.int64)
        for which, (_, _, taught) in zip(asked, rows, strict=True):
            counts[which] += np.frombuffer(opened(taught), np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array([*(x for x, _, _ in rows), None], pa.int64()), pa.array([bucket] * (len(rows) + 1), pa.int64()),
             pa.array([*(squeezed(counts[which].tobytes()) for which in asked), None], pa.binary()),
             pa.array([None] * len(rows) + [int(counts.sum())], pa.int64()), pa.array([None] * len(rows) + [int((counts > 0).sum())], pa.int64())],
            ["segment", "bucket", "counts", "total", "known"],
        )

    asked = segments.select("segment", "words", "taught").mapInArrow(ask, "segment long, bucket long, words binary, taught binary")
    schema = "segment long, bucket long, counts binary, total long, known long"
    answers = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(by_bucket(answer, ["words", "taught"]), schema)
    return materialise(answers, "lm-words")


def scores(docs: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte``.

    Rows where ``learn_from`` is true are learned from; all are scored.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(learn_from, F.lit(False)).alias("learned"), F.coalesce(text, F.lit("")).alias("text"))
    segments = read(rows)
    first = first_counts(segments)
    code = code_of(first)
    buckets = bucket_number(segments, "n", BUCKET_PAIRS)
    found = gather(segments, first, code, buckets)
    ends = segments.select(F.explode("learned").alias("learned")).where("learned").count()
    word_buckets = bucket_number(segments, "n_words", BUCKET_WORDS)
    counted = word_counts(segments, word_buckets)
    total, kinds = counted.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    n, v = total + ends, kinds + (1 if ends else 0)
    # a segment's words come back to it, in one piece a bucket
    back = counted.where("segment is not null").groupBy("segment").agg(F.collect_list(F.struct("bucket", "counts")).alias("counts"))
    whole = looked_up(segments, found).join(back, "segment", "left")
    floor = n + (v + 1)
    shared = docs.sparkSession.sparkContext.broadcast((code, first_order(first, code), weights_of(found)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, first, weights = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                texts, given = segment_texts(batch, i), _listed(batch, "counts", i)
                split, sizes = words_of(texts)
                numbers, words = numbered(split)
                c = np.zeros(len(words), np.int64)
                if len(c):
                    pieces = sorted(zip(given.field("bucket").to_pylist(), given.field("counts").to_pylist(), strict=True))
                    c[word_order(words, word_buckets)[0]] = np.frombuffer(b"".join(opened(x) for _, x in pieces), np.int64)
                log, some = np.log10((c + 1) / floor), c > 0
                text = np.repeat(np.arange(len(texts)), sizes)
                base, known = np.bincount(text, log[numbers], len(texts)), np.bincount(text, some[numbers], len(texts)).astype(np.int64)
                del split, numbers, words, text
                give_back()
                score = coded(segment_paths(batch, i, code, first, buckets), weights, texts)
                bits = -score * np.log2(10) / np.maximum([len(x) for x in texts], 1)
                yield pa.RecordBatch.from_arrays(
                    [_listed(batch, "keys", i), pa.array(sizes + 1), pa.array(known + (ends > 0)), pa.array(np.full(len(texts), n)),
                     pa.array(base + np.log10((ends + 1) / floor)), pa.array(score), pa.array(bits)],
                    ["key", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
                )
            give_back()

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return materialise(whole.mapInArrow(run, schema), "lm-scores").withColumnRenamed("key", key)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = scores(docs, remainder("doc_id", 7) != 2)
    return rows.select(
        "doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )
