"""Byte-level BPE of whole texts with a public tokenizer's vocabulary, and back.

A text can be cut where no token can lie across: before a space that follows something other than white
space. Each distinct piece goes through the tokenizers library as it stands; the ids of short ones, most of which come
again and again, are kept for the next texts, up to a number of pieces. A long piece, without such a
place, which takes the library ever longer, is encoded by tree concatenation: its halves are
encoded apart, and a growing window around the join is encoded again until its first and last
tokens are those that the halves have there. In byte-level BPE a sequence is the encoding of its
text exactly if that holds for every two neighbours; all pairs outside the window come from the
halves, all inside from the window, and agreement ties both together, so the joined ids are those
of the whole text.

Texts of more than ``split_chars`` characters are cut into leaves that tasks encode in parallel;
each round joins neighbouring leaves, so a text of n leaves takes log2(n) rounds.

Null is encoded as empty: no ids. Strings of special tokens become those tokens, as in the library.
Rows are never joined by id, so repeated and null ids, and columns of any name, make no difference.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import column_bytes, slices, table
from palaver.session import materialise

#: Pieces of more characters are encoded as a tree.
LEAF_CHARS = 8192
#: Texts of more characters are spread over tasks.
SPLIT_CHARS = 65536
#: Pieces whose ids a worker keeps, beside those of the texts in hand, and the most characters of one.
KEPT, KEPT_CHARS = 1 << 18, 48
#: Pieces that go through the library at once, and bytes of text in hand at once.
AT_ONCE, IN_HAND = 256, 2 << 20


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Encoding and decoding with one vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        byte_of = _byte_of_char()
        self.bytes_of: list[bytes] = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes_of[i] = special[i].encode() if i in special else bytes(byte_of[c] for c in token)
        #: The bytes of all tokens, to be gathered by id.
        self.table = pa.array(self.bytes_of, pa.binary())
        self.special = re.compile("|".join(map(re.escape, special.values()))) if special else None
        self.longest_special = max(map(len, special.values()), default=0)
        # a special token with white space may lie across pieces
        self.cuts = not any(re.search(r"\s", x) for x in special.values()) and not any(
            t.lstrip or t.rstrip or t.single_word for t in self.tokenizer.get_added_tokens_decoder().values()
        )
        #: Ids of short pieces that have been met, as bytes.
        self.kept: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def cut_at(self, text: str, at: int) -> int:
        """``at``, or the start of the special token that lies across it."""
        if self.special:
            for found in self.special.finditer(text, max(0, at - self.longest_special), at + self.longest_special):
                if found.start() < at < found.end():
                    return found.start()
        return at

    def tree(self, text: str, leaf: int = LEAF_CHARS) -> np.ndarray:
        """Ids of a text without a safe place to cut."""
        middle = self.cut_at(text, len(text) // 2)
        if len(text) <= leaf or not 0 < middle < len(text):
            return self.library([text])[0]
        return self.join(self.tree(text[:middle], leaf), self.tree(text[middle:], leaf))

    def _starts_char(self, token: int) -> bool:
        return self.bytes_of[token][0] & 0xC0 != 0x80

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the concatenated texts of ``left`` and ``right``."""
        if not len(left) or not len(right):
            return np.concatenate((left, right))
        width = 4
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            while a > 0 and not self._starts_char(left[a]):
                a -= 1
            while b < len(right) and not self._starts_char(right[b]):
                b += 1
            text = b"".join(self.bytes_of[i] for i in (*left[a:], *right[:b])).decode()
            # white space splits by what follows it, so a window may end with some only where the text does
            if b < len(right) and text[-1].isspace():
                width *= 2
                continue
            again = self.library([text])[0]
            if (a == 0 or again[0] == left[a]) and (b == len(right) or again[-1] == right[b - 1]):
                return np.concatenate((left[:a], again, right[b:]))
            width *= 2

    def _bytes(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, put together from those of its pieces."""
        if not self.cuts:
            return self._bytes(texts)
        kept = self.kept
        if len(kept) > KEPT:
            kept.clear()
        pieces = [_pieces(text) for text in texts]
        new = list(set().union(*pieces) - kept.keys())
        short = [p for p in new if len(p) <= LEAF_CHARS]
        for at in range(0, len(short), AT_ONCE):
            part = short[at : at + AT_ONCE]
            kept.update(zip(part, self._bytes(part), strict=True))
        kept.update((p, self.tree(p).astype("<u4").tobytes()) for p in new if len(p) > LEAF_CHARS)
        whole = [b"".join(map(kept.__getitem__, x)) for x in pieces]
        for p in new:
            if len(p) > KEPT_CHARS:
                del kept[p]
        return whole

    def decode_all(self, ids: list[bytes]) -> pa.Array:
        """The texts of many lists of ids: one gather over the table of bytes, cut where the texts end."""
        ends = np.cumsum([0] + [len(x) // 4 for x in ids])
        gathered = self.table.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        _, offsets, data = gathered.buffers()
        at = np.frombuffer(offsets, np.int32)[: len(gathered) + 1][ends] if len(gathered) else np.zeros(len(ends), np.int32)
        whole = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(at.astype(np.int32).tobytes()), data or pa.py_buffer(b"")])
        try:
            return whole.cast(pa.string())
        except pa.ArrowInvalid:  # tokens that break a character
            return pa.array([x.decode("utf-8", "replace") for x in whole.to_pylist()], pa.string())

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included."""
        return self.decode_all([ids])[0].as_py()


_SPACE_PAIR = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def _pieces(text: str) -> list[str]:
    """Parts whose encodings concatenate: cut before a space that follows no white space."""
    if text[:1] == " " or _SPACE_PAIR.search(text):
        return _CUT.split(text)
    first, *others = text.split(" ")
    return [first, *[" " + x for x in others]]


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _batch(key: pa.Array, ids: list[bytes], names: tuple[str, str] = ("key", "ids")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, pa.array(ids, pa.binary())], list(names))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", split_chars: int = SPLIT_CHARS) -> DataFrame:
    """``key`` and ``ids`` (little-endian unsigned 32-bit integers) of every row; ``path`` is read by the tasks."""
    slim = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", IN_HAND):
            yield _batch(batch.column("key"), codec(path).encode(batch.column("text").to_pylist()))

    short = slim.where(F.char_length("text") <= split_chars).mapInArrow(whole, f"key {kind}, ids binary")
    long = encode_leaves(slim.where(F.char_length("text") > split_chars), path, kind, split_chars // 2)
    return short.union(long).withColumnRenamed("key", key)


def encode_leaves(docs: DataFrame, path: str, kind: str, leaf: int) -> DataFrame:
    """``key, ids`` of texts cut into leaves of at most ``leaf`` characters, encoded apart and joined in rounds."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text", IN_HAND):
            for i, text in enumerate(batch.column("text").to_pylist()):
                row, node, at = row + 1, 0, 0
                while at < len(text):
                    end = codec(path).cut_at(text, min(len(text), at + leaf))
                    if end <= at:  # a special token longer than the leaf
                        end = at + codec(path).longest_special
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("key").slice(i, 1), pa.array([row]), pa.array([node]), pa.array([text[at:end]])],
                        ["key", "row", "node", "text"],
                    )
                    node, at = node + 1, end

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", IN_HAND):
            ids = codec(path).encode(batch.column("text").to_pylist())
            rest = [batch.column(c) for c in ("key", "row", "node")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(ids, pa.binary())], ["key", "row", "node", "ids"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", IN_HAND):
            left, right = column_bytes(batch, "ids"), column_bytes(batch, "right")
            tree = codec(path)
            ids = [
                tree.join(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")).astype("<u4").tobytes()
                for a, b in zip(left, right, strict=True)
            ]
            rest = [batch.column(c) for c in ("key", "row", "node")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(ids, pa.binary())], ["key", "row", "node", "ids"])

    schema = f"key {kind}, row long, node long, ids binary"
    pieces = docs.mapInArrow(cut, f"key {kind}, row long, node long, text string")
    nodes = materialise(pieces.repartition("row", "node").mapInArrow(leaves, schema), "bpe-leaves")
    last = nodes.agg(F.max("node")).first()[0] or 0
    while last:
        pair = nodes.groupBy("row", (F.col("node") / 2).cast("long").alias("node")).agg(
            F.min("key").alias("key"),
            F.min_by("ids", "node").alias("ids"),
            F.max_by("ids", "node").alias("right"),
            F.count("*").alias("n"),
        )
        alone = pair.where("n = 1").select("key", "row", "node", "ids")
        nodes = materialise(pair.where("n = 2").mapInArrow(joined, schema).union(alone), "bpe-joined")
        last //= 2
    return nodes.select("key", "ids")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``ids`` and their ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", IN_HAND):
            texts = codec(path).decode_all(column_bytes(batch, "ids"))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("ids"), texts], ["key", "ids", "text"])

    slim = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = slim.schema["key"].dataType.simpleString()
    return slim.mapInArrow(run, f"key {kind}, ids binary, text string").withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count, and SHA-256 of the ids and of the decoded text, of every document."""
    back = decode(encode(docs, path), path)
    return back.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary())
