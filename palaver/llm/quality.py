"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of 100 words. Every passage is encoded: figures of its bytes and
words, standardised, go through a learned layer. A gated attention network, learned from document
labels only, weighs the passages, and the weighted mean of their codes gives the score.

The model is fitted on a bounded sample of labelled rows: at most ``per_class`` documents of each
label, first by a hash of their id, none of more than ``max_passages`` passages. Everything else
covers all documents and whole texts.

A null text is an empty one: a bag of one passage whose figures are zero, with a score like any
other. Label rows with a null label, or of ids without a document, are not learned from; of
documents that repeat an id one is learned from, all are scored. With labels of one kind only the
score is that label throughout, without labels 0.5. All columns pass through ``score`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import column_bytes, slices, spare_name, table
from palaver.session import materialise

PASSAGE_WORDS = 100
PER_CLASS = 2000
MAX_PASSAGES = 64
#: Size of the hashed histogram of neighbouring bytes.
PAIRS = 48
CODE, GATE = 16, 8

_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".,;:'\"()?-",
    b"!",
    b"|",
    b"#*$%&<>@=+_/\\~^{}[]`",
    bytes(range(0x80, 0x100)),
)
_CLASS_OF = np.zeros((256, len(_CLASSES)), np.float32)
for _i, _class in enumerate(_CLASSES):
    _CLASS_OF[list(_class), _i] = 1
FIGURES = len(_CLASSES) + 6 + PAIRS


def passages(text: bytes) -> np.ndarray:
    """The figures of every passage of a text, one row each."""
    words = text.split()
    if not words:
        return np.zeros((1, FIGURES), np.float32)
    n = -(-len(words) // PASSAGE_WORDS)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    of_word = np.arange(len(words)) // PASSAGE_WORDS
    count = np.bincount(of_word, minlength=n)
    data = np.frombuffer(b"".join(words), np.uint8)
    of_byte = np.repeat(of_word, lengths)
    size = np.bincount(of_byte, minlength=n)
    histogram = np.bincount(of_byte * 256 + data, minlength=n * 256).reshape(n, 256)
    pair = (data[:-1].astype(np.int64) * 31 + data[1:] * 17) % PAIRS
    pairs = np.bincount(of_byte[1:] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS)
    distinct = np.bincount(np.unique(of_word * len(numbers) + ids) // len(numbers), minlength=n)
    same = np.bincount(of_word[1:], ids[1:] == ids[:-1], minlength=n)
    _, which, often = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True, return_counts=True)
    again = np.bincount(of_word[1:], often[which] > 1, minlength=n)
    spread = np.sqrt(np.maximum(0, np.bincount(of_word, lengths**2, minlength=n) / count - (size / count) ** 2))
    return np.column_stack(
        [
            histogram @ _CLASS_OF / size[:, None],
            size / count / 10,
            spread / 10,
            distinct / count,
            same / count,
            again / count,
            np.log1p(count) / 5,
            pairs / size[:, None] * 10,
        ]
    ).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Encoder ``w, b``; attention ``v, u, a``; output ``c``; or a ``constant`` score."""

    constant: float | None = None
    mean: np.ndarray = field(default_factory=lambda: np.zeros(FIGURES, np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.ones(FIGURES, np.float32))
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """All layers for passages ``x`` of bags that begin at ``starts``."""
        w = self.weights
        sizes = np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        h = np.tanh((x - self.mean) / self.scale @ w["w"] + w["b"])
        t, s = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
        e = (t * s) @ w["a"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        attention = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(attention[:, None] * h, starts, axis=0)
        return {"bag": bag, "h": h, "t": t, "s": s, "attention": attention, "z": z, "p": _sigmoid(z @ w["c"] + w["c0"])}

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        bags = [passages(t) for t in texts]
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        return self.forward(np.concatenate(bags), starts)["p"].astype(np.float64)


def train(bags: list[np.ndarray], labels: np.ndarray, rounds: int = 250, rate: float = 0.02, decay: float = 1e-3) -> Model:
    """Full-batch Adam on the log loss of the bags, both classes with equal weight."""
    if len(set(labels.tolist())) < 2:
        return Model(constant=float(labels[0]) if len(labels) else 0.5)
    x = np.concatenate(bags)
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    rng = np.random.default_rng(0)
    draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
    model = Model(
        mean=x.mean(axis=0),
        scale=x.std(axis=0) + np.float32(1e-2),
        weights={"w": draw(FIGURES, CODE), "b": np.zeros(CODE, np.float32), "v": draw(CODE, GATE), "u": draw(CODE, GATE),
                 "a": draw(GATE), "c": draw(CODE), "c0": np.zeros(1, np.float32)},
    )
    y = labels.astype(np.float32)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()).astype(np.float32)
    seen = (x - model.mean) / model.scale
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for step in range(1, rounds + 1):
        w, f = model.weights, model.forward(x, starts)
        bag, h, t, s = f["bag"], f["h"], f["t"], f["s"]
        out = (f["p"] - y) * share
        dz = out[:, None] * w["c"]
        toward = (dz[bag] * h).sum(axis=1)
        de = f["attention"] * (toward - np.add.reduceat(f["attention"] * toward, starts)[bag])
        dg = de[:, None] * w["a"]
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = (f["attention"][:, None] * dz[bag] + dt @ w["v"].T + ds @ w["u"].T) * (1 - h * h)
        slope = {"w": seen.T @ dh, "b": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ ds, "a": (t * s).T @ de,
                 "c": f["z"].T @ out, "c0": out.sum(keepdims=True)}
        for k in w:
            g = slope[k] + decay * w[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = (w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def remainder(key: str, n: int) -> Column:
    """CRC-32 of an id as text, modulo ``n``; a null id counts as empty text, whose CRC is 0."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    learn_from: Column | None = None,
    per_class: int = PER_CLASS,
    max_passages: int = MAX_PASSAGES,
) -> Model:
    """A model of ``label`` (0 or 1) from at most ``per_class`` documents of each label.

    The sample is at most ``2 * per_class * max_passages`` rows of figures on the driver.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key is not null")
    if learn_from is not None:
        known = known.where(learn_from)
    # an id with both labels says nothing
    known = known.where("label in (0, 1)").groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
    known = known.where("label = _most").drop("_most")
    picked = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(per_class)
        picked = part if picked is None else picked.union(part)
    picked = materialise(picked, "mil-sample")

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bags = [passages(x) for x in column_bytes(batch, "text")]
            rows = [x.astype("<f4").tobytes() if len(x) <= max_passages else None for x in bags]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array(rows, pa.binary())], ["key", "label", "figures"]
            )

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # at most 2 * per_class ids
    sampled = slim.join(F.broadcast(picked), "key")
    kind = sampled.schema["key"].dataType.simpleString()
    rows = (
        sampled.select("key", "label", "text")
        .mapInArrow(figures, f"key {kind}, label int, figures binary")
        .where("figures is not null")
        .groupBy("key")
        .agg(F.min(F.struct("label", "figures")).alias("row"))
        .select("key", "row.*")
        .collect()
    )
    rows = sorted(rows, key=lambda r: str(r["key"]))
    bags = [np.frombuffer(r["figures"], "<f4").reshape(-1, FIGURES) for r in rows]
    return train(bags, np.array([r["label"] for r in rows]))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs``, and the score (0 to 1) as ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = shared.value.scores(column_bytes(batch, text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def fitted(spark: SparkSession, sf_dir: str, docs: DataFrame) -> Model:
    """The model of the contract: labels of ids whose CRC modulo 5 is not 0."""
    return fit(docs, table(spark, sf_dir, "labels"), learn_from=remainder("key", 5) != 0)


def keep_good(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The documents that the model does not reject, with their own columns."""
    out = spare_name(docs, "score")
    return score(docs, model, out=out).where(F.col(out) >= least).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fitted(spark, sf_dir, docs))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )
