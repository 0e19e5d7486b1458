"""License notices by an exact set-similarity join of text blocks with templates.

A text is cut into blocks of words that overlap by the length of the longest template, so any stretch
that long lies whole in a block. A block meets a template if it holds at least a given part of the
template's words. Words are ordered by the number of blocks they occur in, rarest first, counted over
all blocks. In that order, a block and a template that share ``least`` words share one among the first
``size - least + 1`` of each (prefix filter); a block needs ``least`` words (length filter); and the words that
can still follow the first one they share must suffice (positional filter). What is left is verified.
Only words of templates are kept of a block, which changes no shared word. The join is an equality join
of prefix words with the templates' prefixes, and each pair is kept at the first word it shares, so pairs
come once without a further shuffle.

An exact template also has to stand in the block word after word; its places are counted by the block in
whose first part (before the overlap) they begin, so each counts once.

All of it is DataFrame code. The templates are a parameter of at most ``MAX_TEMPLATE_WORDS`` words, so they
and the counts of their words are small at any size of the corpus; nothing else is broadcast or collected.

Null and empty texts have no words and no blocks. Very long texts become many blocks and are spread by the
join. Rows are numbered, so repeated ids, repeated rows and null ids have a result each; further columns play no part, whatever
their names. Words as frequent as each other go by name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import table
from palaver.session import materialise

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII characters that are no part of a word; all others are.
BREAKS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: Words by which the starts of neighbouring blocks are apart.
STRIDE = 64
#: Percent of a template's distinct words that a block must hold.
THRESHOLD = 80
MAX_TEMPLATE_WORDS = 10_000


@dataclass(frozen=True)
class Template:
    """An exact template counts only where its words stand one after the other."""

    label: str
    text: str
    exact: bool = False


PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
#: Sentences of well-known licenses and of the notices that name them.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("gpl-3", "licensed under the gnu general public license version 3"),
    Template("gpl", "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("lgpl", "free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial international license"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike international license"),
)
TEMPLATES = PHRASES + NOTICES


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    spaced = F.translate(F.coalesce(text, F.lit("")), CAPITALS + BREAKS, CAPITALS.lower() + " " * len(BREAKS))
    return F.array_remove(F.split(spaced, " "), "")


def _plain_words(text: str) -> list[str]:
    return text.lower().split()


def blocks(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, key: str = "doc_id", text: str = "text", stride: int = STRIDE
) -> DataFrame:
    """``row, key, n_words, blocks`` of every document, stored.

    ``blocks`` are the blocks that hold words of templates, each with its number and those words' places.
    """
    vocabulary = sorted({w for t in templates for w in _plain_words(t.text)})
    longest = max(len(_plain_words(t.text)) for t in templates)
    if sum(len(_plain_words(t.text)) for t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    n = F.size("words")

    def block(b: Column) -> Column:
        first = b * F.lit(stride)
        placed = F.transform(
            F.slice("words", first + 1, F.lit(stride + longest - 1)), lambda w, i: F.struct((first + i).alias("at"), w.alias("word"))
        )
        return F.struct(b.alias("block"), F.filter(placed, lambda h: h["word"].isin(vocabulary)).alias("hits"))

    numbers = F.sequence(F.lit(0), F.floor((n - 1) / stride).cast("int"))
    found = F.when(n > 0, F.filter(F.transform(numbers, block), lambda b: F.size(b["hits"]) > 0))
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), words_of(F.col(text)).alias("words"))
    return materialise(slim.select("row", "key", n.cast("long").alias("n_words"), found.alias("blocks")), "license-blocks")


def _exploded(rows: DataFrame) -> DataFrame:
    return rows.select("row", F.explode("blocks").alias("b")).select("row", F.col("b.block").alias("block"), F.col("b.hits").alias("hits"))


def word_order(rows: DataFrame, templates: Sequence[Template] = TEMPLATES) -> list[str]:
    """The words of the templates by the number of blocks that hold them, rarest first."""
    words = F.explode(F.array_distinct("hits.word")).alias("word")
    counted = {r["word"]: r["n"] for r in _exploded(rows).select(words).groupBy("word").agg(F.count("*").alias("n")).collect()}
    vocabulary = {w for t in templates for w in _plain_words(t.text)}
    return sorted(vocabulary, key=lambda w: (counted.get(w, 0), w))


def _least(template: Template, size: int, threshold: int) -> int:
    return size if template.exact else -(-threshold * size // 100)


def _prefixes(spark: SparkSession, templates: Sequence[Template], order: Sequence[str], threshold: int) -> DataFrame:
    """A row for each word of each template's prefix."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, template in enumerate(templates):
        ordered = sorted(set(_plain_words(template.text)), key=rank.__getitem__)
        least = _least(template, len(ordered), threshold)
        sequence = _plain_words(template.text) if template.exact else None
        for i, word in enumerate(ordered[: len(ordered) - least + 1]):
            rows.append((word, number, template.label, sequence, ordered, len(ordered), least, i))
    return spark.createDataFrame(
        rows, "word string, template int, label string, sequence array<string>, ordered array<string>, size int, least int, i int"
    )


def _places(hits: Column, sequence: Column, block: Column, stride: int) -> Column:
    """Where ``sequence`` stands word after word and begins in the block's own part."""
    follows = lambda h: F.forall(
        F.transform(sequence, lambda w, i: F.struct((h["at"] + i).alias("at"), w.alias("word"))), lambda s: F.array_contains(hits, s)
    )
    own = lambda h: (h["word"] == F.element_at(sequence, 1)) & (h["at"] < (block + 1) * stride)
    return F.transform(F.filter(F.filter(hits, own), follows), lambda h: h["at"])


def matches(
    rows: DataFrame, templates: Sequence[Template] = TEMPLATES, threshold: int = THRESHOLD, stride: int = STRIDE
) -> DataFrame:
    """``row, block, template, label, containment, places``: every block that meets a template.

    ``rows`` are from ``blocks`` with the same templates and stride. ``places`` are word numbers, for exact templates only.
    """
    order = word_order(rows, templates)
    prefixes = _prefixes(rows.sparkSession, templates, order, threshold)
    fewest = min(_least(t, len(set(_plain_words(t.text))), threshold) for t in templates)
    ordered = F.array_intersect(F.array(*[F.lit(w) for w in order]), F.col("hits.word"))
    # in two steps, so that the intersection is made once
    held = _exploded(rows).select("row", "block", "hits", ordered.alias("held")).where(F.size("held") >= fewest)
    n = F.size("held")
    asked = held.select("row", "block", "hits", "held", F.posexplode(F.slice("held", F.lit(1), n - fewest + 1)).alias("j", "word"))
    rest = F.least(F.col("size") - F.col("i") - 1, n - F.col("j") - 1)
    candidates = asked.join(F.broadcast(prefixes), "word").where(
        (n >= F.col("least")) & (F.col("j") <= n - F.col("least")) & (rest + 1 >= F.col("least"))
    )
    shared = candidates.withColumn("shared", F.array_intersect("ordered", "held"))
    verified = shared.where((F.size("shared") >= F.col("least")) & (F.element_at("shared", 1) == F.col("word")))
    exact = F.col("sequence").isNotNull()
    places = F.when(exact, _places(F.col("hits"), F.col("sequence"), F.col("block"), stride))
    return verified.select(
        "row", "block", "template", "label", (F.size("shared") / F.col("size")).alias("containment"), places.alias("places")
    ).where(~F.coalesce(F.size("places") == 0, F.lit(False)))


def scan(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, threshold: int = THRESHOLD, key: str = "doc_id", text: str = "text",
    stride: int = STRIDE,
) -> DataFrame:
    """One row per document: ``key, n_words``, the places of exact templates and the labels found.

    ``score`` is the largest containment of a template that was met, 0 where none was.
    """
    rows = blocks(docs, templates, key, text, stride)
    placed = F.when(F.col("places").isNotNull(), F.col("label"))
    joined = lambda labels: F.array_join(F.array_sort(F.collect_set(labels)), ",")
    found = matches(rows, templates, threshold, stride).groupBy("row").agg(
        F.sum(F.size(F.coalesce("places", F.array().cast(T.ArrayType(T.IntegerType()))))).cast("long").alias("n_base"),
        F.min(F.array_min("places")).cast("long").alias("first_word"),
        F.max(F.array_max("places")).cast("long").alias("last_word"),
        joined(placed).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("containment").alias("score"),
    )
    plain = rows.select("row", "key", "n_words").join(found, "row", "left")
    return plain.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """All blocks against all templates, one by one."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ",\n  ".join(
        f"({i}, '{t.label}', {quoted(sorted(set(_plain_words(t.text))))}, {quoted(_plain_words(t.text))}, {str(t.exact).lower()})"
        for i, t in enumerate(TEMPLATES)
    )
    longest = max(len(_plain_words(t.text)) for t in TEMPLATES)
    return rf"""
WITH templates(template, label, held, sequence, exact) AS (VALUES
  {rows}
),
words AS (
  SELECT row_number() OVER () AS doc, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
cut AS (SELECT doc, words, unnest(generate_series(0, (len(words) - 1) // {STRIDE})) * {STRIDE} AS start FROM words WHERE len(words) > 0),
met AS (
  SELECT doc, start, label, exact, sequence, list_slice(words, start + 1, start + {STRIDE + longest - 1}) AS block,
    len(list_intersect(list_slice(words, start + 1, start + {STRIDE + longest - 1}), held)) AS shared, len(held) AS size
  FROM cut CROSS JOIN templates
),
placed AS (
  SELECT doc, label, exact, shared / size AS containment, CASE WHEN exact THEN list_transform(
      list_filter(range(1, {STRIDE + 1}), lambda i: list_slice(block, i, i + len(sequence) - 1) = sequence), lambda i: start + i - 1) END AS places
  FROM met WHERE CASE WHEN exact THEN shared = size ELSE 100 * shared >= {THRESHOLD} * size END
),
found AS (
  SELECT doc, sum(CASE WHEN exact THEN len(places) ELSE 0 END) AS n_base, min(list_min(places)) AS first_word, max(list_max(places)) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(containment) AS score
  FROM placed WHERE NOT exact OR len(places) > 0 GROUP BY doc
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM words LEFT JOIN found USING (doc)"""


OP12_SQL = _sql()
