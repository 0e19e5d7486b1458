"""Spans that patterns find in texts, as columns and rows: offsets in code points, and redaction.

Only native expressions. The pieces between matches and the matches themselves give every offset by
addition; the sums run over the matches of one text, never over its characters one by one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palaver.session import materialise

#: Characters before and after a match that are kept as its context.
CONTEXT = 32


def located(docs: DataFrame, patterns: Mapping[str, str], key: str, text: str, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One stored row per document: ``row``, ``key``, ``carry`` and the matches of every pattern in order, with their gaps."""
    extra = carry or {}
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.coalesce(text, F.lit("")).alias("text"),
        *[c.alias(name) for name, c in extra.items()],
    )
    cut = rows.select(
        "*",
        *[F.split("text", p, -1).alias(f"gaps_{g}") for g, p in patterns.items()],
        *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"found_{g}") for g, p in patterns.items()],
    )

    def zipped(g: str) -> Column:
        gaps = F.col(f"gaps_{g}")
        return F.transform(
            f"found_{g}",
            lambda m, i: F.struct(
                F.lit(g).alias("generator"),
                i.alias("i"),
                F.char_length(F.get(gaps, i)).alias("gap"),
                m.alias("match"),
                F.right(F.concat(F.coalesce(F.get(F.col(f"found_{g}"), i - 1), F.lit("")), F.get(gaps, i)), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after"),
            ),
        )

    return materialise(
        cut.select("row", "key", *extra, F.concat(*[zipped(g) for g in patterns]).alias("found")), "spans"
    )


def candidates(rows: DataFrame, *carry: str) -> DataFrame:
    """One row per match: ``row, generator, match, before, after, start, end`` and ``carry``."""
    each = rows.select("row", *carry, F.inline("found")).withColumn("size", F.char_length("match"))
    so_far = Window.partitionBy("row", "generator").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    return each.withColumn("end", end).select(
        "row", *carry, "generator", "match", "before", "after", (F.col("end") - F.col("size")).alias("start"), "end"
    )


def joined(spans: str, kind: str = "kind") -> Column:
    """``kind:start:end`` of an array of spans, comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s[kind], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, sign: Column) -> Column:
    """``text`` with each of the disjoint, sorted ``spans`` (``start, end``) replaced by ``sign``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    walked = F.aggregate(
        spans,
        start,
        lambda acc, s: F.struct(
            s["end"].cast("long").alias("at"),
            F.concat(acc["parts"], F.array(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), sign)).alias("parts"),
        ),
    )
    rest = F.substring(text, (walked["at"] + 1).cast("int"), F.char_length(text))
    return F.concat(F.array_join(walked["parts"], ""), rest)


def disjoint(spans: Column) -> Column:
    """Sorted spans with overlapping ones merged."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        span = F.struct(s["start"].cast("bigint").alias("start"), s["end"].cast("bigint").alias("end"))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (span["start"] < F.try_element_at(acc, F.lit(-1))["end"]), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))).otherwise(
            F.concat(acc, F.array(span))
        )

    return F.aggregate(spans, none, step)
