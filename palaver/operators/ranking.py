"""Top-k lists, and running totals that never hold a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palaver.session import materialise


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, position: str = "position") -> DataFrame:
    """The first ``k`` rows of every group with their position.

    Spark limits by rank before the shuffle, so a group sends at most ``k`` rows per task.
    """
    if by:
        ranked = df.withColumn(position, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        return ranked.where(F.col(position) <= k)
    first = df.orderBy(*order).limit(k)
    return first.withColumn(position, F.row_number().over(Window.orderBy(*order)))


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, ascending: Sequence[bool], out: str = "running"
) -> DataFrame:
    """Sum of ``value`` over the rows up to and including each row of its group.

    Rows are range-partitioned by group and order, which spreads a large group over many
    tasks. Each piece is summed on its own; the totals of the earlier pieces, one row per
    group and piece, are then added. ``order`` must be total within a group.
    """
    keys = [F.asc(c) for c in by] + [F.asc(c) if up else F.desc(c) for c, up in zip(order, ascending, strict=True)]
    pieces = materialise(
        df.repartitionByRange(*keys).withColumn("_piece", F.spark_partition_id()), "running-total"
    )
    inside = Window.partitionBy(*by, "_piece").orderBy(*keys[len(by):])
    local = pieces.withColumn(
        "_inside", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    totals = pieces.groupBy(*by, "_piece").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_piece", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before")
    )
    return local.join(offsets, [*by, "_piece"]).select(
        *[F.col(c) for c in df.columns], (F.col("_inside") + F.col("_before")).alias(out)
    )
