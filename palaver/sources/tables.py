"""Comment tables: day-partitioned Parquet, JSON days, first-row-wins inserts and JDBC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.operators.clean import first_by_id
from palaver.functions.times import first_day, thread_day
from palaver.schema import COMMENT, COMMENT_JSON
from palaver.session import materialise
from palaver.sources.arrays import read_arrays
from palaver.sources.parts import Parts, id_ledger, parts_of, slot


#: How stored days are compressed, by format. Spark's own choices are larger: nothing for JSON, Snappy for Parquet.
COMPRESSION = {"parquet": {"compression": "zstd"}, "json": {"compression": "gzip"}}


def _with_day_field(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("dt_date", T.DateType())])


def with_day(comments: DataFrame) -> DataFrame:
    """Add the thread day, the partition column of every stored table."""
    return comments.withColumn("dt_date", thread_day(F.col("created_utc")))


def write_days(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the days that occur in ``df``; other days at ``path`` stay.

    Rows are spread by day and a few salts first, so that a day is neither one task nor
    thousands of small files; a day far above the others is split further by the runtime.
    """
    (
        df.hint("rebalance", "dt_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**COMPRESSION.get(fmt, {}))
        .partitionBy("dt_date")
        .format(fmt)
        .save(path)
    )


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """All days of a stored comment table; filters on ``dt_date`` prune partitions."""
    return spark.read.schema(_with_day_field(COMMENT)).parquet(path)


def decode(rows: DataFrame) -> DataFrame:
    """Epoch seconds to timestamps."""
    micros = F.round(F.col("created_utc") * 1000000).cast("bigint")
    return rows.withColumn("created_utc", F.timestamp_micros(micros))


def encode(rows: DataFrame) -> DataFrame:
    """Timestamps to epoch seconds, with their fraction."""
    return rows.withColumn("created_utc", F.unix_micros("created_utc") / F.lit(1000000.0))


def read_json_arrays(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Days stored as one JSON array per file; the path may be a glob over days."""
    return decode(spark.read.schema(COMMENT_JSON).option("multiLine", True).json(path))


def read_split_arrays(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """As ``read_json_arrays``, for days so large that one file is work for many tasks."""
    return decode(read_arrays(spark, path, COMMENT_JSON))


def read_json_days(spark: SparkSession, path: str) -> DataFrame:
    """Days stored as JSON lines below ``dt_date=`` folders."""
    return decode(spark.read.schema(_with_day_field(COMMENT_JSON)).json(path))


def write_json_days(comments: DataFrame, path: str) -> None:
    """JSON lines per day. Unlike one array per day, a large day can be many files."""
    write_days(encode(comments), path, "json")


def from_json_column(rows: DataFrame, column: str) -> DataFrame:
    """Comments held as JSON text in a column."""
    parsed = rows.select(F.from_json(F.col(column), COMMENT_JSON).alias("c")).select("c.*")
    return decode(parsed)


def latest_day(comments: DataFrame) -> Column:
    """The newest day as a scalar subquery; ``Parts.parts`` tells it from a few rows, comments by a scan of all days."""
    return comments.select(F.max("dt_date")).scalar()


def last_days(comments: DataFrame, days: int, latest: dt.date | Column | None = None) -> DataFrame:
    """The ``days`` days that end at the latest (or the given) day."""
    end = latest_day(comments) if latest is None else latest if isinstance(latest, Column) else F.lit(latest)
    return comments.where(F.col("dt_date").between(first_day(end, F.lit(days)), end))


def of_days(comments: DataFrame, days: dt.date | Sequence[dt.date] | None = None, latest: Column | None = None) -> DataFrame:
    """One day, several, or by default the latest; days without rows give none."""
    if not days:
        return comments.where(F.col("dt_date") == (latest_day(comments) if latest is None else latest))
    wanted = [days] if isinstance(days, dt.date) else list(days)
    return comments.where(F.col("dt_date").isin(wanted))


def falsy_to_null(rows: DataFrame) -> DataFrame:
    """Empty text, zero and empty lists become NULL, as an insert that omits them leaves it."""
    empty = {"string": F.lit(""), "int": F.lit(0), "bigint": F.lit(0)}

    def blanked(name: str, kind: str) -> Column:
        if kind.startswith("array"):
            return F.when(F.size(name) > 0, F.col(name)).alias(name)
        return F.nullif(F.col(name), empty[kind]).alias(name) if kind in empty else F.col(name)

    return rows.select(*[blanked(name, kind) for name, kind in rows.dtypes])


def rows_to_insert(rows: DataFrame, target: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows whose id is not in ``target``; of rows with one id the first by ``order``."""
    return first_by_id(rows, order).join(target.select("id"), "id", "left_anti")


def insert_new(rows: DataFrame, path: str, order: Sequence[str], falsy_as_null: bool = False) -> None:
    """Append the rows with new ids to the comment table at ``path``; stored rows win.

    The ids of all days are looked up, because an id may have been stored under another day.
    """
    spark = rows.sparkSession
    new = rows_to_insert(rows, spark.read.schema(rows.schema).parquet(path), order)
    new = falsy_to_null(new) if falsy_as_null else new
    new.hint("rebalance", "dt_date").write.mode("append").partitionBy("dt_date").parquet(path)


def comment_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> tuple[Parts, Parts]:
    """A table of comments by day, and the ledger of its ids, both in parts."""
    days = Parts(spark, f"{path}/comments", schema or _with_day_field(COMMENT), "dt_date", "created_utc", "zstd")
    return days, id_ledger(spark, f"{path}/ids")


def _slotted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("slot", slot(F.col("dt_date"), F.col("id")))


def unknown_rows(rows: DataFrame, ledger: Parts, order: Sequence[str]) -> DataFrame:
    """Rows whose id the ledger does not have; of rows with one id the first by ``order``, then by day.

    Reads the parts of the ledger that the rows lie in. A comment's day, that of its making, never changes. The parts
    are found without the other columns. One exchange by id serves the choice of the first and the lookup, so bodies are moved once.
    """
    order = [*order, *({"dt_date"} - set(order))]
    first = _slotted(first_by_id(rows, order))
    asked = parts_of(_slotted(first_by_id(rows.select("id", *order), order)), "slot")
    known = ledger.read(asked).groupBy("id").agg(F.collect_set("slot").alias("_slots"))
    found = F.coalesce(F.array_contains("_slots", F.col("slot")), F.lit(False))
    return first.join(known, "id", "left").where(~found).select(rows.columns)


def insert(rows: DataFrame, table: tuple[Parts, Parts], number: int, order: Sequence[str], falsy_as_null: bool = False) -> None:
    """Append the rows with new ids to a ``comment_table``; stored rows win.

    Rows are committed before their ids: an insert that is run again after the first of the two finds the same ids
    new, but its rows stored.
    """
    days, ledger = table
    if ledger.made(number):
        return
    keys = rows.select(*dict.fromkeys(["id", "dt_date", *order]))
    ids = materialise(_slotted(unknown_rows(keys, ledger, order)).select("id", "slot"), "inserted")
    new = unknown_rows(rows, ledger, order)
    days.append(falsy_to_null(new) if falsy_as_null else new, number)
    ledger.merge(ids, number, lambda both: both)


def read_query(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Result of a query that a database runs. Needs that database's JDBC driver."""
    return spark.read.format("jdbc").options(url=url, query=query, **(properties or {})).load()


def insert_new_jdbc(
    rows: DataFrame, url: str, table: str, order: Sequence[str], properties: dict[str, str] | None = None
) -> None:
    """As ``insert_new``, into a database table."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    target = rows.sparkSession.read.format("jdbc").options(**options).load()
    rows_to_insert(rows, target, order).write.format("jdbc").options(**options).mode("append").save()
