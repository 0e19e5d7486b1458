"""Tables in parts (days or hash buckets), of which a batch reads and replaces only those it touches.

Each commit has a number. It writes its parts below ``data/version=N`` and then, as one small table below
``parts/version=N``, the list of all parts with the commits that hold them, their rows and smallest and
largest time. That list is the commit: a commit that is not whole does not count, and one that is
made again does nothing. The newest list says what to read, so neither the days at hand nor the
newest of them need a scan. What a commit has replaced is deleted two commits later, when nobody who
has read the list before it can still need it.

One job at a time may commit to a table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.session import file_system, materialise

Part = dt.date | int | str


class Parts:
    """A table at ``path`` with the given columns, one of which, ``part``, is the part a row belongs to.

    Tables with bodies name a denser ``compression``; others keep the session's.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, part: str = "dt_date", time: str | None = None,
        compression: str | None = None,
    ) -> None:
        self._options = {"partitionOverwriteMode": "static"} | ({"compression": compression} if compression else {})
        self.spark, self.path, self.schema, self.part, self.time = spark, path.rstrip("/"), schema, part, time
        kind = schema[part].dataType
        when = schema[time].dataType if time else T.TimestampType()
        self._list = T.StructType([
            T.StructField(part, kind), T.StructField("version", T.LongType()), T.StructField("rows", T.LongType()),
            T.StructField("first", when), T.StructField("last", when),
        ])

    # -- commits --------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Numbers of the commits whose lists are kept, oldest first."""
        fs, folder = file_system(self.spark, f"{self.path}/parts")
        if not fs.exists(folder):
            return []
        whole = fs.globStatus(file_system(self.spark, f"{self.path}/parts/version=*/_SUCCESS")[1])
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in whole or ())

    def version(self) -> int | None:
        """The number of the last commit."""
        return max(self.versions(), default=None)

    def made(self, number: int) -> bool:
        """Whether this commit or a later one has been made."""
        last = self.version()
        return last is not None and number <= last

    def parts(self, version: int | None = None) -> DataFrame:
        """The parts with the commits that hold them, their rows and times: some rows a part, from one small file."""
        version = self.version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], self._list)
        return self.spark.read.schema(self._list).parquet(f"{self.path}/parts/version={version}")

    def latest(self) -> Part | None:
        """The largest part that has rows."""
        return self.parts().agg(F.max(self.part)).first()[0]

    # -- reading --------------------------------------------------------------------------------

    def _read(self, listed: Sequence[tuple[Part, int]]) -> DataFrame:
        if not listed:
            return self.spark.createDataFrame([], self.schema)
        held: dict[int, list[Part]] = {}
        for part, version in listed:
            held.setdefault(version, []).append(part)
        kind = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        reader = self.spark.read.schema(kind).option("basePath", f"{self.path}/data")
        if 4 * len(held) > len(listed):
            rows = reader.parquet(*[f"{self.path}/data/version={v}/{self.part}={part}" for part, v in listed])
        else:  # few commits hold many parts each: fewer folders to list, and the parts pruned by a filter
            of = [(F.col("version") == v) & F.col(self.part).isin(parts) for v, parts in held.items()]
            rows = reader.parquet(*[f"{self.path}/data/version={v}" for v in held]).where(reduce(Column.__or__, of))
        return rows.select(self.schema.names)

    def read(self, parts: Sequence[Part] | None = None) -> DataFrame:
        """All rows, or those of some parts. Only their folders are listed."""
        listed = self.parts()
        if parts is not None:
            listed = listed.where(F.col(self.part).isin(list(parts)))
        return self._read([(r[0], r[1]) for r in listed.select(self.part, "version").collect()])

    # -- writing --------------------------------------------------------------------------------

    def _commit(self, rows: DataFrame, number: int, replaced: Sequence[Part]) -> None:
        data = f"{self.path}/data/version={number}"
        rows.select(self.schema.names).hint("rebalance", self.part).write.mode("overwrite").options(
            **self._options
        ).partitionBy(self.part).parquet(data)
        when = [f(self.time).alias(n) if self.time else F.lit(None).cast("timestamp").alias(n) for f, n in ((F.min, "first"), (F.max, "last"))]
        made = self.spark.read.schema(self.schema).parquet(data).groupBy(self.part).agg(F.count("*").alias("rows"), *when)
        made = made.select(self.part, F.lit(number).cast("long").alias("version"), "rows", "first", "last")
        kept = self.parts()
        if replaced:
            kept = kept.where(~F.col(self.part).isin(list(replaced)))
        listed = kept.unionByName(made).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.path}/parts/version={number}")
        self._clean()

    def append(self, rows: DataFrame, number: int) -> bool:
        """Add rows to their parts. Returns whether this commit had not been made before."""
        if self.made(number):
            return False
        self._commit(rows, number, ())
        return True

    def merge(
        self, rows: DataFrame, number: int, combine: Callable[[DataFrame], DataFrame], touched: Sequence[Part] | None = None
    ) -> bool:
        """Replace the parts that ``rows`` touch by what ``combine`` makes of their old and new rows.

        Who knows the parts names them in ``touched``, and gives rows on which ``combine`` alone changes nothing. They are
        then not written twice, and not combined again where none of the parts has old rows.
        """
        if self.made(number):
            return False
        if touched is None:
            new = materialise(rows.select(self.schema.names), "batch")
            touched = parts_of(new, self.part)
            both = combine(self.read(touched).unionByName(new))
        else:
            new, held = rows.select(self.schema.names), self._held(touched)
            both = combine(self.read(touched).unionByName(new)) if held else new
        self._commit(both, number, touched)
        return True

    def _held(self, parts: Sequence[Part]) -> bool:
        """Whether any of these parts has rows."""
        key = F.col(self.part)
        asked = reduce(Column.__or__, [key.eqNullSafe(F.lit(part)) for part in parts], F.lit(False))
        return bool(self.parts().where(asked).limit(1).count())

    def replace(self, rows: DataFrame, number: int) -> bool:
        """Replace the parts that ``rows`` touch by these rows."""
        if self.made(number):
            return False
        new = materialise(rows.select(self.schema.names), "batch")
        self._commit(new, number, parts_of(new, self.part))
        return True

    def _clean(self) -> None:
        """Delete the lists older than the last two, and the data that only those name."""
        versions = self.versions()
        if len(versions) < 3:
            return
        key = [self.part, "version"]
        kept = self.parts(versions[-1]).unionByName(self.parts(versions[-2])).select(key)
        named = lambda v: self.parts(v).select(key).join(kept, key, "left_anti").collect()
        for old in versions[:-2]:
            for part, version in named(old):
                fs, folder = file_system(self.spark, f"{self.path}/data/version={version}/{self.part}={part}")
                fs.delete(folder, True)
            fs, folder = file_system(self.spark, f"{self.path}/parts/version={old}")
            fs.delete(folder, True)


def bucket(key: Column, buckets: int) -> Column:
    """The hash bucket of a key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def parts_of(rows: DataFrame, part: str | Column) -> list[Part]:
    """The parts that rows lie in, which are as few as a table has parts."""
    return [r[0] for r in rows.select(part).distinct().collect()]


#: Hash buckets of a day in a ledger of ids.
LEDGER_BUCKETS = 4

_LEDGER = T.StructType([T.StructField("id", T.StringType()), T.StructField("slot", T.StringType())])


def slot(day: Column, ident: Column) -> Column:
    """The part of a ledger that an id of a day lies in."""
    return F.concat_ws("_", day, bucket(ident, LEDGER_BUCKETS).cast("string"))


def id_ledger(spark: SparkSession, path: str) -> Parts:
    """The ids that a table holds, in hash buckets of each day, so that new rows meet those of their days and buckets only."""
    return Parts(spark, path, _LEDGER, "slot")
