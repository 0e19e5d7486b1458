"""Reading tables and text columns, shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.session import materialise

#: Rows that pass through Python together hold at most this many bytes of text, or one longer text.
SLICE_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of ``SLICE_BYTES``; Spark's own bound would keep eight times as much in hand."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES))


@lru_cache(1)
def _trim():
    """The C library's way to give freed memory back to the system, where it has one."""
    name = ctypes.util.find_library("c")
    return getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None


def give_back() -> None:
    """Return the memory that a task has freed: a worker serves many tasks, and stays as large as its largest."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` with a column that names each row by its file and its place there, the same at every reading."""
    name = spare_name(docs, "row")
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return docs.withColumn(name, place), name
    except AnalysisException:  # not read from files
        return materialise(docs, label).withColumn(name, place), name


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of column ``name``, or of one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(name)).fill_null(0).to_pylist()
        first = total = 0
        for i, size in enumerate(sizes):
            if i > first and total + size > limit:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += size
        if first < len(sizes):
            yield batch.slice(first)
    give_back()
