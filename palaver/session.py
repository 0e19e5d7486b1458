"""Session settings, and tables written to the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "palaver", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` entries win over the defaults.

    Dotted names are passed through a dict: ``build_session(**{"spark.executor.memory": "8g"})``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Days and hours are cut from UTC wall time, so the session must run in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for streams on the same cluster, with one state partition per core.

    The first batch of a streaming query fixes its number of state partitions, and the runtime
    cannot merge small ones as it does in batch jobs, so the number should follow the cluster.
    """
    session = use_utc(spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: what the session names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster
    the setting is required, because a folder of one machine is lost with that machine.
    """
    named = spark.conf.get(_CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="palaver-")
    return _local_dirs[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/palaver/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete all tables that this application has written below the shared folder, when nothing reads them any more."""
    fs, folder = file_system(spark, f"{shared_dir(spark)}/palaver/{spark.sparkContext.applicationId}")
    fs.delete(folder, True)


#: Parquet as large as its values: for rows of numbers that compress well and take far more memory than disk.
PLAIN = {"compression": "none", "parquet.enable.dictionary": "false"}


def stored(df: DataFrame, label: str, partition_by: Sequence[str] = (), options: Mapping[str, str] = {}) -> str:
    """Write ``df`` as Parquet in the shared folder; returns its path."""
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return path


def materialise(df: DataFrame, label: str, partition_by: Sequence[str] = (), options: Mapping[str, str] = {}) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and gives later joins a real size
    to choose their strategy by: that of the files, so of ``PLAIN`` ones where others would be too small.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stored(df, label, partition_by, options))


def file_system(spark: SparkSession, path: str):
    """Spark's handle of the store that ``path`` lies in, and the path as that store names it."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()), named
