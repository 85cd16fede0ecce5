"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock so date bucketing is stable,
# ANSI semantics (malformed casts fail the job like the warehouse does), and
# adaptive execution so shuffle partition counts, join strategies and skewed
# partitions are re-planned from runtime statistics.
_REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
# Streaming state (watermark dedup) lives in RocksDB so large key sets spill
# to local disk instead of the executor heap. Only applied when the session
# has not chosen a provider (it must stay fixed for a given checkpoint).
_STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


def get_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session configured for the pipeline.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in _REQUIRED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _REQUIRED_CONF.items():
        spark.conf.set(k, v)
    keep_state_on_disk(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names this setting; it is never overridden, and filled in
    here only on a local master. A cluster without it is an error: a folder
    of the driver's own disk would not be seen by the executors.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = os.path.join(os.environ.get("TIDEMARK_LOCAL_ROOT", "/tmp"), "tidemark-checkpoints")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint location (never machine-local)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Keep the state of streams started from now on in RocksDB, its memory
    bounded an executor, unless the session has chosen a provider: the
    default one holds all keys on the executors' heaps."""
    if not spark.conf.get(_STATE_STORE[0], None):
        spark.conf.set(*_STATE_STORE)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.compression", CODEC)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of ``path`` (works for
    HDFS, object stores and local paths alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-folders of ``path`` (metadata listing only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop FileSystem of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Codec of the tables written here: event keys are hexadecimal text, which
#: snappy keeps at full length and zstd halves.
CODEC = "zstd"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings for what starts in here."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_dropped(spark: SparkSession):
    """The shuffle files of a write (or a stream's batch) started in here go
    when it ends. Else they lie on the executors' disks until the driver
    happens to collect its garbage, those of all earlier steps together. Not
    for frames that are collected twice: the second time finds no files."""
    return _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def few_folders(spark: SparkSession):
    """A partitioned write whose tasks have rows of a few folders each keeps
    their files open, where it would sort, and spill, all rows by folder. With
    more folders it sorts the rest."""
    return _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "4"})


def materialize(df, name: str = "materialized"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return the read-back frame: lineage is cut, the result survives
    executor loss, and (unlike ``checkpoint()`` on an unpersisted frame) the
    plan is computed once; later readers get column pruning and pushdown."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
    out = spark.read.parquet(path)
    out._folder = path
    return out


@contextmanager
def kept_for(frame: DataFrame) -> Iterator[DataFrame]:
    """A frame that ``materialize`` gave, for the steps in here; its files go
    after them."""
    try:
        yield frame
    finally:
        delete_path(frame.sparkSession, frame._folder)


def materialized(df: DataFrame, name: str = "materialized"):
    """``materialize`` for the steps of a ``with`` block."""
    return kept_for(materialize(df, name))
