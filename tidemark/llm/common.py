"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import delete_path, ensure_checkpoint_dir, scratch_dir

# A word is a maximal run of bytes other than space and \x09-\x0D. Python's
# bytes.split() cuts at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
# Rows per Arrow batch sent to Python. Texts can be long, so a batch of the
# default 10,000 rows could be far larger than a worker's memory share.
ARROW_ROWS = 512
ARROW_BYTES = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once an application, unless
    their PYTHONPATH already holds it."""
    package = Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    paths = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if app in _SHIPPED or str(package.parent) in paths:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*")):
            if f.suffix in (".py", ".json"):
                z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> None:
    """Session settings of the corpus operators: a shared checkpoint folder,
    the package on the workers, and small Arrow batches (``ARROW_ROWS``)."""
    ensure_checkpoint_dir(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


_RELEASED = [0.0]


def lean(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function after whose last row the worker hands its freed
    memory back: workers are reused, and what an idle one keeps counts
    against its executor in every later step."""

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Hand freed memory of this process back to the system: a model's
    training data would else stay with the driver for the rest of the job."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps: it
    does so once the driver's garbage collector has met them, which on a
    quiet driver can take longer than the whole job."""
    if time.monotonic() - _RELEASED[0] > 2:
        gc.collect()
        give_back()
        spark.sparkContext._jvm.System.gc()
        _RELEASED[0] = time.monotonic()


_MADE: list[str] = []


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.parquet(path)
    out._folder = path
    _MADE.append(path)
    release(spark)
    return out


def discard(*stored: DataFrame) -> None:
    """Delete the folders of stored tables whose last reader has been
    written, so that a job's disk holds what it still needs."""
    for df in stored:
        path = df.__dict__.pop("_folder", None)
        if path:
            delete_path(df.sparkSession, path)


@contextlib.contextmanager
def folders():
    """Gathers the folders that ``store`` makes inside the block."""
    start, found = len(_MADE), []
    try:
        yield found
    finally:
        found += _MADE[start:]
        del _MADE[start:]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(col: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null stays null)."""
    return F.pmod(F.crc32(F.encode(col.cast("string"), "UTF-8")), F.lit(modulus))


def text_key(text: Column) -> Column:
    """Tells rows apart that share a doc_id; equal rows share the key."""
    return F.xxhash64(text, text.isNull())


def word_array(text: Column) -> Column:
    """The words of a text as a Spark expression. Splitting takes one pass;
    Java's regexp_count and regexp_extract_all copy the text at each match."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def shield(df: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``df`` under column names that meet no working column, the new name
    of each column, and the way back to the own names."""
    names = df.columns
    new = {c: f"own_{i}" for i, c in enumerate(names)}
    return df.toDF(*new.values()), new, lambda out: out.select(*[F.col(n).alias(c) for c, n in new.items()])


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads a polynomial hash over all 64 bits."""
    out = h >> np.uint64(30)
    out ^= h
    out *= np.uint64(0xBF58476D1CE4E5B9)
    part = out >> np.uint64(27)
    out ^= part
    out *= np.uint64(0x94D049BB133111EB)
    np.right_shift(out, np.uint64(31), out=part)
    out ^= part
    return out


_P = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive units (uint64, mod 2**64)."""
    n = len(units) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = units[:n].copy()
    for i in range(1, k):
        h *= _P
        h += units[i : n + i]
    return mix(h)


def binary_list(col: pa.Array) -> list[bytes]:
    """Rows of a string or binary column as bytes, null as empty."""
    if not pa.types.is_binary(col.type):
        col = col.cast(pa.binary())
    return [x or b"" for x in col.to_pylist()]


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """Regroup batches into blocks of about ``limit`` text bytes (at least
    one row), as (table, texts). Bounds what one step holds."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush():
        t = pa.Table.from_batches(held)
        return t, [x for b in held for x in binary_list(b.column(column))]

    for batch in batches:
        lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        lo = 0
        ends = np.cumsum(lens)
        while lo < len(lens):
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + limit - size, "right")))
            held.append(batch.slice(lo, hi - lo))
            size += int(ends[hi - 1] - base)
            lo = hi
            if size >= limit:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the stored table ``edges`` (a, b).

    Returns (node, root), root the smallest node of the component, for each
    node with an edge. Every round each node takes the smallest root among
    itself and its neighbours, then the root of that root (pointer jumping,
    so long chains shrink by half a round); rounds are written tables, so a
    lost executor costs at most one round. Stops when no root changes.
    """
    both = store(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), f"{name}_edges")
    roots = store(both.groupBy(F.col("a").alias("node"))
                  .agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), f"{name}_roots")
    while True:
        near = (both.join(roots.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        step = store(roots.select("node", "root").join(near, "node").select("node", "root", F.least("root", "near").alias("to")), f"{name}_step")
        via = step.select(F.col("node").alias("to"), F.col("to").alias("via"))
        nxt = store(step.join(via, "to").select("node", F.least("to", "via").alias("root"),
                                                (F.least("to", "via") != F.col("root")).alias("moved")), f"{name}_roots")
        moved = nxt.where("moved").limit(1).count()
        discard(step, roots)
        roots = nxt
        if not moved:
            discard(both)
            return roots
