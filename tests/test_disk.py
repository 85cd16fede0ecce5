"""What the jobs leave on disk, and what they move."""

from __future__ import annotations

import glob
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.functions.columns import pack_digests, unpack_digests
from tidemark.operators.fact import merge_keyed
from tidemark.plans import catalog
from tidemark.session import materialize, materialized, scratch_dir, shuffles_dropped
from tidemark.sinks import landing
from tidemark.sinks.fact_table import FactTable
from tidemark.streaming import ingest as stream

SF = "/root/testdata/sf0.001"


def _shuffle_blocks(spark) -> int:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return blocks.count("shuffle_")


def _scratch(spark) -> set[str]:
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")))


def _left(spark, before: set[str], *names: str) -> list[str]:
    return sorted(x for x in _scratch(spark) - before if x.startswith(names))


def test_written_frames_leave_no_shuffle_files(spark):
    had = _shuffle_blocks(spark)
    with materialized(spark.range(1000).repartition(7).groupBy((F.col("id") % 9).alias("k")).count(), "left") as frame:
        for _ in range(50):  # they are removed in the background
            if (now := _shuffle_blocks(spark)) <= had:
                break
            time.sleep(0.1)
        assert now <= had and frame.count() == 9
        folder = frame._folder
        assert os.path.exists(folder.removeprefix("file://"))
    assert not os.path.exists(folder.removeprefix("file://"))
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("name", ["fct_sales_incremental", "rerun_idempotence"])
def test_layers_go_once_the_table_holds_their_rows(spark, name):
    before = _scratch(spark)
    table = catalog.QUERIES[name](spark, SF)
    assert table.count() > 0
    assert _left(spark, before, "fact_raw", "enriched", "stg", "fact_delta") == []


def test_upsert_meets_rows_of_shared_files_alone(spark, tmp_root, monkeypatch):
    """Rows of files that only one side has are not joined; derived columns are there in all."""
    from tidemark.sinks import fact_table as ft

    met = []
    monkeypatch.setattr(ft, "merge_keyed", lambda t, u, k: (met.append((sorted(r.x for r in t.collect()), sorted(r.x for r in u.collect()))), merge_keyed(t, u, k))[1])
    table = FactTable(spark, tmp_root)
    rows = "sales_event_key string, source_file_name string, load_ts timestamp, x int"
    digest = "0123456789abcdef" * 2
    t1 = datetime(2024, 3, 1)
    first = [("a", "f1", t1, 1), (digest, "f2", t1, 2), (None, "f2", t1, 3), ("ABCDEF0123456789", None, t1, 4), ("0123456789ABCDEF0123456789abcdef", "f3", t1, 5)]
    double = lambda df: df.withColumn("y", F.col("x") * 2)
    table.upsert(spark.createDataFrame(first, rows), derive=double)
    table.upsert(spark.createDataFrame([(digest, "f2", t1, 6), ("b", "f4", t1, 7)], rows), derive=double)
    assert met == [([2, 3], [6])]
    got = {(r.sales_event_key, r.source_file_name, r.x, r.y) for r in table.read().collect()}
    assert got == {("a", "f1", 1, 2), (digest, "f2", 6, 12), (None, "f2", 3, 6), ("ABCDEF0123456789", None, 4, 8),
                   ("0123456789ABCDEF0123456789abcdef", "f3", 5, 10), ("b", "f4", 7, 14)}


def test_packed_digests_come_back_as_they_were(spark):
    keys = ["0f" * 16, "0F" * 16, "0f" * 16 + "a", "", None, "0f" * 7, "0f" * 8, "x" * 32, "0f" * 16 + "\n", "abc", " 0f"]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    packed = pack_digests(df, "k")
    assert {r.i for r in packed.where("_digest is not null").collect()} == {0, 3, 5, 6}
    assert [r.k for r in unpack_digests(packed, "k", df.columns).orderBy("i").collect()] == keys


def test_merge_within_a_column_equals_the_plain_merge(spark):
    rows = "sales_event_key string, source_file_name string, v int"
    target = materialize(spark.createDataFrame([("a", "f1", 1), ("b", "f1", 2), ("c", "f2", 3), ("d", None, 4), ("e", None, 5), (None, "f1", 6)], rows))
    updates = materialize(spark.createDataFrame([("b", "f1", 20), ("d", None, 40), ("z", "f9", 90)], rows))
    want = sorted(map(str, merge_keyed(target, updates).collect()))
    scoped = merge_keyed(target, updates, within="source_file_name")
    assert sorted(map(str, scoped.collect())) == want and len(want) == 7
    assert sorted(map(str, merge_keyed(target, updates.limit(0), within="source_file_name").collect())) == sorted(map(str, target.collect()))


def test_row_tests_read_the_joined_tables_once(spark, monkeypatch):
    read, raw = [], catalog.m.raw
    monkeypatch.setattr(catalog.m, "raw", lambda s, d: (read.append(d), raw(s, d))[1])
    report = catalog.QUERIES["row_test_report"](spark, SF)
    assert read == [SF] and "lineitem" not in report._jdf.queryExecution().optimizedPlan().toString()


def test_gzipped_landing_reads_like_a_plain_one(spark, tmp_root):
    cols = "order_id long, customer_id long, product_category string, order_status string, load_ts timestamp, source_file_name string"
    rows = spark.createDataFrame([(i, i, ' a,"b" ', "x\ny" if i == 3 else None, datetime(2024, 3, 1), f"s{i % 2}.csv") for i in range(9)], cols)
    got = []
    for kind in (None, "gzip"):
        root, raw = f"{tmp_root}/{kind}", f"{tmp_root}/raw_{kind}"
        landing.land_daily(rows, root, grain="month", compression=kind)
        stream.stream_ingest(spark, root, raw, f"{tmp_root}/ckpt_{kind}").awaitTermination()
        read = [stream.read_raw(spark, raw), stream.read_rejected(spark, raw)]
        got.append([sorted(map(str, r.drop("load_ts").collect())) for r in read])
    files = glob.glob(f"{tmp_root.removeprefix('file://')}/gzip/**/*.csv.gz", recursive=True)
    assert files and got[0] == got[1] and sum(map(len, got[0])) >= 9


def test_streams_leave_no_landing_and_no_second_copy(spark):
    before = _scratch(spark)
    assert catalog.QUERIES["stream_upsert_fact"](spark, SF).count() > 0
    assert _left(spark, before, "landing", "latest", "fact_delta") == []


def test_stream_dedup_holds_a_row_once(spark, tmp_root):
    """Rows of a single batch are read without a shuffle; nulls, plain keys and ties come out as the order says."""
    schema = "sales_event_key string, order_id long, product_id long, source_file_name string, load_ts timestamp, v string"
    digest, t1, t2 = "ab" * 16, datetime(2024, 3, 1, 1, 2, 3, 456789), datetime(1960, 1, 1)
    rows = [(digest, 1, 5, "f", t1, "old tie"), (digest, 1, 4, "f", t1, "won"), ("k", 2, None, "f", None, "null load"), ("k", 2, 9, None, t2, "before 1970"),
            ("n", 3, None, "f", None, None), (None, 4, 1, "f", t1, "no key")]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_root}/in")
    source = spark.readStream.schema(schema).parquet(f"{tmp_root}/in")
    stream.stream_dedup(source, f"{tmp_root}/out", f"{tmp_root}/ckpt", ["product_id"]).awaitTermination()
    got = stream.read_latest(spark, f"{tmp_root}/out")
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == source.columns and got.dtypes == source.dtypes
    assert {tuple(r) for r in got.collect()} == {rows[1], rows[3], rows[4], rows[5]}


def test_batches_are_not_sorted_by_folder(spark, tmp_root, monkeypatch):
    """Accepted and rejected rows are written in one pass, without a sort of all rows that spills."""
    cols = "order_id string, quantity string, load_ts timestamp, source_file_name string"
    landing.land_daily(spark.createDataFrame([(str(i), "two" if i % 3 else "2", datetime(2024, 3, 1), "s.csv") for i in range(9)], cols), f"{tmp_root}/in", grain="month")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(f"{tmp_root}/in").select("path", "length")
    key, during = "spark.sql.maxConcurrentOutputFileWriters", []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path, *a, f=DataFrameWriter.parquet, **k: (during.append(int(spark.conf.get(key))), f(w, path, *a, **k))[1])
    stream.ingest_batch(files, 7, f"{tmp_root}/in", f"{tmp_root}/raw")
    assert during == [4] and spark.conf.get(key) == "0"  # Spark sorts by folder at 0
    assert {r.outcome for r in spark.read.parquet(f"{tmp_root}/raw").collect()} == {"rejected"}
    assert spark.read.parquet(f"{tmp_root}/raw").count() == 9
