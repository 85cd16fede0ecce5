"""Property tests: upsert idempotence, partitioned table == naive merge,
restatement == rebuild (moved dates included), streaming ingest run twice ==
once, latest-wins stream dedup, lineage and schema of stored files."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import marts
from tidemark.operators.dims import dim_date
from tidemark.operators.fact import fct_projection, merge_keyed
from tidemark.operators.incremental import replaced_rows, restate_kpi_dates
from tidemark.operators.intermediate import int_sales_enriched
from tidemark.operators.staging import stg_sales
from tidemark.sinks.fact_table import FactTable
from tidemark.session import scratch_dir
from tidemark.sources import files as fs
from tidemark.streaming import ingest as stream

from tests.test_failure_cases import raw_df, row


def _rows(spec):
    """spec: list of (order_id, file_no, day_offset, qty)."""
    return [row(o, qty=q, file=f"f{f}.csv", load=datetime(2024, 3, 1) + timedelta(days=d)) for o, f, d, q in spec]


def _sorted(df):
    return sorted(tuple(r) for r in df.select("sales_event_key", "quantity", "load_ts").collect())


spec_st = st.lists(st.tuples(st.integers(1, 6), st.integers(0, 3), st.integers(0, 5), st.integers(1, 9)),
                   min_size=1, max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=spec_st, second=spec_st)
def test_store_upsert_equals_naive_merge_and_is_idempotent(spark, first, second):
    a = fct_projection(int_sales_enriched(stg_sales(raw_df(spark, _rows(first)))))
    b = fct_projection(int_sales_enriched(stg_sales(raw_df(spark, _rows(second)))))
    store = FactTable(spark, scratch_dir(spark, "prop_store"))
    store.upsert(a)
    store.upsert(b)
    once = _sorted(store.read())
    assert once == _sorted(merge_keyed(a, b))
    store.upsert(b)
    assert _sorted(store.read()) == once


def test_restate_equals_rebuild(spark):
    base = _rows([(1, 0, 0, 1), (2, 0, 1, 2), (3, 1, 2, 3)])
    late = [row(9, qty=4, file="late.csv", load=datetime(2024, 4, 1))]
    dim = dim_date(spark, as_of=date(2024, 6, 30))
    fct_old = fct_projection(int_sales_enriched(stg_sales(raw_df(spark, base))))
    fct_new = fct_projection(int_sales_enriched(stg_sales(raw_df(spark, base + late))))
    delta = fct_new.join(fct_old.select("sales_event_key"), "sales_event_key", "left_anti")
    restated = restate_kpi_dates(marts.mart_sales_daily_kpi(fct_old, dim), fct_new, delta, dim)
    rebuilt = marts.mart_sales_daily_kpi(fct_new, dim)
    assert sorted(map(tuple, restated.collect())) == sorted(map(tuple, rebuilt.collect()))


def test_stream_ingest_twice_equals_once(spark, tmp_root):
    land = f"{tmp_root}/landing"
    raw_df(spark, _rows([(1, 0, 0, 1), (2, 1, 0, 2)])).drop("source_file_name", "load_ts") \
        .write.option("header", True).csv(land)
    out, ckpt = f"{tmp_root}/raw", f"{tmp_root}/ckpt"
    for _ in range(2):
        stream.stream_ingest(spark, land, out, ckpt).awaitTermination()
        assert stream.read_raw(spark, out).count() == 2 and stream.read_rejected(spark, out).count() == 0


def test_restatement_when_a_row_moves_to_another_date(spark):
    """A re-delivered key whose order date moved: the date it left is
    restated too, so the result equals a rebuild."""
    dim = dim_date(spark, as_of=date(2024, 6, 30))
    old = fct_projection(int_sales_enriched(stg_sales(raw_df(spark, _rows([(1, 0, 0, 1), (2, 0, 0, 2), (3, 0, 4, 1)])))))
    moved = old.filter("order_id = 2").withColumn("order_date", F.expr("order_date + interval 5 days").cast("date"))
    new = merge_keyed(old, moved)
    got = restate_kpi_dates(marts.mart_sales_daily_kpi(old, dim), new, moved, dim, replaced_rows(old, moved))
    want = marts.mart_sales_daily_kpi(new, dim)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_table_gains_and_loses_columns(spark):
    table = FactTable(spark, scratch_dir(spark, "schema_table"))
    first = spark.createDataFrame([("a", "f1", 1), ("c", "f3", 3)], "sales_event_key string, source_file_name string, x int")
    second = spark.createDataFrame([("b", "f2", "new"), ("c", "f3", "new")], "sales_event_key string, source_file_name string, sales_channel string")
    table.upsert(first)
    table.upsert(second)
    got = table.read(second.schema)
    assert got.columns == second.columns and {r.sales_event_key: r.sales_channel for r in got.collect()} == {"a": None, "b": "new", "c": "new"}
    assert {r.sales_event_key: r.x for r in table.read().collect()} == {"a": 1, "b": None, "c": None}


def test_upsert_rewrites_touched_files_only_and_skips_replayed_batches(spark, tmp_root):
    table = FactTable(spark, tmp_root)
    schema = "sales_event_key string, source_file_name string, load_ts timestamp, x int"
    day = lambda d: datetime(2024, 3, d)
    table.upsert(spark.createDataFrame([("a", "f1", day(1), 1), ("b", "f1", day(1), 2), ("c", "f2", day(2), 3), ("d", None, day(2), 4), ("e", "", day(2), 5)], schema), 0)
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(table.data) for f in names if f.endswith(".parquet")}
    before = files()
    delta = spark.createDataFrame([("a", "f1", day(5), 9), ("z", "f/9 %", day(4), 7)], schema)
    table.upsert(delta, 1)
    assert len(before & files()) == len(before) - 1  # the partition of f1 alone is replaced
    want = {("a", 9), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("z", 7)}
    assert {(r.sales_event_key, r.x) for r in table.read().collect()} == want
    table.upsert(delta.withColumn("x", F.lit(0)), 1)  # a replay
    assert {(r.sales_event_key, r.x) for r in table.read().collect()} == want
    assert table.high_water_mark().first()[0] == datetime(2024, 3, 4, 23)
    assert "ledger" in table.high_water_mark()._jdf.queryExecution().executedPlan().toString()
    new = spark.createDataFrame([("n", "f", datetime(2024, 3, 4, 23), 1), ("o", "f", datetime(2024, 3, 4, 22, 59), 1)], schema)
    assert [r.sales_event_key for r in table.new_rows(new).collect()] == ["n"]


def test_replaced_partitions_leave_no_stale_one(spark, tmp_root):
    from tidemark.sinks.fact_table import replace_partitions

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "x int, p string")
    replace_partitions(rows, tmp_root, "p")
    stored = spark.read.parquet(tmp_root)
    replace_partitions(stored.where("p = 'a'").withColumn("x", F.lit(9)), tmp_root, "p", rows.where("p <> 'c'").select("p"))
    assert sorted((r.x, r.p) for r in spark.read.parquet(tmp_root).collect()) == [(3, "c"), (9, "a")]


def test_stream_dedup_latest_wins_for_any_batches(spark, tmp_root):
    """Rows whose load times go back and forth over several micro-batches:
    no key is lost and the latest row of each stays."""
    schema = "sales_event_key string, source_file_name string, load_ts timestamp, x int"
    days = [10, 11, 1, 1, 12, 2]
    for i, day in enumerate(days):
        rows = [(f"k{i % 3}", "f", datetime(2024, 3, day), i), (f"only{i}", "f", datetime(2024, 3, day), i), (f"k{i % 3}", "f", None, -1)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_root}/in/b{i}")
    want = {}
    for i, day in enumerate(days):
        for k in (f"k{i % 3}", f"only{i}"):
            if k not in want or (day, -i) > (want[k][0], -want[k][1]):
                want[k] = (day, i)
    for per in (1, 100):
        source = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", per).parquet(f"{tmp_root}/in")
        path = scratch_dir(spark, "dedup_test")
        stream.stream_dedup(source, path, scratch_dir(spark, "ckpt"), ["x"]).awaitTermination()
        assert {r.sales_event_key: (r.load_ts.day, r.x) for r in stream.read_latest(spark, path).collect()} == want


def test_manifests_are_audited_once(spark, tmp_root):
    os.makedirs(f"{tmp_root}/m", exist_ok=True)
    out, ckpt = f"{tmp_root}/audit", f"{tmp_root}/ck"
    for i, n in enumerate((1, 1, 2)):  # the second run finds nothing new
        if i != 1:
            with open(f"{tmp_root}/m/{i}.json", "w", encoding="utf-8") as fh:
                fh.write('{"file_name": "f.csv", "s3_uri": "file:/x/file=a+b.csv/p.csv", "row_count": 3}\n')
        stream.stream_manifests(spark, f"{tmp_root}/m", out, ckpt).awaitTermination()
        assert spark.read.parquet(out).count() == n
    assert spark.read.parquet(out).first().data_file == "a+b.csv"


def test_lineage_survives_part_files(spark, tmp_root):
    """The source file is the landed folder, however many part files it has."""
    raw = raw_df(spark, _rows([(i, 0, 0, 1) for i in range(1, 30)])).withColumn("source_file_name", F.lit("late 50%/sales.csv"))
    schema = raw.drop("source_file_name", "load_ts").schema
    for parts in (1, 5):
        root = f"{tmp_root}/parts{parts}"
        (raw.withColumn("file", F.col("source_file_name")).drop("source_file_name", "load_ts").repartition(parts)
         .write.option("header", True).partitionBy("file").csv(root))
        names = {r[0] for r in fs.read_raw_with_lineage(spark, root, schema).select("source_file_name").distinct().collect()}
        assert names == {"late 50%/sales.csv"}


def test_stream_reads_a_reordered_header_by_name(spark, tmp_root):
    """Two batches: a file in contract order with one malformed row, then
    one in reverse order with a new column; no batch stops."""
    cols = [c for c in raw_df(spark, []).columns if c not in ("source_file_name", "load_ts")]
    rows = raw_df(spark, _rows([(1, 0, 0, 1), (2, 0, 0, 2)])).select(*cols)
    bad = rows.withColumn("quantity", F.when(F.col("order_id") == 2, F.lit("many")).otherwise(F.col("quantity").cast("string")))
    bad.coalesce(1).write.option("header", True).csv(f"{tmp_root}/in/a")
    out, ckpt = f"{tmp_root}/raw", f"{tmp_root}/ck"
    stream.stream_ingest(spark, f"{tmp_root}/in", out, ckpt).awaitTermination()
    rows.select(*cols[::-1], F.lit("new").alias("sales_channel")).coalesce(1).write.option("header", True).csv(f"{tmp_root}/in/b")
    stream.stream_ingest(spark, f"{tmp_root}/in", out, ckpt).awaitTermination()
    got = fs.typed(stream.read_raw(spark, out))
    assert sorted((r.order_id, r.quantity, r.sales_channel or "none") for r in got.collect()) == [(1, 1, "new"), (1, 1, "none"), (2, 2, "new")]
    (rejected,) = stream.read_rejected(spark, out).collect()
    assert rejected.order_id == "2" and rejected.quantity == "many" and rejected.failed_columns == ["quantity"]


def test_stream_kpi_restatement_equals_batch_rebuild(spark, tmp_root):
    """Two landed files arrive in separate micro-batches (the second one
    late, touching an old business date): the restated KPI equals the mart
    rebuilt in batch from the final fact."""
    land = f"{tmp_root}/landing"
    first = _rows([(1, 0, 0, 1), (2, 0, 1, 2)])
    late = [row(3, qty=5, file="late.csv", load=datetime(2024, 4, 1)),
            row(1, qty=7, file="late.csv", load=datetime(2024, 4, 1))]
    cols = raw_df(spark, []).drop("source_file_name", "load_ts").columns
    raw_df(spark, first).select(*cols).coalesce(1).write.option("header", True).csv(f"{land}/a")
    raw_df(spark, late).select(*cols).coalesce(1).write.option("header", True).csv(f"{land}/b")
    raw = f"{tmp_root}/raw"
    stream.stream_ingest(spark, land, raw, f"{tmp_root}/ck_raw", max_files_per_trigger=1).awaitTermination()
    store, kpi = FactTable(spark, f"{tmp_root}/fct"), f"{tmp_root}/kpi"
    dim = dim_date(spark, as_of=date(2024, 6, 30))
    staged = stream.staged_stream(stream.raw_stream(spark, raw, max_files_per_trigger=1))
    stream.stream_daily_kpi(staged, store, kpi, dim, f"{tmp_root}/ckpt").awaitTermination()
    assert store.entries().count() == 2  # one upsert per micro-batch
    rebuilt = marts.mart_sales_daily_kpi(store.read(), dim)
    got = sorted(map(tuple, stream.read_kpi(spark, kpi).select(*rebuilt.columns).collect()))
    assert got == sorted(map(tuple, rebuilt.collect()))
    assert store.read().count() == 4
