"""End-to-end ingest batch and the library-only file helpers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import contract as ct
from tidemark.plans.pipeline import run_ingest_batch
from tidemark.sinks import landing as ld
from tidemark.sources import files as fs

from tests.test_failure_cases import raw_df, row


def test_run_ingest_batch_lands_verified_files(spark, tmp_root):
    as_of = datetime(2026, 6, 2, 9, 30, 0)
    landing, manifests = f"{tmp_root}/sales/raw", f"{tmp_root}/manifests"
    rows = [row(i + 1, load=as_of) for i in range(2000)]
    batch = raw_df(spark, rows).drop("source_file_name", "load_ts")
    run_ingest_batch(spark, batch, landing, manifests, as_of=as_of)
    # arrival-date folders, zero padded
    paths = [r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", True).load(landing).select("path").collect()]
    assert paths and all("/year=2026/month=06/day=02/" in p for p in paths)
    m = fs.scan_checksum_manifests(spark, f"{manifests}/checksum").collect()
    assert sum(r.expected_row_count for r in m) == 2000
    assert all(r.checksum_algorithm == "SHA-256" and len(r.checksum_sha256) == 64 for r in m)
    schema_manifest = spark.read.schema(ct.SCHEMA_MANIFEST_SCHEMA).json(f"{manifests}/schema").first()
    assert schema_manifest.schema_validation_status == "PASSED"
    assert schema_manifest.actual_schema["unit_price"] == "number"
    # the landed files read back under the strict header check
    schema = batch.schema
    raw = fs.read_raw_with_lineage(spark, landing, schema)
    assert raw.count() == 2000 and raw.filter(F.col("source_file_name").isNull()).count() == 0


def test_scan_schema_contract_and_layer_paths(spark, tmp_root):
    import shutil
    import os

    os.makedirs(tmp_root, exist_ok=True)
    shutil.copy(ct.CONTRACT_PATH, f"{tmp_root}/contract.json")
    c = ct.scan_schema_contract(spark, f"{tmp_root}/contract.json").first()
    assert c.dataset == "sales" and c.allow_additive_columns
    assert c.required_columns["order_timestamp"] == "datetime" and len(c.optional_columns) == 3
    assert ld.layer_path("/w", " marts ", "fct") == "/w/marts/fct"
    assert ld.layer_path("/w", None, "fct") == "/w/public/fct"


def test_contract_missing_file_is_error():
    import pytest

    with pytest.raises(FileNotFoundError):
        ct.load_contract("/nonexistent/contract.json")


def test_run_elt_incremental_second_run_equals_full_build(spark, tmp_root):
    from tidemark.plans import models as m
    from tidemark.plans.pipeline import run_elt
    from tidemark.sources.adapters import FIXTURE_TIE_BREAKERS

    sf = "/root/testdata/sf0.001"
    raw_all = m.raw(spark, sf)
    cutoff = F.lit(m.INCREMENTAL_CUTOFF).cast("timestamp")
    tb = list(FIXTURE_TIE_BREAKERS)
    run_elt(spark, raw_all.filter(F.col("load_ts") < cutoff), tmp_root, gate=False, tie_breakers=tb)
    out = run_elt(spark, raw_all, tmp_root, gate=False, tie_breakers=tb)
    from tidemark.sinks.fact_table import FactTable

    table = FactTable(spark, out["fct_sales"].removesuffix("/data"))
    entries = sorted(r.rows for r in table.entries().collect())
    assert len(entries) == 2 and sum(entries) < 2 * table.read().count()  # the second run took the new rows
    key = ["sales_event_key", "quantity", "net_amount", "load_ts"]
    got = sorted(map(tuple, table.read().select(*key).collect()))
    want = sorted(map(tuple, m.fct(spark, sf).select(*key).collect()))
    assert got == want
    tests = {(r.table_name, r.test_name, r.column_name): r.failures
             for r in spark.read.parquet(out["row_test_report"]).collect()}
    assert tests[("fct_sales", "unique", "sales_event_key")] == 0
    assert tests[("fct_sales", "assert_sales_amounts_reconcile", None)] == 0


def test_run_elt_on_empty_raw_gives_empty_marts(spark, tmp_root):
    from tidemark.plans import models as m
    from tidemark.plans.pipeline import run_elt
    from tidemark.sources.adapters import FIXTURE_TIE_BREAKERS

    raw = m.raw(spark, "/root/testdata/sf0.001").limit(0)
    out = run_elt(spark, raw, tmp_root, gate=False, tie_breakers=list(FIXTURE_TIE_BREAKERS))
    assert spark.read.parquet(out["mart_customer_sales_kpi"]).count() == 0


def test_run_elt_gate_and_freshness(spark, tmp_root):
    import pytest

    from tidemark.plans.pipeline import run_elt

    late = raw_df(spark, [row(1), row(2, net="-5.00")])
    with pytest.raises(ValueError, match="stale"):
        run_elt(spark, late, tmp_root, layers=("staging",), loaded_by=datetime(2024, 4, 1))
    with pytest.raises(AssertionError, match="negative net amount"):
        run_elt(spark, late, tmp_root)
