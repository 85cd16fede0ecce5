"""End-to-end composition.

``run_ingest_batch``: validate a batch's rows -> contract -> land CSV ->
schema manifest -> checksum manifest -> verify landed checksums.

``run_elt``: RAW -> staging -> intermediate -> fact (incremental upsert) ->
date dim -> marts + load audit -> quality report, in ``ref`` order. Each
layer is written to shared storage and the next layer reads it back, so
lineage is cut at every layer boundary and a lost executor only recomputes
within the current layer. The quality checks run on the marts built in
this same run (not on a second, independent build).
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import marts, quality
from tidemark.operators.contract import load_contract, validate_contract
from tidemark.operators.dims import days_through, dim_date
from tidemark.operators.fact import fct_projection
from tidemark.operators.integrity import file_fingerprints, require_checksums_match, verify_checksums
from tidemark.operators.intermediate import int_sales_enriched
from tidemark.operators.staging import stg_sales
from tidemark.sinks.fact_table import FactTable
from tidemark.sinks.landing import land_by_arrival, layer_path, materialize_full, read_layer, write_checksum_manifest, write_schema_manifest
from tidemark.sources.files import scan_checksum_manifests

LAYERS = ("staging", "intermediate", "marts")


def run_ingest_batch(spark: SparkSession, batch: DataFrame, landing: str, manifests: str,
                     as_of: datetime | None = None) -> str:
    """Validate one batch of raw rows, land it and verify what was landed."""
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    quality.validate_batch(batch)
    report = validate_contract(batch, load_contract())
    land_by_arrival(batch.withColumn("arrival_ts", F.lit(as_of)), landing, arrival="arrival_ts", file_col=None)
    write_schema_manifest(spark, report, f"{manifests.rstrip('/')}/schema", as_of)
    write_checksum_manifest(spark, landing, f"{manifests.rstrip('/')}/checksum", as_of=as_of)
    verified = verify_checksums(file_fingerprints(spark, landing), scan_checksum_manifests(spark, f"{manifests.rstrip('/')}/checksum"))
    require_checksums_match(verified)
    return landing


def run_elt(spark: SparkSession, raw: DataFrame, root: str, as_of: date | datetime | None = None,
            layers: tuple[str, ...] = LAYERS, tie_breakers=None, gate: bool = True,
            loaded_by: datetime | None = None) -> dict[str, str]:
    """Build the requested layers; returns table -> path.

    With ``loaded_by`` the run stops first if RAW's newest load is too old
    at that time (``check_source_freshness`` says error). ``gate`` stops it
    after the report if a quality check fails. The calendar reaches the
    newest business date of the fact.
    """
    out: dict[str, str] = {}
    if loaded_by is not None:
        fresh = quality.check_source_freshness(raw, loaded_by).first()
        if fresh["freshness_status"] == "error":
            raise ValueError(f"RAW is stale: newest load {fresh['max_loaded_at']}")
    if "staging" in layers:
        out["stg_sales"] = materialize_full(stg_sales(raw, tie_breakers=tie_breakers), root, "staging", "stg_sales")
    if "intermediate" in layers:
        stg = read_layer(spark, root, "staging", "stg_sales")
        out["int_sales_enriched"] = materialize_full(int_sales_enriched(stg), root, "intermediate", "int_sales_enriched")
    if "marts" in layers:
        enriched = read_layer(spark, root, "intermediate", "int_sales_enriched")
        table = FactTable(spark, layer_path(root, "marts", "fct_sales"))
        new = fct_projection(table.new_rows(enriched) if table.exists() else enriched)
        table.upsert(new)
        out["fct_sales"] = table.data
        fct = table.read(new.schema)
        last = fct.agg(F.max("order_date")).first()[0]
        dim = dim_date(spark, as_of or last, n_days=days_through(last))
        out["dim_date"] = materialize_full(dim, root, "marts", "dim_date")
        dim = spark.read.parquet(out["dim_date"])
        built = {
            "mart_sales_daily_kpi": marts.mart_sales_daily_kpi(fct, dim),
            "mart_customer_sales_kpi": marts.mart_customer_sales_kpi(fct),
            "mart_product_category_sales_kpi": marts.mart_product_category_sales_kpi(fct),
            "dim_product_categories": marts.dim_product_categories(fct),
            "mart_load_audit": marts.mart_load_audit(raw, fct),
        }
        for name, df in built.items():
            out[name] = materialize_full(df, root, "marts", name)
        tables = {"sales_raw": raw, "fct_sales": fct, "dim_date": dim,
                  "stg_sales": read_layer(spark, root, "staging", "stg_sales"),
                  "int_sales_enriched": enriched}
        tables.update({n: spark.read.parquet(out[n]) for n in built})
        report = quality.quality_report(tables, quality.ALL_CHECKS)
        out["quality_report"] = materialize_full(report, root, "audit", "quality_report")
        tests = quality.row_test_report(tables, quality.ROW_TESTS)
        out["row_test_report"] = materialize_full(tests, root, "audit", "row_test_report")
        if gate:
            quality.require_passing(spark.read.parquet(out["quality_report"]))
    return out


def run_layer(spark: SparkSession, raw: DataFrame, root: str, layer: str, **kw) -> dict[str, str]:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return run_elt(spark, raw, root, layers=(layer,), **kw)
