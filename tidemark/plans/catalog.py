"""Registry of every implemented query: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the driver's tables (through the adapters) so its work
grows with the data; nothing is capped or sampled except where the limit
is the feature (top-k reports).
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import exact_avg, money_sum, safe_column, safe_ratio
from tidemark.operators import contract as ct
from tidemark.operators import fact as fa
from tidemark.operators import incremental as inc
from tidemark.operators import integrity as ig
from tidemark.operators import intermediate as im
from tidemark.operators import marts
from tidemark.operators import quality as q
from tidemark.operators import serving as sv
from tidemark.operators import staging as sg
from tidemark.operators import summaries as sm
from tidemark.operators import usage as us
from tidemark.plans import models as m
from tidemark.plans import pipeline as pl
from tidemark.session import CODEC, delete_path, materialize, materialized, scratch_dir, shuffles_dropped
from tidemark.sinks import landing as ld
from tidemark.sinks.fact_table import FactTable
from tidemark.sources import adapters as ad
from tidemark.sources import files as fs
from tidemark.streaming import ingest as st


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# --- staging / intermediate / fact / dims / marts -------------------------------
query("stg_sales")(lambda s, d: m.stg(s, d))
query("int_sales_enriched")(lambda s, d: m.enriched(s, d))
query("fct_sales")(lambda s, d: m.fct(s, d))
query("dim_date")(lambda s, d: m.dim(s, d))
query("mart_sales_daily_kpi")(lambda s, d: marts.mart_sales_daily_kpi(m.fct(s, d), m.dim(s, d)))
query("mart_customer_sales_kpi")(lambda s, d: marts.mart_customer_sales_kpi(m.fct(s, d)))
query("mart_product_category_sales_kpi")(lambda s, d: marts.mart_product_category_sales_kpi(m.fct(s, d)))
query("dim_product_categories")(lambda s, d: marts.dim_product_categories(m.fct(s, d)))
query("mart_load_audit")(lambda s, d: _audit(s, d))


# --- summaries ----------------------------------------------------------------------


LATE_AS_OF = date(2025, 6, 30)
BACKFILL_WINDOW = (date(2024, 5, 1), date(2024, 5, 3))
DASH_FILTER = {"start": date(2024, 1, 1), "end": date(2024, 12, 31), "months": ["Jan", "Feb", "Mar", "Oct"]}
FRESHNESS_AS_OF = datetime(2030, 10, 30, 6, 30, 0)


def _daily(s, d):
    return marts.mart_sales_daily_kpi(m.fct(s, d), m.dim(s, d))


def _raw_once(s, d):
    """What file counts need of RAW, written once for both sides to read."""
    return materialize(m.raw(s, d).select("order_id", "batch_id", "source_file_name", "load_ts", *ad.FIXTURE_TIE_BREAKERS), "audited_raw")


def _audit(s, d):
    raw = _raw_once(s, d)
    return marts.mart_load_audit(raw, m.fct_of(raw))


def _customer(s, d):
    return marts.mart_customer_sales_kpi(m.fct(s, d))


def _category(s, d):
    return marts.mart_product_category_sales_kpi(m.fct(s, d))


query("agg_files_raw")(lambda s, d: marts.agg_files_raw(m.raw(s, d)))
query("agg_files_fact")(lambda s, d: marts.agg_files_fact(m.fct(s, d)))
query("raw_load_summary")(lambda s, d: sm.raw_load_summary(m.raw(s, d)))
query("audit_summary")(lambda s, d: sm.audit_summary(_audit(s, d)))
def _layer_counts(s, d):
    stg = materialize(m.stg(s, d), "counted_stg")
    enriched = im.int_sales_enriched(stg)
    return sm.layer_row_counts({"staging": stg, "intermediate": enriched, "fact": fa.fct_projection(enriched)})


query("layer_row_counts")(_layer_counts)
query("late_raw_summary")(lambda s, d: sm.late_raw_summary(m.raw(s, d)))
query("late_fact_summary")(lambda s, d: sm.late_fact_summary(m.fct(s, d)))
query("backfill_raw_summary")(lambda s, d: sm.backfill_raw_summary(m.raw(s, d)))
query("backfill_fact_summary")(lambda s, d: sm.backfill_fact_summary(m.fct(s, d)))
query("file_name_filter")(lambda s, d: sm.file_name_filter(m.raw(s, d), sm.LATE_PATTERN))

# --- sort / limit / top-k and dashboard serving ------------------------------------------
query("read_mart")(lambda s, d: sv.read_mart(_daily(s, d), "order_date"))
query("top_customers")(lambda s, d: sv.top_customers(_customer(s, d), 100))
query("category_ranking")(lambda s, d: sv.category_ranking(_category(s, d)))
query("daily_latest_20")(lambda s, d: sv.daily_latest(_daily(s, d), 20))
query("customers_top_20")(lambda s, d: sv.top_customers(_customer(s, d), 20))
query("audit_latest")(lambda s, d: sv.audit_latest(_audit(s, d)))
query("dim_date_head")(lambda s, d: sv.dim_date_head(QUERIES["dim_date"](s, d), 10))
query("dim_date_count")(lambda s, d: sv.dim_date_count(QUERIES["dim_date"](s, d)))
query("late_kpi_dates_touched")(lambda s, d: sv.late_kpi_dates_touched(_daily(s, d), LATE_AS_OF, 20))
query("backfill_kpi_dates")(lambda s, d: sv.backfill_kpi_dates(_daily(s, d), *BACKFILL_WINDOW))
query("date_range_filter")(lambda s, d: sv.date_range_filter(_daily(s, d), *BACKFILL_WINDOW))
query("month_in_filter")(lambda s, d: sv.month_in_filter(_daily(s, d), DASH_FILTER["months"]))
query("available_months")(lambda s, d: sv.available_months(_daily(s, d)))
query("dash_date_bounds")(lambda s, d: sv.dash_date_bounds(_daily(s, d)))
query("dash_headline")(lambda s, d: sv.dash_headline(_daily(s, d), **DASH_FILTER))
query("dash_daily_net")(lambda s, d: sv.dash_daily_net(_daily(s, d), **DASH_FILTER))
query("dash_status_breakdown")(lambda s, d: sv.dash_status_breakdown(_daily(s, d), **DASH_FILTER))
query("dash_daily_table")(lambda s, d: sv.dash_daily_table(_daily(s, d), **DASH_FILTER))
query("dash_top_customers")(lambda s, d: sv.dash_top_customers(_customer(s, d), 20, 100))
query("dash_category_summary")(lambda s, d: sv.dash_category_summary(_category(s, d)))
query("dash_audit_summary")(lambda s, d: sv.dash_audit_summary(_audit(s, d)))

# --- usage analytics -------------------------------------------------------------------------
_WH = m.USAGE_WAREHOUSES
_AS = m.USAGE_AS_OF
query("scan_usage_history")(lambda s, d: us.window_filter(ad.warehouse_metering_history(s, d), _AS, 30, _WH))
query("usage_by_day")(lambda s, d: us.usage_by_day(ad.warehouse_metering_history(s, d), _AS, _WH))
query("usage_summary_30d")(lambda s, d: us.usage_summary(ad.warehouse_metering_history(s, d), _AS, _WH))
query("usage_by_hour")(lambda s, d: us.usage_by_hour(ad.warehouse_metering_history(s, d), _AS, _WH))
query("top_queries_by_time")(lambda s, d: us.top_queries_by_time(ad.query_history(s, d), _AS, _WH))
query("top_queries_by_bytes")(lambda s, d: us.top_queries_by_bytes(ad.query_history(s, d), _AS, _WH))
query("usage_by_query_tag")(lambda s, d: us.usage_by_query_tag(ad.query_history(s, d), _AS, _WH))
query("usage_tagged_text_match")(lambda s, d: us.usage_tagged_text_match(ad.query_history(s, d), _AS, _WH))
query("usage_by_user")(lambda s, d: us.usage_by_user(ad.query_history(s, d), _AS, _WH))
query("usage_by_service_daily")(lambda s, d: us.usage_by_service_daily(ad.metering_daily_history(s, d), _AS))
query("usage_risk_level")(lambda s, d: us.usage_risk_level(ad.warehouse_metering_history(s, d), _AS, _WH))

# --- data-quality checks -----------------------------------------------------------------------


def _check_tables(s, d, checks):
    """The tables that the checks name. RAW and the fact are written once as
    tables in the shared folder if several of them read it (lineage cut;
    survives executor loss), and so is each checked mart, which its scalar
    and its duplicate checks both read; else they stay plans. Of the fact
    only what its readers use is written."""
    names = list(dict.fromkeys(c.table for c in checks))
    marts_named = sorted(n for n in names if n.startswith("mart_"))
    raw = m.raw(s, d)
    if "sales_raw" in names and "mart_load_audit" in names:
        raw = materialize(raw, "checked_raw")
    fct = m.fct_of(raw)
    if len(marts_named) + ("fct_sales" in names) > 1:
        used = {c for n in marts_named for c in marts.FACT_INPUT[n]}.union(q.checked_columns(checks, "fct_sales", fct.columns))
        fct = materialize(fct.select(*[c for c in fct.columns if c in used]), "checked_fct")
    build = {
        "sales_raw": lambda: raw,
        "fct_sales": lambda: fct,
        "mart_sales_daily_kpi": lambda: marts.mart_sales_daily_kpi(fct, m.dim(s, d)),
        "mart_customer_sales_kpi": lambda: marts.mart_customer_sales_kpi(fct),
        "mart_product_category_sales_kpi": lambda: marts.mart_product_category_sales_kpi(fct),
        "mart_load_audit": lambda: marts.mart_load_audit(raw, fct),
    }
    return {n: materialize(build[n](), f"checked_{n}") if n in marts_named and len(names) > 1 else build[n]() for n in names}


def _report(kinds):
    def run(s, d):
        checks = [c for c in q.ALL_CHECKS if kinds is None or c.kind in kinds]
        return q.quality_report(_check_tables(s, d, checks), checks)

    return run


query("check_not_null")(lambda s, d: q.check_not_null(m.raw(s, d), "order_id"))
query("check_unique")(lambda s, d: q.check_unique(m.raw(s, d), "order_id"))
query("check_unique_event_key")(lambda s, d: q.check_unique(m.stg(s, d), "sales_event_key"))
query("check_accepted_values")(lambda s, d: q.check_accepted_values(m.raw(s, d), "order_status", q.ACCEPTED_STATUSES))
query("check_amounts_reconcile")(lambda s, d: q.check_amounts_reconcile(m.fct(s, d)))
query("check_load_audit_matched")(lambda s, d: q.check_load_audit_matched(_audit(s, d)))
query("check_source_freshness")(lambda s, d: q.check_source_freshness(m.raw(s, d), FRESHNESS_AS_OF))
query("hours_since_latest_load")(lambda s, d: q.hours_since_latest_load(m.raw(s, d), FRESHNESS_AS_OF))
query("scan_row_count")(_report({"row_count"}))
query("scan_missing_count")(_report({"missing_count"}))
query("scan_duplicate_count")(_report({"duplicate_count"}))
query("scan_min_threshold")(_report({"min"}))
query("scan_failed_rows")(_report({"failed_rows"}))
query("quality_report")(_report(None))
query("validate_batch")(lambda s, d: q.batch_violations(m.raw(s, d)))

# --- incremental fact, upsert, late data and restatement ------------------------------


def _initial(fct):
    """The fact as an earlier run left it: rows loaded before the cutoff."""
    return fct.filter(F.col("load_ts") < F.lit(m.INCREMENTAL_CUTOFF).cast("timestamp"))


def _fact_once(s, d, by_month: bool = False):
    """The whole fact, written once: the target of an earlier run and the
    rows of the next one are both parts of it. RAW is written before, so
    that the shuffles of its joins are gone when the dedup's are written.
    ``by_month`` gathers the fact's months, for a reader that takes some of
    them."""
    with materialized(m.raw(s, d), "fact_raw") as raw:
        if by_month:
            path = scratch_dir(s, "fct_by_month")
            with shuffles_dropped(s):
                m.fct_of(raw).hint("rebalance", "order_month").write.option("compression", CODEC).partitionBy("order_month").parquet(path)
            whole = s.read.parquet(path).select(*fa.FCT_COLUMNS)
        else:
            whole = materialize(m.fct_of(raw), "fct_once")
    initial = _initial(whole)
    return whole, initial, fa.incremental_filter(whole, initial)


def _fact_table(s, d, reruns: int = 1):
    """A fact table built by one full and ``reruns`` incremental upserts.
    What the next step has read goes before the one after it."""
    table = FactTable(s, scratch_dir(s, "fct_table"))
    with ExitStack() as layers:
        with materialized(m.raw(s, d), "fact_raw") as raw:
            stg = layers.enter_context(materialized(m.stg_of(raw), "stg"))
        enriched = lambda rows: fa.fct_projection(im.int_sales_enriched(rows))
        table.upsert(_initial(stg), stored=True, derive=enriched)
        for _ in range(reruns):
            table.upsert(table.new_rows(stg), stored=True, derive=enriched)
    return table


def _upsert(s, d):
    _, initial, delta = _fact_once(s, d)
    return fa.merge_keyed(initial, delta, within="source_file_name")


def _merge_join(s, d):
    _, initial, delta = _fact_once(s, d)
    return inc.matched_updates(initial, delta)


def _high_water(s, d):
    """The mark from the ledger of a fact table that holds the earlier rows."""
    table = FactTable(s, scratch_dir(s, "fct_table"))
    table.upsert(_initial(m.fct(s, d)))
    return table.high_water_mark()


def _restate(s, d):
    whole, initial, delta = _fact_once(s, d, by_month=True)
    return inc.restate_kpi_dates(marts.mart_sales_daily_kpi(initial, m.dim(s, d)), whole, delta, m.dim(s, d), inc.replaced_rows(initial, delta))


query("incremental_filter")(lambda s, d: _fact_once(s, d)[2])
query("scalar_subquery_highwater")(_high_water)
query("upsert_fact")(_upsert)
query("merge_join")(_merge_join)
query("fct_sales_incremental")(lambda s, d: _fact_table(s, d, 1).read())
query("rerun_idempotence")(lambda s, d: _fact_table(s, d, 2).read())
query("late_arrivals")(lambda s, d: inc.late_arrivals(m.fct(s, d), 7))
query("restate_kpi_dates")(_restate)

# --- file sources / sinks, integrity, streaming (own tests; rows-only in the driver) ----


def landed_schema(df) -> T.StructType:
    present = set(df.columns)
    return T.StructType([f for f in fs.RAW_CSV_SCHEMA.fields if f.name in present])


def _land(s, d, kind: str = "daily", compression: str | None = None):
    """Land the fixture's raw rows as CSV in a fresh shared folder. Fixture
    files are monthly (``sales_YYYY_MM.csv`` by load month), so they land at
    month grain, one folder per source file."""
    raw = m.raw(s, d)
    root = scratch_dir(s, f"landing_{kind}")
    if kind == "backfill":
        ld.land_backfill(sm.file_name_filter(raw, sm.BACKFILL_PATTERN), root)
    elif kind == "late":
        ld.land_late(sm.file_name_filter(raw, sm.LATE_PATTERN), root, grain="month")
    else:
        ld.land_daily(raw, root, grain="month", compression=compression)
    return root, landed_schema(raw)


def _landed_rows(kind):
    """Rows that a landing holds, by source file (business date for a
    backfill): its files counted by the file reader."""

    def run(s, d):
        root, _ = _land(s, d, kind)
        counts = ig.file_row_counts(s, root)
        folder = F.regexp_extract("path", r"/business_date=([^/]+)/", 1) if kind == "backfill" else fs.source_file(F.col("path"))
        return counts.groupBy(folder.alias("business_date" if kind == "backfill" else "source_file_name")).agg(F.sum("row_count").alias("row_count"))

    return run


def _listing(s, d):
    """Every source file with bytes in the landing, and whether it is there."""
    root, _ = _land(s, d)
    files = ig.list_landing_files(s, root).select(fs.source_file(F.col("path")).alias("source_file_name"), "length")
    return files.groupBy("source_file_name").agg((F.sum("length") > 0).alias("has_bytes"))


def _messy_text(s, d):
    """The fixture's raw rows as text, some of them malformed: words in
    ``quantity``, amounts beyond the type, and (``extra``) a field too many."""
    raw = m.raw(s, d)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in ld.RAW_CSV_COLUMNS if c in raw.columns], "source_file_name",
                      (F.col("customer_id") % 101 == 3).alias("extra"))
    return text.withColumns({
        "quantity": F.when(F.col("product_id") % 97 == 5, F.lit("two")).otherwise(F.col("quantity")),
        "unit_price": F.when(F.col("product_id") % 89 == 7, F.lit("9" * 20 + ".00")).otherwise(F.col("unit_price")),
    })


def _land_messy(s, d):
    """A landing of ``_messy_text``: late files have their columns in reverse
    order, and rows with a field too many lie in files of their own."""
    rows = materialize(_messy_text(s, d), "messy")
    root = scratch_dir(s, "landing_messy")
    cols = [c for c in rows.columns if c not in ("source_file_name", "extra")]
    late = F.col("source_file_name").ilike(sm.LATE_PATTERN)
    for where, order, folder in ((~late & ~F.col("extra"), cols, "plain"), (late & ~F.col("extra"), cols[::-1], "reversed")):
        (rows.where(where).select(*order, F.col("source_file_name").alias("file")).hint("rebalance", "file")
         .write.options(**ld.CSV_OPTIONS).partitionBy("file").csv(f"{root}/{folder}"))
    extra = rows.where("extra")
    lines = extra.select(F.col("source_file_name").alias("file"), F.lit(1).alias("n"),
                         F.concat(F.to_csv(F.struct(*cols), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}), F.lit(",extra")).alias("value"))
    heads = extra.select(F.col("source_file_name").alias("file")).distinct().select("file", F.lit(0).alias("n"), F.lit(",".join(cols)).alias("value"))
    (lines.union(heads).repartition("file").sortWithinPartitions("file", "n").select("value", "file")  # lines as they are
     .write.options(**{**ld.CSV_OPTIONS, "header": False, "quote": "", "sep": "\x01"}).partitionBy("file").csv(f"{root}/extra"))
    return root


LANDED = [c for c in ld.RAW_CSV_COLUMNS if c not in ("sales_channel", "generated_at_utc")]


def _scan_csv(s, d):
    """A batch read of the messy landing: the rows that cast, typed."""
    return fs.typed(fs.accepted(fs.scan_text(s, _land_messy(s, d)))).select(*LANDED)


def _ingested(s, d):
    """The messy landing ingested as a stream; the second run adds nothing."""
    root, raw, ckpt = _land_messy(s, d), scratch_dir(s, "raw_table"), scratch_dir(s, "ckpt_ingest")
    for _ in range(2):
        st.stream_ingest(s, root, raw, ckpt).awaitTermination()
    return raw


def _stream_ingest(s, d):
    return fs.typed(st.read_raw(s, _ingested(s, d))).select(*LANDED, "source_file_name")


def _quarantine(s, d):
    rows = st.read_rejected(s, _ingested(s, d))
    return rows.select("order_id", "batch_id", "source_file_name", "quantity", "unit_price", F.array_join("failed_columns", ",").alias("failed"))


def _ingest_incremental(s, d):
    """Two landings, each followed by a run: the second run takes the new
    files alone, in several small batches."""
    raw_rows, root = m.raw(s, d), scratch_dir(s, "landing_parts")
    raw, ckpt = scratch_dir(s, "raw_table"), scratch_dir(s, "ckpt_ingest")
    late = F.col("source_file_name").ilike(sm.LATE_PATTERN)
    for part, per in ((raw_rows.where(~late), st.MAX_FILES), (raw_rows.where(late), 50)):
        ld.land_daily(part, root, grain="month")
        st.stream_ingest(s, root, raw, ckpt, max_files_per_trigger=per).awaitTermination()
    return fs.typed(st.read_raw(s, raw)).select(*LANDED, "source_file_name")


def _with_lineage(s, d):
    root, schema = _land(s, d)
    return fs.read_raw_with_lineage(s, root, schema).drop("load_ts")  # the clock


def _stream_dedup(s, d):
    raw_path, path = scratch_dir(s, "raw_for_dedup"), scratch_dir(s, "dedup")
    with shuffles_dropped(s):
        m.raw(s, d).write.option("compression", CODEC).parquet(raw_path)
    raw_stream = s.readStream.schema(s.read.parquet(raw_path).schema).parquet(raw_path)
    staged = st.staged_stream(raw_stream, ["l_suppkey"])
    st.stream_dedup(staged, path, scratch_dir(s, "ckpt_dedup"), ad.FIXTURE_TIE_BREAKERS).awaitTermination()
    return st.read_latest(s, path).select(*sg.STG_COLUMNS)


def _raw_stream(s, d):
    """RAW, ingested from a landing of gzipped files, as a staged stream. The
    landed files go once RAW holds their rows: nothing reads them again."""
    root, _ = _land(s, d, compression="gzip")
    raw = scratch_dir(s, "raw_table")
    st.stream_ingest(s, root, raw, scratch_dir(s, "ckpt_ingest")).awaitTermination()
    delete_path(s, root)
    return st.raw_stream(s, raw)


def _stream_upsert(s, d):
    table = FactTable(s, scratch_dir(s, "stream_fct"))
    st.stream_upsert_fact(st.staged_stream(_raw_stream(s, d)), table, scratch_dir(s, "ckpt_upsert")).awaitTermination()
    return table.read().drop("load_ts")  # the clock


def _stream_kpi(s, d):
    table, kpi = FactTable(s, scratch_dir(s, "stream_fct_kpi")), scratch_dir(s, "stream_kpi")
    st.stream_daily_kpi(st.staged_stream(_raw_stream(s, d)), table, kpi, m.dim(s, d), scratch_dir(s, "ckpt_kpi")).awaitTermination()
    return st.read_kpi(s, kpi).drop("latest_load_ts")  # the clock


def _stream_quality(s, d):
    """The scan metrics of all batches added up."""
    metrics = scratch_dir(s, "quality_metrics")
    rows = _raw_stream(s, d)
    typed = fs.typed(rows)
    st.stream_quality_metrics(typed, metrics, scratch_dir(s, "ckpt_quality")).awaitTermination()
    per_batch = s.read.parquet(metrics)
    return per_batch.agg(*[F.sum(c).alias(c) for c in per_batch.columns if c != "batch_id"])


def _manifests(s, d):
    root, _ = _land(s, d)
    mroot = scratch_dir(s, "manifests")
    ld.write_checksum_manifest(s, root, mroot)
    return root, mroot


def _by_source(rows, *aggs):
    return rows.groupBy("source_file_name").agg(*aggs)


def _manifest_records(s, d):
    """Manifest records by source file: rows, and whether every record names
    the algorithm and a digest of the right length."""
    rows = fs.scan_checksum_manifests(s, _manifests(s, d)[1])
    good = (F.col("checksum_algorithm") == "SHA-256") & F.col("checksum_sha256").rlike("^[0-9a-f]{64}$") & (F.col("file_size_bytes") > 0)
    return _by_source(rows.withColumn("source_file_name", fs.source_file(F.col("data_s3_uri"))),
                      F.sum("expected_row_count").alias("expected_row_count"), F.min(good).alias("is_complete"))


def _written_manifests(s, d):
    """The manifest files as the sink wrote them, read as plain JSON."""
    rows = s.read.json(_manifests(s, d)[1])
    return _by_source(rows.withColumn("source_file_name", fs.source_file(F.col("s3_uri"))), F.sum("row_count").alias("row_count"),
                      (F.count("*") == F.count_distinct("s3_key")).alias("one_record_per_file"))


def _ingestion_audit(s, d):
    """Manifests appended to their own table by a stream, whose second run
    finds nothing new: rows by source file, and records beyond one per file."""
    _, mroot = _manifests(s, d)
    audit, ckpt = scratch_dir(s, "ingestion_audit"), scratch_dir(s, "ckpt_audit")
    for _ in range(2):
        st.stream_manifests(s, mroot, audit, ckpt).awaitTermination()
    rows = s.read.parquet(audit).withColumnRenamed("data_file", "source_file_name")
    return _by_source(rows, F.sum("row_count").alias("row_count"), (F.count("*") - F.count_distinct("s3_uri")).alias("repeated_records"))


def _fingerprints(s, d):
    """Digests of the landed files, held against those of their lines as
    Spark's text reader gives them: rows by source file."""
    root, _ = _land(s, d)
    one = s.read.option("recursiveFileLookup", True).text(root, wholetext=True)
    lines = one.select(fs.unescaped(F.col("_metadata.file_path")).alias("p"), F.sha2("value", 256).alias("expected"))
    files = ig.file_fingerprints(s, root)
    both = files.join(lines, F.regexp_replace("path", "^file:/+", "/") == F.regexp_replace("p", "^file:/+", "/"), "left")
    return _by_source(both.withColumn("source_file_name", fs.source_file(F.col("path"))), F.min(F.coalesce(F.col("sha256") == F.col("expected"), F.lit(False))).alias("digests_agree"))


def _verify(s, d):
    root, mroot = _manifests(s, d)
    rows = ig.verify_checksums(ig.file_fingerprints(s, root), fs.scan_checksum_manifests(s, mroot))
    return _by_source(rows.withColumn("source_file_name", fs.source_file(F.col("path"))),
                      F.min("checksum_status").alias("lowest_status"), F.max("checksum_status").alias("highest_status"))


def _verify_rows(s, d):
    root, mroot = _manifests(s, d)
    landed = fs.scan_csv_batch(s, root, landed_schema(m.raw(s, d)))
    by_path = landed.select(F.col("_metadata.file_path").alias("source_file_name"))  # manifests name part files
    manifests = fs.scan_checksum_manifests(s, mroot)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    by_path = by_path.withColumn("source_file_name", plain(fs.unescaped(F.col("source_file_name"))))
    rows = ig.verify_row_counts(manifests.withColumn("data_s3_uri", plain(F.col("data_s3_uri"))), by_path)
    return _by_source(rows.withColumn("source_file_name", fs.source_file(F.col("source_file_name"))), F.sum("expected_row_count").alias("expected_row_count"),
                      F.sum("loaded_row_count").alias("loaded_row_count"), F.sum(F.abs("row_count_difference")).alias("row_count_difference"))


def _header_drift(s, d):
    """Drift of the messy landing's files, by source file."""
    rows = ig.file_header_drift(s, _land_messy(s, d), ct.load_contract(), ld.RAW_CSV_COLUMNS)
    return _by_source(rows.withColumn("source_file_name", fs.source_file(F.col("path"))), F.max("is_reordered").alias("is_reordered"),
                      F.max(F.array_join("missing_required_columns", ",")).alias("missing"), F.max(F.array_join("additive_columns", ",")).alias("additive"))


def _run_elt(s, d):
    raw = m.raw(s, d)
    newest = raw.agg(F.max(F.col("load_ts").cast("timestamp"))).first()[0]
    out = pl.run_elt(s, raw, scratch_dir(s, "elt"), as_of=m.last_order_date(s, d), gate=False,  # the fixture plants failing rows
                     tie_breakers=list(ad.FIXTURE_TIE_BREAKERS), loaded_by=newest and newest + timedelta(hours=1))
    return s.read.parquet(out["mart_sales_daily_kpi"])


def _run_layer(s, d):
    out = pl.run_layer(s, m.raw(s, d), scratch_dir(s, "elt_staging"), "staging",
                       tie_breakers=list(ad.FIXTURE_TIE_BREAKERS))
    return s.read.parquet(out["stg_sales"])


def _exclude_manifests(s, d):
    """RAW of a landing in which every data file has a manifest beside it:
    rows by source file, and how many of them stem from a manifest."""
    root, _ = _land(s, d)
    ld.write_checksum_manifest(s, root, f"{root}/manifests")
    raw = scratch_dir(s, "raw_table")
    st.stream_ingest(s, root, raw, scratch_dir(s, "ckpt_ingest")).awaitTermination()
    rows = st.read_raw(s, raw)
    bad = fs.manifest_rows(rows).select("source_file_name").distinct().withColumn("is_manifest", F.lit(True))
    return _by_source(rows.join(bad, "source_file_name", "left"), F.count("*").alias("row_count"), F.count("is_manifest").alias("manifest_rows"))


def _sync_columns(s, d):
    # the stored fact lacks the optional channel column; the new schema adds it
    target = m.fct(s, d)
    like = target.withColumn("sales_channel", F.lit(None).cast("string")).drop("generated_at_utc")
    return fa.sync_columns(target, like)


def _promote_optional(s, d):
    return sg.stg_sales(m.raw(s, d), tie_breakers=ad.FIXTURE_TIE_BREAKERS, include_optional=True)


def _add_optional(s, d):
    """A stored RAW table gains a column: older segments lack the channel,
    newer ones have it, and one merged schema reads both."""
    raw, root = m.raw(s, d), scratch_dir(s, "raw_segments")
    late = F.col("source_file_name").ilike(sm.LATE_PATTERN)
    raw.where(~late).write.parquet(f"{root}/segment=1")
    channel = F.concat(F.lit("channel "), F.col("product_id") % 4)
    raw.where(late).withColumn("sales_channel", channel).write.parquet(f"{root}/segment=2")
    stored = s.read.option("mergeSchema", True).parquet(root).drop("segment")
    return sg.stg_sales(stored, tie_breakers=ad.FIXTURE_TIE_BREAKERS, include_optional=True)


def _land_daily(s, d):
    """Rows by arrival month, as the folders of the landing have them."""
    counts = ig.file_row_counts(s, _land(s, d)[0])
    folder = [F.regexp_extract("path", rf"/{c}=([^/]+)/", 1).alias(c) for c in ("year", "month")]
    return counts.groupBy(*folder).agg(F.sum("row_count").alias("row_count"))


query("land_daily")(_land_daily)
query("land_late")(_landed_rows("late"))
query("land_backfill")(_landed_rows("backfill"))
query("list_landing_files")(_listing)
query("scan_csv_batch")(_scan_csv)
query("attach_lineage")(_with_lineage)
query("ingest_files_incremental")(_ingest_incremental)
query("stream_ingest")(_stream_ingest)
query("stream_dedup")(_stream_dedup)
query("stream_upsert_fact")(_stream_upsert)
query("stream_daily_kpi")(_stream_kpi)
query("stream_quality_metrics")(_stream_quality)
query("write_checksum_manifest")(_written_manifests)
query("scan_checksum_manifests")(_manifest_records)
query("file_ingestion_audit")(_ingestion_audit)
query("file_fingerprints")(_fingerprints)
query("file_row_counts")(_landed_rows("daily"))
query("verify_checksums")(_verify)
query("verify_row_counts")(_verify_rows)
query("file_header_drift")(_header_drift)
query("run_elt")(_run_elt)
query("run_layer")(_run_layer)
query("sync_all_columns")(_sync_columns)
query("promote_optional")(_promote_optional)
query("add_optional_column")(_add_optional)
query("exclude_manifests")(_exclude_manifests)

# --- schema contract, completeness, helpers -----------------------------------------


def _expected(s):
    return ct.inline_values(s, ct.load_contract())


def _actual(s, d):
    """The columns of RAW text with the types that all their values take."""
    raw = m.raw(s, d)
    return ct.observed_columns(raw.select(*[F.col(c).cast("string") for c in raw.columns]))


query("scan_table_columns")(lambda s, d: _actual(s, d).select("ordinal_position", "column_name", "contract_type"))
query("infer_contract_schema")(lambda s, d: _actual(s, d).select("column_name", "contract_type"))
query("schema_validation_report")(lambda s, d: ct.schema_validation_report(_expected(s), _actual(s, d)))
query("join_expected_actual_schema")(lambda s, d: ct.schema_validation_report(_expected(s), _actual(s, d))
                                     .select("column_name", "expected_type", "actual_type"))
query("additive_column_report")(lambda s, d: ct.additive_column_report(_expected(s), _actual(s, d)))
query("anti_additive_columns")(lambda s, d: ct.additive_column_report(_expected(s), _actual(s, d))
                               .select("column_name"))
query("missing_required")(lambda s, d: _expected(s).filter("is_required").select("column_name")
                          .join(_actual(s, d).select("column_name"), "column_name", "left_anti"))
query("additive_columns")(lambda s, d: _actual(s, d).select("column_name")
                          .join(_expected(s).select("column_name"), "column_name", "left_anti"))
query("validate_contract")(lambda s, d: ct.contract_status(_expected(s), _actual(s, d), ct.load_contract().allow_additive_columns))
query("normalize_columns")(lambda s, d: ct.normalize_columns(
    m.raw(s, d).toDF(*[f" {c.upper()} " for c in m.raw(s, d).columns])))
query("files_not_loaded")(lambda s, d: sm.files_not_loaded(m.raw(s, d), m.fct(s, d)))
query("all_files_loaded")(lambda s, d: sm.all_files_loaded(m.raw(s, d), m.fct(s, d)))
query("require_columns")(lambda s, d: sv.require_columns(_daily(s, d)))
query("rename_compat")(lambda s, d: sv.rename_compat(marts.dim_product_categories(m.fct(s, d))))
query("project_present")(lambda s, d: sv.project_present(_daily(s, d), list(sv.DAILY_TABLE_COLUMNS) + ["not_a_column"]))
query("materialize_full")(lambda s, d: s.read.parquet(
    ld.materialize_full(m.stg(s, d), scratch_dir(s, "layers"), "staging", "stg_sales")))
query("row_generator")(lambda s, d: m.dim(s, d).select("date_day"))

# --- sub-steps of the models, primitive aggregates, joins -------------------------------

STAMP_AS_OF = datetime(2024, 6, 30, 0, 0, 0)


def _staged(s, d):
    raw = m.raw(s, d)
    return raw.select(*sg.stage_columns(raw), "l_suppkey")


query("sales_event_key")(lambda s, d: m.raw(s, d).select(
    "order_id", "batch_id", "source_file_name", sg.sales_event_key(m.raw(s, d)).alias("sales_event_key")))
query("stage_cast")(lambda s, d: _staged(s, d).select(
    "order_id", "customer_id", "product_id", "order_timestamp", "order_date", "quantity",
    "unit_price", "gross_amount", "discount_amount", "net_amount", "load_ts"))
def _normalized(s, d):
    """Normalised text of rows whose category words are joined by marks."""
    raw = m.raw(s, d).withColumn("product_category", F.translate("product_category", "t", "-"))
    raw = raw.withColumn("payment_method", F.replace("payment_method", F.lit("T S"), F.lit("T/s")))
    return raw.select(*sg.stage_columns(raw)).select("sales_event_key", "product_category", "payment_method", "order_status")


query("stage_normalize")(_normalized)
query("stage_not_null_key")(lambda s, d: m.raw(s, d).filter(F.col("order_id").isNotNull()))
query("enrich_order_month")(lambda s, d: m.stg(s, d).select(
    "sales_event_key", im.order_month(F.col("order_date")).alias("order_month")))
query("enrich_discount_rate")(lambda s, d: m.stg(s, d).select(
    "sales_event_key", im.discount_rate(F.col("discount_amount"), F.col("gross_amount")).alias("discount_rate")))
query("enrich_status_flags")(lambda s, d: m.stg(s, d).select(
    "sales_event_key", "order_status",
    im.is_completed(F.col("order_status")).alias("is_completed_order"),
    im.is_failed_or_reversed(F.col("order_status")).alias("is_failed_or_reversed_order")))
query("fct_projection")(lambda s, d: fa.fct_projection(m.enriched(s, d), stamp=True, as_of=STAMP_AS_OF))
query("safe_column")(lambda s, d: m.raw(s, d).select(
    safe_column(m.raw(s, d), "ORDER_ID", "bigint").alias("order_id"),
    safe_column(m.raw(s, d), "generated_at_utc", "timestamp"),
    safe_column(m.raw(s, d), "sales_channel", "string")))
query("dedup_latest")(lambda s, d: sg.dedup_latest(
    m.fct(s, d).select("customer_id", "sales_event_key", "order_timestamp", "net_amount"),
    ["customer_id"], [F.col("order_timestamp").desc_nulls_last(), F.col("sales_event_key").asc()]))
query("join_daily_date_dim")(lambda s, d: marts.daily_sales(m.fct(s, d)).join(
    m.dim(s, d), F.col("order_date") == F.col("date_day"), "left").select(
    "order_date", "date_day", "month_name", "is_weekend", "total_orders"))
query("join_raw_fact_files")(lambda s, d: marts.agg_files_raw(m.raw(s, d)).join(
    marts.agg_files_fact(m.fct(s, d)), "source_file_name", "left").select(
    "source_file_name", "raw_row_count", "fact_row_count"))
query("agg_count")(lambda s, d: m.fct(s, d).groupBy("order_date").agg(F.count(F.lit(1)).alias("total_orders")))
query("agg_count_if")(lambda s, d: marts.daily_sales(m.fct(s, d)).select(
    "order_date", "completed_orders", "pending_orders", "cancelled_orders", "refunded_orders"))
query("agg_count_distinct")(lambda s, d: m.fct(s, d).groupBy("product_category").agg(
    F.count_distinct("product_id").alias("distinct_products"),
    F.count_distinct("customer_id").alias("unique_customers")))
query("agg_sum_amounts")(lambda s, d: m.fct(s, d).groupBy("order_date").agg(
    money_sum("gross_amount").alias("gross_sales_amount"),
    money_sum("discount_amount").alias("total_discount_amount"),
    money_sum("net_amount").alias("net_sales_amount")))
query("agg_sum_case")(lambda s, d: m.fct(s, d).groupBy("customer_id").agg(
    money_sum(F.when(F.col("is_completed_order"), F.col("net_amount")).otherwise(F.lit(0)))
    .alias("completed_net_sales_amount")))
query("agg_avg_case")(lambda s, d: m.fct(s, d).groupBy("customer_id").agg(
    exact_avg(F.when(F.col("is_completed_order"), F.col("net_amount"))).alias("avg_completed_order_amount")))
query("agg_ratio_of_sums")(lambda s, d: m.fct(s, d).groupBy("order_date").agg(
    safe_ratio(F.sum("discount_amount"), F.sum("gross_amount"), 0.0).alias("discount_rate")))
query("agg_min_max")(lambda s, d: m.fct(s, d).groupBy("customer_id").agg(
    F.min("order_date").alias("first_order_date"), F.max("order_date").alias("latest_order_date"),
    F.min("load_ts").alias("first_load_ts"), F.max("load_ts").alias("last_load_ts")))


def _backfill_range(s, d, start=date(2024, 5, 1), end=date(2024, 5, 31)):
    """Re-aimed backfill: land the backfill rows whose business date falls
    in [start, end] (one partition per day), then replay the same window;
    dynamic partition overwrite leaves exactly one copy per day."""
    if end < start:
        raise ValueError("end_date must be greater than or equal to start_date")
    rows = sm.file_name_filter(m.raw(s, d), sm.BACKFILL_PATTERN).filter(
        F.to_date("order_timestamp").between(F.lit(start), F.lit(end)))
    root = scratch_dir(s, "backfill_window")
    ld.land_backfill(rows, root)
    ld.land_backfill(rows, root)  # replay: idempotent
    return s.read.option("header", True).schema(landed_schema(rows).add("business_date", "date")).csv(root)


query("backfill_range")(_backfill_range)
query("quarantine_rows")(_quarantine)


def _row_tests(s, d):
    raw = materialize(m.raw(s, d), "tested_raw")  # staging, raw tests and audit read it once each
    stg = materialize(m.stg_of(raw), "tested_stg")
    enriched = im.int_sales_enriched(stg)
    fct = fa.fct_projection(enriched)
    tables = {
        "sales_raw": raw, "stg_sales": stg, "int_sales_enriched": enriched, "dim_date": m.dim(s, d),
        "fct_sales": fct, "mart_sales_daily_kpi": marts.mart_sales_daily_kpi(fct, m.dim(s, d)),
        "mart_customer_sales_kpi": marts.mart_customer_sales_kpi(fct),
        "mart_load_audit": marts.mart_load_audit(raw, fct),
        "mart_product_category_sales_kpi": marts.mart_product_category_sales_kpi(fct),
    }
    return q.row_test_report(tables, q.ROW_TESTS)


query("row_test_report")(_row_tests)
