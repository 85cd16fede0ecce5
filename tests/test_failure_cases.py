"""Hand-written failure cases (FIXTURES.md section 3) on small frames."""

from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.operators import contract as ct
from tidemark.operators import integrity as ig
from tidemark.operators import marts, quality
from tidemark.operators.fact import fct_sales, incremental_filter, merge_keyed
from tidemark.operators.intermediate import int_sales_enriched
from tidemark.operators.staging import quarantine_rows, stg_sales
from tidemark.session import materialize
from tidemark.sinks import landing as ld
from tidemark.sinks.fact_table import FactTable
from tidemark.sources import files as fs

RAW_DDL = (
    "order_id bigint, customer_id bigint, product_id bigint, product_category string, "
    "order_timestamp timestamp_ntz, quantity bigint, unit_price decimal(18,2), gross_amount decimal(18,2), "
    "discount_amount decimal(18,2), net_amount decimal(18,2), payment_method string, order_status string, "
    "batch_id string, generated_at_utc string, source_file_name string, load_ts timestamp"
)
T0 = datetime(2024, 3, 1, 10, 0, 0)


def row(order_id=1, qty=2, price="10.00", disc="1.00", net=None, status="Completed", file="f1.csv",
        load=datetime(2024, 3, 2, 8, 0, 0), batch="b1", gross=None, customer=1001, product=101):
    price_d = D(price)
    gross_d = D(gross) if gross is not None else (price_d * qty).quantize(D("0.01"))
    disc_d = D(disc) if disc is not None else None
    if net is None:
        net_d = max(gross_d - disc_d, D("0")) if disc_d is not None else D("5.00")
    else:
        net_d = D(net)
    return (order_id, customer, product, " electronics ", T0, qty, price_d, gross_d, disc_d, net_d,
            "credit card", status, batch, "2024-03-02T08:00:00+00:00", file, load)


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_DDL)


def fct_of(raw):
    return fct_sales(int_sales_enriched(stg_sales(raw)))


# --- batch validation --------------------------------------------------------------------

def test_empty_batch_raises(spark):
    with pytest.raises(ValueError, match="empty"):
        quality.validate_batch(raw_df(spark, []))


def test_missing_required_column_named(spark):
    df = raw_df(spark, [row()]).drop("quantity")
    with pytest.raises(ValueError, match="quantity"):
        quality.validate_batch(df)
    with pytest.raises(ValueError, match="quantity"):
        ct.validate_contract(df)


def test_duplicate_order_id_raises(spark):
    with pytest.raises(ValueError, match="repeat an order_id"):
        quality.validate_batch(raw_df(spark, [row(1), row(1)]))


def test_negative_net_raises_and_fails_scan(spark):
    raw = raw_df(spark, [row(1, net="-1.00")])
    with pytest.raises(ValueError, match="net_amount"):
        quality.validate_batch(raw)
    rep = quality.metric_report(raw, [c for c in quality.RAW_CHECKS if c.kind == "failed_rows"])
    out = {r.check_name: (r.metric_value, r.outcome) for r in rep.collect()}
    assert out["negative net amount should not exist"] == (1.0, "fail")


def test_zero_quantity_raises(spark):
    with pytest.raises(ValueError, match="quantity"):
        quality.validate_batch(raw_df(spark, [row(1, qty=0, gross="0.00", net="0.00")]))


def test_unknown_status_is_accepted_values_failure(spark):
    raw = raw_df(spark, [row(1, status="SHIPPED"), row(2)])
    stg = stg_sales(raw)
    bad = quality.check_accepted_values(stg, "order_status", quality.ACCEPTED_STATUSES).collect()
    assert [(r.order_status, r.n_records) for r in bad] == [("SHIPPED", 1)]


# --- contract --------------------------------------------------------------------------------

def test_unit_price_as_text_is_type_mismatch(spark):
    df = raw_df(spark, [row()]).withColumn("unit_price", F.col("unit_price").cast("string"))
    rep = ct.contract_findings(df, ct.load_contract())
    assert rep["type_mismatches"] == [{"column_name": "unit_price", "expected_type": "number", "actual_type": "string"}]
    with pytest.raises(ValueError, match="unit_price: TYPE_MISMATCH"):
        ct.validate_contract(df)


def test_additive_column_allowed_or_not(spark):
    df = raw_df(spark, [row()]).withColumn("coupon", F.lit("x"))
    allowed = ct.load_contract()
    rep = ct.validate_contract(df.drop("source_file_name", "load_ts"), allowed)
    assert rep["additive_columns"] == ["coupon"] and rep["schema_validation_status"] == "PASSED"
    strict = ct.Contract(**{**allowed.__dict__, "allow_additive_columns": False})
    with pytest.raises(ValueError, match="coupon: ADDITIVE"):
        ct.validate_contract(df.drop("source_file_name", "load_ts"), strict)


def test_types_are_told_by_all_values(spark):
    rows = [("1", "1.5", "2024-03-01 10:00:00", "true", "x", None, "7"), ("-20", "3", "2024-03-02", "FALSE", "1", None, "7 a"), (None, None, None, None, None, None, None)]
    text = spark.createDataFrame(rows, "i string, n string, t string, b string, s string, none string, ` M ` string")
    got = {r.column_name: r.contract_type for r in ct.observed_columns(text).collect()}
    assert got == {"i": "integer", "n": "number", "t": "datetime", "b": "boolean", "s": "string", "none": "string", "m": "string"}
    assert ct.observed_columns(text.limit(0)).count() == 7
    expected = spark.createDataFrame([(1, "i", "integer", True), (2, "n", "integer", False), (3, "gone", "string", True), (4, "later", "string", False)],
                                     "ordinal_position int, column_name string, expected_type string, is_required boolean")
    for allow in (True, False):
        status = {r.column_name: (r.validation_status, r.breaks_contract) for r in ct.contract_status(expected, ct.observed_columns(text.select("i", "n", "s")), allow).collect()}
        assert status == {"i": ("PASSED", False), "n": ("TYPE_MISMATCH", True), "gone": ("MISSING_COLUMN", True), "later": ("MISSING_COLUMN", False),
                          "s": ("ADDITIVE_COLUMN_DETECTED", not allow)}


ODD_VALUES = ["1", "+1", "-2024", "1.5", "-1.5e3", "1d", "1.f", "0x1.8P-2d", "NaN", "+inf", "1e999", "", ".", "..1", "1e", "1.2.3", "\t1", "1\n", "\r\n7", "\u0663",
              "TRUE", "False", "t", "2024-01", "2024-01-01T00:00:00Z", "12:30", "T12:30", "1/2/2024", "a-b", "-", ":1", "5\x00", "-5.", "99999999999999999999", "- 5",
              "1,5", "2024-02-30", "\u00a05", "0x10", "1L", "-2024.5", "now", None]


def test_each_value_is_told_as_by_its_casts(spark):
    v = F.trim("value")
    takes = (v.rlike(r"^[+-]?\d+$"), v.try_cast("double").isNotNull() & v.rlike(r"\d"),
             v.try_cast("timestamp").isNotNull() & v.rlike("[-:/]"), F.lower(v).isin("true", "false"))
    rows = spark.createDataFrame([(x,) for x in ODD_VALUES], "value string")
    for r in rows.select("value", ct.value_kinds(F.col("value")).alias("kinds"), F.array(*[F.coalesce(t, F.lit(False)) for t in takes]).alias("takes")).collect():
        assert r.kinds == (None if r.value is None else sum(ok << i for i, ok in enumerate(r.takes))), r


def test_type_tests_stand_in_the_plan_once(spark):
    """Not once a column: the code of one aggregate over 16 columns by 4 tests was too long to compile well."""
    wide = spark.range(3).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(16)])
    plan = ct.observed_columns(wide)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_and") == 1 and "count_if" not in plan and {r.contract_type for r in ct.observed_columns(wide).collect()} == {"integer"}


def test_plain_numbers_and_moments_pass_few_tests(spark):
    """A value is trimmed once, a plain number is told by one pattern without a cast, one with a colon or slash meets none."""
    names = [f"c{i}" for i in range(16)]
    plan = ct.observed_columns(spark.range(3).select(*[F.col("id").cast("string").alias(n) for n in names]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == len(names) and "bit_and" in plan
    values = ["7", "-7", "1.5", "+0.25", "7\u2028", "1.5\u2028", "1.5\n", "1.", ".5", "1.5.5", "9" * 400 + ".5"]
    told = [3, 3, 2, 2, 3, 0, 2, 2, 2, 0, 2]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, value string")
    got = rows.select("i", ct.value_kinds(F.col("value")).alias("k"), F.col("value").rlike(ct.PLAIN_NUMBER).alias("plain")).orderBy("i").collect()
    assert [r.k for r in got] == told
    assert [r.plain for r in got] == [True] * 5 + [False] * 5 + [True]


def test_optional_column_absent_is_typed_null(spark):
    stg = stg_sales(raw_df(spark, [row()]), include_optional=True)
    assert dict(stg.dtypes)["sales_channel"] == "string"
    assert stg.select("sales_channel").first()[0] is None


def test_reordered_header_is_breaking(spark, tmp_root):
    good = spark.createDataFrame([(1, 2)], "order_id bigint, customer_id bigint")
    swapped = spark.createDataFrame([(2, 1)], "customer_id bigint, order_id bigint")
    good.coalesce(1).write.option("header", True).csv(f"{tmp_root}/a")
    swapped.coalesce(1).write.option("header", True).csv(f"{tmp_root}/b")
    drift = {os.path.basename(os.path.dirname(r.path)): r for r in
             ig.file_header_drift(spark, tmp_root, ct.load_contract()).collect()}
    assert drift["b"].is_reordered and drift["b"].is_breaking
    assert not drift["a"].is_reordered
    with pytest.raises(Exception):
        fs.scan_csv_batch(spark, f"{tmp_root}/b", good.schema).collect()


# --- staging / audit ---------------------------------------------------------------------------

def test_null_order_id_dropped_and_file_mismatched(spark):
    raw = raw_df(spark, [row(None), row(2)])
    fct = fct_of(raw)
    assert fct.count() == 1
    audit = marts.mart_load_audit(raw, fct).collect()
    assert [(r.raw_row_count, r.fact_row_count, r.reconciliation_status) for r in audit] == [(2, 1, "MISMATCHED")]


def test_tie_has_deterministic_survivor(spark):
    a, b = row(1, product=200), row(1, product=100)
    for rows in ([a, b], [b, a]):
        out = stg_sales(raw_df(spark, rows)).collect()
        assert len(out) == 1 and out[0].product_id == 100


def test_latest_load_wins(spark):
    early, late = row(1, qty=1, load=datetime(2024, 3, 2)), row(1, qty=3, load=datetime(2024, 3, 5))
    assert stg_sales(raw_df(spark, [early, late])).first().quantity == 3


def test_null_source_file_is_mismatched(spark):
    raw = raw_df(spark, [row(1, file=None)])
    audit = marts.mart_load_audit(raw, fct_of(raw)).collect()
    assert audit[0].fact_row_count == 0 and audit[0].reconciliation_status == "MISMATCHED"


# --- amount reconciliation ------------------------------------------------------------------------

def test_amount_checks(spark):
    raw = raw_df(spark, [
        row(1, gross="20.02"),                     # gross != qty * price by 0.02 -> failing
        row(2, disc="50.00", net="0.00"),          # discount > gross, net 0 -> passes
        row(3, disc=None, net="5.00"),             # NULL discount -> predicate NULL, not reported
    ])
    bad = quality.check_amounts_reconcile(fct_of(raw)).collect()
    assert sorted(r.quantity for r in bad) == [2] and len(bad) == 1
    assert bad[0].gross_amount == D("20.02")


# --- incremental ------------------------------------------------------------------------------------

def test_redelivered_key_updates_in_place(spark, tmp_root):
    first = fct_of(raw_df(spark, [row(1, qty=1), row(2)]))
    store = FactTable(spark, tmp_root)
    store.upsert(first)
    again = fct_of(raw_df(spark, [row(1, qty=5, load=datetime(2024, 3, 9))]))
    store.upsert(again)
    out = {r.order_id: r.quantity for r in store.read().collect()}
    assert out == {1: 5, 2: 2}
    merged = {r.order_id: r.quantity for r in merge_keyed(first, again).collect()}
    assert merged == out


def test_row_older_than_lookback_not_picked_up(spark):
    target = fct_of(raw_df(spark, [row(1, load=datetime(2024, 3, 2, 12, 0, 0))]))
    src = int_sales_enriched(stg_sales(raw_df(spark, [
        row(2, load=datetime(2024, 3, 2, 10, 59, 0)),   # older than max - 1h
        row(3, load=datetime(2024, 3, 2, 11, 0, 0)),    # exactly max - 1h: kept
    ])))
    assert sorted(r.order_id for r in incremental_filter(src, target).collect()) == [3]


def test_empty_target_takes_everything(spark):
    target = fct_of(raw_df(spark, [row(1)])).limit(0)
    src = int_sales_enriched(stg_sales(raw_df(spark, [row(2, load=datetime(1999, 1, 1))])))
    assert incremental_filter(src, target).count() == 1


# --- freshness / aggregates -------------------------------------------------------------------------

@pytest.mark.parametrize("age_h,status", [(25, "pass"), (27, "warn"), (31, "error")])
def test_freshness(spark, age_h, status):
    raw = raw_df(spark, [row(1, load=datetime(2024, 3, 2, 0, 0, 0))])
    as_of = datetime(2024, 3, 2, 0, 0, 0).replace(hour=0) + __import__("datetime").timedelta(hours=age_h)
    assert quality.check_source_freshness(raw, as_of).first().freshness_status == status


def test_group_without_completed_orders(spark):
    fct = fct_of(raw_df(spark, [row(1, status="Pending", customer=7)]))
    r = marts.mart_customer_sales_kpi(fct).first()
    assert r.completed_net_sales_amount == D("0.00") and r.avg_completed_order_amount is None


# --- files --------------------------------------------------------------------------------------------

def test_checksum_mismatch_raises(spark, tmp_root):
    data = f"{tmp_root}/landing"
    raw_df(spark, [row(1), row(2)]).drop("source_file_name", "load_ts").coalesce(1) \
        .write.option("header", True).csv(data)
    ld.write_checksum_manifest(spark, data, f"{tmp_root}/manifests")
    manifests = fs.scan_checksum_manifests(spark, f"{tmp_root}/manifests")
    ig.require_checksums_match(ig.verify_checksums(ig.file_fingerprints(spark, data), manifests))
    # change the landed bytes after the manifest was written
    path = [p for p in os.listdir(data) if p.endswith(".csv")][0]
    with open(os.path.join(data, path), "a", encoding="utf-8") as fh:
        fh.write("tampered\n")
    crc = os.path.join(data, f".{path}.crc")  # local-FS checksum sidecar; object stores have none
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(ValueError, match="Checksum"):
        ig.require_checksums_match(ig.verify_checksums(ig.file_fingerprints(spark, data), manifests))


def test_checksums_and_headers_read_in_blocks(spark, tmp_root):
    """A file far larger than a block hashes like the whole, and a header
    needs its first block alone, whatever the size of the file."""
    import hashlib
    import io

    from tidemark.sources import arrow_files as af

    class Counted(io.BytesIO):
        most = total = 0

        def read(self, n=-1):
            assert 0 < n <= af.CHUNK
            out = super().read(n)
            self.most, self.total = max(self.most, len(out)), self.total + len(out)
            return out

    body = b"\xef\xbb\xbforder_id,note\r\n" + b"1,x\n" * 2_000_000
    whole = Counted(body)
    assert af.sha256(whole) == hashlib.sha256(body).hexdigest() and whole.total == len(body)
    for size in (len(body), 200):
        stream = Counted(body[:size])
        assert af.first_line(stream) == b"order_id,note" and stream.total <= af.FIRST
    assert af.first_line(io.BytesIO(b"")) == b"" and af.first_line(io.BytesIO(b"a" * 100_000 + b"\nb")) == b"a" * 100_000
    os.makedirs(tmp_root, exist_ok=True)
    for name in ("plain.csv", "a+b %20.csv"):
        with open(os.path.join(tmp_root, name), "wb") as fh:
            fh.write(body)
    got = ig.file_fingerprints(spark, tmp_root).collect()
    assert {os.path.basename(r.path) for r in got} == {"plain.csv", "a+b %20.csv"}
    assert {(r.length, r.sha256) for r in got} == {(len(body), hashlib.sha256(body).hexdigest())}
    assert {tuple(r.columns) for r in ig.file_headers(spark, tmp_root).collect()} == {("order_id", "note")}


@pytest.mark.parametrize("split", ["128m", "700", "97"])
def test_row_counts_over_splits_equal_the_csv_parser(spark, tmp_root, split):
    """Quoted line ends, escaped marks, blank lines, CRLF and splits that
    begin inside a quoted field."""
    import csv
    import random

    rng = random.Random(split)
    os.makedirs(tmp_root, exist_ok=True)
    for i in range(5):
        with open(f"{tmp_root}/f {i}+%20.csv", "w", newline="", encoding="utf-8") as fh:
            w = csv.writer(fh, lineterminator=["\n", "\r\n"][i % 2])
            w.writerow(["a", "b"])
            for j in range([0, 1, 60, 200, 90][i]):
                w.writerow([j, "".join(rng.choice(["x", "\n", '"', ",", "yy ", "\n\n"]) for _ in range(rng.randint(0, 6)))])
                if rng.random() < 0.1:
                    fh.write("\n")
    with open(f"{tmp_root}/backslash.csv", "w", encoding="utf-8") as fh:
        fh.write('a,b\n1,"one \\" mark\nand \\\\"\n2,x\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        for escape in ('"', "\\"):
            glob = "backslash.csv" if escape == "\\" else "[fn]*.csv"
            got = {os.path.basename(r.path): r.row_count for r in ig.file_row_counts(spark, tmp_root, glob, escape=escape).collect()}
            parsed = (spark.read.option("header", True).option("multiLine", True).option("escape", escape).option("pathGlobFilter", glob).csv(tmp_root)
                      .groupBy(fs.unescaped(F.col("_metadata.file_name"))).count().collect())
            assert {k: n for k, n in got.items() if n} == {r[0]: r[1] for r in parsed}
            assert escape == "\\" or got["f 0+%20.csv"] == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_text_raw_reads_by_name_and_tells_bad_rows_apart(spark, tmp_root):
    from tidemark.sources.files import REQUIRED_COLUMNS

    good = dict.fromkeys(REQUIRED_COLUMNS, "1") | {"order_timestamp": "2024-03-01 10:00:00", "product_category": " a,b ", "batch_id": ""}
    os.makedirs(tmp_root, exist_ok=True)

    def land(name, columns, *rows):
        with open(f"{tmp_root}/{name}", "w", encoding="utf-8") as fh:
            for r in (columns, *rows):
                fh.write(",".join(f'"{x}"' if "," in x else x for x in r) + "\n")

    cols = list(REQUIRED_COLUMNS)
    row = lambda **kw: [str((good | kw).get(c, "new")) for c in cols]
    land("a.csv", cols, row(order_id=1), row(order_id=2, quantity="two"), row(order_id=3, unit_price="9" * 30), row(order_id=4)[:-2], row(order_id=5) + ["x"])
    back = cols[::-1]
    land("b [1].csv", [c.upper() for c in back], [row(order_id=6)[cols.index(c)] for c in back])
    land("c.csv", [*cols, "coupon"], [*row(order_id=7), "ten"])
    land("d.csv", [c for c in cols if c != "quantity"], [v for c, v in zip(cols, row(order_id=8)) if c != "quantity"])
    open(f"{tmp_root}/e.csv", "w").close()
    rows = fs.scan_text(spark, tmp_root)
    got = {r.order_id: r for r in rows.collect()}
    assert {k: r.failed_columns for k, r in got.items() if r.failed_columns} == {
        "2": ["quantity"], "3": ["unit_price"], "4": ["_corrupt_record"], "5": ["_corrupt_record"], "8": ["quantity"]}
    assert got["6"].product_category == " a,b " and got["6"].quantity == "1" and got["7"].coupon == "ten" and got["1"].coupon is None
    assert got["5"]._corrupt_record.endswith(",x") and got["6"].source_file_name.endswith("b%20%5B1%5D.csv")
    typed = fs.typed(fs.accepted(rows)).collect()
    assert sorted(r.order_id for r in typed) == [1, 6, 7] and dict(fs.typed(fs.accepted(rows)).dtypes)["unit_price"] == "decimal(18,2)"


def test_source_file_keeps_plus_signs_and_percent_codes(spark):
    path = "file:///x/file=a%2Bb%2520c+d/part-0.csv"
    assert spark.range(1).select(fs.source_file(F.lit(path))).first()[0] == "a+b c+d"


def test_quoted_newline_is_one_row(spark, tmp_root):
    os.makedirs(tmp_root, exist_ok=True)
    with open(os.path.join(tmp_root, "q.csv"), "w", encoding="utf-8") as fh:
        fh.write('order_id,note\n1,"two\nlines"\n2,plain\n')
    with open(os.path.join(tmp_root, "empty.csv"), "w", encoding="utf-8") as fh:
        fh.write("order_id,note\n")
    counts = {os.path.basename(r.path): r.row_count for r in ig.file_row_counts(spark, tmp_root).collect()}
    assert counts == {"q.csv": 2, "empty.csv": 0}


def test_manifest_beside_csv_not_ingested(spark, tmp_root):
    os.makedirs(tmp_root, exist_ok=True)
    with open(os.path.join(tmp_root, "sales.csv"), "w", encoding="utf-8") as fh:
        fh.write("order_id,customer_id\n1,2\n")
    with open(os.path.join(tmp_root, "sales.csv.manifest.json"), "w", encoding="utf-8") as fh:
        fh.write('{"file_name": "sales.csv"}\n')
    schema = "order_id bigint, customer_id bigint"
    from pyspark.sql import types as T

    raw = fs.read_raw_with_lineage(spark, tmp_root, T._parse_datatype_string(schema))
    assert raw.count() == 1
    assert fs.manifest_rows(raw).count() == 0


def test_backfill_end_before_start_raises(spark):
    from tidemark.plans.catalog import _backfill_range

    with pytest.raises(ValueError):
        _backfill_range(spark, "unused", date(2024, 5, 3), date(2024, 5, 1))


def test_overflowing_quantity_is_quarantined(spark):
    raw = spark.createDataFrame([("1", "9" * 20), ("2", "3")], "order_id string, quantity string")
    assert [(r.order_id, r.failed_columns) for r in quarantine_rows(raw).collect()] == [("1", ["quantity"])]


def test_malformed_number_fails_strict_and_is_quarantined(spark):
    raw = spark.createDataFrame(
        [("1", "1001", "101", "x", "2024-03-01 10:00:00", "2", "10.00", "20.00", "1.00", "19.00", "c", "Completed",
          "b", "2024-03-02T08:00:00+00:00", "f.csv", datetime(2024, 3, 2)),
         ("2", "1001", "101", "x", "2024-03-01 10:00:00", "two", "10.00", "20.00", "1.00", "19.00", "c", "Completed",
          "b", "2024-03-02T08:00:00+00:00", "f.csv", datetime(2024, 3, 2))],
        "order_id string, customer_id string, product_id string, product_category string, order_timestamp string, "
        "quantity string, unit_price string, gross_amount string, discount_amount string, net_amount string, "
        "payment_method string, order_status string, batch_id string, generated_at_utc string, "
        "source_file_name string, load_ts timestamp")
    with pytest.raises(Exception):
        stg_sales(raw).collect()
    q = __import__("tidemark.operators.staging", fromlist=["x"]).quarantine_rows(raw).collect()
    assert [(r.order_id, r.failed_columns) for r in q] == [("2", ["quantity"])]
    # '9.6' rounds like the warehouse number cast instead of failing
    ok = stg_sales(raw.filter("order_id = '1'").withColumn("quantity", F.lit("9.6"))).first()
    assert ok.quantity == 10


def test_file_completeness_reports_missing_and_unexpected(spark):
    from tidemark.operators import summaries as sm

    expected = spark.createDataFrame([("s3://b/sales/raw/a.csv",), ("b.csv",), ("c.csv",)], "source_file_name string")
    loaded = spark.createDataFrame([("a.csv",), ("b.csv",), ("b.csv",), ("zzz.csv",)], "source_file_name string")
    assert sorted(r.file_name for r in sm.files_not_loaded(expected, loaded).collect()) == ["c.csv"]
    r = sm.all_files_loaded(expected, loaded).first()
    assert (r.expected_files, r.loaded_files, r.missing_files, r.unexpected_files, r.all_loaded) == (3, 3, 1, 1, False)
    ok = sm.all_files_loaded(expected.limit(2), loaded.filter("source_file_name != 'zzz.csv'")).first()
    assert ok.all_loaded


def test_first_upsert_writes_its_rows_once(spark, monkeypatch, tmp_path):
    """Stored rows are written before a merge; the first rows go straight to the table, which tells the ledger."""
    from tidemark.sinks import fact_table as ft

    written = []
    monkeypatch.setattr(ft, "materialize", lambda df, name: (written.append(name), materialize(df, name))[1])
    table = ft.FactTable(spark, str(tmp_path / "t"))
    rows = "sales_event_key string, source_file_name string, load_ts timestamp, v int"
    t1, t2 = datetime(2024, 3, 1), datetime(2024, 3, 2)
    table.upsert(spark.createDataFrame([("a", "f", t1, 1), ("b", None, t2, 2)], rows))
    assert written == [] and table.entries().select("rows", "newest").collect() == [(2, t2)]
    table.upsert(spark.createDataFrame([("a", "f", t2, 3)], rows))
    assert written == ["fact_delta"] and sorted(r.v for r in table.read().collect()) == [2, 3]
    empty = ft.FactTable(spark, str(tmp_path / "e"))
    empty.upsert(spark.createDataFrame([], rows), 0)
    assert empty.applied(0)
