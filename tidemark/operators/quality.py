"""Data-quality checks.

Two families, as in the reference:

* row checks (``check_*``) return the failing rows (empty = pass);
* metric checks (``Check``) compute one number per check and compare it to
  a threshold. ``quality_report`` evaluates a whole suite, per table one
  global aggregate for the scalar metrics and a group-by for each duplicate
  check (see ``metric_report``), and returns one row per check.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import hour_boundaries_between, strict_greatest

ACCEPTED_STATUSES = ("COMPLETED", "PENDING", "CANCELLED", "REFUNDED")
RECONCILIATION_STATUSES = ("MATCHED", "MISMATCHED")
AMOUNT_TOLERANCE = 0.01
FRESHNESS_WARN_HOURS, FRESHNESS_ERROR_HOURS = 26, 30


# --- row checks: return failing rows --------------------------------------------------

def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once (NULLs ignored) with their count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside ``values`` with their count (NULLs are not failures)."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def amounts_mismatch(tolerance: float = AMOUNT_TOLERANCE) -> Column:
    gross_expected = F.col("quantity") * F.col("unit_price")
    net_expected = strict_greatest(F.col("gross_amount") - F.col("discount_amount"), F.lit(0))
    tol = F.lit(tolerance).cast("decimal(10,2)")
    # NULL predicate (e.g. NULL discount) is not a failure, as in SQL
    return (F.abs(F.col("gross_amount") - gross_expected) > tol) | (
        F.abs(F.col("net_amount") - net_expected) > tol
    )


def check_amounts_reconcile(fct: DataFrame, tolerance: float = AMOUNT_TOLERANCE) -> DataFrame:
    return fct.filter(amounts_mismatch(tolerance)).select(
        "sales_event_key", "quantity", "unit_price", "gross_amount", "discount_amount", "net_amount"
    )


def check_load_audit_matched(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("reconciliation_status") != "MATCHED")


def hours_since_latest_load(raw: DataFrame, as_of: datetime) -> DataFrame:
    latest = F.max(F.col("load_ts").cast("timestamp"))
    return raw.agg(
        F.count(F.lit(1)).alias("row_count"),
        latest.alias("latest_load_ts"),
        hour_boundaries_between(latest, F.lit(as_of).cast("timestamp")).alias("hours_since_latest_load"),
    )


def check_source_freshness(raw: DataFrame, as_of: datetime, warn_after_hours: int = FRESHNESS_WARN_HOURS,
                           error_after_hours: int = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Age of ``max(load_ts)`` at ``as_of``: pass / warn / error."""
    latest = F.max(F.col("load_ts").cast("timestamp"))
    age_h = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(latest)) / F.lit(3_600_000_000)
    out = raw.agg(latest.alias("max_loaded_at"), age_h.alias("age_hours"))
    status = (
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(F.col("age_hours") > error_after_hours, F.lit("error"))
        .when(F.col("age_hours") > warn_after_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return out.select("max_loaded_at", F.round("age_hours", 6).alias("age_hours"), status.alias("freshness_status"))


# --- metric checks ----------------------------------------------------------------------

_OPS = {">": operator.gt, ">=": operator.ge, "=": operator.eq, "<": operator.lt, "<=": operator.le}


@dataclass(frozen=True)
class Check:
    """One metric check. ``kind`` is row_count | missing_count |
    duplicate_count | min | failed_rows; ``predicate`` is the failing-row
    condition (SQL text) for failed_rows."""

    table: str
    kind: str
    column: str | None = None
    op: str = "="
    threshold: float = 0
    name: str | None = None
    predicate: str | None = None

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        if self.kind == "row_count":
            return f"row_count {self.op} {self.threshold:g}"
        return f"{self.kind}({self.column}) {self.op} {self.threshold:g}"

    def outcome(self, metric: Column) -> Column:
        return F.when(_OPS[self.op](metric, F.lit(self.threshold)), F.lit("pass")).otherwise(F.lit("fail"))


def checked_columns(checks: Sequence[Check], table: str, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that the checks of ``table`` name."""
    told = " ".join(x for c in checks if c.table == table for x in (c.column, c.predicate) if x)
    return [c for c in columns if re.search(rf"\b{re.escape(c)}\b", told, re.IGNORECASE)]


def _scalar_metric(c: Check) -> Column:
    if c.kind == "row_count":
        return F.count(F.lit(1)).cast("double")
    if c.kind == "missing_count":
        return F.count_if(F.col(c.column).isNull()).cast("double")
    if c.kind == "min":
        return F.min(F.col(c.column)).cast("double")
    if c.kind == "failed_rows":
        return F.count_if(F.coalesce(F.expr(c.predicate), F.lit(False))).cast("double")
    raise ValueError(c.kind)


def _report_row(c: Check, metric: Column) -> Column:
    return F.struct(
        F.lit(c.table).alias("table_name"),
        F.lit(c.check_name).alias("check_name"),
        metric.alias("metric_value"),
        F.lit(f"{c.op} {c.threshold:g}").alias("threshold"),
        F.coalesce(c.outcome(metric), F.lit("fail")).alias("outcome"),
    )


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct non-NULL values that occur more than once."""
    return check_unique(df, column).agg(F.count(F.lit(1)).cast("double").alias("metric"))


def metric_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Report rows for the checks of one table: all scalar metrics in one
    global aggregate (a task sends one row), and each duplicate check as a
    group-by over its column alone, so no counters travel with a unique key.
    """
    scalar = [c for c in checks if c.kind != "duplicate_count"]
    dups = [c for c in checks if c.kind == "duplicate_count"]
    parts: list[DataFrame] = []
    if scalar:
        agg = df.agg(*[_scalar_metric(c).alias(f"m{i}") for i, c in enumerate(scalar)])
        rows = F.array(*[_report_row(c, F.col(f"m{i}")) for i, c in enumerate(scalar)])
        parts.append(agg.select(F.inline(rows)))
    for c in dups:
        parts.append(duplicate_count(df, c.column).select(F.inline(F.array(_report_row(c, F.col("metric"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_report(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check over all tables: table, check, value, threshold, outcome."""
    parts = [
        metric_report(tables[t], [c for c in checks if c.table == t])
        for t in dict.fromkeys(c.table for c in checks)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def require_passing(report: DataFrame) -> None:
    """Gate: raise if any check failed, naming every failed check (a report
    has one row per declared check)."""
    failed = report.filter(F.col("outcome") != "pass").collect()
    if failed:
        lines = ", ".join(f"{r.table_name}: {r.check_name} (= {r.metric_value})" for r in failed)
        raise AssertionError(f"{len(failed)} quality check(s) failed: {lines}")


# --- the reference's scan suites --------------------------------------------------------

def _missing(table: str, *cols: str) -> list[Check]:
    return [Check(table, "missing_count", c) for c in cols]


RAW_CHECKS = [
    Check("sales_raw", "row_count", op=">", threshold=0),
    *_missing("sales_raw", "order_id", "customer_id", "order_timestamp", "source_file_name", "load_ts"),
    # informational: order ids legitimately repeat across files
    Check("sales_raw", "duplicate_count", "order_id", op=">=", threshold=0),
    Check("sales_raw", "failed_rows", name="negative quantity should not exist", predicate="quantity <= 0"),
    Check("sales_raw", "failed_rows", name="negative net amount should not exist", predicate="net_amount < 0"),
    Check("sales_raw", "failed_rows", name="invalid order status should not exist",
          predicate="upper(order_status) not in ('COMPLETED', 'PENDING', 'CANCELLED', 'REFUNDED')"),
]

MART_CHECKS = [
    Check("mart_sales_daily_kpi", "row_count", op=">", threshold=0),
    Check("mart_sales_daily_kpi", "missing_count", "order_date"),
    Check("mart_sales_daily_kpi", "duplicate_count", "order_date"),
    *_missing("mart_sales_daily_kpi", "total_orders", "completed_orders", "net_sales_amount"),
    Check("mart_sales_daily_kpi", "min", "total_orders", ">=", 0),
    Check("mart_sales_daily_kpi", "min", "completed_orders", ">=", 0),
    Check("mart_sales_daily_kpi", "min", "net_sales_amount", ">=", 0),
    Check("fct_sales", "row_count", op=">", threshold=0),
    Check("fct_sales", "missing_count", "sales_event_key"),
    Check("fct_sales", "duplicate_count", "sales_event_key"),
    *_missing("fct_sales", "order_id", "customer_id", "order_date", "source_file_name"),
    Check("fct_sales", "min", "quantity", ">", 0),
    Check("fct_sales", "min", "net_amount", ">=", 0),
    Check("mart_customer_sales_kpi", "row_count", op=">", threshold=0),
    Check("mart_customer_sales_kpi", "missing_count", "customer_id"),
    Check("mart_customer_sales_kpi", "duplicate_count", "customer_id"),
    Check("mart_customer_sales_kpi", "min", "total_orders", ">=", 0),
    Check("mart_customer_sales_kpi", "min", "completed_orders", ">=", 0),
    Check("mart_customer_sales_kpi", "min", "completed_net_sales_amount", ">=", 0),
    Check("mart_product_category_sales_kpi", "row_count", op=">", threshold=0),
    Check("mart_product_category_sales_kpi", "missing_count", "product_category"),
    Check("mart_product_category_sales_kpi", "duplicate_count", "product_category"),
    Check("mart_product_category_sales_kpi", "min", "total_orders", ">=", 0),
    Check("mart_product_category_sales_kpi", "min", "completed_orders", ">=", 0),
    Check("mart_product_category_sales_kpi", "min", "completed_net_sales_amount", ">=", 0),
]

RECONCILIATION_CHECKS = [
    Check("mart_load_audit", "row_count", op=">", threshold=0),
    Check("mart_load_audit", "missing_count", "source_file_name"),
    Check("mart_load_audit", "duplicate_count", "source_file_name"),
    Check("mart_load_audit", "missing_count", "reconciliation_status"),
    Check("mart_load_audit", "failed_rows", name="all loaded files should reconcile",
          predicate="reconciliation_status <> 'MATCHED'"),
    Check("mart_load_audit", "failed_rows", name="raw and fact row counts should match",
          predicate="row_count_difference <> 0"),
]

ALL_CHECKS = RAW_CHECKS + MART_CHECKS + RECONCILIATION_CHECKS


# --- pre-load batch validation ------------------------------------------------------------

REQUIRED_BATCH_COLUMNS = (
    "order_id", "customer_id", "product_id", "product_category", "order_timestamp",
    "quantity", "unit_price", "gross_amount", "discount_amount", "net_amount",
    "payment_method", "order_status", "batch_id", "generated_at_utc",
)


BATCH_RULES = {
    "duplicate_order_ids": "{} row(s) repeat an order_id",
    "negative_net_amount": "{} row(s) have net_amount below zero",
    "non_positive_quantity": "{} row(s) have quantity of zero or less",
}


def batch_violations(df: DataFrame) -> DataFrame:
    """All batch rule counts in one aggregate: rows, duplicated order ids
    (rows beyond the first per id), negative net, non-positive quantity."""
    per_id = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    dup = per_id.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("bigint").alias("duplicate_order_ids"))
    rules = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("net_amount") < 0).alias("negative_net_amount"),
        F.count_if(F.col("quantity") <= 0).alias("non_positive_quantity"),
    )
    # one row each; unpivot both to (rule, violations) and union
    return rules.unpivot([], ["row_count", "negative_net_amount", "non_positive_quantity"], "rule", "value").unionByName(
        dup.unpivot([], ["duplicate_order_ids"], "rule", "value")
    )


def validate_batch(df: DataFrame, required: Sequence[str] = REQUIRED_BATCH_COLUMNS) -> DataFrame:
    """``df``, or ``ValueError`` naming every rule that the batch breaks and
    how many rows break it."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"batch rejected: it lacks {', '.join(absent)}")
    found = {r["rule"]: r["value"] for r in batch_violations(df).collect()}
    told = [text.format(found[rule]) for rule, text in BATCH_RULES.items() if found[rule] > 0]
    if found["row_count"] == 0:
        told = ["it is empty"]
    if told:
        raise ValueError("batch rejected: " + "; ".join(told))
    return df


# --- declarative row tests (per-model column tests + singular tests) ------------------------

@dataclass(frozen=True)
class RowTest:
    """``not_null`` / ``unique`` / ``accepted_values`` on a column, or a
    singular ``expression`` test (failing-row predicate). ``failures`` is the
    number of rows the test query returns: NULL rows, duplicated values,
    distinct unaccepted values, or rows matching the predicate."""

    table: str
    test: str
    column: str | None = None
    values: tuple[str, ...] = ()
    predicate: str | None = None
    name: str | None = None

    @property
    def test_name(self) -> str:
        return self.name or self.test


def _row_test_row(t: RowTest, failures: Column) -> Column:
    return F.struct(
        F.lit(t.table).alias("table_name"),
        F.lit(t.test_name).alias("test_name"),
        F.lit(t.column).cast("string").alias("column_name"),
        failures.cast("bigint").alias("failures"),
        F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )


def _row_failing(t: RowTest) -> Column:
    if t.test == "not_null":
        return F.col(t.column).isNull()
    return F.coalesce(F.expr(t.predicate), F.lit(False))


def row_test_table_report(df: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    """All tests of one table. Row-count tests (not_null, expression) share
    one global aggregate; each unique test groups its column alone;
    accepted_values counts distinct bad values after a selective filter."""
    counted = [t for t in tests if t.test in ("not_null", "expression")]
    uniques = [t for t in tests if t.test == "unique"]
    accepted = [t for t in tests if t.test == "accepted_values"]
    parts: list[DataFrame] = []
    if counted:
        agg = df.agg(*[F.count_if(_row_failing(t)).alias(f"f{i}") for i, t in enumerate(counted)])
        parts.append(agg.select(F.inline(F.array(*[_row_test_row(t, F.col(f"f{i}")) for i, t in enumerate(counted)]))))
    for t in uniques:
        n = check_unique(df, t.column).agg(F.count(F.lit(1)).alias("f"))
        parts.append(n.select(F.inline(F.array(_row_test_row(t, F.col("f"))))))
    for t in accepted:
        n = df.filter(~F.col(t.column).isin(*t.values)).agg(F.count_distinct(t.column).alias("f"))
        parts.append(n.select(F.inline(F.array(_row_test_row(t, F.col("f"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_test_report(tables: dict[str, DataFrame], tests: Sequence[RowTest]) -> DataFrame:
    parts = [
        row_test_table_report(tables[t], [x for x in tests if x.table == t])
        for t in dict.fromkeys(x.table for x in tests)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _nn(table: str, *cols: str) -> list[RowTest]:
    return [RowTest(table, "not_null", c) for c in cols]


ROW_TESTS = [
    *_nn("sales_raw", "order_id", "customer_id", "source_file_name", "load_ts"),
    *_nn("stg_sales", "sales_event_key"), RowTest("stg_sales", "unique", "sales_event_key"),
    *_nn("stg_sales", "order_id", "customer_id"),
    RowTest("stg_sales", "accepted_values", "order_status", ACCEPTED_STATUSES),
    *_nn("stg_sales", "source_file_name", "load_ts"),
    *_nn("int_sales_enriched", "sales_event_key"), RowTest("int_sales_enriched", "unique", "sales_event_key"),
    *_nn("dim_date", "date_day"), RowTest("dim_date", "unique", "date_day"),
    *_nn("fct_sales", "sales_event_key"), RowTest("fct_sales", "unique", "sales_event_key"),
    *_nn("fct_sales", "order_id", "customer_id"),
    RowTest("fct_sales", "accepted_values", "order_status", ACCEPTED_STATUSES),
    *_nn("fct_sales", "source_file_name", "load_ts"),
    RowTest("fct_sales", "expression", name="assert_sales_amounts_reconcile",
            predicate="abs(gross_amount - quantity * unit_price) > 0.01 or "
                      "abs(net_amount - case when gross_amount is null or discount_amount is null then null "
                      "else greatest(gross_amount - discount_amount, 0) end) > 0.01"),
    *_nn("mart_sales_daily_kpi", "order_date"), RowTest("mart_sales_daily_kpi", "unique", "order_date"),
    *_nn("mart_customer_sales_kpi", "customer_id"), RowTest("mart_customer_sales_kpi", "unique", "customer_id"),
    *_nn("mart_load_audit", "source_file_name"), RowTest("mart_load_audit", "unique", "source_file_name"),
    RowTest("mart_load_audit", "accepted_values", "reconciliation_status", RECONCILIATION_STATUSES),
    RowTest("mart_load_audit", "expression", name="assert_load_audit_matched",
            predicate="reconciliation_status <> 'MATCHED'"),
    *_nn("mart_product_category_sales_kpi", "product_category"),
    RowTest("mart_product_category_sales_kpi", "unique", "product_category"),
]
