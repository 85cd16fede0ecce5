"""Serving queries behind the sales dashboard and the validation reports:
ordered reads, top-k, filters and headline aggregates.

Top-k uses ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject (per-partition top-k, then a k-row merge), so no
full sort or shuffle of the mart. Every ordering carries a unique
tie-breaker so the k rows are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUIRED_DAILY_COLUMNS = (
    "order_date", "total_orders", "completed_orders", "net_sales_amount", "avg_order_value",
)
DAILY_TABLE_COLUMNS = (
    "order_date", "year_number", "quarter_number", "month_number", "month_name",
    "week_number", "day_of_week_name", "is_weekend", "total_orders", "completed_orders",
    "pending_orders", "cancelled_orders", "refunded_orders", "unique_customers",
    "gross_sales_amount", "total_discount_amount", "net_sales_amount", "avg_order_value",
    "discount_rate",
)


# --- ordered reads / top-k ---------------------------------------------------------

def read_mart(mart: DataFrame, *order: str) -> DataFrame:
    return mart.orderBy(*order)


def top_customers(customer_kpi: DataFrame, k: int = 100) -> DataFrame:
    return customer_kpi.orderBy(
        F.col("completed_net_sales_amount").desc_nulls_last(), F.col("customer_id").asc()
    ).limit(k)


def category_ranking(category_kpi: DataFrame) -> DataFrame:
    return category_kpi.orderBy(
        F.col("completed_net_sales_amount").desc_nulls_last(), F.col("product_category").asc()
    )


def daily_latest(daily_kpi: DataFrame, k: int = 20) -> DataFrame:
    return daily_kpi.orderBy(F.col("order_date").desc()).limit(k)


def audit_latest(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.col("last_loaded_at").desc_nulls_last(), F.col("source_file_name").asc())


def dim_date_head(dim: DataFrame, k: int = 10) -> DataFrame:
    return dim.orderBy("date_day").limit(k)


def dim_date_count(dim: DataFrame) -> DataFrame:
    return dim.agg(F.count(F.lit(1)).alias("date_count"))


def late_kpi_dates_touched(daily_kpi: DataFrame, as_of: date, k: int = 20) -> DataFrame:
    """KPI rows for business dates 30..7 days before ``as_of``, most
    recently loaded first."""
    d = F.lit(as_of).cast("date")
    return (
        daily_kpi.filter(F.col("order_date").between(F.date_sub(d, 30), F.date_sub(d, 7)))
        .select("order_date", "total_orders", "completed_orders", "net_sales_amount", "latest_load_ts")
        .orderBy(F.col("latest_load_ts").desc_nulls_last(), F.col("order_date").asc())
        .limit(k)
    )


def backfill_kpi_dates(daily_kpi: DataFrame, start: date, end: date) -> DataFrame:
    return (
        date_range_filter(daily_kpi, start, end)
        .select("order_date", "total_orders", "completed_orders", "net_sales_amount", "latest_load_ts")
        .orderBy("order_date")
    )


# --- dashboard filters ---------------------------------------------------------------

def date_range_filter(df: DataFrame, start: date | None, end: date | None, column: str = "order_date") -> DataFrame:
    """Inclusive range; a missing bound leaves that side open."""
    c = F.col(column)
    if start is not None:
        df = df.filter(c >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(c <= F.lit(end).cast("date"))
    return df


def month_in_filter(df: DataFrame, months: Sequence[str] | None, column: str = "month_name") -> DataFrame:
    """Keep the selected months; an empty selection keeps everything."""
    return df.filter(F.col(column).isin(*months)) if months else df


def available_months(df: DataFrame, column: str = "month_name") -> DataFrame:
    """Distinct non-null month names in calendar order (the dashboard sorted
    them by name; calendar order is the intent)."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.min("month_number").alias("month_number"))
        .orderBy("month_number")
        .select(column, "month_number")
    )


def rename_compat(df: DataFrame, legacy: str = "distinct_product_count", current: str = "distinct_products") -> DataFrame:
    if legacy in df.columns and current not in df.columns:
        return df.withColumnRenamed(legacy, current)
    return df


def project_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_DAILY_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Daily KPI table is missing required columns: {missing}")
    return df


def filtered_daily(daily_kpi: DataFrame, start: date | None = None, end: date | None = None,
                   months: Sequence[str] | None = None) -> DataFrame:
    return month_in_filter(date_range_filter(require_columns(daily_kpi), start, end), months)


# --- dashboard aggregates ------------------------------------------------------------

def dash_date_bounds(daily_kpi: DataFrame) -> DataFrame:
    return daily_kpi.agg(F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date"))


def dash_headline(daily_kpi: DataFrame, start: date | None = None, end: date | None = None,
                  months: Sequence[str] | None = None) -> DataFrame:
    """Headline tiles. ``unique_customer_days`` sums daily distinct counts;
    ``avg_order_value`` is the unweighted mean of the daily AOVs (as the
    dashboard shows it), rounded to 6 places."""
    f = filtered_daily(daily_kpi, start, end, months)
    return f.agg(
        F.sum("total_orders").cast("bigint").alias("total_orders"),
        F.sum("completed_orders").cast("bigint").alias("completed_orders"),
        F.sum("unique_customers").cast("bigint").alias("unique_customer_days"),
        F.sum("net_sales_amount").cast("decimal(38,2)").alias("net_sales"),
        F.round(F.avg("avg_order_value"), 6).alias("avg_order_value"),
    )


def dash_daily_net(daily_kpi: DataFrame, **flt) -> DataFrame:
    return filtered_daily(daily_kpi, **flt).select("order_date", "net_sales_amount").orderBy("order_date")


def dash_status_breakdown(daily_kpi: DataFrame, **flt) -> DataFrame:
    return filtered_daily(daily_kpi, **flt).select(
        "order_date", "completed_orders", "pending_orders", "cancelled_orders", "refunded_orders"
    ).orderBy("order_date")


def dash_daily_table(daily_kpi: DataFrame, **flt) -> DataFrame:
    return project_present(filtered_daily(daily_kpi, **flt), DAILY_TABLE_COLUMNS).orderBy("order_date")


def dash_top_customers(customer_kpi: DataFrame, k: int = 20, pool: int = 100) -> DataFrame:
    """Top ``k`` of the top-``pool`` customers, id rendered as text."""
    return (
        top_customers(customer_kpi, pool)
        .orderBy(F.col("completed_net_sales_amount").desc_nulls_last(), F.col("customer_id").asc())
        .limit(k)
        .withColumn("customer_id", F.col("customer_id").cast("string"))
    )


def dash_category_summary(category_kpi: DataFrame) -> DataFrame:
    """Top category and its sales next to totals over all categories, in a
    single aggregate (``max_by`` over a tie-broken ordering key)."""
    kpi = rename_compat(category_kpi)
    sales = F.col("completed_net_sales_amount")
    # smallest (sales is NULL, -sales, name) = first row of the ranking
    # "sales desc nulls last, name asc"
    rank_key = F.struct(sales.isNull(), -sales, F.col("product_category"))
    return kpi.agg(
        F.min_by("product_category", rank_key).alias("top_category"),
        F.max("completed_net_sales_amount").alias("top_category_sales"),
        F.sum("completed_net_sales_amount").cast("decimal(38,2)").alias("total_category_sales"),
        F.sum("distinct_products").cast("bigint").alias("total_distinct_products"),
    )


def dash_audit_summary(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("files_loaded"),
        F.count_if(F.col("reconciliation_status") == "MATCHED").alias("matched_files"),
        F.count_if(~F.col("reconciliation_status").eqNullSafe("MATCHED")).alias("mismatched_files"),
    )
