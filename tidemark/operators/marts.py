"""KPI marts and the raw-to-fact load audit.

Every mart aggregates the fact with partial (map-side) aggregation and then
joins, if at all, on the *aggregated* side: daily rows meet the date
dimension after the group-by, per-file counts meet each other after both
group-bys.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import exact_avg, money_sum, safe_ratio
from tidemark.operators.fact import audit_stamp

MATCHED, MISMATCHED = "MATCHED", "MISMATCHED"
DATE_ATTRS = [
    "year_number", "quarter_number", "month_number", "month_name",
    "week_number", "day_of_week_name", "is_weekend",
]


#: What each mart reads of the fact.
FACT_INPUT = {
    "mart_sales_daily_kpi": ["order_date", "customer_id", "order_status", "is_completed_order", "gross_amount", "discount_amount", "net_amount", "load_ts"],
    "mart_customer_sales_kpi": ["customer_id", "order_date", "is_completed_order", "is_failed_or_reversed_order", "net_amount"],
    "mart_product_category_sales_kpi": ["product_category", "product_id", "customer_id", "is_completed_order", "is_failed_or_reversed_order",
                                        "gross_amount", "discount_amount", "net_amount", "load_ts"],
    "mart_load_audit": ["source_file_name", "load_ts"],
}


def _stamp(cols: list, stamp: bool, as_of: datetime | None) -> list:
    return cols + [audit_stamp(as_of)] if stamp else cols


def _completed_net():
    return F.when(F.col("is_completed_order"), F.col("net_amount")).otherwise(F.lit(0))


def _completed_net_or_null():
    return F.when(F.col("is_completed_order"), F.col("net_amount"))


def daily_sales(fct: DataFrame) -> DataFrame:
    """Per ``order_date`` counts, distinct customers, sums, AOV over all
    statuses, ratio-of-sums discount rate, latest load."""
    return fct.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("is_completed_order")).alias("completed_orders"),
        F.count_if(F.col("order_status") == "PENDING").alias("pending_orders"),
        F.count_if(F.col("order_status") == "CANCELLED").alias("cancelled_orders"),
        F.count_if(F.col("order_status") == "REFUNDED").alias("refunded_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        money_sum("gross_amount").alias("gross_sales_amount"),
        money_sum("discount_amount").alias("total_discount_amount"),
        money_sum("net_amount").alias("net_sales_amount"),
        exact_avg("net_amount").alias("avg_order_value"),
        safe_ratio(F.sum("discount_amount"), F.sum("gross_amount"), 0.0).alias("discount_rate"),
        F.max("load_ts").alias("latest_load_ts"),
    )


DAILY_KPI_COLUMNS = (
    ["order_date"] + DATE_ATTRS
    + ["total_orders", "completed_orders", "pending_orders", "cancelled_orders",
       "refunded_orders", "unique_customers", "gross_sales_amount",
       "total_discount_amount", "net_sales_amount", "avg_order_value",
       "discount_rate", "latest_load_ts"]
)


def mart_sales_daily_kpi(
    fct: DataFrame, dim: DataFrame, stamp: bool = False, as_of: datetime | None = None
) -> DataFrame:
    """Daily KPI left-joined to the date dimension (dates outside it keep
    NULL attributes). The fact is aggregated first, so the join sees one
    row per date on each side; no broadcast is forced - Spark broadcasts
    the dimension only when its size estimate is under the broadcast
    threshold (a generated ``dim_date`` is ~1500 rows), else sort-merge."""
    daily = daily_sales(fct)
    joined = daily.join(
        dim.select("date_day", *DATE_ATTRS),
        daily.order_date == F.col("date_day"),
        "left",
    )
    return joined.select(*_stamp([F.col(c) for c in DAILY_KPI_COLUMNS], stamp, as_of))


def mart_customer_sales_kpi(fct: DataFrame, stamp: bool = False, as_of: datetime | None = None) -> DataFrame:
    agg = fct.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("is_completed_order")).alias("completed_orders"),
        F.count_if(F.col("is_failed_or_reversed_order")).alias("failed_or_reversed_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("latest_order_date"),
        money_sum(_completed_net()).alias("completed_net_sales_amount"),
        exact_avg(_completed_net_or_null()).alias("avg_completed_order_amount"),
    )
    return agg.select("*", *_stamp([], stamp, as_of))


def mart_product_category_sales_kpi(fct: DataFrame, stamp: bool = False, as_of: datetime | None = None) -> DataFrame:
    """Category KPI. Few groups but two exact distinct counts: Spark
    expands rows per distinct column and shuffles on (category, value), so
    the distinct work is spread over all tasks, not one per category."""
    agg = fct.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("is_completed_order")).alias("completed_orders"),
        F.count_if(F.col("is_failed_or_reversed_order")).alias("failed_or_reversed_orders"),
        F.count_distinct("product_id").alias("distinct_products"),
        F.count_distinct("customer_id").alias("unique_customers"),
        money_sum("gross_amount").alias("gross_sales_amount"),
        money_sum("discount_amount").alias("total_discount_amount"),
        money_sum("net_amount").alias("net_sales_amount"),
        money_sum(_completed_net()).alias("completed_net_sales_amount"),
        exact_avg(_completed_net_or_null()).alias("avg_completed_order_amount"),
        F.max("load_ts").alias("latest_load_ts"),
    )
    return agg.select("*", *_stamp([], stamp, as_of))


def dim_product_categories(fct: DataFrame, stamp: bool = False, as_of: datetime | None = None) -> DataFrame:
    agg = fct.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("product_id").alias("distinct_product_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("latest_order_date"),
        money_sum(_completed_net()).alias("completed_net_sales_amount"),
        exact_avg(_completed_net_or_null()).alias("avg_completed_order_amount"),
    )
    return agg.select("*", *_stamp([], stamp, as_of))


def files_summary(df: DataFrame, count_name: str, first_name: str, last_name: str) -> DataFrame:
    """Per ``source_file_name``: row count and load window."""
    ts = F.col("load_ts").cast("timestamp")
    return df.groupBy("source_file_name").agg(
        F.count(F.lit(1)).alias(count_name),
        F.min(ts).alias(first_name),
        F.max(ts).alias(last_name),
    )


def agg_files_raw(raw: DataFrame) -> DataFrame:
    return files_summary(raw, "raw_row_count", "first_loaded_at", "last_loaded_at")


def agg_files_fact(fct: DataFrame) -> DataFrame:
    return files_summary(fct, "fact_row_count", "first_fact_loaded_at", "last_fact_loaded_at")


def mart_load_audit(raw: DataFrame, fct: DataFrame, stamp: bool = False, as_of: datetime | None = None) -> DataFrame:
    """Per landed file: raw vs fact row counts and MATCHED/MISMATCHED.

    Plain ``=`` on the file name: a NULL file name never meets its fact
    rows, so it stays MISMATCHED (warehouse NULL semantics)."""
    r = agg_files_raw(raw).alias("r")
    f = agg_files_fact(fct).alias("f")
    fact_count = F.coalesce(F.col("f.fact_row_count"), F.lit(0).cast("bigint"))
    joined = r.join(f, F.col("r.source_file_name") == F.col("f.source_file_name"), "left")
    cols = [
        F.col("r.source_file_name").alias("source_file_name"),
        F.col("r.raw_row_count").alias("raw_row_count"),
        fact_count.alias("fact_row_count"),
        (F.col("r.raw_row_count") - fact_count).alias("row_count_difference"),
        F.col("r.first_loaded_at").alias("first_loaded_at"),
        F.col("r.last_loaded_at").alias("last_loaded_at"),
        F.col("f.first_fact_loaded_at").alias("first_fact_loaded_at"),
        F.col("f.last_fact_loaded_at").alias("last_fact_loaded_at"),
        F.when(F.col("r.raw_row_count") == fact_count, F.lit(MATCHED))
        .otherwise(F.lit(MISMATCHED)).alias("reconciliation_status"),
    ]
    return joined.select(*_stamp(cols, stamp, as_of))
