"""Intermediate enrichment: month bucket, guarded discount rate, status flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import safe_ratio

INT_COLUMNS = [
    "sales_event_key", "order_id", "customer_id", "product_id", "product_category",
    "order_timestamp", "order_date", "order_month", "quantity", "unit_price",
    "gross_amount", "discount_amount", "net_amount", "discount_rate",
    "payment_method", "order_status", "is_completed_order",
    "is_failed_or_reversed_order", "batch_id", "generated_at_utc",
    "source_file_name", "load_ts",
]
COMPLETED = "COMPLETED"
FAILED_OR_REVERSED = ("CANCELLED", "REFUNDED")


def order_month(order_date: Column) -> Column:
    return F.trunc(order_date, "month")


def discount_rate(discount: Column, gross: Column) -> Column:
    return safe_ratio(discount, gross, default=0.0)


def is_completed(status: Column) -> Column:
    # never NULL: unknown status -> false
    return status.eqNullSafe(F.lit(COMPLETED))


def is_failed_or_reversed(status: Column) -> Column:
    return F.when(status.isin(*FAILED_OR_REVERSED), F.lit(True)).otherwise(F.lit(False))


def int_sales_enriched(stg: DataFrame) -> DataFrame:
    extra = [c for c in stg.columns if c not in INT_COLUMNS]
    enriched = stg.select(
        "*",
        order_month(F.col("order_date")).alias("order_month"),
        discount_rate(F.col("discount_amount"), F.col("gross_amount")).alias("discount_rate"),
        is_completed(F.col("order_status")).alias("is_completed_order"),
        is_failed_or_reversed(F.col("order_status")).alias("is_failed_or_reversed_order"),
    )
    return enriched.select(*INT_COLUMNS, *extra)
