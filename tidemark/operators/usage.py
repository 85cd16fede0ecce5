"""Compute-usage analytics over metering and query-log tables.

Every operator takes the history table, an ``as_of`` clock, a warehouse
allow-list and a look-back window; the time predicate and the allow-list
are plain filters that reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GIB = 1024 ** 3
HIGH_CREDITS, MEDIUM_CREDITS = 5, 1


def window_filter(history: DataFrame, as_of: datetime, days: int,
                  warehouses: Sequence[str] | None, ts: str = "start_time") -> DataFrame:
    """``ts >= as_of - days`` with the bound typed like the column, so the
    comparison is column-vs-literal and reaches the scan as a pushed filter."""
    bound = F.lit(as_of - timedelta(days=days)).cast(history.schema[ts].dataType)
    out = history.filter(F.col(ts) >= bound)
    if warehouses:
        out = out.filter(F.col("warehouse_name").isin(*warehouses))
    return out


def _secs(c: Column) -> Column:
    return c.cast("double") / 1000


def _gb(c: Column, places: int = 2) -> Column:
    return F.round(c.cast("double") / GIB, places)


def _csum(c: str, scale: int) -> Column:
    """Credit sums widened to precision 38 (same declared type on every engine)."""
    return F.sum(c).cast(f"decimal(38,{scale})")


def _credit_sums() -> list[Column]:
    return [
        _csum("credits_used", 4).alias("total_credits_used"),
        _csum("credits_used_compute", 6).alias("compute_credits_used"),
        _csum("credits_used_cloud_services", 6).alias("cloud_services_credits_used"),
    ]


def usage_by_day(metering: DataFrame, as_of: datetime, warehouses: Sequence[str] | None = None, days: int = 30) -> DataFrame:
    w = window_filter(metering, as_of, days, warehouses)
    return w.groupBy(F.to_date("start_time").alias("usage_date"), "warehouse_name").agg(*_credit_sums())


def usage_summary(metering: DataFrame, as_of: datetime, warehouses: Sequence[str] | None = None, days: int = 30) -> DataFrame:
    w = window_filter(metering, as_of, days, warehouses)
    active = F.count_distinct(F.date_trunc("day", F.col("start_time")))
    return w.groupBy("warehouse_name").agg(
        *_credit_sums(),
        active.alias("active_days"),
        F.round(F.sum("credits_used").cast("double") / F.nullif(active, F.lit(0)), 4).alias("avg_credits_per_active_day"),
    )


def usage_by_hour(metering: DataFrame, as_of: datetime, warehouses: Sequence[str] | None = None, days: int = 7) -> DataFrame:
    w = window_filter(metering, as_of, days, warehouses)
    return w.groupBy(
        F.date_trunc("hour", F.col("start_time")).cast("timestamp_ntz").alias("usage_hour"), "warehouse_name"
    ).agg(_csum("credits_used", 4).alias("credits_used"))


def top_queries_by_time(history: DataFrame, as_of: datetime, warehouses: Sequence[str] | None = None,
                        days: int = 7, k: int = 25) -> DataFrame:
    w = window_filter(history, as_of, days, warehouses)
    return w.orderBy(F.col("execution_time").desc_nulls_last(), F.col("query_id").asc()).limit(k).select(
        "query_id", "user_name", "role_name", "warehouse_name", "database_name", "schema_name",
        "query_type",
        _secs(F.col("execution_time")).alias("execution_seconds"),
        _secs(F.col("total_elapsed_time")).alias("total_elapsed_seconds"),
        "bytes_scanned", "rows_produced", "start_time", "query_text",
    )


def top_queries_by_bytes(history: DataFrame, as_of: datetime, warehouses: Sequence[str] | None = None,
                         days: int = 7, k: int = 25) -> DataFrame:
    w = window_filter(history, as_of, days, warehouses)
    return w.orderBy(F.col("bytes_scanned").desc_nulls_last(), F.col("query_id").asc()).limit(k).select(
        "query_id", "user_name", "role_name", "warehouse_name", "database_name", "schema_name",
        "query_type", "bytes_scanned",
        _gb(F.col("bytes_scanned")).alias("gb_scanned"),
        _secs(F.col("execution_time")).alias("execution_seconds"),
        "start_time", "query_text",
    )


def _query_stats(with_bytes: bool) -> list[Column]:
    cols = [
        F.count(F.lit(1)).alias("query_count"),
        _secs(F.sum("execution_time")).alias("total_execution_seconds"),
        _secs(F.avg("execution_time")).alias("avg_execution_seconds"),
    ]
    if with_bytes:
        cols.append(F.sum("bytes_scanned").alias("total_bytes_scanned"))
    cols.append(_gb(F.sum("bytes_scanned")).alias("total_gb_scanned"))
    return cols


def usage_by_query_tag(history: DataFrame, as_of: datetime, warehouses: Sequence[str] | None = None, days: int = 7) -> DataFrame:
    w = window_filter(history, as_of, days, warehouses).filter(F.col("query_tag").isNotNull())
    return w.groupBy("query_tag", "warehouse_name").agg(*_query_stats(True))


def usage_tagged_text_match(history: DataFrame, as_of: datetime, warehouses: Sequence[str] | None = None,
                            days: int = 7, pattern: str = "%dbt%") -> DataFrame:
    w = window_filter(history, as_of, days, warehouses).filter(
        F.col("query_text").ilike(pattern) | F.col("query_tag").ilike(pattern)
    )
    return w.groupBy("warehouse_name", "query_tag").agg(*_query_stats(False))


def usage_by_user(history: DataFrame, as_of: datetime, warehouses: Sequence[str] | None = None, days: int = 7) -> DataFrame:
    w = window_filter(history, as_of, days, warehouses)
    return w.groupBy("user_name", "warehouse_name").agg(
        F.count(F.lit(1)).alias("query_count"),
        _secs(F.sum("execution_time")).alias("total_execution_seconds"),
        _gb(F.sum("bytes_scanned")).alias("total_gb_scanned"),
        F.min("start_time").alias("first_query_time"),
        F.max("start_time").alias("latest_query_time"),
    )


def usage_by_service_daily(daily: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return daily.filter(F.col("usage_date") >= since).groupBy("usage_date", "service_type").agg(
        _csum("credits_used", 4).alias("credits_used"),
        _csum("credits_used_compute", 6).alias("compute_credits_used"),
        _csum("credits_used_cloud_services", 6).alias("cloud_services_credits_used"),
    )


def usage_risk_level(metering: DataFrame, as_of: datetime, warehouses: Sequence[str] | None = None,
                     days: int = 30, high: float = HIGH_CREDITS, medium: float = MEDIUM_CREDITS) -> DataFrame:
    w = window_filter(metering, as_of, days, warehouses)
    daily = w.groupBy(F.to_date("start_time").alias("usage_date"), "warehouse_name").agg(
        _csum("credits_used", 4).alias("credits_used")
    )
    level = (
        F.when(F.col("credits_used") >= F.lit(high), F.lit("HIGH"))
        .when(F.col("credits_used") >= F.lit(medium), F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )
    return daily.select("usage_date", "warehouse_name", "credits_used", level.alias("usage_risk_level"))
