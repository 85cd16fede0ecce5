"""Late-data and restatement operators on top of the keyed fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dims import dim_date  # noqa: F401  (re-exported for callers)
from tidemark.operators.fact import FACT_KEY, high_water_mark
from tidemark.operators.marts import mart_sales_daily_kpi
from tidemark.session import materialize


def high_water_mark_frame(target: DataFrame, ts: str = "load_ts", lookback: str = "1 hour") -> DataFrame:
    """The incremental threshold as a one-row frame (for inspection)."""
    return target.agg(
        (F.coalesce(F.max(F.col(ts).cast("timestamp")), F.lit("1900-01-01 00:00:00").cast("timestamp"))
         - F.expr(f"INTERVAL {lookback}")).alias("high_water_mark")
    )


def matched_updates(target: DataFrame, delta: DataFrame, key: str = FACT_KEY) -> DataFrame:
    """The 'when matched' side of a merge: delta rows whose key is stored."""
    return delta.join(target.select(key), key, "left_semi")


def late_arrivals(fct: DataFrame, min_lag_days: int = 7) -> DataFrame:
    """Per landed file: rows whose business date precedes the arrival date
    by at least ``min_lag_days``, and their lag distribution."""
    lag = F.datediff(F.to_date(F.col("load_ts")), F.col("order_date"))
    late = fct.select("source_file_name", lag.alias("lag_days")).filter(F.col("lag_days") >= min_lag_days)
    return late.groupBy("source_file_name").agg(
        F.count(F.lit(1)).alias("late_rows"),
        F.min("lag_days").alias("min_lag_days"),
        F.max("lag_days").alias("max_lag_days"),
        (F.sum("lag_days").cast("double") / F.count("lag_days")).alias("avg_lag_days"),
    )


def touched_dates(new_rows: DataFrame, column: str = "order_date") -> DataFrame:
    return new_rows.select(column).distinct()


def replaced_rows(stored: DataFrame, delta: DataFrame, key: str = FACT_KEY) -> DataFrame:
    """Stored rows that ``delta`` replaces. A re-delivered key may have moved
    to another date; the date it leaves is touched as well."""
    return stored.join(delta.select(key), key, "left_semi")


def restate_kpi_dates(current_kpi: DataFrame, fct: DataFrame, new_rows: DataFrame, dim: DataFrame,
                      replaced: DataFrame | None = None) -> DataFrame:
    """Recompute the daily KPI only for business dates touched by
    ``new_rows``, or left by the stored rows that they replaced
    (``replaced``), and exchange exactly those dates in ``current_kpi``. A
    date without rows any more disappears.

    The fact is semi-joined to the touched dates before aggregating, so the
    work is proportional to the affected dates, not to the whole history.
    The join names the month too: a fact that is partitioned by it is read
    in the touched months alone (dynamic partition pruning). The result
    equals a full rebuild of the mart from ``fct``. The dates are written
    first, so both uses read a few rows.
    """
    dates = touched_dates(new_rows)
    if replaced is not None:
        dates = dates.union(touched_dates(replaced)).distinct()
    dates = materialize(dates, "touched_dates").where(F.col("order_date") >= F.lit("0001-01-01").cast("date"))
    months = dates.select("order_date", F.trunc("order_date", "month").alias("order_month"))
    affected = fct.join(months, ["order_date", "order_month"], "left_semi")
    fresh = mart_sales_daily_kpi(affected, dim)
    kept = current_kpi.join(dates, "order_date", "left_anti")
    return kept.unionByName(fresh.select(*current_kpi.columns))
