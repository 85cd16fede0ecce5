"""Calendar dimension generated from a row generator."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import quarter_end, week_start, year_end

DIM_START = "2024-01-01"
DIM_DAYS = 1500
DIM_DATE_COLUMNS = [
    "date_day", "year_number", "quarter_number", "month_number", "month_name",
    "week_number", "day_of_month", "day_of_week_number", "day_of_week_name",
    "week_start_date", "month_start_date", "month_end_date", "quarter_start_date",
    "quarter_end_date", "year_start_date", "year_end_date", "is_weekend",
]


def row_generator(spark: SparkSession, n: int, start: str = DIM_START) -> DataFrame:
    """``n`` consecutive days from ``start`` (gap-free, unlike a warehouse
    sequence)."""
    return spark.range(n).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day"))


def days_through(last: date | None, start: str = DIM_START, least: int = DIM_DAYS) -> int:
    """Days from ``start`` that reach ``last``, ``least`` at least."""
    return least if last is None else max(least, (last - date.fromisoformat(start)).days + 1)


def dim_date(
    spark: SparkSession,
    as_of: date | datetime | Column | None = None,
    start: str = DIM_START,
    n_days: int = DIM_DAYS,
    stamp: bool = False,
) -> DataFrame:
    """Calendar attributes per day, cut at ``as_of + 2 years``.

    Week numbers are ISO; ``day_of_week_number`` counts 0 = Sunday so the
    weekend test is ``in (0, 6)``. Size is bounded by ``n_days``, which is
    what makes broadcasting it to fact-side joins safe.
    """
    if as_of is None:
        today = F.current_date()
    elif isinstance(as_of, Column):
        today = as_of.cast("date")
    else:
        today = F.lit(as_of).cast("date")
    d = F.col("date_day")
    dow = (F.dayofweek(d) - 1).cast("int")
    cols = [
        d,
        F.year(d).cast("int").alias("year_number"),
        F.quarter(d).cast("int").alias("quarter_number"),
        F.month(d).cast("int").alias("month_number"),
        F.monthname(d).alias("month_name"),
        F.weekofyear(d).cast("int").alias("week_number"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        dow.alias("day_of_week_number"),
        F.dayname(d).alias("day_of_week_name"),
        week_start(d).alias("week_start_date"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.trunc(d, "quarter").alias("quarter_start_date"),
        quarter_end(d).alias("quarter_end_date"),
        F.trunc(d, "year").alias("year_start_date"),
        year_end(d).alias("year_end_date"),
        dow.isin(0, 6).alias("is_weekend"),
    ]
    if stamp:
        cols.append(F.current_timestamp().alias("updated_at"))
    return row_generator(spark, n_days, start).filter(d <= F.add_months(today, 24)).select(*cols)
