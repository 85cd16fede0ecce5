"""Load-validation summaries: per-file raw/fact windows, audit totals,
layer counts and late/backfill file summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATE_PATTERN = "%late_arriving%"
BACKFILL_PATTERN = "%backfill%"


def file_name_filter(df: DataFrame, pattern: str, column: str = "source_file_name") -> DataFrame:
    """Case-insensitive ``LIKE`` on the landed file name."""
    return df.filter(F.col(column).ilike(pattern))


def raw_load_summary(raw: DataFrame) -> DataFrame:
    ts = F.col("load_ts").cast("timestamp")
    return raw.groupBy("source_file_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(ts).alias("first_loaded_at"),
        F.max(ts).alias("last_loaded_at"),
    )


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.sum("raw_row_count").alias("total_raw_rows"),
        F.sum("fact_row_count").alias("total_fact_rows"),
        F.sum("row_count_difference").alias("total_difference"),
    )


def layer_row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count (``unionByName`` of counts; each
    count is a separate partial aggregate, never a collect)."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def raw_file_kind_summary(raw: DataFrame, pattern: str) -> DataFrame:
    """Per matching raw file: rows, order-timestamp window, latest load."""
    return file_name_filter(raw, pattern).groupBy("source_file_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(F.col("order_timestamp").cast("timestamp_ntz")).alias("min_order_timestamp"),
        F.max(F.col("order_timestamp").cast("timestamp_ntz")).alias("max_order_timestamp"),
        F.max(F.col("load_ts").cast("timestamp")).alias("latest_load_ts"),
    )


def fact_file_kind_summary(fct: DataFrame, pattern: str) -> DataFrame:
    return file_name_filter(fct, pattern).groupBy("source_file_name").agg(
        F.count(F.lit(1)).alias("fact_row_count"),
        F.min("order_date").alias("min_order_date"),
        F.max("order_date").alias("max_order_date"),
        F.max("load_ts").alias("latest_load_ts"),
    )


def late_raw_summary(raw: DataFrame) -> DataFrame:
    return raw_file_kind_summary(raw, LATE_PATTERN)


def late_fact_summary(fct: DataFrame) -> DataFrame:
    return fact_file_kind_summary(fct, LATE_PATTERN)


def backfill_raw_summary(raw: DataFrame) -> DataFrame:
    return raw_file_kind_summary(raw, BACKFILL_PATTERN)


def backfill_fact_summary(fct: DataFrame) -> DataFrame:
    return fact_file_kind_summary(fct, BACKFILL_PATTERN)


def files_not_loaded(expected: DataFrame, loaded: DataFrame, expected_col: str = "source_file_name",
                     loaded_col: str = "source_file_name") -> DataFrame:
    """Expected files with no loaded row. Both sides are reduced to the
    file's base name and anti-joined on equality (no substring theta join)."""
    from tidemark.functions.columns import basename

    e = expected.select(basename(F.col(expected_col)).alias("file_name")).distinct()
    lo = loaded.select(basename(F.col(loaded_col)).alias("file_name")).distinct()
    return e.join(lo, "file_name", "left_anti")


def all_files_loaded(expected: DataFrame, loaded: DataFrame, expected_col: str = "source_file_name",
                     loaded_col: str = "source_file_name") -> DataFrame:
    """Set equality of expected and loaded file names, as counts + flag."""
    from tidemark.functions.columns import basename

    e = expected.select(basename(F.col(expected_col)).alias("file_name")).distinct()
    lo = loaded.select(basename(F.col(loaded_col)).alias("file_name")).distinct()
    both = e.withColumn("in_expected", F.lit(True)).join(
        lo.withColumn("in_loaded", F.lit(True)), "file_name", "full_outer"
    )
    exp, got = F.col("in_expected").isNotNull(), F.col("in_loaded").isNotNull()
    counts = both.agg(
        F.count_if(exp).alias("expected_files"),
        F.count_if(got).alias("loaded_files"),
        F.count_if(exp & ~got).alias("missing_files"),
        F.count_if(got & ~exp).alias("unexpected_files"),
    )
    return counts.withColumn(
        "all_loaded", (F.col("missing_files") == 0) & (F.col("unexpected_files") == 0)
    )
