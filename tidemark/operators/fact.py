"""Incremental keyed fact: high-water-mark filter, projection, keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

FACT_KEY = "sales_event_key"
FCT_COLUMNS = [
    "sales_event_key", "order_id", "customer_id", "product_id", "product_category",
    "order_timestamp", "order_date", "order_month", "quantity", "unit_price",
    "gross_amount", "discount_amount", "net_amount", "discount_rate",
    "payment_method", "order_status", "is_completed_order",
    "is_failed_or_reversed_order", "batch_id", "source_file_name",
    "generated_at_utc", "load_ts",
]
EMPTY_TARGET_FLOOR = "1900-01-01 00:00:00"


def audit_stamp(as_of: datetime | None = None) -> Column:
    """The ``updated_at`` audit column: ``as_of`` when given, else now."""
    if as_of is None:
        return F.current_timestamp().alias("updated_at")
    return F.lit(as_of).cast("timestamp").alias("updated_at")


def fct_projection(enriched: DataFrame, stamp: bool = False, as_of: datetime | None = None) -> DataFrame:
    cols = [F.col(c) for c in FCT_COLUMNS]
    if stamp:
        cols.append(audit_stamp(as_of))
    return enriched.select(*cols)


def high_water_mark(target: DataFrame, ts: str = "load_ts", lookback: str = "1 hour") -> Column:
    """Scalar subquery ``coalesce(max(ts), 1900-01-01) - lookback`` over the
    target. It stays in the plan (no driver round trip) and Spark turns it
    into a pushed filter on the source scan."""
    sub = target.select(
        (F.coalesce(F.max(F.col(ts).cast("timestamp")), F.lit(EMPTY_TARGET_FLOOR).cast("timestamp"))
         - F.expr(f"INTERVAL {lookback}")).alias("hw")
    )
    return sub.scalar()


def incremental_filter(src: DataFrame, target: DataFrame, ts: str = "load_ts", lookback: str = "1 hour") -> DataFrame:
    """Rows of ``src`` at or after the target's high-water mark minus the lookback."""
    return src.filter(F.col(ts) >= high_water_mark(target, ts, lookback))


def sync_columns(target: DataFrame, like: DataFrame) -> DataFrame:
    """``on_schema_change='sync_all_columns'``: project ``target`` onto the
    schema of ``like`` - dropped columns go, new ones are NULL for old rows."""
    have = {c.lower(): c for c in target.columns}
    cols = []
    for f in like.schema.fields:
        if f.name.lower() in have:
            cols.append(F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return target.select(*cols)


def merge_keyed(target: DataFrame, updates: DataFrame, key: str | Sequence[str] = FACT_KEY, within: str | None = None) -> DataFrame:
    """Keyed upsert: every incoming row wins over the stored row with the
    same key; stored rows without an incoming match are kept; nothing is
    deleted. ``updates`` must be unique per key (staging guarantees it).

    Anti-join + union rather than union + window: only the key column of
    ``updates`` is shuffled against the target (AQE broadcasts it when a
    delta is small), and the target is never sorted.

    ``within`` names a column that all rows of a key share, as the source
    file that the event key embeds: stored rows whose value no incoming row
    has are kept as they are, and only the others meet the incoming keys.
    The shared values are written first, so that their uses read a few rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    stored = sync_columns(target, updates)
    if within is None:
        return stored.join(updates.select(*keys), keys, "left_anti").unionByName(updates)
    values = [df.select(F.col(within).alias("_within")).distinct() for df in (stored, updates)]
    shared = materialize(values[0].intersect(values[1]), "merged_within")
    same = F.col(within).eqNullSafe(F.col("_within"))
    incoming = updates.join(shared, same, "left_semi").select(*keys)
    kept = stored.join(shared, same, "left_semi").join(incoming, keys, "left_anti")
    return stored.join(shared, same, "left_anti").unionByName(kept).unionByName(updates)


def fct_sales(
    enriched: DataFrame,
    target: DataFrame | None = None,
    lookback: str = "1 hour",
    stamp: bool = False,
    as_of: datetime | None = None,
) -> DataFrame:
    """Full build when ``target`` is None, otherwise high-water-mark filter
    of the enriched rows and keyed merge into ``target``."""
    if target is None:
        return fct_projection(enriched, stamp, as_of)
    delta = fct_projection(incremental_filter(enriched, target, "load_ts", lookback), stamp, as_of)
    return merge_keyed(target, delta, FACT_KEY)
