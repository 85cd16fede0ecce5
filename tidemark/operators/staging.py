"""Staging: rename/cast/normalise raw rows, surrogate key, latest-wins dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import (
    MONEY,
    cast_to,
    safe_column,
    key_text,
    title_case,
    to_whole_number,
    upper_trim,
)

STG_COLUMNS = [
    "sales_event_key", "order_id", "customer_id", "product_id", "product_category",
    "order_timestamp", "order_date", "quantity", "unit_price", "gross_amount",
    "discount_amount", "net_amount", "payment_method", "order_status", "batch_id",
    "generated_at_utc", "source_file_name", "load_ts",
]
# Optional contract columns carried when ``include_optional`` is set.
OPTIONAL_COLUMNS = ["sales_channel", "promotion_code", "device_type"]
EVENT_KEY_PARTS = ("order_id", "batch_id", "source_file_name")
CAST_CHECKED = ("order_id", "customer_id", "product_id", "quantity", "unit_price", "gross_amount",
                "discount_amount", "net_amount", "order_timestamp", "generated_at_utc", "load_ts")
#: Columns that staging casts and leaves as they are else.
ONLY_CAST = (*CAST_CHECKED, "batch_id", "source_file_name")


def _typed(df: DataFrame, name: str) -> T.DataType | None:
    for f in df.schema.fields:
        if f.name.lower() == name.lower():
            return f.dataType
    return None


def event_key_text(df: DataFrame) -> Column:
    """The text whose digest is the event key."""
    return key_text(*[safe_column(df, c) for c in EVENT_KEY_PARTS])


def sales_event_key(df: DataFrame) -> Column:
    return F.md5(event_key_text(df))


def stage_columns(raw: DataFrame, include_optional: bool = False, lenient: bool = False) -> list[Column]:
    """The staging projection: one expression per output column. Casts fail
    the job on malformed text (ANSI); ``lenient`` turns them into
    ``try_cast`` so bad values become NULL (see ``quarantine_rows``)."""

    def num(name: str) -> Column:
        dt = _typed(raw, name) or T.StringType()
        return to_whole_number(safe_column(raw, name, dt), dt, lenient).alias(name)

    def money(name: str) -> Column:
        return cast_to(safe_column(raw, name, _typed(raw, name) or "string"), MONEY, lenient).alias(name)

    ts = cast_to(safe_column(raw, "order_timestamp", _typed(raw, "order_timestamp") or "string"),
                 "timestamp_ntz", lenient)
    cols = [
        sales_event_key(raw).alias("sales_event_key"),
        num("order_id"),
        num("customer_id"),
        num("product_id"),
        title_case(safe_column(raw, "product_category")).alias("product_category"),
        ts.alias("order_timestamp"),
        ts.cast("date").alias("order_date"),
        num("quantity"),
        money("unit_price"),
        money("gross_amount"),
        money("discount_amount"),
        money("net_amount"),
        title_case(safe_column(raw, "payment_method")).alias("payment_method"),
        upper_trim(safe_column(raw, "order_status")).alias("order_status"),
        safe_column(raw, "batch_id").alias("batch_id"),
        cast_to(safe_column(raw, "generated_at_utc", _typed(raw, "generated_at_utc") or "string"),
                "timestamp", lenient).alias("generated_at_utc"),
        safe_column(raw, "source_file_name").alias("source_file_name"),
        cast_to(safe_column(raw, "load_ts", _typed(raw, "load_ts") or "timestamp"),
                "timestamp", lenient).alias("load_ts"),
    ]
    if include_optional:
        cols += [safe_column(raw, c) for c in OPTIONAL_COLUMNS]
    return cols


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    rank_col: str = "_rn",
) -> DataFrame:
    """Keep the first row per key under ``order_by`` (a total order).

    ``row_number() ... = 1`` lets Spark insert a partial WindowGroupLimit
    *before* the shuffle, so each map task forwards at most one row per key:
    a hot key costs one row per map partition on the wire, not all of its
    rows in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def stg_sales(
    raw: DataFrame,
    tie_breakers: Sequence[str] | None = None,
    include_optional: bool = False,
) -> DataFrame:
    """Whole staging model: one row per ``sales_event_key`` (latest
    ``load_ts`` wins, ties broken by ``tie_breakers`` ascending), and no
    NULL ``order_id``.

    The NULL-order-id filter is applied *before* the dedup. That is
    equivalent to the model's filter-after-dedup because the key embeds
    the order id: a key group is either all-NULL or all-non-NULL. Filtering
    first also removes what would otherwise be one hot key per file.
    """
    out_cols = STG_COLUMNS + (OPTIONAL_COLUMNS if include_optional else [])
    if tie_breakers is None:
        staged = raw.select(*stage_columns(raw, include_optional)).filter(F.col("order_id").isNotNull())
        ties = [c for c in STG_COLUMNS if c not in ("sales_event_key", "load_ts")]
        order = [F.col("load_ts").desc_nulls_last()] + [F.col(t).asc_nulls_last() for t in ties]
        return dedup_latest(staged, ["sales_event_key"], order).select(*out_cols)
    # Only the key's text and the ordering columns are computed before the
    # shuffle; digests, casts and capitalisation run on the rows that stay.
    # A column that staging leaves as it is is ordered by itself: no copy of
    # it travels, or lies in the sort, beside it.
    by_name = dict(zip(STG_COLUMNS, stage_columns(raw)))
    staged = dict(zip(STG_COLUMNS, raw.select(*by_name.values()).schema.fields))
    added, order = [], []
    for i, c in enumerate(["load_ts", *tie_breakers]):
        if c in by_name and not (c in ONLY_CAST and staged[c].dataType == _typed(raw, c)):
            added.append(by_name[c].alias(f"_order_{i}"))
            c = f"_order_{i}"
        order.append(F.col(c).asc_nulls_last() if i else F.col(c).desc_nulls_last())
    keyed = raw.select("*", event_key_text(raw).alias("_key"), *added).filter(by_name["order_id"].isNotNull())
    latest = dedup_latest(keyed, ["_key"], order)
    return latest.select(*stage_columns(raw, include_optional)).select(*out_cols)


def quarantine_rows(raw: DataFrame) -> DataFrame:
    """Raw rows a strict staging cast would reject: a value present in RAW
    that becomes NULL under ``try_cast``, with the offending column names."""
    staged = raw.select("*", *[c.alias(f"__t_{c_name}") for c, c_name in
                               zip(stage_columns(raw, lenient=True), ["sales_event_key"] + STG_COLUMNS[1:])
                               if c_name in CAST_CHECKED])
    present = [c for c in CAST_CHECKED if _typed(raw, c) is not None]
    bad = F.array_compact(F.array(*[
        F.when(F.col(f"`{c}`").isNotNull() & F.col(f"__t_{c}").isNull(), F.lit(c)) for c in present
    ]))
    return (staged.withColumn("failed_columns", bad)
            .filter(F.size("failed_columns") > 0)
            .select(*[F.col(f"`{c}`") for c in raw.columns], "failed_columns"))
