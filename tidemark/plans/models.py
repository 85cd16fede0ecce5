"""Model chains over the fixture adapters, shared by the query catalog,
bench and tests. Each returns a lazy DataFrame (no action)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dims import days_through, dim_date
from tidemark.operators.fact import fct_sales
from tidemark.operators.intermediate import int_sales_enriched
from tidemark.operators.staging import stg_sales
from tidemark.sources.adapters import DATE_SHIFT_DAYS, FIXTURE_TIE_BREAKERS, read_table, sales_raw

# Fixed clock for reproducible results (every model takes ``as_of``).
USAGE_AS_OF = datetime(2024, 1, 31, 0, 0, 0)
USAGE_WAREHOUSES = ("wh_purchase", "wh_view", "wh_click")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_raw(spark, sf_dir)


def stg_of(raw: DataFrame) -> DataFrame:
    """Staging of a RAW frame of the fixture."""
    return stg_sales(raw, tie_breakers=FIXTURE_TIE_BREAKERS)


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_of(raw(spark, sf_dir))


def enriched_of(raw: DataFrame) -> DataFrame:
    return int_sales_enriched(stg_of(raw))


def fct_of(raw: DataFrame) -> DataFrame:
    """The fact of a RAW frame of the fixture."""
    return fct_sales(enriched_of(raw))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_of(raw(spark, sf_dir))


def fct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fct_sales(enriched(spark, sf_dir))


def last_order_date(spark: SparkSession, sf_dir: str) -> date | None:
    """Newest business date, from the one table that carries it."""
    newest = read_table(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("date")).first()[0]
    return newest + timedelta(days=DATE_SHIFT_DAYS) if newest else None


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar up to the newest business date; that is its clock."""
    last = last_order_date(spark, sf_dir)
    return dim_date(spark, as_of=last, n_days=days_through(last))


# --- incremental split used by the upsert / restatement queries ------------------------
INCREMENTAL_CUTOFF = datetime(2027, 1, 1, 0, 0, 0)
