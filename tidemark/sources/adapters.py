"""Adapters that derive the pipeline's input tables from the driver's
TPC-H-style parquet tables, so every query grows with the data.

``sales_raw``      lineitem x orders x part  -> raw landed sales rows
``warehouse_metering_history`` / ``metering_daily_history`` / ``query_history``
                   events                    -> usage-history views

The SQL text of each adapter (``*_SQL``) is the portable twin used by the
DuckDB oracle; the DataFrame versions below are what Spark runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import MONEY

# Business dates are moved so 1995-01-01 lands on 2024-01-01, the first day
# of the date dimension.
DATE_SHIFT_DAYS = 10592
# Tie-breakers that make the staging dedup a total order on this fixture.
FIXTURE_TIE_BREAKERS = ("product_id", "l_suppkey", "quantity", "discount_amount")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw landed sales rows with ingest lineage (``source_file_name``,
    ``load_ts``). Category/payment/status text is deliberately messy, one
    part in 501 yields a NULL order id, and repeated (orderkey, linenumber)
    pairs give natural duplicates for the dedup."""
    l = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_returnflag",
    )
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")

    # Sizes are data-dependent: plain joins, the planner/AQE picks
    # broadcast vs sort-merge from statistics.
    base = l.join(o, l.l_orderkey == o.o_orderkey).join(p, l.l_partkey == p.p_partkey)

    quantity = F.col("l_quantity").cast("bigint")
    unit_price = F.col("p_retailprice").cast(MONEY)
    gross = (quantity * unit_price).cast(MONEY)
    kind = F.col("l_orderkey") % 50
    file_kind = (
        F.when(kind == 0, F.lit("sales_backfill_"))
        .when(kind == 1, F.lit("sales_late_arriving_"))
        .otherwise(F.lit("sales_"))
    )
    lag_days = (
        F.when(kind == 0, 60 + F.col("l_partkey") % 30)
        .when(kind == 1, 7 + F.col("l_partkey") % 23)
        .otherwise(F.col("l_partkey") % 3)
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit(" completed"))
        .when(F.col("o_orderstatus") == "O", F.lit("Pending "))
        .when(F.col("l_returnflag") == "R", F.lit("Refunded"))
        .otherwise(F.lit("CANCELLED"))
    )
    order_ts = F.col("o_orderdate") + _days(F.lit(DATE_SHIFT_DAYS))

    priced = base.select(
        F.when(F.col("l_partkey") % 501 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        .alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.concat(F.lit("  "), F.lower("p_type"), F.lit(" ")).alias("product_category"),
        order_ts.alias("order_timestamp"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        gross.alias("gross_amount"),
        F.col("l_discount").cast(T.DecimalType(4, 2)).alias("l_discount"),
        F.concat(F.lit(" "), F.substr("o_orderpriority", F.lit(3)), F.lit(" ")).alias("payment_method"),
        status.alias("order_status"),
        F.concat(F.lit("b"), (F.col("l_orderkey") % 8).cast("string")).alias("batch_id"),
        file_kind.alias("file_kind"),
        lag_days.alias("lag_days"),
        F.col("l_suppkey"),
    )
    discount = (F.col("gross_amount") * F.col("l_discount")).cast(MONEY)
    load_ts = F.col("order_timestamp") + _days(F.col("lag_days"))
    priced = priced.withColumn("discount_amount", discount).withColumn("load_ts", load_ts)
    file_name = F.concat(
        F.col("file_kind"),
        F.year("load_ts").cast("string"),
        F.lit("_"),
        F.lpad(F.month("load_ts").cast("string"), 2, "0"),
        F.lit(".csv"),
    )
    return priced.select(
        "order_id", "customer_id", "product_id", "product_category", "order_timestamp",
        "quantity", "unit_price", "gross_amount", "discount_amount",
        F.greatest(F.col("gross_amount") - F.col("discount_amount"), F.lit(0))
        .cast(MONEY).alias("net_amount"),
        "payment_method", "order_status", "batch_id",
        file_name.alias("source_file_name"),
        "load_ts", "l_suppkey",
    )


SALES_RAW_SQL = """
select order_id, customer_id, product_id, product_category, order_timestamp, quantity, unit_price, gross_amount, discount_amount,
  cast(greatest(gross_amount - discount_amount, 0) as decimal(18,2)) as net_amount,
  payment_method, order_status, batch_id,
  concat(file_kind, cast(year(load_ts) as varchar(4)), '_', lpad(cast(month(load_ts) as varchar(2)), 2, '0'), '.csv') as source_file_name,
  load_ts, l_suppkey
from (
  select *, cast(gross_amount * l_discount as decimal(18,2)) as discount_amount,
    order_timestamp + interval '1' day * lag_days as load_ts
  from (
    select
      case when l.l_partkey % 501 = 0 then null else l.l_orderkey * 10 + l.l_linenumber end as order_id,
      o.o_custkey as customer_id,
      l.l_partkey as product_id,
      concat('  ', lower(p.p_type), ' ') as product_category,
      o.o_orderdate + interval '10592' day as order_timestamp,
      cast(l.l_quantity as bigint) as quantity,
      cast(p.p_retailprice as decimal(18,2)) as unit_price,
      cast(cast(l.l_quantity as bigint) * cast(p.p_retailprice as decimal(18,2)) as decimal(18,2)) as gross_amount,
      cast(l.l_discount as decimal(4,2)) as l_discount,
      concat(' ', substr(o.o_orderpriority, 3), ' ') as payment_method,
      case when o.o_orderstatus = 'F' then ' completed' when o.o_orderstatus = 'O' then 'Pending '
           when l.l_returnflag = 'R' then 'Refunded' else 'CANCELLED' end as order_status,
      concat('b', cast(l.l_orderkey % 8 as varchar(20))) as batch_id,
      case when l.l_orderkey % 50 = 0 then 'sales_backfill_' when l.l_orderkey % 50 = 1 then 'sales_late_arriving_' else 'sales_' end as file_kind,
      case when l.l_orderkey % 50 = 0 then 60 + l.l_partkey % 30 when l.l_orderkey % 50 = 1 then 7 + l.l_partkey % 23 else l.l_partkey % 3 end as lag_days,
      l.l_suppkey
    from lineitem l
    join orders o on l.l_orderkey = o.o_orderkey
    join part p on l.l_partkey = p.p_partkey
  ) base
) priced
"""


# --- usage-history views over ``events`` ------------------------------------

def _credits(event_type: Column, event_id: Column) -> Column:
    rate = (
        F.when(event_type == "purchase", F.lit(0.02).cast(T.DecimalType(6, 4)))
        .when(event_type == "view", F.lit(0.01).cast(T.DecimalType(6, 4)))
        .otherwise(F.lit(0.001).cast(T.DecimalType(6, 4)))
    )
    return (event_id % 10).cast(T.DecimalType(10, 0)) * rate


def warehouse_metering_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    credits = _credits(F.col("event_type"), F.col("event_id"))
    return ev.select(
        F.col("ts").alias("start_time"),
        F.concat(F.lit("wh_"), F.col("event_type")).alias("warehouse_name"),
        credits.alias("credits_used"),
        (credits * F.lit(0.90).cast(T.DecimalType(3, 2))).alias("credits_used_compute"),
        (credits * F.lit(0.10).cast(T.DecimalType(3, 2))).alias("credits_used_cloud_services"),
    )


def metering_daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read_table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("usage_date"),
        F.col("event_type").alias("service_type"),
        _credits(F.col("event_type"), F.col("event_id")).alias("c"),
    )
    return m.groupBy("usage_date", "service_type").agg(
        F.sum("c").alias("credits_used"),
        F.sum(F.col("c") * F.lit(0.90).cast(T.DecimalType(3, 2))).alias("credits_used_compute"),
        F.sum(F.col("c") * F.lit(0.10).cast(T.DecimalType(3, 2))).alias("credits_used_cloud_services"),
    )


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    tag = (
        F.when(eid % 4 == 0, F.lit(None).cast("string"))
        .when(eid % 4 == 1, F.lit("dbt_staging"))
        .when(eid % 4 == 2, F.lit("dbt_marts"))
        .otherwise(F.lit("adhoc"))
    )
    exec_ms = (eid * 37) % 90000
    return ev.select(
        eid.alias("query_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_name"),
        F.when(eid % 3 == 0, F.lit("TRANSFORMER")).otherwise(F.lit("ANALYST")).alias("role_name"),
        F.concat(F.lit("wh_"), F.col("event_type")).alias("warehouse_name"),
        F.lit("demo_sales").alias("database_name"),
        F.when(eid % 4 == 2, F.lit("MARTS")).otherwise(F.lit("STAGING")).alias("schema_name"),
        F.when(eid % 5 == 0, F.lit("CREATE_TABLE_AS_SELECT")).otherwise(F.lit("SELECT")).alias("query_type"),
        tag.alias("query_tag"),
        exec_ms.alias("execution_time"),
        (exec_ms + eid % 500).alias("total_elapsed_time"),
        (((eid * 7919) % 100000) * 1048576).alias("bytes_scanned"),
        (eid % 1000).alias("rows_produced"),
        F.col("ts").alias("start_time"),
        F.when(eid % 6 == 0, F.lit("select 1 /* DBT */")).otherwise(F.lit("select 1")).alias("query_text"),
    )


_CREDITS_SQL = (
    "cast(event_id % 10 as decimal(10,0)) * case when event_type = 'purchase' then cast(0.0200 as decimal(6,4)) "
    "when event_type = 'view' then cast(0.0100 as decimal(6,4)) else cast(0.0010 as decimal(6,4)) end"
)

WAREHOUSE_METERING_HISTORY_SQL = f"""
select ts as start_time, concat('wh_', event_type) as warehouse_name,
  {_CREDITS_SQL} as credits_used,
  ({_CREDITS_SQL}) * cast(0.90 as decimal(3,2)) as credits_used_compute,
  ({_CREDITS_SQL}) * cast(0.10 as decimal(3,2)) as credits_used_cloud_services
from events
"""

METERING_DAILY_HISTORY_SQL = f"""
select usage_date, service_type, sum(c) as credits_used,
  sum(c * cast(0.90 as decimal(3,2))) as credits_used_compute,
  sum(c * cast(0.10 as decimal(3,2))) as credits_used_cloud_services
from (select cast(ts as date) as usage_date, event_type as service_type, {_CREDITS_SQL} as c from events) e
group by usage_date, service_type
"""

QUERY_HISTORY_SQL = """
select event_id as query_id, concat('u', cast(user_id as varchar)) as user_name,
  case when event_id % 3 = 0 then 'TRANSFORMER' else 'ANALYST' end as role_name,
  concat('wh_', event_type) as warehouse_name,
  'demo_sales' as database_name,
  case when event_id % 4 = 2 then 'MARTS' else 'STAGING' end as schema_name,
  case when event_id % 5 = 0 then 'CREATE_TABLE_AS_SELECT' else 'SELECT' end as query_type,
  case when event_id % 4 = 0 then null when event_id % 4 = 1 then 'dbt_staging' when event_id % 4 = 2 then 'dbt_marts' else 'adhoc' end as query_tag,
  (event_id * 37) % 90000 as execution_time,
  (event_id * 37) % 90000 + event_id % 500 as total_elapsed_time,
  ((event_id * 7919) % 100000) * 1048576 as bytes_scanned,
  event_id % 1000 as rows_produced, ts as start_time,
  case when event_id % 6 = 0 then 'select 1 /* DBT */' else 'select 1' end as query_text
from events
"""
