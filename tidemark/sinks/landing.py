"""Landing-zone writers: CSV batches under arrival-date or business-date
partitions, checksum manifests, schema manifests, layer tables.

All writes go through Spark's committers (task retries and executor loss
are handled by the commit protocol); nothing is written from the driver.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.integrity import file_fingerprints, file_row_counts
from tidemark.session import CODEC, path_exists, shuffles_dropped

# Raw CSV column order as produced by the daily batch (contract order, then
# the optional channel column).
RAW_CSV_COLUMNS = [
    "order_id", "customer_id", "product_id", "product_category", "sales_channel",
    "order_timestamp", "quantity", "unit_price", "gross_amount", "discount_amount",
    "net_amount", "payment_method", "order_status", "batch_id", "generated_at_utc",
]


# Values are landed as they are: the writer would trim them by default.
CSV_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _csv_payload(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.col(c) for c in columns if c in df.columns]


def land_by_arrival(
    df: DataFrame,
    root: str,
    arrival: str = "load_ts",
    file_col: str | None = "source_file_name",
    columns: list[str] | None = None,
    mode: str = "append",
    grain: str = "day",
    compression: str | None = None,
) -> str:
    """Write CSV with header under ``root/year=YYYY/month=MM/day=DD/``
    keyed by the **arrival** date (zero-padded; ``grain="month"`` stops at
    the month folder for monthly source files). With ``file_col`` each
    source file keeps its own leaf folder so lineage survives.

    Rows are *rebalanced* on the partition columns (the ``rebalance`` hint):
    AQE groups each folder's rows into as few tasks as the advisory
    partition size allows - one output file for a normal source file - and
    splits an oversized folder over several tasks, so a hot file is never
    funnelled through one task. A source file may thus become several part
    files; its lineage is the ``file=`` folder (``sources.files.source_file``).

    ``compression`` ("gzip") lands ``*.csv.gz``: about a quarter of the bytes,
    but one task reads a file whole, which the split of oversized folders
    keeps small; readers of plain lines and digests want it unset."""
    columns = columns or RAW_CSV_COLUMNS
    a = F.col(arrival)
    parts = [F.date_format(a, "yyyy").alias("year"), F.date_format(a, "MM").alias("month")]
    part_names = ["year", "month"]
    if grain == "day":
        parts.append(F.date_format(a, "dd").alias("day"))
        part_names.append("day")
    if file_col:
        parts.append(F.col(file_col).alias("file"))
        part_names.append("file")
    with shuffles_dropped(df.sparkSession):
        (
            df.select(*_csv_payload(df, columns), *parts)
            .hint("rebalance", *part_names)
            .write.mode(mode)
            .options(**CSV_OPTIONS, **({"compression": compression, "zlib.compress.level": "BEST_SPEED"} if compression else {}))
            .partitionBy(*part_names)
            .csv(root)
        )
    return root


def land_daily(df: DataFrame, root: str, arrival: str = "load_ts", grain: str = "day", compression: str | None = None) -> str:
    return land_by_arrival(df, root, arrival, grain=grain, compression=compression)


def land_late(df: DataFrame, root: str, arrival: str = "load_ts", grain: str = "day") -> str:
    """Late batches land in the same arrival-date zone as daily files."""
    return land_by_arrival(df, root, arrival, grain=grain)


def land_backfill(df: DataFrame, root: str, business_ts: str = "order_timestamp",
                  columns: list[str] | None = None) -> str:
    """One partition per **business** date ``business_date=YYYY-MM-DD``;
    dynamic partition overwrite makes a replay of the same days idempotent
    while leaving other days untouched."""
    columns = columns or RAW_CSV_COLUMNS
    (
        df.select(*_csv_payload(df, columns), F.date_format(F.col(business_ts), "yyyy-MM-dd").alias("business_date"))
        .hint("rebalance", "business_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**CSV_OPTIONS)
        .partitionBy("business_date")
        .csv(root)
    )
    return root


def checksum_manifest(spark, landing: str, glob: str = "*.csv", as_of: datetime | None = None) -> DataFrame:
    """One manifest record per landed file: name, uri, key, algorithm,
    sha256, bytes, data rows, created_at."""
    fp = file_fingerprints(spark, landing, glob)
    rows = file_row_counts(spark, landing, glob)
    created = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return fp.join(rows, "path", "left").select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("path").alias("s3_uri"),
        F.regexp_extract("path", r"^[a-zA-Z0-9]+:/+[^/]*/(.*)$", 1).alias("s3_key"),
        F.lit("SHA-256").alias("checksum_algorithm"),
        F.col("sha256").alias("checksum_sha256"),
        F.col("length").alias("file_size_bytes"),
        F.coalesce(F.col("row_count"), F.lit(0).cast("bigint")).alias("row_count"),
        created.alias("created_at_utc"),
    )


def write_checksum_manifest(spark, landing: str, manifest_root: str, glob: str = "*.csv",
                            as_of: datetime | None = None) -> str:
    """Persist manifests as JSON records in their own folder, apart from
    the data files, so ingestion never reads them as sales rows."""
    checksum_manifest(spark, landing, glob, as_of).write.mode("append").json(manifest_root)
    return manifest_root


def write_schema_manifest(spark, report: dict, path: str, as_of: datetime | None = None) -> str:
    """Persist a contract-check result (one JSON record) plus created_at."""
    from tidemark.operators.contract import SCHEMA_MANIFEST_SCHEMA

    row = dict(report)
    row["created_at_utc"] = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([row], SCHEMA_MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(path)
    return path


def layer_path(root: str, layer: str | None, table: str, default_layer: str = "public") -> str:
    """``<root>/<layer>/<table>``: the custom layer name (trimmed) when
    given, else the target default."""
    name = (layer or "").strip() or default_layer
    return f"{root.rstrip('/')}/{name}/{table}"


def materialize_full(df: DataFrame, root: str, layer: str, table: str) -> str:
    """Full-refresh table: the layer's table is replaced by ``df``, which
    must not read it; returns its path."""
    path = layer_path(root, layer, table)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC).parquet(path)
    return path


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """A layer's table."""
    path = layer_path(root, layer, table)
    if not path_exists(spark, path):
        raise ValueError(f"layer table {layer}.{table} has not been built under {root}")
    return spark.read.parquet(path)
