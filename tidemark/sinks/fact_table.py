"""Keyed fact table on plain partitioned Parquet.

Rows are partitioned by their source file (a digest of its name, so that any
name makes a folder). The event key embeds the file, so all deliveries of a
key meet in one partition and an upsert recomputes only the partitions that
the incoming rows touch: stored rows of those partitions without the incoming
keys, union the incoming rows, written with dynamic partition overwrite. A
delta of new files only adds partitions. Untouched files are neither read
(dynamic partition pruning) nor written. The files that table and delta
share are written first, as a few rows: known to be small, they prune the
scan, and only rows of these files meet the incoming keys.

Beside the data stands a ledger of the upserts: rows, newest load time, and
the batch id of a stream's batch, written after the data. It gives the
high-water mark without a scan, and a replayed batch is skipped. A run that
dies between the two leaves an older mark and repeats the same keyed merge,
which changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import pack_digests, unpack_digests
from tidemark.operators.fact import EMPTY_TARGET_FLOOR, FACT_KEY, merge_keyed
from tidemark.session import CODEC, delete_path, kept_for, materialize, materialized, path_exists, shuffles_dropped

PART = "file_part"


def gathered(rows: DataFrame, part: str, key: str | None = None) -> DataFrame:
    """``rows`` gathered by ``part``, an oversized part over several tasks;
    digests of the column ``key`` travel as bytes."""
    if key is None or dict(rows.dtypes).get(key) != "string":
        return rows.hint("rebalance", part)
    return unpack_digests(pack_digests(rows, key).hint("rebalance", part), key, rows.columns)


def replace_partitions(rows: DataFrame, path: str, part: str, touched: DataFrame | None = None) -> None:
    """Write ``rows`` over the partitions of ``path`` that they fall in; a
    partition of ``touched`` (one column ``part``) without rows disappears.
    Rows of a partition are gathered, an oversized one over several tasks."""
    spark = rows.sparkSession
    with materialized(rows, "partitions") as rows:  # read twice, and may stem from ``path``
        with shuffles_dropped(spark):
            (gathered(rows, part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
             .partitionBy(part).parquet(path))
        if touched is not None:
            for r in touched.join(rows.select(part).distinct(), part, "left_anti").distinct().collect():
                delete_path(spark, f"{path}/{part}={r[0]}")


class FactTable:
    def __init__(self, spark: SparkSession, path: str, key: str = FACT_KEY, file: str = "source_file_name", loaded: str = "load_ts"):
        self.spark, self.path, self.key, self.file, self.loaded = spark, path.rstrip("/"), key, file, loaded
        self.data, self.ledger = f"{self.path}/data", f"{self.path}/ledger"

    def _part(self) -> Column:
        return F.md5(F.coalesce(F.col(self.file), F.lit("")))

    def exists(self) -> bool:
        return path_exists(self.spark, self.data)

    def _stored(self, schema: T.StructType | None) -> DataFrame:
        if schema is None:
            return self.spark.read.option("mergeSchema", True).parquet(self.data)
        return self.spark.read.schema(T.StructType([f for f in schema.fields if f.name != PART] + [T.StructField(PART, T.StringType())])).parquet(self.data)

    def read(self, schema: T.StructType | None = None) -> DataFrame | None:
        """The rows, or None before the first upsert. With ``schema`` the
        table has its columns: one that older files lack is NULL there, one
        that it does not name is gone; without, it has every column that
        some file has."""
        return self._stored(schema).drop(PART) if self.exists() else None

    def applied(self, batch_id: int) -> bool:
        return path_exists(self.spark, f"{self.ledger}/entry=batch-{batch_id}/_SUCCESS")

    def upsert(self, delta: DataFrame, batch_id: int | None = None, stored: bool = False,
               derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Keyed merge of ``delta`` (unique per key; incoming rows win). A
        batch id that has been applied before is skipped. ``stored`` tells
        that ``delta`` does no more than read stored rows: it is read several
        times as it is, where another one is written first. ``derive`` gives
        the table's rows for those of ``delta``, one by one: columns that it
        adds to rows of new files do not travel with them."""
        if batch_id is not None and self.applied(batch_id):
            return
        if stored or not self.exists():
            self._merge(delta, batch_id, derive)
        else:
            with kept_for(materialize(delta, "fact_delta")) as written:
                self._merge(written, batch_id, derive)

    def _merge(self, delta: DataFrame, batch_id: int | None, derive: Callable[[DataFrame], DataFrame]) -> None:
        parted = lambda rows: rows.withColumn(PART, self._part())
        schema = derive(delta).schema
        if not self.exists():
            self._write(parted(derive(gathered(delta, self.file, self.key))))
            if self.exists():  # the table is the delta
                delta = self._stored(schema)
        else:
            here = F.col(PART) >= ""  # each is; only a side with a filter prunes the other's scan
            known = self.spark.read.schema(T.StructType([T.StructField(PART, T.StringType())])).parquet(self.data)
            with (materialized(parted(delta).select(PART).distinct(), "fact_parts") as parts,
                  materialized(known.join(parts.where(here), PART, "left_semi").distinct(), "fact_parts") as shared):
                shared = shared.where(here)
                merged = merge_keyed(self._stored(schema).join(shared, PART, "left_semi"), parted(derive(delta)).join(shared, PART, "left_semi"), [self.key, PART])
                new = parted(delta).join(shared, PART, "left_anti").drop(PART)
                self._write(gathered(merged, PART, self.key).unionByName(parted(derive(gathered(new, self.file, self.key)))))
        entry = f"batch-{batch_id}" if batch_id is not None else uuid.uuid4().hex
        newest = F.max(F.col(self.loaded).cast("timestamp")) if self.loaded in delta.columns else F.lit(None).cast("timestamp")
        delta.agg(F.count("*").alias("rows"), newest.alias("newest")).write.mode("overwrite").parquet(f"{self.ledger}/entry={entry}")

    def _write(self, rows: DataFrame) -> None:
        with shuffles_dropped(self.spark):
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
             .partitionBy(PART).parquet(self.data))

    def entries(self) -> DataFrame:
        return self.spark.read.schema("rows long, newest timestamp, entry string").parquet(self.ledger)

    def high_water_mark(self, lookback: str = "1 hour") -> DataFrame:
        """(high_water_mark): the newest load time less ``lookback``, from
        the ledger; no data file is opened."""
        newest = F.max("newest") if self.exists() else F.lit(None).cast("timestamp")
        rows = self.entries() if self.exists() else self.spark.range(1)
        return rows.agg((F.coalesce(newest, F.lit(EMPTY_TARGET_FLOOR).cast("timestamp")) - F.expr(f"INTERVAL {lookback}")).alias("high_water_mark"))

    def new_rows(self, src: DataFrame, lookback: str = "1 hour") -> DataFrame:
        """Rows of ``src`` at or after the high-water mark."""
        return src.where(F.col(self.loaded) >= self.high_water_mark(lookback).scalar())
