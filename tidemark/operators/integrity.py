"""File-integrity operators, each one Spark job over *all* landed files:
content fingerprints, data-row counts, checksum and row-count
verification, per-file header drift against the contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.contract import Contract, normalize_name
from tidemark.session import scratch_dir
from tidemark.sources.arrow_files import digests, first_lines, reachable

CHECKSUM_MATCH, CHECKSUM_MISMATCH, CHECKSUM_MISSING = "MATCH", "MISMATCH", "MISSING_FILE"


def list_landing_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Path, size and modification time of matching files. The binary
    content column is not selected, so file bodies are never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def file_fingerprints(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """SHA-256 and byte size per file. Each file is streamed by one task in
    1 MiB blocks, so its size does not matter; the listing packs small files
    into tasks by size. Where Arrow cannot open the store, Spark reads the
    file as one row, which bounds it to 2 GB."""
    files = list_landing_files(spark, root, glob)
    if reachable(root):
        return digests(files.select("path", "length"))
    whole = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    return whole.select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))


def _quotes(value: Column, escape: str) -> Column:
    """Quotation marks of a line that open or close a quoted field."""
    if escape != '"':  # an escaped mark does neither; a doubled one does both
        value = F.replace(F.replace(value, F.lit(escape * 2), F.lit("")), F.lit(escape + '"'), F.lit(""))
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def file_row_counts(spark: SparkSession, root: str, glob: str = "*.csv", escape: str = "\\") -> DataFrame:
    """Data rows per file, header excluded, files without rows counted as 0
    (Spark does not list files of zero bytes).

    A quoted field may hold line ends, so a line end closes a row only
    outside quotes. Files are read in splits: a line with an odd number of
    quotation marks flips the state, and the lines between two flips are
    counted by row id alone. Each split gives its number of row ends for
    either state at its start, and whether it flips the state; the running
    parity of the splits before it tells which number holds. Only flipping
    lines and one row per split are shuffled, so one huge file is counted by
    all tasks. Blank lines outside quotes are no rows, as in Spark's CSV
    reader, whose escape character is the default. Marks inside unquoted
    fields, which no CSV writer leaves bare, are not supported.
    """
    files = list_landing_files(spark, root, glob).select("path")
    lines = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(root)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
        .where(F.trim("value") != "")
        .select("path", "block", (_quotes(F.col("value"), escape) % 2 == 1).alias("flips"), F.monotonically_increasing_id().alias("id"))
    )
    split = lines.groupBy("path", "block").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count_if("flips").alias("n_flips"))
    in_split = Window.partitionBy("path", "block").orderBy("id")
    flips = (lines.where("flips").select("path", "block", "id", F.row_number().over(in_split).alias("k"), F.lead("id").over(in_split).alias("next")))
    # lines from the k-th flip up to the next one end with parity k mod 2
    inner = (flips.groupBy("path", "block")
             .agg(F.min("id").alias("first_flip"),
                  F.sum(F.when((F.col("k") % 2 == 0) & F.col("next").isNotNull(), F.col("next") - F.col("id"))).alias("even"),
                  F.max(F.when(F.col("next").isNull(), F.col("id"))).alias("last_flip")))
    both = split.join(inner, ["path", "block"], "left")
    total = F.col("last") - F.col("first") + 1
    tail = F.when(F.col("n_flips") % 2 == 0, F.col("last") - F.col("last_flip") + 1).otherwise(0)
    even = F.when(F.col("n_flips") == 0, total).otherwise(F.col("first_flip") - F.col("first") + F.coalesce("even", F.lit(0)) + tail)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_flips").over(before), F.lit(0)) % 2 == 1
    ends = both.select("path", F.when(inside, total - even).otherwise(even).alias("ends"))
    counted = ends.groupBy(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("p")).agg(F.sum("ends").alias("ends"))
    plain = F.regexp_replace("path", "^file:/+", "file:/")
    return files.join(counted, plain == F.regexp_replace("p", "^file:/+", "file:/"), "left").select(
        "path", F.greatest(F.coalesce("ends", F.lit(0)) - 1, F.lit(0)).cast("bigint").alias("row_count"))


def verify_checksums(fingerprints: DataFrame, manifests: DataFrame) -> DataFrame:
    """Recorded vs recomputed checksum per manifest entry."""
    m = manifests.select(
        F.col("data_s3_uri").alias("path"),
        F.col("checksum_sha256").alias("expected_sha256"),
        F.col("file_size_bytes").alias("expected_bytes"),
    )
    j = m.join(fingerprints, "path", "left")
    status = (
        F.when(F.col("sha256").isNull(), F.lit(CHECKSUM_MISSING))
        .when(F.col("sha256") == F.col("expected_sha256"), F.lit(CHECKSUM_MATCH))
        .otherwise(F.lit(CHECKSUM_MISMATCH))
    )
    return j.select("path", "expected_sha256", F.col("sha256").alias("actual_sha256"),
                    "expected_bytes", F.col("length").alias("actual_bytes"), status.alias("checksum_status"))


def require_checksums_match(verified: DataFrame) -> None:
    """Fail if a file does not match; every failing file is written to a
    table under the shared folder, whose path the error names."""
    spark = verified.sparkSession
    path = scratch_dir(spark, "checksum_failures")
    verified.filter(F.col("checksum_status") != CHECKSUM_MATCH).write.parquet(path)
    bad = spark.read.parquet(path)
    n = bad.count()
    if n:
        first = bad.agg(F.min("path")).first()[0]
        raise ValueError(f"Checksum validation failed for {n} file(s), the first is {first}; all are listed in {path}")


def verify_row_counts(manifests: DataFrame, raw: DataFrame) -> DataFrame:
    """Manifest expected rows vs rows that reached RAW, per file."""
    loaded = raw.groupBy("source_file_name").agg(F.count(F.lit(1)).alias("loaded_row_count"))
    m = manifests.select(F.col("data_s3_uri").alias("source_file_name"), "expected_row_count")
    j = m.join(loaded, "source_file_name", "left")
    loaded_n = F.coalesce(F.col("loaded_row_count"), F.lit(0).cast("bigint"))
    return j.select(
        "source_file_name", "expected_row_count", loaded_n.alias("loaded_row_count"),
        (F.col("expected_row_count") - loaded_n).alias("row_count_difference"),
    )


def file_headers(spark: SparkSession, root: str, glob: str = "*.csv", files: DataFrame | None = None) -> DataFrame:
    """(path, columns): the first line of every file as an array of
    normalised column names. ``files`` (path) may name the files instead.

    The tasks read the first 64 KiB of each file, whatever its size. Where
    Arrow cannot open the store, Spark reads the lines of the first splits.
    """
    if reachable(root):
        named = list_landing_files(spark, root, glob) if files is None else files
        first = first_lines(named.select("path"))
    else:
        lines = (
            spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(root)
            .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
            .filter(F.col("block") == 0).withColumn("rid", F.monotonically_increasing_id())
        )
        first = lines.groupBy("path").agg(F.min_by("value", "rid").alias("header"))
        first = first.withColumn("path", F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))))
        if files is not None:
            first = first.join(files.select("path"), "path", "left_semi")
    names = F.transform(F.split(F.col("header"), ","), lambda x: F.lower(F.trim(F.regexp_replace(x, '"', ""))))
    return first.select("path", names.alias("columns"))


def file_header_drift(spark: SparkSession, root: str, contract: Contract,
                      expected_order: Sequence[str] | None = None, glob: str = "*.csv") -> DataFrame:
    """Per landed file: missing required, additive (unknown) and
    reordered columns versus the contract; ``is_breaking`` when anything
    is missing or reordered, or additive columns are not allowed."""
    required = F.array(*[F.lit(normalize_name(c)) for c in contract.required])
    known = F.array(*[F.lit(c) for c in list(contract.required) + list(contract.optional)])
    order = F.array(*[F.lit(normalize_name(c)) for c in (expected_order or list(contract.required) + list(contract.optional))])
    h = file_headers(spark, root, glob)
    missing = F.array_except(required, F.col("columns"))
    additive = F.array_except(F.col("columns"), known)
    reordered = F.array_intersect(F.col("columns"), order) != F.array_intersect(order, F.col("columns"))
    breaking = (F.size(missing) > 0) | reordered
    if not contract.allow_additive_columns:
        breaking = breaking | (F.size(additive) > 0)
    return h.select(
        "path", "columns",
        F.array_sort(missing).alias("missing_required_columns"),
        F.array_sort(additive).alias("additive_columns"),
        reordered.alias("is_reordered"),
        breaking.alias("is_breaking"),
    )
