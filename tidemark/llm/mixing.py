"""Mixing sources to target weights by systematic sampling.

The size of a document is its number of words. A mix takes ``share`` times
the words of all documents. Sources, in code point order with null last,
weigh ``weights`` in turn; their targets are proportional to the weights but
stop at ``cap`` times the source's own size, and what is cut off goes to the
others by weight until no target is above its limit.

Each document of a source is expected ``target / source size`` times. With
the source's documents in order of (size, doc_id), the prefix sums of the
expected copies plus one random offset are laid on the number line and a
document is taken once for each integer that its interval crosses. Sorting
by size first keeps the taken words within about one document of the
target. The offset is a hash of the seed and the source's place, so reruns
agree.

A document's place within its source comes from one range shuffle by
(source, size, doc_id) and the counts of each range, so a source with most
of the rows is spread over as many ranges as its rows fill.

Null texts and texts without words have size 0 and take nothing; they are
returned. A source without words has target 0. Rows with a null doc_id or
a repeated doc_id are documents of their own. Empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, store, word_array

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """(source, source_size, target, rate, shift) from (source, size) rows.

    One row per source reaches the ordered pass. Limits are filled in order
    of limit over weight: a source is at its limit when the level at which
    the sources from it on would share the rest reaches it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    ranked = (per.withColumn("place", F.row_number().over(place) - 1)
              .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                 (F.col("place") % len(weights) + 1).cast("int")))
              .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
              .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share))))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(F.col("limit") / F.col("weight"), "place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = (ranked.withColumn("filled", F.coalesce(F.sum("limit").over(fill), F.lit(0.0)))
              .withColumn("open_weight", F.sum("weight").over(rest))
              .withColumn("level", (F.col("total") - F.col("filled")) / F.col("open_weight"))
              .withColumn("open", F.col("level") * F.col("weight") < F.col("limit"))
              # the first source below its limit sets the level of all later ones
              .withColumn("water", F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), F.col("place"), F.col("level")))).over(everything)))
    target = F.when(F.col("water").isNull() | (F.col("limit") <= F.col("weight") * F.col("water.level")), F.col("limit")).otherwise(F.col("weight") * F.col("water.level"))
    shift = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), F.col("place").cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return levels.select("source", "source_size", target.alias("target"),
                         F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"), shift.alias("shift"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every document with doc_id, source, size, source_size, target, copies
    and taken (= copies * size), and the columns named by ``keep``.

    Names in ``keep`` must differ from those. Built-in expressions only.
    """
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", *keep,
                        F.size(word_array(F.coalesce(F.col("text"), F.lit("")))).cast("long").alias("size"))
    order = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("doc_id")]
    # equal rows may swap places freely; the written table fixes the order
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = store(sized.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
                   .withColumn("part", F.spark_partition_id()).withColumn("place", place), "mix_ranged")
    targets = store(source_targets(ranged.select("source", "size"), weights, share, cap, seed), "mix_targets")
    counts = ranged.groupBy("part", "source").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.col("source").alias("s"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift_by"))
    per = store(offsets.join(targets, F.col("s").eqNullSafe(F.col("source"))).drop("source").withColumnRenamed("part", "p"), "mix_offsets")
    joined = ranged.join(per, (F.col("p") == F.col("part")) & F.col("source").eqNullSafe(F.col("s")))
    rank = (F.col("shift_by") + F.col("place") + 1).cast("double")
    crossed = F.floor(F.col("rate") * rank + F.col("shift")) - F.floor(F.col("rate") * (rank - 1) + F.col("shift"))
    return (joined.withColumn("copies", crossed.cast("long"))
            .select("doc_id", "source", *keep, "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))
