"""Merkle manifest of a dataset: one tree per group, one tree over the groups.

The digest of a row is the sha256 of its fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and its value. Within a group the leaves ascend by
the order columns. While a group has more than one node, every ``FAN``
consecutive nodes become the sha256 of their digests, concatenated as hex
text (the last run may be shorter, even one node). What remains is the
group's subroot; the subroots in the order of their groups (null first, then
by UTF-8 bytes) give the root the same way.

All of it is joins of nodes by (group, index), with built-in expressions:

1. A leaf's index in its group comes from one range shuffle of digests by
   (group, order) and the counts of each range, so a group that holds a third
   of the rows is spread over as many ranges as its rows fill. Texts are
   hashed where they are read and never shuffled.
2. Every level equijoins its nodes with the computed indices of their
   siblings: index XOR 1 in a binary tree, else the slots (slot + o) mod fan
   of the same run for o = 1 .. fan - 1. Index pairs are unique, so no join
   key is hot. The rows at slot zero then emit the parents. Each level is a
   written table of a third of the rows of the one below it.
3. Audit paths go down again: a node's path is its own siblings before the
   path of its parent, one equijoin a level, so all levels together move
   about one and a half times the leaves, not leaves times levels.

Defined results: null fields count as ``-``; rows with equal order columns
go by digest (equal rows hold neighbouring leaves of equal digest); a null
order value sorts first; a null group is a group; a lone leaf is its own
subroot and a lone subroot the root; empty input has no rows and no root.
Other columns, whatever their names, take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, store

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(values: list[Column]) -> Column:
    """The 32 bytes of a row's digest."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def group_key(group: Column) -> Column:
    """A group as a text that is never null and sorts like it, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (grp, ...) with ``idx``, the place in the group by ``order``,
    and ``n``, the rows of the group."""
    spark = rows.sparkSession
    by = [F.col("grp"), *[F.col(c).asc_nulls_first() for c in order]]
    here = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # written with its ranges, so that a rerun of a task can't deal them anew
    ranged = store(rows.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
                   .withColumn("part", F.spark_partition_id()).withColumn("here", here), "merkle_ranged")
    counts = ranged.groupBy("part", "grp").agg(F.count("*").alias("c"), F.min("here").alias("first"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("part", "grp", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                          F.sum("c").over(Window.partitionBy("grp")).alias("n"))
    return (ranged.join(shift, ["part", "grp"]).withColumn("idx", F.col("here") + F.col("shift")).drop("part", "here", "shift"))


def sibling(idx: Column, offset: int, fan: int) -> Column:
    """Index of the sibling ``offset`` slots on, around the run of ``fan``."""
    if fan == 2:
        return idx.bitwiseXOR(F.lit(1).cast("long"))
    return idx - idx % fan + (idx % fan + offset) % fan


def grow(nodes: DataFrame, fan: int = FAN) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``nodes`` (grp, idx, n, h, ...), and the roots.

    A level is a stored (grp, idx, n, h, before, after, ...) of the nodes of
    all groups with more than one node there; ``before`` and ``after`` are
    the concatenated digests of its siblings on either side. Roots are (grp,
    subroot, depth), depth the levels below the root.
    """
    widest = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    roots = nodes.where("n = 1").select("grp", F.col("h").alias("subroot"), F.lit(0).alias("depth"))
    while widest > 1:
        joined = nodes.where("n > 1")
        others = joined.select(F.col("grp").alias("s_grp"), F.col("idx").alias("s_idx"), F.col("h").alias("s_h"))
        for o in range(1, fan):
            other = others.toDF(f"grp_{o}", f"idx_{o}", f"h_{o}")
            joined = joined.join(other, (F.col("grp") == F.col(f"grp_{o}")) & (sibling(F.col("idx"), o, fan) == F.col(f"idx_{o}")), "left")
        slot = F.col("idx") % fan
        none = F.lit(b"")

        def side(wanted: list[tuple[int, Column]]) -> Column:
            return F.concat(none, *[F.coalesce(F.when(on, F.col(f"h_{o}")), none) for o, on in wanted])

        # the sibling o slots on stands after the node while its slot is below
        # fan, else it has gone around and stands before it
        after = side([(o, slot + o < fan) for o in range(1, fan)])
        before = side([(o, slot + o >= fan) for o in range(1, fan)])
        drop = [f"{c}_{o}" for c in ("grp", "idx", "h") for o in range(1, fan)]
        level = store(joined.withColumns({"before": before, "after": after}).drop(*drop), "merkle_level")
        levels.append(level)
        nodes = (level.where(F.col("idx") % fan == 0)
                 .select("grp", F.expr(f"idx div {fan}").alias("idx"), F.expr(f"(n + {fan - 1}) div {fan}").alias("n"),
                         F.unhex(F.sha2(F.concat(_hex(F.col("h")), _hex(F.col("after"))), 256)).alias("h")))
        roots = roots.union(nodes.where("n = 1").select("grp", F.col("h").alias("subroot"), F.lit(len(levels)).alias("depth")))
        widest = -(-widest // fan)
    return levels, store(roots, "merkle_roots")


def _step() -> Column:
    return F.array(F.struct(F.col("before"), F.col("after")))


def paths(nodes: DataFrame, levels: list[DataFrame], roots: DataFrame, fan: int = FAN) -> DataFrame:
    """``nodes`` with ``subroot`` and ``path``, the siblings (before, after)
    of each level from the leaf to the group's root and on along the root's
    own path. ``roots`` is (grp, subroot, depth, path)."""
    at = F.col("depth")
    out = nodes.where("n = 1").join(roots.where(at == 0).select("grp", "subroot", "path"), "grp")
    above = None
    for k in range(len(levels) - 1, -1, -1):
        tops = roots.where(at == k + 1).select("grp", F.lit(0).cast("long").alias("idx"), "subroot", "path")
        up = (tops if above is None else above.select("grp", "idx", "subroot", "path").union(tops)).toDF("u_grp", "u_idx", "subroot", "up")
        above = (levels[k].join(up, (F.col("grp") == F.col("u_grp")) & (F.expr(f"idx div {fan}") == F.col("u_idx")))
                 .withColumn("path", F.concat(_step(), F.col("up"))).drop("u_grp", "u_idx", "up", "before", "after"))
    return out if above is None else above.unionByName(out)


def folded(leaf: Column, path: Column) -> Column:
    """Hex root that a leaf's digest gives along its path."""
    return F.aggregate(path, _hex(leaf), lambda acc, x: F.sha2(F.concat(_hex(x["before"]), acc, _hex(x["after"])), 256))


def siblings_hex(path: Column) -> Column:
    """The path's digests, level by level and from left to right, as hex."""
    return F.array_join(F.transform(path, lambda x: _hex(F.concat(x["before"], x["after"]))), "")


def prove(rows: DataFrame, order: list[str], fan: int = FAN) -> DataFrame:
    """``rows`` (grp, h, order columns, ...) with subroot, root and path."""
    leaves = store(placed(rows, [*order, "h"]), "merkle_leaves")
    levels, roots = grow(leaves, fan)
    tops = store(placed(roots.select(F.lit("").alias("grp"), F.col("grp").alias("own"), "depth", F.col("subroot").alias("h")), ["own"]), "merkle_tops")
    top_levels, top_root = grow(tops, fan)
    whole = top_root.first()
    empty = F.array().cast("array<struct<before:binary,after:binary>>")
    of_top = paths(tops, top_levels, top_root.withColumn("path", empty), fan)
    groups = store(of_top.select(F.col("own").alias("grp"), F.col("h").alias("subroot"), F.col("depth"), "path"), "merkle_groups")
    found = paths(leaves, levels, groups, fan)
    return found.withColumn("root", F.lit(bytes(whole["subroot"]) if whole else None).cast("binary"))


def write_manifest(docs: DataFrame, path: str, fields=FIELDS, group: str = "source", order: str = "doc_id", fan: int = FAN) -> str:
    """Write every row's leaf, subroot, root and audit path as Parquet, the
    manifest against which ``verify`` holds a later copy."""
    rows = docs.select(group_key(F.col(group)).alias("grp"), F.col(order).alias("key"), digest([F.col(c) for c in fields]).alias("h"))
    prove(rows, ["key"], fan).select("grp", "key", "idx", F.col("h").alias("leaf"), "subroot", "root", "path").write.parquet(path)
    return path


def verify(docs: DataFrame, path: str, fields=FIELDS, group: str = "source", order: str = "doc_id") -> DataFrame:
    """Rows (grp, key, state) by which ``docs`` departs from the manifest:
    ``missing`` leaves, ``unexpected`` rows, and leaves whose path does not
    give the root (``broken``). Empty if the copy is whole."""
    spark = docs.sparkSession
    now = (docs.select(group_key(F.col(group)).alias("grp"), F.col(order).alias("key"), digest([F.col(c) for c in fields]).alias("leaf"))
           .groupBy("grp", "key", "leaf").agg(F.count("*").alias("now")))
    then = (spark.read.parquet(path).withColumn("good", folded(F.col("leaf"), F.col("path")) == _hex(F.col("root")))
            .groupBy("grp", "key", "leaf").agg(F.count("*").alias("then"), F.min("good").alias("good")))
    both = now.alias("a").join(then.alias("b"), (F.col("a.grp") == F.col("b.grp")) & F.col("a.key").eqNullSafe(F.col("b.key")) & (F.col("a.leaf") == F.col("b.leaf")), "full")
    state = (F.when(F.coalesce("now", F.lit(0)) < F.coalesce("then", F.lit(0)), "missing")
             .when(F.coalesce("now", F.lit(0)) > F.coalesce("then", F.lit(0)), "unexpected").when(~F.col("good"), "broken"))
    return (both.select(F.coalesce("a.grp", "b.grp").alias("grp"), F.coalesce("a.key", "b.key").alias("key"), state.alias("state"))
            .where("state is not null"))


def tamper_report(docs: DataFrame, changed: Column, instead: dict[str, Column], fields=FIELDS, group: str = "source", order: str = "doc_id",
                  fan: int = FAN) -> DataFrame:
    """What an audit sees of a copy in which the rows where ``changed`` holds
    have the fields of ``instead``: (doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified), digests in lowercase hex."""
    h = digest([F.col(c) for c in fields])
    other = digest([instead.get(c, F.col(c)) for c in fields])
    rows = docs.select(group_key(F.col(group)).alias("grp"), F.col(order).alias("key"), h.alias("h"),
                       F.when(F.coalesce(changed, F.lit(False)), F.nullif(other, h)).alias("other"))
    found = prove(rows, ["key"], fan)
    root = _hex(F.col("root"))
    out = found.select(F.col("key").alias(order), _hex(F.col("h")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), root.alias("root"),
                       F.sha2(siblings_hex(F.col("path")), 256).alias("proof_sha256"),
                       folded(F.coalesce("other", "h"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
