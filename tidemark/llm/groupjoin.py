"""Similarity join of documents on word shingles by a token-group matrix.

A document is its set of distinct 5-word shingles of the text with A-Z
lower-cased (fewer words: the whole sequence is its one shingle; no words:
the empty set, linked with nothing). Two documents link when
100 * intersection >= 80 * union. The result is exact up to collisions of
64-bit shingle hashes.

1. One pass counts shingles into bounded bitmaps (``sharedbits``) of those
   that repeat and those that repeat often.
2. Shingles get one global order: unique, repeated, repeated often; then by
   hash. A set of size n that links with another shares a shingle among the
   first n - ceil(0.8 n) + 1 of this order. For most documents these are all
   unique and the document is finished.
3. Equal sets become one node, so copies never multiply.
4. Each node is checked against a pivot, the smallest node that shares the
   most prefix shingles, and if they do not link against a second one (the
   smallest by hash); links found join nodes of a dense cluster without
   listing its pairs.
5. Nodes are dealt into groups of about ``GROUP`` similar nodes: nodes of one
   component, or single nodes with one pivot, of one class of sizes (linked
   sets are in the same or neighbouring classes). The token-group matrix holds
   each group's union of shingles. A node queries the groups of other
   components that share a prefix shingle; the overlap with the union bounds
   the overlap with every member, and only groups whose bound reaches the
   threshold are opened and compared member by member, in one task for each
   group (a copy of the members for every ``QUERIES`` queries), with one link
   for each component that a query joins.
6. Links of both steps give the components.

Rows with a null or repeated doc_id stay rows of their own; a component is
named by the smallest doc_id among its rows (null if none has one).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binary_list, components, discard, gram_hashes, hash_words, lean, partitions, shield, store, text_key
from .sharedbits import count_bits, is_set

SHINGLE = 5
PERCENT = 80
GROUP = 256
#: Shingles that occur this often come last in the order.
OFTEN = 16


def shingle_set(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = hash_words(words)
    # short sequences: the seed keeps one of n words apart from k-grams
    grams = gram_hashes(h, k) if len(h) >= k else gram_hashes(np.r_[np.uint64(len(h)), h], len(h) + 1)
    return np.unique(grams)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Smallest overlap that a set of size n has with any set it links to."""
    return -(-n * percent // 100)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for text in binary_list(batch.column("text")):
            yield shingle_set(text)


_SETS = ("doc_id long, row_key long, n_shingles long, node binary, prefix array<bigint>, shingles binary")
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
                         ("prefix", pa.list_(pa.int64())), ("shingles", pa.binary())])


def shingle_sets(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: size, key of its set, and for documents that
    could link the prefix shingles that may be shared, and the whole set
    (once for each task and set)."""
    repeated, often = count_bits(docs.select("text"), _counted, (2, OFTEN))

    @lean
    def build(batches):
        seen: set[bytes] = set()
        bits = (repeated.value, often.value)
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist(), binary_list(batch.column("text"))):
                s = shingle_set(text)
                n = len(s)
                if not n:
                    rows.append((doc_id, key, 0, None, None, None))
                    continue
                node = xxhash.xxh3_128_digest(s.tobytes(), seed=n)
                prefix = whole = None
                if node not in seen:
                    rank = is_set(bits[0], s).astype(np.int8) + is_set(bits[1], s)
                    first = np.argsort(rank, kind="stable")[: n - least_overlap(n, percent) + 1]
                    may = s[first][rank[first] > 0]
                    if len(may):
                        prefix, whole = may.view(np.int64), s.tobytes()
                        if len(seen) > 200_000:
                            seen.clear()
                        seen.add(node)
                rows.append((doc_id, key, n, node, prefix, whole))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SETS_ARROW)], schema=_SETS_ARROW)

    return store(docs.select("doc_id", text_key(F.col("text")).alias("row_key"), "text").mapInArrow(build, _SETS), "join_sets")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _check_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Linked (a, b) among rows (a, b, sa, sb) of nodes with their sets."""

    @lean
    def check(batches):
        for batch in batches:
            sa, sb = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
            keep = [_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(sa, sb)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(check, "a binary, b binary")


def links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Stored (a, b): enough links between nodes to connect every component
    (each is a true link; pairs inside an already joined group are left out).

    Sets travel only for nodes that share a prefix shingle with another, and
    after the pivots only for those that ask or are asked.
    """
    full = sets.where("shingles is not null")
    light = full.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"))
    prefix = store(light.select("node", "n", F.explode("prefix").alias("token")), "join_prefix")
    shared = (prefix.groupBy("token").agg(F.count("*").alias("df"), F.min(F.struct("node", "n")).alias("low"),
                                          F.min(F.struct(F.xxhash64("node").alias("h"), "node", "n")).alias("hashed"))
              .where("df > 1").select("token", "low", F.struct("hashed.node", "hashed.n").alias("alt")))
    tokens = store(prefix.join(shared, "token"), "join_tokens")  # (token, node, n, low, alt)
    discard(prefix)
    wanted = tokens.groupBy("node").agg(F.first("n").alias("n"))
    body = store(full.select("node", "shingles").join(wanted, "node").groupBy("node")
                 .agg(F.first("n").alias("n"), F.first("shingles").alias("shingles")), "join_bodies")

    def best(pivot: str) -> DataFrame:
        votes = (tokens.where(F.col("node") != F.col(f"{pivot}.node")).groupBy("node", "n", F.col(pivot).alias("pivot"))
                 .agg(F.count("*").alias("votes")))
        return votes.groupBy("node", "n").agg(F.max(F.struct("votes", "pivot")).getField("pivot").alias("pivot"))

    def stars(pairs: DataFrame, name: str) -> DataFrame:
        """Links among (node, n, pivot) whose sizes allow one."""
        fit = pairs.where(F.least("n", "pivot.n") * 100 >= F.greatest("n", "pivot.n") * percent).select("node", F.col("pivot.node").alias("b"))
        left = body.select("node", F.col("shingles").alias("sa")).join(fit, "node").withColumnRenamed("node", "a")
        return store(_check_pairs(left.join(body.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"), percent), name)

    pivots = store(best("low"), "join_pivots")
    first = stars(pivots, "join_stars")
    rest = pivots.select("node").join(first.select(F.col("a").alias("node")), "node", "left_anti")
    second = stars(best("alt").join(rest, "node"), "join_stars")
    star = store(first.union(second), "join_star")
    discard(first, second)
    light_tokens = store(tokens.select("token", "node"), "join_tokens")
    discard(tokens)

    # nodes under one pivot are joined; so is what their pivot is joined to
    up = star.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
    over = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
    under = store(up.join(over, "up", "left").select("node", F.coalesce("top", "up").alias("comp")), "join_under")

    # groups: nodes of one component, or single nodes with one pivot, and of
    # one class of sizes; nodes that are some pivot themselves count as theirs
    cls = F.floor(F.log("n") / F.log(F.lit(100 / percent)))
    known = (body.select("node", cls.alias("cls")).join(under, "node", "left")
             .join(pivots.select("node", F.col("pivot.node").alias("pivot")), "node", "left")
             .select("node", "cls", F.coalesce("comp", "node").alias("comp"), F.coalesce("pivot", "node").alias("pivot")))
    known = store(known, "join_known")
    discard(under, pivots)
    sizes = store(known.groupBy("comp").agg(F.count("*").alias("size")), "join_sizes")
    sized = known.join(sizes, "comp").withColumn("single", F.col("size") == 1)
    sized = store(sized.select("node", "comp", "size", "single", "cls",
                               F.xxhash64("single", F.when(F.col("single"), F.col("pivot")).otherwise(F.col("comp")), "cls").alias("base")), "join_sized")
    many = store(sized.groupBy("base").agg(F.ceil(F.count("*") / F.lit(GROUP)).alias("parts")), "join_parts")
    member = store(sized.join(many, "base")
                   .select("node", "comp", "size", "single", "cls", F.xxhash64("base", F.pmod(F.xxhash64("node", F.lit(7)), "parts")).alias("grp")), "join_groups")
    discard(known, sizes, sized, many)

    # tokens that still stand between components
    tagged = store(light_tokens.join(member, "node"), "join_tagged")
    discard(light_tokens)
    open_tokens = store(tagged.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("token"), "join_open")
    between = store(tagged.join(open_tokens, "token"), "join_between")
    discard(tagged, open_tokens)
    matrix = store(between.select("token", "grp", F.col("cls").alias("g_cls"), F.col("single").alias("g_single"),
                                  F.when(~F.col("single"), F.col("comp")).alias("g_comp"), F.when(F.col("single"), F.lit(1)).otherwise(F.col("size")).alias("g_size"))
                   .distinct(), "join_matrix")
    asks = (between.select(F.col("token").alias("t"), "node", "cls", "comp", "size").join(matrix, F.expr(
        "t = token and abs(cls - g_cls) <= 1 and "
        "((g_single and size = 1) or (not g_single and (size < g_size or (size = g_size and comp < g_comp))))"))
            .select("node", "grp").distinct())
    asks = store(asks, "join_asks")
    discard(between, matrix)

    asked = store(member.join(asks.select("grp").distinct(), "grp"), "join_asked")
    needed = asked.select("node").union(asks.select("node")).distinct()
    few = store(body.select("node", "shingles").join(needed, "node"), "join_few")
    discard(body)
    unions = store(_unions(asked.select("grp", "node").join(few, "node")), "join_unions")
    opened = store(_bounded(asks.join(few, "node").join(unions, "grp"), percent), "join_opened")
    discard(asks, unions)
    found = _inside(opened, asked, member, few, percent)
    out = store(star.union(found), "join_links")
    discard(star, opened, asked, member, few)
    return out


#: Queries that meet a copy of a group's members.
QUERIES = 512


def _inside(opened: DataFrame, asked: DataFrame, member: DataFrame, few: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the queries (node, grp) into members of other
    components, one for each component that a query joins.

    A group's members and its queries meet in one task, which holds the
    members (about ``GROUP``) and streams the queries; a group with many
    queries is dealt out, a copy of its members for every ``QUERIES``.
    """
    spark = opened.sparkSession
    dealt = opened.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(QUERIES)).alias("copies"))
    salt = F.pmod(F.xxhash64("node"), F.col("copies"))
    rows = (asked.select("grp", "node", "comp").join(dealt, "grp")
            .select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("salt"), F.lit(0).alias("asks"), "node", "comp")
            .union(opened.join(dealt, "grp").join(member.select("node", "comp"), "node").select("grp", salt.alias("salt"), F.lit(1).alias("asks"), "node", "comp")))
    rows = rows.join(few, "node").repartition(partitions(spark), "grp", "salt").sortWithinPartitions("grp", "salt", "asks")

    @lean
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members = None, []
        for batch in batches:
            a, b = [], []
            for grp, salt, asks, node, comp, s in zip(*[batch.column(c).to_pylist() for c in ("grp", "salt", "asks", "node", "comp", "shingles")]):
                if (grp, salt) != now:
                    now, members = (grp, salt), []
                own = np.frombuffer(s, np.uint64)
                if not asks:
                    members.append((node, comp, own))
                    continue
                joined = {comp}
                for other, its, theirs in members:
                    if its not in joined and _linked(own, theirs, percent):
                        joined.add(its)
                        a.append(node)
                        b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return rows.select("grp", "salt", "asks", "node", "comp", "shingles").mapInArrow(check, "a binary, b binary")


def _unions(members: DataFrame) -> DataFrame:
    """(grp, shingles): a matrix row, the union of a group's sets. A group
    holds about ``GROUP`` nodes, so it fits one task."""

    def union(key, sets):
        parts = [np.frombuffer(x, np.uint64) for x in sets.column("shingles").to_pylist()]
        return pa.table({"grp": pa.array([key[0].as_py()], pa.int64()),
                         "union": pa.array([np.unique(np.concatenate(parts)).tobytes()], pa.binary())})

    return members.select("grp", "shingles").groupBy("grp").applyInArrow(union, "grp long, union binary")


def _bounded(asks: DataFrame, percent: int) -> DataFrame:
    """(node, grp) whose overlap with the group's union can reach a link."""

    @lean
    def bound(batches):
        for batch in batches:
            keep = []
            for s, u in zip(batch.column("shingles").to_pylist(), batch.column("union").to_pylist()):
                s, u = np.frombuffer(s, np.uint64), np.frombuffer(u, np.uint64)
                at = np.searchsorted(u, s)
                at[at == len(u)] = 0
                keep.append(bool(np.count_nonzero(u[at] == s) >= least_overlap(len(s), percent)))
            yield batch.select(["node", "grp"]).filter(pa.array(keep, pa.bool_()))

    return asks.select("node", "grp", "shingles", "union").mapInArrow(bound, "node binary, grp long")


def join_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, row_key, n_shingles, root, component_id) of every row.

    ``row_key`` is ``common.text_key`` of the text, ``root`` the key of the
    component (null for sets without shingles).
    """
    spark = docs.sparkSession
    sets = shingle_sets(docs, percent)
    edges = links(sets, percent)
    rows = store(sets.select("doc_id", "row_key", "n_shingles", "node"), "join_nodes")
    discard(sets)
    roots = components(spark, edges, "join_final")
    discard(edges)
    lows = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    named = store(lows.join(roots.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node")), "join_named")
    discard(roots)
    best = store(named.groupBy("root").agg(F.min("low").alias("component_id")), "join_best")
    of = store(named.join(best, "root").select("node", "root", "component_id"), "join_component")
    discard(named, best)
    return (rows.join(of, "node", "left")
            .select("doc_id", "row_key", "n_shingles", "root",
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component (the smallest doc_id, null
    last) and every row without shingles."""
    rows = store(join_components(docs, percent), "join_rows")
    least = (rows.where("root is not null").groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("k"))
             .select(F.col("k.doc_id").alias("k_id"), F.col("k.row_key").alias("k_key"), F.lit(True).alias("leads")))
    bare = rows.where("root is null").select(F.col("doc_id").alias("k_id"), F.col("row_key").alias("k_key"), F.lit(False).alias("leads")).distinct()
    keys = store(least.union(bare), "join_keep")
    discard(rows)
    own, name, restore = shield(docs)
    keyed = own.withColumn("row_key", text_key(F.col(name["text"])))
    joined = keyed.join(keys, F.col(name["doc_id"]).eqNullSafe(F.col("k_id")) & (F.col("row_key") == F.col("k_key")))
    # equal rows of a group share the key: one of them stays. The rank filter
    # alone lets each task drop its copies before the shuffle
    copies = Window.partitionBy("k_id", "k_key").orderBy("k_key")
    one = joined.where("leads").withColumn("copy", F.row_number().over(copies)).where("copy = 1").drop("copy")
    return restore(one.union(joined.where("not leads")))
