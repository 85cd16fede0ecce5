"""Benchmark decontamination by spaced seeds.

Texts are lower-cased and cut into runs of letters and digits. A seed is a
hash of the tokens at the 1s of a fixed mask laid at some place; the 0s
ignore their tokens, so a substituted word there does not hide the overlap.
Seeds of the benchmark and of the documents are joined on the hash; each
joined pair names an alignment (document place minus item place); the
alignments of a document and an item are verified together on the tokens:
the alignment's longest stretch from an equal token to an equal token of which
``MIN_EQUAL`` are equal must have ``MIN_TOKENS`` tokens (or all of a shorter
item), or ``MIN_EQUAL`` of the whole item be equal, its edges included.

Items of up to ``SHORT_ITEM`` tokens also have the seeds of ``SHORT_MASKS``.
With them, such an item is met wherever a fifth of its tokens is substituted
(every placing of the substitutions on 8 to 20 tokens was tried).

The benchmark's seeds are put in two bounded bitmaps (``sharedbits``) that
drop nearly all document seeds before the join; the join itself is an
ordinary Spark join, so a benchmark of any size works.

Items of fewer than ``EXACT_BELOW`` tokens are met whole and word for word,
by one seed of their length. Items of fewer than ``MIN_ITEM`` (a parameter)
take no part, since one or two words occur in clean documents by chance;
``left_out`` counts them.

Consecutive places with one seed (repeated words) travel as one run; two
runs meet in an interval of alignments, so a text of one word repeated n
times and an item of m give n + m alignments, not n times m.

Null texts are empty. Repeated items or documents are matched row by row;
equal rows give one result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_list, hash_words, lean, mix, shield, store, text_key
from .sharedbits import count_bits, is_set

#: 1: token counts, 0: token is ignored.
MASKS = ("1111111", "111010010111", "1100110101011", "10110011011")
SHORT_MASKS = ("110111", "11100011", "1011011")
SHORT_ITEM = 20
MIN_TOKENS = 13
MIN_EQUAL = 0.8
EXACT_BELOW = 8
MIN_ITEM = 4

_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> np.ndarray:
    """Token hashes of one text."""
    return hash_words(_TOKEN.findall(text.decode().lower().encode()))


def seeds(t: np.ndarray, masks=MASKS + SHORT_MASKS, exact=()) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of every mask at every place it fits, then of every
    run of ``exact`` lengths."""
    places, out = [], []
    for number, mask in [*enumerate(masks), *((1000 + n, "1" * n) for n in exact)]:
        n = len(t) - len(mask) + 1
        if n > 0:
            h = np.full(n, number + 1, np.uint64)
            for i, bit in enumerate(mask):
                if bit == "1":
                    h = h * _MULTIPLIER + t[i : n + i]
            places.append(np.arange(n))
            out.append(mix(h))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(places), np.concatenate(out)


def runs(places: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first places, lengths, hashes) of runs of one seed at consecutive places."""
    if not len(h):
        return places, places, h
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (places[1:] != places[:-1] + 1)])
    return places[first], np.diff(np.r_[first, len(h)]), h[first]


def left_out(benchmark: DataFrame, min_item: int = MIN_ITEM) -> int:
    """Items, not empty, that are too short to take part."""

    def short(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([0 < len(tokens(x)) < min_item for x in binary_list(batch.column("text"))], pa.bool_()).cast(pa.int64())})

    return benchmark.select("text").mapInArrow(short, "n long").agg(F.sum("n")).first()[0] or 0


def _second(h: np.ndarray) -> np.ndarray:
    return mix(h ^ np.uint64(0xD6E8FEB86659FD93))


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, min_equal: float = MIN_EQUAL) -> tuple[int, int, int]:
    """(first document place, tokens, equal tokens) of the longest stretch,
    from an equal token to an equal token, with ``min_equal`` of its tokens
    equal in the item laid at document place ``shift``; the whole item if
    that holds for it."""
    lo, hi = max(0, shift), min(len(doc), shift + len(item))
    if hi <= lo:
        return 0, 0, 0
    equal = doc[lo:hi] == item[lo - shift : hi - shift]
    total = int(equal.sum())
    if hi - lo == len(item) and total >= min_equal * len(item):
        return lo, len(item), total
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0, 0
    # equal - min_equal * tokens of a stretch is a difference of these sums
    sums = np.r_[0, np.cumsum(equal - min_equal)]
    low = np.minimum.accumulate(sums[at])
    # the earliest start whose sum does not exceed that of the end
    first = np.searchsorted(-low, -(sums[at + 1] + 1e-9), "left")
    size = at + 1 - at[np.minimum(first, len(at) - 1)]
    best = int(np.argmax(size))
    start, end = int(at[first[best]]), int(at[best]) + 1
    return lo + start, end - start, int(equal[start:end].sum())


def _item_seeds(min_item: int):
    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for key, item_id, text in zip(batch.column("item").to_pylist(), batch.column("item_id").to_pylist(), binary_list(batch.column("text"))):
                t = tokens(text)
                if len(t) < min_item:
                    continue
                if len(t) < EXACT_BELOW:
                    places, n, h = runs(*seeds(t, (), (len(t),)))
                else:
                    places, n, h = runs(*seeds(t, MASKS + SHORT_MASKS if len(t) <= SHORT_ITEM else MASKS))
                out[0].extend([key] * len(h))
                out[1].extend([item_id] * len(h))
                out[2].extend(places.tolist())
                out[3].extend(n.tolist())
                out[4].extend(h.view(np.int64).tolist())
            yield pa.RecordBatch.from_pydict({"item": pa.array(out[0], pa.int64()), "item_id": pa.array(out[1], pa.int64()), "item_place": pa.array(out[2], pa.int32()),
                                              "item_n": pa.array(out[3], pa.int32()), "h": pa.array(out[4], pa.int64())})

    return run


def _token_counts(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(tokens(x)) for x in binary_list(batch.column("text"))], pa.int32())})


def _token_rows(batches):
    for batch in batches:
        t = [tokens(x).tobytes() for x in binary_list(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(t, pa.binary())], names=["item", "item_tokens"])


def _column_hashes(f):
    def read(batches):
        for batch in batches:
            yield f(batch.column("h").to_numpy().view(np.uint64))

    return read


_HITS = "doc_id long, row_key long, tokens binary, hits array<struct<h:bigint,place:int,n:int>>"
_HITS_ARROW = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("tokens", pa.binary()),
                         ("hits", pa.list_(pa.struct([("h", pa.int64()), ("place", pa.int32()), ("n", pa.int32())])))])


def contaminated(docs: DataFrame, benchmark: DataFrame, min_tokens: int = MIN_TOKENS, min_equal: float = MIN_EQUAL,
                 min_item: int = MIN_ITEM) -> DataFrame:
    """Verified overlaps, one row per document row and benchmark item:
    doc_id, row_key (``common.text_key`` of the text), item_id, first_token,
    overlap_tokens, equal_tokens (of the longest overlap)."""
    items = store(benchmark.select("item_id", "text", F.xxhash64("item_id", "text").alias("item")).distinct(), "bench_items")
    bench = store(items.select("item", "item_id", "text").mapInArrow(_item_seeds(min_item), "item long, item_id long, item_place int, item_n int, h long"), "bench_seeds")
    # lengths of the items that are met whole, a few numbers
    short = items.select("text").mapInArrow(_token_counts, "n int").where((F.col("n") >= min_item) & (F.col("n") < EXACT_BELOW)).distinct()
    exact = sorted(r["n"] for r in short.collect())
    hashes = bench.select("h")
    one = count_bits(hashes, _column_hashes(lambda h: h), (1,))[0]
    two = count_bits(hashes, _column_hashes(_second), (1,))[0]

    @lean
    def find(batches):
        first, second = one.value, two.value
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist(), binary_list(batch.column("text"))):
                t = tokens(text)
                places, h = seeds(t, exact=exact)
                on = is_set(first, h)
                places, h = places[on], h[on]
                if len(h):
                    on = is_set(second, _second(h))
                    places, h = places[on], h[on]
                if len(h):
                    places, n, h = runs(places, h)
                    hits = [{"h": a, "place": b, "n": c} for a, b, c in zip(h.view(np.int64).tolist(), places.tolist(), n.tolist())]
                    rows.append({"doc_id": doc_id, "row_key": key, "tokens": t.tobytes(), "hits": hits})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_HITS_ARROW)

    hit = store(docs.select("doc_id", text_key(F.col("text")).alias("row_key"), "text").mapInArrow(find, _HITS), "bench_hits")
    pairs = (hit.select("doc_id", "row_key", F.explode("hits").alias("hit"))
             .join(bench, F.col("hit.h") == F.col("h"))
             .select("doc_id", "row_key", "item", "item_id",
                     F.explode(F.sequence(F.col("hit.place") - F.col("item_place") - F.col("item_n") + 1,
                                          F.col("hit.place") + F.col("hit.n") - 1 - F.col("item_place"))).alias("shift"))
             .groupBy("doc_id", "row_key", "item", "item_id").agg(F.collect_set("shift").alias("shifts")))
    item_tokens = store(items.select("item", "text").mapInArrow(_token_rows, "item long, item_tokens binary"), "bench_tokens")
    # equal rows share doc_id and key: one of them stands for all
    bodies = hit.select(F.col("doc_id").alias("d"), F.col("row_key").alias("k"), "tokens").dropDuplicates(["d", "k"])
    full = (store(pairs, "bench_pairs").join(bodies, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_key") == F.col("k")))
            .join(item_tokens, "item").select("doc_id", "row_key", "item_id", "shifts", "tokens", "item_tokens"))

    @lean
    def verify(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                item = np.frombuffer(r["item_tokens"], np.uint64)
                doc = np.frombuffer(r["tokens"], np.uint64)
                good = [(n, equal, -first) for first, n, equal in (overlap(doc, item, shift, min_equal) for shift in r["shifts"])
                        if n >= min(min_tokens, len(item)) and equal >= min_equal * n]
                if good:
                    n, equal, first = max(good)
                    rows.append((r["doc_id"], r["row_key"], r["item_id"], -first, n, equal))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()])],
                                                 names=["doc_id", "row_key", "item_id", "first_token", "overlap_tokens", "equal_tokens"])

    checked = full.mapInArrow(verify, "doc_id long, row_key long, item_id long, first_token int, overlap_tokens int, equal_tokens int")
    best = F.max(F.struct("overlap_tokens", "equal_tokens", (-F.col("first_token")).alias("early"))).alias("best")
    return (checked.groupBy("doc_id", "row_key", "item_id").agg(best)
            .select("doc_id", "row_key", "item_id", (-F.col("best.early")).alias("first_token"), "best.overlap_tokens", "best.equal_tokens"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage."""
    bad = store(contaminated(docs, benchmark).select("doc_id", "row_key").distinct(), "bench_bad")
    own, name, restore = shield(docs)
    doc_id, text = F.col(name["doc_id"]), F.col(name["text"])
    return restore(own.join(bad, doc_id.eqNullSafe(F.col("doc_id")) & (text_key(text) == F.col("row_key")), "left_anti"))
