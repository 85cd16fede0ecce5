"""A bounded bitmap of the hashes that occur more than once in a corpus.

Most hashes (shingles, anchors) of a corpus occur once and can never make a
match. Tasks send the sorted, distinct 32-bit remainders of their hashes by
leading bits, one packed blob a chunk; each range of leading bits is then
counted on its own and gives a slice of a bitmap. The bitmap has a fixed
number of bits, so its size (2**bits / 8 bytes) does not grow with the
input. A clear bit proves that a hash occurs once; a set bit may be a false
alarm, so users of the bitmap only skip work by it and stay exact. On
corpora with far more repeated hashes than bits it skips less.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame

from .common import discard, lean, partitions, release, store

#: log2 of the bitmap's bits: 2**27 bits are 16 MiB in each Python worker.
BITS = 27
#: Hashes held by a task before it sends a chunk.
CHUNK = 1 << 21

_BLOBS = pa.schema([("lead", pa.int32()), ("once", pa.binary()), ("more", pa.binary()), ("counts", pa.binary())])


def _blobs(parts: list[np.ndarray], lead_bits: int) -> pa.RecordBatch:
    """Distinct hashes of a chunk, by leading bits: those that occur once
    there, and those that occur more often with their counts."""
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    lead = (values >> np.uint64(64 - lead_bits)).astype(np.int64)
    rest = (values >> np.uint64(32 - lead_bits)).astype(np.uint32)
    cuts = np.searchsorted(lead, np.arange((1 << lead_bits) + 1))
    rows = []
    for i in range(1 << lead_bits):
        r, c = rest[cuts[i] : cuts[i + 1]], counts[cuts[i] : cuts[i + 1]]
        if len(r):
            many = c > 1
            rows.append((i, r[~many].tobytes(), r[many].tobytes(), np.minimum(c[many], 2**32 - 1).astype(np.uint32).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _BLOBS.types)], schema=_BLOBS)


def count_bits(
    docs: DataFrame,
    hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]],
    thresholds: tuple[int, ...] = (2,),
    bits: int = BITS,
) -> list[Broadcast]:
    """One broadcast bitmap for each threshold t: set where a hash occurs
    at least t times in ``docs``.

    ``hashes`` turns a task's batches into arrays of uint64 hashes. Empty
    input gives clear bitmaps.
    """
    spark = docs.sparkSession
    lead_bits = min(16, max(6, (partitions(spark) - 1).bit_length()))
    width = bits - lead_bits

    @lean
    def emit(batches):
        held, size = [], 0
        for h in hashes(batches):
            held.append(h)
            size += len(h)
            if size >= CHUNK:
                yield _blobs(held, lead_bits)
                held, size = [], 0
        if size:
            yield _blobs(held, lead_bits)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        once = [np.frombuffer(x, np.uint32) for x in pdf["once"]]
        more = [np.frombuffer(x, np.uint32) for x in pdf["more"]]
        extra = [np.frombuffer(x, np.uint32) for x in pdf["counts"]]
        values = np.concatenate(once + more)
        weight = np.concatenate([np.ones(sum(map(len, once)), np.int64), *extra]).astype(np.int64)
        order = np.argsort(values, kind="stable")
        values, weight = values[order], weight[order]
        first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        totals = np.add.reduceat(weight, first)
        values = values[first]
        out = []
        for t in thresholds:
            flags = np.zeros(1 << width, bool)
            flags[values[totals >= t] >> np.uint32(32 - width)] = True
            out.append(np.packbits(flags).tobytes())
        return pd.DataFrame({"lead": [int(pdf["lead"].iloc[0])], "maps": [out]})

    blobs = docs.mapInArrow(emit, "lead int, once binary, more binary, counts binary")
    slices = blobs.groupBy("lead").applyInPandas(count, "lead int, maps array<binary>")
    size = (1 << width) // 8
    maps = [np.zeros((1 << bits) // 8, np.uint8) for _ in thresholds]
    # written first, so that the counting tasks run side by side
    counted = store(slices, "count_bits")
    for row in counted.toLocalIterator():
        for m, part in zip(maps, row["maps"]):
            m[row["lead"] * size : (row["lead"] + 1) * size] = np.frombuffer(bytes(part), np.uint8)
    discard(counted)
    del blobs, slices
    release(spark)
    return [spark.sparkContext.broadcast(m) for m in maps]


_PAIRS = pa.schema([("lead", pa.int32()), ("keys", pa.binary()), ("tags", pa.binary())])


def varied_bits(
    docs: DataFrame,
    pairs: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]],
    bits: int = BITS,
) -> Broadcast:
    """A broadcast bitmap, set where a hash comes with two or more different
    tags. ``pairs`` turns a task's batches into (hashes, tags), both uint64.
    """
    spark = docs.sparkSession
    lead_bits = min(16, max(6, (partitions(spark) - 1).bit_length()))
    width = bits - lead_bits

    def distinct(h: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((tag, h))
        h, tag = h[order], tag[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (tag[1:] != tag[:-1])] if len(h) else np.empty(0, bool)
        return h[new], tag[new]

    def blobs(held) -> pa.RecordBatch:
        h, tag = distinct(*(np.concatenate(x) for x in zip(*held)))
        lead = (h >> np.uint64(64 - lead_bits)).astype(np.int64)
        rest = (h >> np.uint64(32 - lead_bits)).astype(np.uint32)
        cuts = np.searchsorted(lead, np.arange((1 << lead_bits) + 1))
        rows = [(i, rest[a:b].tobytes(), tag[a:b].tobytes()) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _PAIRS.types)], schema=_PAIRS)

    @lean
    def emit(batches):
        held, size = [], 0
        for h, tag in pairs(batches):
            if len(h):
                held.append((h, tag))
                size += len(h)
            if size >= CHUNK:
                yield blobs(held)
                held, size = [], 0
        if size:
            yield blobs(held)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        key = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["keys"]])
        key, _ = distinct(key, np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["tags"]]))
        flags = np.zeros(1 << width, bool)
        flags[key[1:][key[1:] == key[:-1]] >> np.uint32(32 - width)] = True
        return pd.DataFrame({"lead": [int(pdf["lead"].iloc[0])], "map": [np.packbits(flags).tobytes()]})

    slices = docs.mapInArrow(emit, "lead int, keys binary, tags binary").groupBy("lead").applyInPandas(count, "lead int, map binary")
    size = (1 << width) // 8
    whole = np.zeros((1 << bits) // 8, np.uint8)
    counted = store(slices, "varied_bits")
    for row in counted.toLocalIterator():
        whole[row["lead"] * size : (row["lead"] + 1) * size] = np.frombuffer(bytes(row["map"]), np.uint8)
    discard(counted)
    del slices
    release(spark)
    return spark.sparkContext.broadcast(whole)


def is_set(bitmap: np.ndarray, h: np.ndarray, bits: int = BITS) -> np.ndarray:
    i = (h >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[i >> 3] >> (7 - (i & 7)).astype(np.uint8)) & 1 == 1
