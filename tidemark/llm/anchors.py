"""Windows of a corpus that may repeat, routed to index blocks by anchors.

Both substring operators ask, for every window of ``window`` consecutive
units (bytes or words) of a document, whether the same window occurs
earlier. The anchor of a window is the smallest hash of its ``k``-unit
grams; equal windows have equal anchors, and neighbouring windows mostly
share one, so a document falls into segments of windows with one anchor.

1. Anchors are counted into two bounded bitmaps (``sharedbits``): repeated,
   and hot (over ``HOT`` segments). A window whose anchor occurs once cannot
   repeat and is finished. A third bitmap marks the repeated anchors whose
   segments differ.
2. A task resolves equal segments of one block of text at once: only the
   first is sent on. So a passage in a third of all documents is sent once
   a block of text, not once a document.
3. Segments meet by anchor. Where all of an anchor's segments are equal only
   their hash is sent; where they differ, their content. Differing segments
   of a hot anchor (a passage's edges differ in every document) are cut into
   single windows that meet by window hash instead; so no key gathers more
   than about ``HOT`` segments, or one segment or window a block of text.
4. An index block (some MB of complete keys) is resolved by the operator.

All this is one shuffle. Results are spans of window starts that are not
first occurrences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import binary_list, mix, partitions, store, text_blocks
from .sharedbits import count_bits, is_set, varied_bits

HOT = 1000
#: Bytes of text that a task resolves at once, and that it only counts.
BLOCK_BYTES = 1 << 21
COUNT_BYTES = 1 << 18
#: Bytes of segments in an index block, about.
INDEX_BYTES = 1 << 21

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            one = np.ones(1, np.uint64)
            cls.up = np.cumprod(np.r_[one, np.full(size - 1, _BASE, np.uint64)], dtype=np.uint64)
            cls.down = np.cumprod(np.r_[one, np.full(size - 1, _INVERSE, np.uint64)], dtype=np.uint64)
        return cls.up[:n], cls.down[:n]


class PrefixHash:
    """Polynomial prefix hashes of a sequence of unit codes, mod 2**64:
    the hash of any run is one difference and one product."""

    def __init__(self, codes: np.ndarray):
        up, down = Powers.get(len(codes) + 1)
        self.up = up
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * down[:-1], out=self.sums[1:])

    def runs(self, starts: np.ndarray, lengths) -> np.ndarray:
        return (self.sums[starts + lengths] - self.sums[starts]) * self.up[starts]

    def all(self, k: int) -> np.ndarray:
        n = max(0, len(self.sums) - k)
        return (self.sums[k:] - self.sums[:n]) * self.up[:n]


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return np.minimum(a[: len(a) - (w - size)], a[w - size :]) if w > size else a


def segments(hashes: PrefixHash, lens: np.ndarray, k: int, window: int, by_place: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, counts, anchors): runs of window starts with one anchor, in
    a concatenation of documents of ``lens`` units; no window crosses two.

    With ``by_place`` a run ends where the smallest gram stands elsewhere
    (the leftmost of equals), so equal windows of one document are always
    in different runs; else it ends where the smallest hash changes."""
    total = int(lens.sum())
    n = total - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = hashes.all(k)
    if by_place:
        low = np.uint64(max(22, len(grams).bit_length()))
        least = sliding_min((grams >> low << low) | np.arange(len(grams), dtype=np.uint64), window - k + 1)[:n]
    else:
        least = sliding_min(grams, window - k + 1)[:n]
    ends = np.cumsum(lens)
    flips = np.zeros(total + 1, np.int32)
    whole = lens >= window
    np.add.at(flips, (ends - lens)[whole], 1)
    np.add.at(flips, (ends - window + 1)[whole], -1)
    inside = np.cumsum(flips[:n]) > 0
    new = np.r_[True, (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])]
    # two documents can touch only if a window fits exactly; cut there too
    first = (ends - lens)[whole]
    new[first] = True
    starts = np.flatnonzero(new)
    counts = np.diff(np.r_[starts, n])
    keep = inside[starts]
    starts, counts = starts[keep], counts[keep]
    least = least[starts]
    if by_place:
        least = grams[(least & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)]
    return starts, counts, mix(least)


class Units:
    """How an operator cuts texts: ``codes(texts)`` gives unit codes of the
    concatenation and each text's number of units; ``pack(texts)`` gives what
    a segment's content is sliced from, ``width`` bytes a unit."""

    def __init__(self, codes: Callable, width: int, k: int, window: int, within: bool):
        self.codes, self.width, self.k, self.window, self.within = codes, width, k, window, within


SPANS = "doc_id long, row_key long, start int, windows int"
_PENDING = "blk long, doc_id long, row_key long, start int, windows int, late boolean, content binary"
_PENDING_ARROW = pa.schema([("blk", pa.int64()), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("start", pa.int32()),
                            ("windows", pa.int32()), ("late", pa.bool_()), ("content", pa.binary())])
_SPANS_ARROW = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32())])


def _row_key() -> Column:
    """Tells rows of one doc_id apart; equal rows share the key and the spans."""
    return F.xxhash64("text")


def later(keys: np.ndarray, doc: np.ndarray, row: np.ndarray, start: np.ndarray, within: bool) -> np.ndarray:
    """True where an equal key stands earlier: in a smaller doc_id, or (with
    ``within``) earlier in the same row; ``start`` is the place in the row.
    Rows that share a doc_id without being the same are not ordered, and the
    same place of an equal row is not an earlier one."""
    order = np.lexsort((start, row, doc, keys))
    k, d, r, place = keys[order], doc[order], row[order], start[order]
    head = np.r_[True, k[1:] != k[:-1]]
    first = np.maximum.accumulate(np.where(head, np.arange(len(k)), 0))
    late = d > d[first]
    if within:
        own = head | np.r_[True, (d[1:] != d[:-1]) | (r[1:] != r[:-1])]
        late |= place > place[np.maximum.accumulate(np.where(own, np.arange(len(k)), 0))]
    out = np.empty(len(k), bool)
    out[order] = late
    return out


def merged(at: np.ndarray, n: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of window starts (at, n) joined where one follows another in
    the same document."""
    order = np.argsort(at, kind="stable")
    at, n = at[order], n[order]
    if not len(at):
        return at, n
    doc = np.searchsorted(ends, at, "right")
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + n[:-1]) | (doc[1:] != doc[:-1])])
    return at[first], np.add.reduceat(n, first)


def repeated_spans(docs: DataFrame, units: Units, resolve: Callable) -> DataFrame:
    """Stored spans (doc_id, row_key, start, windows) of window starts that
    are not first occurrences. ``resolve(docs, rows, starts, counts,
    contents)`` gets an index block in the order of (doc_id, row_key, start)
    and returns the windows that are not first as (segment, offset) arrays.
    Rows without a doc_id have no order and take no part.
    """
    spark = docs.sparkSession
    rows = docs.where("doc_id is not null").select("doc_id", _row_key().alias("row_key"), "text")
    k, window, width = units.k, units.window, units.width

    def anchors(batches):
        for _, texts in text_blocks(batches, "text", COUNT_BYTES):
            codes, lens, _ = units.codes(texts)
            yield segments(PrefixHash(codes), lens, k, window, units.within)[2]

    repeated, hot = count_bits(rows.select("text"), anchors, (2, HOT))

    def content_hash(hashes, starts, counts):
        return mix(hashes.runs(starts, counts + window - 1) + counts.astype(np.uint64))

    def variants(batches):
        for _, texts in text_blocks(batches, "text", COUNT_BYTES):
            codes, lens, _ = units.codes(texts)
            hashes = PrefixHash(codes)
            starts, counts, anchor = segments(hashes, lens, k, window, units.within)
            on = is_set(repeated.value, anchor)
            yield anchor[on], content_hash(hashes, starts[on], counts[on])

    varied = varied_bits(rows.select("text"), variants)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in text_blocks(batches, "text", BLOCK_BYTES):
            codes, lens, packed = units.codes(texts)
            hashes = PrefixHash(codes)
            starts, counts, anchor = segments(hashes, lens, k, window, units.within)
            on = is_set(repeated.value, anchor)
            starts, counts, anchor = starts[on], counts[on], anchor[on]
            if not len(starts):
                continue
            ends = np.cumsum(lens)
            doc_ids, row_keys = block.column("doc_id").to_numpy(), block.column("row_key").to_numpy()

            def batch(at, n, key, late, with_content):
                which = np.searchsorted(ends, at, "right")
                body = ([packed[a * width : (a + m + window - 1) * width] for a, m in zip(at.tolist(), n.tolist())]
                        if with_content else pa.nulls(len(at), pa.binary()))
                return pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(doc_ids[which]), pa.array(row_keys[which]),
                    pa.array((at - (ends - lens)[which]).astype(np.int32)), pa.array(n.astype(np.int32)),
                    pa.array(np.full(len(at), late)), pa.array(body, pa.binary())], schema=_PENDING_ARROW)

            def is_late(at, key):
                which = np.searchsorted(ends, at, "right")
                return later(key, doc_ids[which], row_keys[which], at - (ends - lens)[which], units.within)

            tag = content_hash(hashes, starts, counts)
            late = is_late(starts, mix(anchor) ^ tag)
            done_at, done_n = [starts[late]], [counts[late]]
            starts, counts, anchor = starts[~late], counts[~late], anchor[~late]
            differ = is_set(varied.value, anchor)
            by_window = differ & is_set(hot.value, anchor)
            if by_window.any():
                n = counts[by_window]
                each = np.repeat(starts[by_window] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                one = mix(hashes.runs(each, window))
                late = is_late(each, one)
                done_at.append(each[late])
                done_n.append(np.ones(int(late.sum()), np.int64))
                yield batch(each[~late], np.ones(int((~late).sum()), np.int64), one[~late], False, True)
            for which, with_content in ((~differ, False), (differ & ~by_window, True)):
                if which.any():
                    yield batch(starts[which], counts[which], anchor[which], False, with_content)
            at, n = merged(np.concatenate(done_at), np.concatenate(done_n), ends)
            if len(at):
                yield batch(at, n, mix(at.astype(np.uint64)), True, False)  # spread, and passed through

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush():
            t = pa.Table.from_batches(held)
            doc, row, start, n, blk = (t.column(c).to_numpy() for c in ("doc_id", "row_key", "start", "windows", "blk"))
            start, n = start.astype(np.int64), n.astype(np.int64)
            done, differ = t.column("late").to_numpy(), t.column("content").is_valid().to_numpy()
            yield doc[done], row[done], start[done], n[done]
            same = np.flatnonzero(~differ & ~done)  # an anchor's segments are all equal here
            late = same[later(blk[same], doc[same], row[same], start[same], units.within)]
            yield doc[late], row[late], start[late], n[late]
            order = np.flatnonzero(differ)
            if len(order):
                order = order[np.lexsort((start[order], row[order], doc[order]))]
                contents = binary_list(t.column("content").combine_chunks())
                seg, off = resolve(doc[order], row[order], start[order], n[order], [contents[i] for i in order])
                if len(seg):
                    first = np.flatnonzero(np.r_[True, (seg[1:] != seg[:-1]) | (off[1:] != off[:-1] + 1)])
                    of = order[seg[first]]
                    yield doc[of], row[of], start[of] + off[first], np.diff(np.r_[first, len(seg)])

        def spans():
            for doc, row, start, n in flush():
                if len(doc):
                    yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(row), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                                                     schema=_SPANS_ARROW)

        for batch in batches:
            blk = batch.column("blk").to_numpy()
            if held and size >= INDEX_BYTES:
                # take the rest of the last key, then flush
                rest = int(np.searchsorted(blk != held[-1].column("blk")[len(held[-1]) - 1].as_py(), True))
                held.append(batch.slice(0, rest))
                if rest == len(blk):
                    continue
                yield from spans()
                held, size = [], 0
                batch = batch.slice(rest)
            held.append(batch)
            size += batch.nbytes
        if held:
            yield from spans()

    blocks = rows.mapInArrow(cut, _PENDING).repartition(partitions(spark), "blk").sortWithinPartitions("blk")
    return store(blocks.mapInArrow(decide, SPANS), "substring_spans")


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, text, spans) for every row of ``docs``; spans are (start,
    windows), null if there is none."""
    per = (spans.groupBy(F.col("doc_id").alias("s_id"), F.col("row_key").alias("s_key"))
           .agg(F.collect_list(F.struct("start", "windows")).alias("spans")))
    keyed = docs.select("doc_id", "text", _row_key().alias("row_key"))
    return keyed.join(per, (F.col("doc_id") == F.col("s_id")) & (F.col("row_key") == F.col("s_key")), "left").select("doc_id", "text", "spans")


def covered(n: int, spans, window: int) -> np.ndarray:
    """Mask of the units covered by the spans' windows."""
    if not spans:
        return np.zeros(n, bool)
    start = np.array([s["start"] for s in spans], np.int64)
    size = np.array([s["windows"] for s in spans], np.int64)
    flips = np.zeros(n + 1, np.int64)
    np.add.at(flips, start, 1)
    np.add.at(flips, start + size + window - 1, -1)
    return np.cumsum(flips[:n]) > 0
