"""Substring deduplication by relative Lempel-Ziv parsing.

A word that is covered by a window of ``WINDOW`` consecutive words whose
sequence starts earlier (in a smaller doc_id, or earlier in the same
document) is removed. ``anchors`` routes the segments that may repeat to
index blocks. A block is the reference: its segments in order of document.
Each segment is parsed greedily against the reference before it: at a place
whose window is indexed, the longest common extension with the indexed place
is a factor, compared word by word. A factor of at least a window's length
is a duplicate span. Windows across a factor's end belong to no factor, so
the parse goes on at the first of them and looks each one up. A segment
meets every block that can hold a match, since equal windows share an
anchor; other blocks need not be parsed.

Words are compared by 64-bit hashes. Null texts have no words; rows without
a doc_id have no order and stay whole; rows that share a doc_id without
being equal do not remove each other's words, nor do equal rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .anchors import PrefixHash, Units, covered, repeated_spans, with_spans
from .common import binary_list, hash_words, mix

WINDOW = 20
GRAM = 8


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    words = [t.split() for t in texts]
    lens = np.fromiter(map(len, words), np.int64, len(words))
    codes = hash_words([w for ws in words for w in ws])
    return codes, lens, codes.tobytes()


def parse(window: int):
    """The resolver of an index block (see ``anchors.repeated_spans``)."""

    def resolve(doc, row, start, n, contents):
        ref = np.frombuffer(b"".join(contents), np.uint64)
        size = n + window - 1
        base = np.cumsum(size) - size
        hashes = PrefixHash(ref)
        grams = mix(hashes.all(window)).tolist()
        words = ref.tolist()
        docs, rows, base_l, n_l, size_l = doc.tolist(), row.tolist(), base.tolist(), n.tolist(), size.tolist()
        shift = (start - base).tolist()  # from a place in ref to the place in its row
        index: dict[int, tuple[int, int]] = {}  # window -> (segment, place) first seen
        by_row: dict[tuple[int, int], tuple[int, int]] = {}  # of later rows with one doc_id
        seg: list[int] = []
        off: list[int] = []
        for s in range(len(n_l)):
            b, last = base_l[s], base_l[s] + size_l[s]
            p = 0
            while p < n_l[s]:
                h = grams[b + p]
                at = index.get(h)
                if at is not None and docs[at[0]] == docs[s] and rows[at[0]] != rows[s]:
                    at = by_row.get((h, rows[s]))
                    if at is None:
                        by_row[h, rows[s]] = (s, b + p)
                        p += 1
                        continue
                if at is not None and docs[at[0]] == docs[s] and at[1] + shift[at[0]] == b + p + shift[s]:
                    p += 1  # the same place of an equal row
                    continue
                if at is None:
                    index[h] = (s, b + p)
                    p += 1
                    continue
                src, q = at[1], b + p
                src_end = base_l[at[0]] + size_l[at[0]]
                length = 0
                while q + length < last and src + length < src_end and words[q + length] == words[src + length]:
                    length += 1
                if length < window:  # the hashes met by chance
                    p += 1
                    continue
                for i in range(length - window + 1):
                    seg.append(s)
                    off.append(p + i)
                p += length - window + 1
        return np.array(seg, np.int64), np.array(off, np.int64)

    return resolve


def duplicate_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Every row of ``docs`` with doc_id, text, spans (word places)."""
    units = Units(word_codes, 8, gram, window, within=True)
    return with_spans(docs, repeated_spans(docs, units, parse(window)))


def removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, kept, n_words, n_removed, kept_sha256): the words that stay,
    joined by one space."""

    def cut(batches):
        for batch in batches:
            out = []
            for text, spans in zip(binary_list(batch.column("text")), batch.column("spans").to_pylist()):
                words = text.split()
                if spans:
                    gone = covered(len(words), spans, window)
                    kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                    out.append((kept, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
                else:
                    kept = b" ".join(words)
                    out.append((kept, len(words), 0, hashlib.sha256(kept).hexdigest()))
            kept, n, r, sha = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
                                              pa.array(r, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "kept", "n_words", "n_removed", "kept_sha256"])

    return duplicate_words(docs, window, gram).mapInArrow(cut, "doc_id long, kept string, n_words long, n_removed long, kept_sha256 string")
