"""Token ids in wavelet-matrix shards.

Documents are ordered by doc_id, encoded with a tokenizer of the
``tokenizers`` library and written as shards of about ``SHARD_TOKENS`` ids.
A shard is one row of a zstd-compressed Parquet file, so Spark's committer
covers lost executors and any shared store works:

======== =============== ==================================================
part,seq int             order of the shards (range partition, place in it)
n        long            ids in the shard
doc_id   array<long>     its documents, in order (null ids first)
ends     array<long>     ids of the shard up to and with each document
zeros    array<long>     zero bits of each plane
planes   array<binary>   bit planes, high bit first, packed, stably sorted
                         by the planes before (the wavelet matrix)
ranks    array<binary>   uint32 count of ones before every 512th bit
======== =============== ==================================================

``Shard`` gives ``access``, ``count`` (rank) and ``occurrences`` (select)
from the planes alone, without decoding the shard.

Null texts are empty and hold only the end id. Rows with equal doc_id stay
separate documents, ordered by their text's hash. Null doc_ids sort first.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import string
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

from .common import give_back, lean, partitions, text_blocks

SHARD_TOKENS = 1 << 18
STEP = 512
SHARD_SCHEMA = ("part int, seq int, n long, doc_id array<bigint>, ends array<bigint>, "
                "zeros array<bigint>, planes array<binary>, ranks array<binary>")
# Word pieces kept by a worker's cache before it starts anew, and text bytes
# encoded at once (memory bounds).
CACHE_PIECES = 250_000
BLOCK_BYTES = 3 << 19
# Punctuation that a pre-tokenizer of letters, digits and other marks always
# cuts from the letters before it. The apostrophe is not one: "'s" is a token.
_TAIL = "".join(c for c in string.punctuation if c != "'")
_MARKS = "(?P<m>[" + re.escape(_TAIL) + "]+)$"
# Letters below U+0250 without one whose lower case has two characters: texts
# of them are in normal form C.
_LETTERS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+$"
# The tokenizer file's settings (fixed values of its format) for which
# encoding word by word is proved to give the ids of the whole text.
_PROVED = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}


def _byte_chars() -> dict[int, str]:
    """Printable stand-ins of the bytes, as byte-level BPE files use them:
    printable bytes stand for themselves, the others for 256, 257, ..."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in keep)
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _strings(a: pa.Array) -> list[str]:
    """``a.to_pylist()``, several times as fast."""
    return a.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Encodes texts as the tokenizer encodes them whole.

    Where the file has the settings of ``_PROVED`` (white space is dropped,
    no token crosses it), texts are cut into words by Arrow, and only the
    distinct words of a block are looked at. A plain word, letters below
    U+0250 with punctuation behind them, is two pieces: the lower-cased
    letters go straight to the BPE model, the marks to the tokenizer; any
    other word is one piece for the whole tokenizer. A cache holds the ids of
    the pieces. For other files every text goes whole to the tokenizer.
    """

    def __init__(self, path: str):
        # one thread a task: others' memory would count against the executor
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = all(spec.get(k) == v for k, v in _PROVED.items())
        if self.by_word:
            from tokenizers import pre_tokenizers

            self.table = str.maketrans({chr(b): c for b, c in _byte_chars().items()})
            self.model = Tokenizer(self.tok.model)  # the same merges, for words that are ready
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            suffix, vocab = spec["model"]["end_of_word_suffix"], self.model.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {"": 0}  # piece -> its place; the empty piece has no ids
        self.used = 0  # ids in flat
        self.starts = np.zeros(1 << 16, np.int64)
        self.lens = np.zeros(1 << 16, np.int64)
        self.flat = np.empty(1 << 18, np.uint32)

    def _whole(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of words (behind a space) by the whole tokenizer."""
        got = [self.tok.encode(k[1:], add_special_tokens=False).ids for k in keys]
        n = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(n.sum())), n

    def _letters(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of lower-case words of letters by the BPE model,
        many words a call: a word ends where a token has the suffix."""
        ready = [k if k.isascii() else k.encode().decode("latin-1").translate(self.table) for k in keys]
        calls = [" ".join(ready[i : i + 1000]) for i in range(0, len(ready), 1000)]
        ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in self.model.encode_batch_fast(calls, add_special_tokens=False)), np.uint32)
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def _places(self, keys: list[str], encode) -> np.ndarray:
        """Places of pieces in the cache; ``encode`` gives new ones' ids."""
        index = self.index
        new = [k for k in keys if k not in index]
        if new:
            got, n = encode(new)
            assert len(n) == len(new)
            at, ids = len(index), len(got)
            while at + len(new) > len(self.lens):
                self.starts, self.lens = (np.concatenate([x, x]) for x in (self.starts, self.lens))
            while self.used + ids > len(self.flat):
                self.flat = np.concatenate([self.flat, self.flat])
            self.lens[at : at + len(new)] = n
            self.starts[at : at + len(new)] = self.used + np.cumsum(n) - n
            self.flat[self.used : self.used + ids] = got
            self.used += ids
            index.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(index.__getitem__, keys), np.int64, len(keys))

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of the two pieces of each word."""
        if len(self.index) >= CACHE_PIECES:
            self._clear()
        core = pc.ascii_rtrim(words, _TAIL)
        plain = pc.or_(pc.match_substring_regex(core, _LETTERS), pc.equal(words, ""))
        first, second = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        on = plain.to_numpy(zero_copy_only=False)
        # odd words are kept apart from letters by a leading space
        odd = _strings(words.filter(pc.invert(plain)))
        first[~on] = self._places([" " + w for w in odd], self._whole)
        some, core = words.filter(plain), core.filter(plain)
        letters = pc.utf8_lower(core).dictionary_encode()
        first[on] = self._places(_strings(letters.dictionary), self._letters)[letters.indices.to_numpy(zero_copy_only=False)] if len(some) else first[on]
        length = pc.binary_length(core).to_numpy(zero_copy_only=False)
        has = np.flatnonzero(pc.binary_length(some).to_numpy(zero_copy_only=False) > length)
        if len(has):
            marks = pc.extract_regex(some.take(pa.array(has)), _MARKS).field(0).dictionary_encode()
            tails = np.zeros(len(some), np.int64)
            tails[has] = self._places([" " + t for t in _strings(marks.dictionary)], self._whole)[marks.indices.to_numpy(zero_copy_only=False)]
            second[on] = tails
        return first, second

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, ``end`` after each, and each text's count."""
        if not self.by_word:
            got = [e.ids + [end] for e in self.tok.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
            n = np.fromiter(map(len, got), np.int64, len(got))
            return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(n.sum())), n
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.large_string()))
        n = np.diff(lists.offsets.to_numpy())
        words = lists.flatten().cast(pa.string()).dictionary_encode()
        which = words.indices.to_numpy(zero_copy_only=False)
        first, second = self._pieces(words.dictionary)
        at = np.empty(2 * len(which), np.int32)
        at[0::2], at[1::2] = first[which], second[which]
        at_n = self.lens[at]
        out_end = np.cumsum(at_n)
        total = int(out_end[-1]) if len(at_n) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.starts[at] - (out_end - at_n), at_n)] if total else np.empty(0, np.uint32)
        word_end = np.r_[0, out_end][2 * np.cumsum(n)]
        return np.insert(ids, word_end, end), np.diff(np.r_[0, word_end]) + 1


_ENCODERS: dict[str, WordEncoder] = {}


def build_planes(ids: np.ndarray) -> tuple[list[int], list[bytes], list[bytes]]:
    """(zeros, planes, ranks) of the wavelet matrix of ``ids``."""
    top = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    seq = ids.astype(np.uint16 if top <= 16 else np.uint32)
    zeros, planes, ranks = [], [], []
    for level in range(top - 1, -1, -1):
        bit = ((seq >> level) & 1).astype(bool)
        zeros.append(int(len(seq) - np.count_nonzero(bit)))
        packed = np.packbits(bit, bitorder="little")
        planes.append(packed.tobytes())
        blocks = np.add.reduceat(bit, np.arange(0, len(bit), STEP), dtype=np.uint32) if len(bit) else np.empty(0, np.uint32)
        ranks.append((np.cumsum(blocks, dtype=np.uint32) - blocks).astype(np.uint32).tobytes())
        seq = np.concatenate([seq[~bit], seq[bit]])
    return zeros, planes, ranks


class Shard:
    """Reads one stored shard."""

    def __init__(self, n: int, zeros, planes, ranks):
        self.n, self.zeros = int(n), [int(z) for z in zeros]
        self.planes = [np.frombuffer(bytes(p), np.uint8) for p in planes]
        self.ranks = [np.frombuffer(bytes(r), np.uint32) for r in ranks]

    def decode(self) -> np.ndarray:
        """All ids: the planes' stable sorts undone from the lowest bit up."""
        top = len(self.planes)
        seq = np.zeros(self.n, np.uint16 if top <= 16 else np.uint32)
        for level in range(top):
            bit = np.unpackbits(self.planes[top - 1 - level], count=self.n, bitorder="little").view(bool)
            z = self.zeros[top - 1 - level]
            up = np.empty_like(seq)
            up[~bit] = seq[:z]
            up[bit] = seq[z:] | seq.dtype.type(1 << level)
            seq = up
        return seq

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place."""
        at = np.asarray(at, np.int64)
        block = np.minimum(at // STEP, max(0, len(self.ranks[level]) - 1))
        out = self.ranks[level][block].astype(np.int64) if len(self.ranks[level]) else np.zeros_like(at)
        for i, (a, b) in enumerate(zip(at.tolist(), block.tolist())):
            lo = b * STEP // 8
            whole = self.planes[level][lo : a // 8]
            out[i] += int(np.bitwise_count(whole).sum())
            if a % 8:
                out[i] += int(self.planes[level][a // 8] & ((1 << a % 8) - 1)).bit_count()
        return out

    def access(self, places) -> np.ndarray:
        at = np.asarray(places, np.int64)
        out = np.zeros(len(at), np.int64)
        for level, z in enumerate(self.zeros):
            bit = (self.planes[level][at // 8] >> (at % 8).astype(np.uint8)) & 1
            ones = self._ones(level, at)
            out = out * 2 + bit
            at = np.where(bit == 1, z + ones, at - ones)
        return out

    def _range(self, token: int) -> tuple[int, int]:
        """Where the token's occurrences stand below the last plane."""
        lo, hi = 0, self.n
        if token < 0 or token >> len(self.planes):
            return 0, 0
        for level, z in enumerate(self.zeros):
            a, b = self._ones(level, np.array([lo, hi]))
            lo, hi = (z + a, z + b) if token >> (len(self.planes) - 1 - level) & 1 else (lo - a, hi - b)
        return int(lo), int(hi)

    def count(self, token: int) -> int:
        lo, hi = self._range(token)
        return hi - lo

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the plane's k-th (from 0) bit of this value."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * STEP - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.planes[level][block * STEP // 8 : (block + 1) * STEP // 8], bitorder="little")
        return block * STEP + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def occurrences(self, token: int) -> np.ndarray:
        """Places of the token, ascending."""
        lo, hi = self._range(token)
        out = []
        for at in range(lo, hi):
            for level in range(len(self.planes) - 1, -1, -1):
                bit = token >> (len(self.planes) - 1 - level) & 1
                at = self._select(level, bit, at - (self.zeros[level] if bit else 0))
            out.append(at)
        return np.array(out, np.int64)


def write_shards(docs: DataFrame, tokenizer: str | Callable[[], str], end_id: int, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> str:
    """Encode ``docs`` (doc_id, text) and write the shards; returns the path.

    One range shuffle by doc_id puts documents in order; the number of
    ranges is the session's shuffle partitions. Extra columns are ignored.
    ``tokenizer`` is the file's place, or a function that gives it on each
    worker.
    """
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "token_shards")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    rows = (rows.repartitionByRange(partitions(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
            .select("doc_id", "text"))

    @lean
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = tokenizer() if callable(tokenizer) else tokenizer
        enc = _ENCODERS.get(file)
        if enc is None:
            enc = _ENCODERS[file] = WordEncoder(file)
            give_back()  # what reading the file took
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, list]] = []
        size = 0

        def flush():
            ids = np.concatenate([x[0] for x in held])
            zeros, planes, ranks = build_planes(ids)
            row = {"part": part, "seq": seq, "n": len(ids), "doc_id": [d for x in held for d in x[2]],
                   "ends": np.cumsum(np.concatenate([x[1] for x in held])).tolist(), "zeros": zeros, "planes": planes, "ranks": ranks}
            return pa.RecordBatch.from_pylist([row], schema=_SHARD)

        for block, texts in text_blocks(batches, "text", BLOCK_BYTES):
            ids, lens = enc.encode(texts, end_id)
            doc_ids, ends = block.column("doc_id").to_pylist(), np.cumsum(lens)
            a = 0
            while a < len(lens):  # documents up to the one that fills the shard
                base = int(ends[a - 1]) if a else 0
                b = min(len(lens), int(np.searchsorted(ends, base + shard_tokens - size)) + 1)
                held.append((ids[base : ends[b - 1]], lens[a:b], doc_ids[a:b]))
                size += int(ends[b - 1]) - base
                a = b
                if size >= shard_tokens:
                    yield flush()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield flush()

    rows.mapInArrow(shards, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)
    return path


_SHARD = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int64()), ("doc_id", pa.list_(pa.int64())),
                    ("ends", pa.list_(pa.int64())), ("zeros", pa.list_(pa.int64())),
                    ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary()))])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``base``, the ids of all shards before each.

    Sums are taken by range partition first, so the only ordered pass over
    everything sees one row for each range partition.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = shards.select("part", "seq", "n")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (sizes.groupBy("part").agg(F.sum("n").alias("total"))
             .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_base")))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    base = (sizes.withColumn("in_part", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(parts, "part").select("part", "seq", (F.col("part_base") + F.col("in_part")).alias("base")))
    return shards.join(base, ["part", "seq"])


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    @lean
    def digest(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = Shard(r["n"], r["zeros"], r["planes"], r["ranks"]).decode().astype("<u4")
                ends = r["ends"]
                starts = [0, *ends[:-1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["part"]] * len(ends), pa.int32()), pa.array([r["seq"]] * len(ends), pa.int32()),
                    pa.array(r["doc_id"], pa.int64()), pa.array(starts, pa.int64()),
                    pa.array([e - s for s, e in zip(starts, ends)], pa.int64()),
                    pa.array([zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends)], pa.int64()),
                ], names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    base = read_shards(spark, path).select("part", "seq", "base")
    docs = (spark.read.schema(SHARD_SCHEMA).parquet(path).drop("ranks")
            .withColumn("ranks", F.array().cast("array<binary>"))
            .mapInArrow(digest, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"))
    return (docs.join(base, ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def token_counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): occurrences of each asked token over all shards, by rank."""

    def count(batches):
        for batch in batches:
            for r in batch.to_pylist():
                s = Shard(r["n"], r["zeros"], r["planes"], r["ranks"])
                yield pa.RecordBatch.from_pydict({"token": pa.array(tokens, pa.int64()), "n": pa.array([s.count(t) for t in tokens], pa.int64())})

    return spark.read.parquet(path).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def token_occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(place): every place of ``token`` in the whole id sequence, by select."""

    def find(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at = Shard(r["n"], r["zeros"], r["planes"], r["ranks"]).occurrences(token) + r["base"]
                yield pa.RecordBatch.from_pydict({"place": pa.array(at, pa.int64())})

    return read_shards(spark, path).mapInArrow(find, "place long")
