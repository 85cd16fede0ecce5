"""Language-model scoring with a log-bilinear neural model.

Tokens are the words of a text, A-Z lower-cased, and one end. The model has
a row for each of the ``WORDS`` most frequent training words, for the end,
and for ``CLASSES`` classes of all other words, told by a hash of a word's
last ``SUFFIX`` bytes. So every word, however rare, is a context and a
target of the neural model; what grows with the corpus are the counts that
divide a class among its words. The two tokens before give a context vector
(each position has its own weights over the row embeddings), and a token's
energy is its product with its row's output vector plus a bias. Training is
noise-contrastive estimation in numpy: every block of the corpus trains from
the same start, the blocks' parameters are averaged by tokens in Spark, and
a second round goes on from the average over the other half of the blocks;
so all training text is used and nothing but model-sized sums reaches the
driver.

The energy splits into one term for each context position, so the
normaliser of every pair of context tokens is one entry of a matrix product
of the exponentiated terms. Scores are therefore normalised exactly. A word
of a class has the probability of the class times (c + 1) / (N' + V' + 1)
with c its training count, N' and V' tokens and distinct words of the class
in all training texts: a smoothed unigram, like the base score over all
tokens.

The corpus is encoded once in blocks: local ids and the hashes of the block's
words (64 bits; words are told apart by them). The words' training counts
are a Spark aggregation joined back to the blocks; a group of that join is
one word's blocks or one block's words.

Null texts are empty and hold only the end. Rows whose id has no crc32 (null
doc_id) train. Repeated rows are scored each. Without training text counts
are 0 and the model uniform.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_words, store, text_blocks

WORDS = 1022
CLASSES = 512
SUFFIX = 3
DIM = 24
NOISE = 64
BATCH = 2048
BLOCK_BYTES = 1 << 24
_LOG10 = float(np.log10(np.e))

_BLOCK = ("block long, doc_id array<bigint>, held_out array<boolean>, lens array<int>, ids binary, "
          "words array<bigint>, counts array<int>, subs array<int>")


def encode(docs: DataFrame) -> DataFrame:
    """Stored blocks of ``docs`` (doc_id, held_out, text): each document as
    local word ids (without its end), the words, their training counts."""

    def blocks(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for table, texts in text_blocks(batches, "text", BLOCK_BYTES):
            held = np.array(table.column("held_out").to_pylist(), bool)
            index: dict[bytes, int] = {}
            ids, lens = [], []
            for text in texts:
                ws = text.lower().split()
                ids.append(np.fromiter((index.setdefault(w, len(index)) for w in ws), np.uint32, len(ws)))
                lens.append(len(ws))
            flat = np.concatenate(ids)
            counts = np.bincount(flat[~np.repeat(held, lens)], minlength=len(index)) if len(flat) else np.zeros(0, np.int64)
            row = {"block": (part << 32) | seq, "doc_id": table.column("doc_id").to_pylist(), "held_out": held.tolist(), "lens": lens,
                   "ids": zlib.compress(flat.tobytes(), 1), "words": hash_words(list(index)).view(np.int64), "counts": counts.astype(np.int32),
                   "subs": np.fromiter((xxhash.xxh32_intdigest(w[-SUFFIX:]) % CLASSES for w in index), np.int32, len(index))}
            seq += 1
            yield pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)

    return store(docs.select("doc_id", "held_out", "text").mapInArrow(blocks, _BLOCK), "lm_blocks")


_BLOCK_ARROW = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())),
                          ("lens", pa.list_(pa.int32())), ("ids", pa.binary()), ("words", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("subs", pa.list_(pa.int32()))])


@dataclass
class Totals:
    """Training totals: tokens, distinct tokens, ends; tokens and distinct
    words of each class."""

    tokens: int
    distinct: int
    ends: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray


def count_words(blocks: DataFrame, words: int = WORDS) -> tuple[DataFrame, list[tuple[int, int]], Totals]:
    """(word, c) over all training documents, the model's words, totals."""
    local = (blocks.select(F.explode(F.arrays_zip("words", "counts", "subs")).alias("w"))
             .select(F.col("w.words").alias("word"), F.col("w.counts").cast("long").alias("n"), F.col("w.subs").alias("sub")))
    counts = store(local.where("n > 0").groupBy("word").agg(F.sum("n").alias("c"), F.min("sub").alias("sub")), "lm_counts")
    first = counts.orderBy(F.col("c").desc(), "word").limit(words).collect()
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = blocks.select(F.sum(F.size(F.filter("held_out", lambda x: ~x)))).first()[0] or 0
    of = {r["sub"]: (r["n"], r["v"]) for r in counts.groupBy("sub").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}  # CLASSES rows
    n, v = (np.array([of.get(k, (0, 0))[i] for k in range(CLASSES)], np.int64) for i in (0, 1))
    for r in first:
        n[r["sub"]] -= r["c"]
        v[r["sub"]] -= 1
    return counts.select("word", "c"), [(r["word"], r["c"]) for r in first], Totals(tokens + ends, distinct + (1 if ends else 0), ends, n, v)


def with_counts(blocks: DataFrame, counts: DataFrame, top: list[tuple[int, int]]) -> DataFrame:
    """Stored blocks with the counts ``c`` and model rows ``cls`` of their
    words. ``top`` has at most ``WORDS`` rows, so it is broadcast."""
    spark = blocks.sparkSession
    classes = F.broadcast(spark.createDataFrame([(w, i) for i, (w, _) in enumerate(top)], "word long, cls int"))
    local = (blocks.select("block", F.posexplode(F.arrays_zip("words", "subs")).alias("id", "w"))
             .select("block", "id", F.col("w.words").alias("word"), F.col("w.subs").alias("sub")))
    known = counts.join(classes, "word", "left").select("word", "c", "cls")

    def pack(words):
        at = np.argsort(words.column("id").to_numpy())
        c = words.column("c").fill_null(0).to_numpy()[at]
        cls = words.column("cls").to_numpy()[at]
        return pa.table({"b": words.column("block").slice(0, 1), "c": pa.array([zlib.compress(c.astype(np.int64).tobytes(), 1)], pa.binary()),
                         "cls": pa.array([zlib.compress(cls.astype(np.int32).tobytes(), 1)], pa.binary())})

    seen = (local.join(known, "word", "left").select("block", "id", "c", F.coalesce("cls", F.col("sub") + len(top)).alias("cls"))
            .groupBy("block").applyInArrow(pack, "b long, c binary, cls binary"))
    return store(blocks.drop("words", "counts", "subs").join(seen, F.col("block") == F.col("b"), "left").drop("b"), "lm_counted")


@dataclass
class Params:
    """size = model words + classes + end; context row ``size`` is the start."""

    inp: np.ndarray  # (size + 1) x DIM
    out: np.ndarray  # size x DIM
    bias: np.ndarray
    place: np.ndarray  # 2 x DIM: weights of the last and the last but one token

    @classmethod
    def start(cls, unigram: np.ndarray, seed: int = 11) -> "Params":
        rng = np.random.default_rng(seed)
        size = len(unigram)
        return cls(rng.normal(0, 0.1, (size + 1, DIM)).astype(np.float32), rng.normal(0, 0.1, (size, DIM)).astype(np.float32),
                   np.log(unigram).astype(np.float32), np.ones((2, DIM), np.float32))

    def pack(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.inp, self.out, self.bias, self.place)])

    def unpack(self, flat: np.ndarray) -> "Params":
        out, lo = [], 0
        for x in (self.inp, self.out, self.bias, self.place):
            out.append(flat[lo : lo + x.size].reshape(x.shape).astype(np.float32))
            lo += x.size
        return Params(*out)


def _sum_rows(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Rows summed by ``index`` in double precision, in the order they come."""
    at = np.argsort(index, kind="stable")
    index = index[at]
    first = np.flatnonzero(np.r_[True, index[1:] != index[:-1]][: len(index)])
    out = np.zeros((size, rows.shape[1]), np.float32)
    out[index[first]] = np.add.reduceat(rows[at], first, axis=0, dtype=np.float64)
    return out


def train_block(p: Params, one: np.ndarray, two: np.ndarray, target: np.ndarray, unigram: np.ndarray, seed: int, rate: float = 0.05) -> Params:
    """Noise-contrastive estimation over (last, last but one, token) with
    noise from the unigrams, shared by a batch; Adagrad steps."""
    rng = np.random.default_rng(seed)
    size = len(p.bias)
    inp, out, bias, place = p.inp.copy(), p.out.copy(), p.bias.copy(), p.place.copy()
    caches = [np.ones(x.shape, np.float32) for x in (inp, out, bias, place)]
    log_noise = np.log(NOISE * unigram).astype(np.float32)
    cum = np.cumsum(unigram)
    order = rng.permutation(-(-len(target) // BATCH))

    def move(x, cache, g):
        cache += g * g
        x += rate * g / np.sqrt(cache)

    for lo in order * BATCH:
        a, b, t = one[lo : lo + BATCH], two[lo : lo + BATCH], target[lo : lo + BATCH]
        noise = np.minimum(np.searchsorted(cum, rng.random(NOISE)), size - 1)
        ra, rb, q = inp[a], inp[b], out[t]
        ctx = ra * place[0] + rb * place[1]
        z = (ctx * q).sum(1) + bias[t] - log_noise[t]
        zn = ctx @ out[noise].T + bias[noise] - log_noise[noise]
        g = 1 / (1 + np.exp(np.clip(z, -30, 30)))
        gn = -1 / (1 + np.exp(-np.clip(zn, -30, 30)))
        dctx = g[:, None] * q + gn @ out[noise]  # sums over the batch: Adagrad scales each row by its own
        dout = _sum_rows(t, ctx * g[:, None], size)
        np.add.at(dout, noise, gn.T @ ctx)
        dbias = np.bincount(t, g, size).astype(np.float32)
        np.add.at(dbias, noise, gn.sum(0))
        dinp = _sum_rows(np.r_[a, b], np.concatenate([dctx * place[0], dctx * place[1]]), size + 1)
        dplace = np.stack([(dctx * ra).sum(0), (dctx * rb).sum(0)])
        for x, cache, grad in zip((inp, out, bias, place), caches, (dinp, dout, dbias, dplace)):
            move(x, cache, grad)
    return Params(inp, out, bias, place)


def contexts(tokens: np.ndarray, lens: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The last and the last but one token before each, within documents
    of ``lens`` tokens (the end included)."""
    begin = np.cumsum(lens) - lens
    one, two = np.r_[start, tokens[:-1]], np.r_[start, start, tokens[:-2]][: len(tokens)]
    one[begin] = start
    two[begin] = start
    more = begin[lens > 1] + 1
    two[more] = start
    return one, two


class Scorer:
    """Normalised log-probabilities from tables of the energy's terms."""

    def __init__(self, p: Params):
        self.last = (p.inp * p.place[0]) @ p.out.T
        self.before = (p.inp * p.place[1]) @ p.out.T + p.bias
        shift = [x.max(1, keepdims=True) for x in (self.last, self.before)]
        both = np.exp(self.last - shift[0]).astype(np.float64) @ np.exp(self.before - shift[1]).astype(np.float64).T
        self.norm = np.log(both) + shift[0] + shift[1].T

    def logp(self, one: np.ndarray, two: np.ndarray, token: np.ndarray) -> np.ndarray:
        return self.last[one, token].astype(np.float64) + self.before[two, token] - self.norm[one, two]


def _sequence(row: dict, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(model rows with ends, lens with ends, word counts c, held) of a block."""
    lens = np.array(row["lens"], np.int64)
    held = np.array(row["held_out"], bool)
    ids = np.frombuffer(zlib.decompress(row["ids"]), np.uint32)
    c = np.frombuffer(zlib.decompress(row["c"]), np.int64) if row["c"] else np.zeros(0, np.int64)
    cls = np.frombuffer(zlib.decompress(row["cls"]), np.int32).astype(np.int64) if row["c"] else np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.insert(cls[ids], ends, end), lens + 1, np.insert(c[ids], ends, -1), held


def train(blocks: DataFrame, top: list[tuple[str, int]], totals: Totals, rounds: int = 2) -> Params:
    """Averaged parameters after ``rounds`` passes, each over its share of
    the blocks (all training text once)."""
    spark = blocks.sparkSession
    weight = np.r_[[c for _, c in top], totals.class_tokens, totals.ends].astype(np.float64) + 1
    unigram = weight / weight.sum()
    end = len(top) + CLASSES
    params = Params.start(unigram)
    width = 64
    for r in range(rounds):
        start = spark.sparkContext.broadcast((params, unigram))

        def step(batches):
            p, u = start.value
            for batch in batches:
                for row in batch.to_pylist():
                    tokens, lens, _, held = _sequence(row, end)
                    one, two = contexts(tokens, lens, len(u))
                    use = ~np.repeat(held, lens)
                    if use.any():
                        flat = train_block(p, one[use], two[use], tokens[use], u, row["block"] % (1 << 31)).pack()
                        n = int(use.sum())
                        flat = np.r_[flat, np.zeros(-len(flat) % width, np.float32)].reshape(-1, width).astype(np.float64) * n
                        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(np.full(len(flat), n, np.int64)),
                                                          *[pa.array(flat[:, j]) for j in range(width)]], names=["i", "n", *[f"p{j}" for j in range(width)]])

        part = blocks.where(F.pmod(F.xxhash64("block"), F.lit(rounds)) == r)
        sums = (part.mapInArrow(step, "i int, n long, " + ", ".join(f"p{j} double" for j in range(width)))
                .groupBy("i").agg(F.sum("n").alias("n"), *[F.sum(f"p{j}").alias(f"p{j}") for j in range(width)]).orderBy("i").toPandas())
        if len(sums):
            flat = (sums[[f"p{j}" for j in range(width)]].to_numpy() / sums[["n"]].to_numpy()).ravel()
            params = params.unpack(flat.astype(np.float32))
    return params


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every row of ``docs`` (doc_id, held_out, text)."""
    blocks = encode(docs)
    counts, top, totals = count_words(blocks)
    blocks = with_counts(blocks, counts, top)
    model = docs.sparkSession.sparkContext.broadcast(train(blocks, top, totals))
    end = len(top) + CLASSES
    room = totals.class_tokens + totals.class_distinct + 1

    def score(batches):
        scorer = Scorer(model.value)
        for batch in batches:
            for row in batch.to_pylist():
                tokens, lens, c, held = _sequence(row, end)
                if not len(lens):
                    continue
                begin = np.cumsum(lens) - lens
                one, two = contexts(tokens, lens, end + 1)
                c = np.where(c < 0, totals.ends, c)
                base = np.log10((c + 1) / (totals.tokens + totals.distinct + 1))
                logp = scorer.logp(one, two, tokens) * _LOG10
                rare = (tokens >= len(top)) & (tokens < end)
                logp[rare] += np.log10((c[rare] + 1) / room[tokens[rare] - len(top)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_id"], pa.int64()), pa.array(held), pa.array(lens), pa.array(np.add.reduceat((c > 0).astype(np.int64), begin)),
                    pa.array(np.full(len(lens), totals.tokens, np.int64)), pa.array(np.add.reduceat(base, begin)), pa.array(np.add.reduceat(logp, begin)),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return blocks.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
