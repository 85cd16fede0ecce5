"""Language identification by averaged hashed subword embeddings.

A text's words are its runs of letters, lower-cased. Each word gives its
character n-grams (1 to 4, with word bounds) and itself, hashed into
``BUCKETS`` embeddings; the text is the mean of these and a linear softmax
gives the language. Embeddings and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled
documents. The logits are then scaled by one temperature, fitted on a part
of the sample that training left out, and a text is accepted if its
probability reaches the level at which accepted predictions of that part
are right as often as ``PRECISION`` asks.

The model is linear, so a task adds up one vector of logits for each word;
vectors of words seen in the task are kept. Texts are whole. Null texts and
texts without a letter are ``und`` with score 0 and not accepted. Rows with
a null language never train. With no labelled text every prediction is
``und``.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_list, text_key

#: Labelled documents that training sees, at most (smallest hashes first).
SAMPLE_ROWS = 3000
BUCKETS = 1 << 16
DIM = 16
NGRAMS = (1, 2, 3, 4)
PRECISION = 0.99
UNKNOWN = "und"
#: Words whose logits a task keeps before it starts anew (a memory bound).
_CACHE = 300_000
#: Runs of letters and of numerals such as \u00bd that are no decimal digits.
_WORD = re.compile(r"[^\W\d_]+")


def subwords(word: str) -> list[int]:
    """Buckets of a word's n-grams and of itself."""
    w = f"<{word}>"
    h = xxhash.xxh32_intdigest
    grams = [h(w[i : i + n]) & (BUCKETS - 1) for n in NGRAMS for i in range(len(w) - n + 1)]
    grams.append(h(w, seed=1) & (BUCKETS - 1))
    return grams


def words(text: bytes) -> list[str]:
    """The lower-cased runs of letters."""
    runs = _WORD.findall(text.decode().lower())
    if all(map(str.isalpha, runs)):
        return runs
    return [w for run in runs for w in "".join(c if c.isalpha() else " " for c in run).split()]


@dataclass
class Model:
    langs: list[str]
    logits: np.ndarray  # BUCKETS x languages: embedding times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    level: float = 0.0  # accepted from this probability on


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _bags(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, weights, owner) of documents' (bucket, count) lists."""
    n = np.array([len(b) for b, _ in rows])
    buckets = np.concatenate([b for b, _ in rows])
    weights = np.concatenate([c / c.sum() for _, c in rows]).astype(np.float32)
    return buckets, weights, np.repeat(np.arange(len(rows)), n)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], langs: list[str], epochs: int = 8, rate: float = 8.0, batch: int = 32, seed: int = 7) -> Model:
    """Train on (buckets, counts) of documents with their languages."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    y = np.array([names.index(x) for x in langs])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    test = order[: len(rows) // 5]
    train = order[len(rows) // 5 :]
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w = np.zeros((DIM, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)

    def mean(which):
        b, c, o = _bags([rows[i] for i in which])
        x = np.zeros((len(which), DIM), np.float32)
        np.add.at(x, o, emb[b] * c[:, None])
        return b, c, o, x

    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(train)
        for lo in range(0, len(train), batch):
            which = train[lo : lo + batch]
            b, c, o, x = mean(which)
            d = _softmax(x @ w + bias)
            d[np.arange(len(which)), y[which]] -= 1
            d /= len(which)
            gx = d @ w.T
            w -= step * 0.25 * (x.T @ d)
            bias -= step * 0.02 * d.sum(0)
            np.subtract.at(emb, b, step * 4 * gx[o] * c[:, None])
    model = Model(names, emb @ w, bias)
    if len(test) >= 20:
        z = mean(test)[3] @ w + bias
        grid = np.exp(np.linspace(-2, 2, 41))
        loss = [-np.log(_softmax(z * t)[np.arange(len(test)), y[test]] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(z * model.temperature)
        sure, right = p.max(1), p.argmax(1) == y[test]
        best = np.argsort(-sure)
        good = np.cumsum(right[best]) / np.arange(1, len(best) + 1) >= PRECISION
        model.level = float(sure[best][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return model


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` documents (doc_id, text, lang); their bucket
    counts, not their texts, go to the driver."""
    keyed = docs.where("lang is not null and text is not null").select(F.xxhash64("doc_id", text_key(F.col("text"))).alias("h"), "lang", "text")
    # the sample is chosen by key, a proven bound, so it is broadcast and the
    # texts stay where they are; repeated rows may bring a few more of them
    last = keyed.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if last is None:
        return fit([], [])
    some = keyed.where(F.col("h") <= last)

    def count(batches):
        for batch in batches:
            out = []
            for lang, text in zip(batch.column("lang").to_pylist(), binary_list(batch.column("text"))):
                all_grams = [g for w in words(text) for g in subwords(w)]
                if all_grams:
                    b, c = np.unique(np.array(all_grams, np.int32), return_counts=True)
                    out.append((lang, b, c.astype(np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.list_(pa.int32())),
                                                  pa.array([x[2] for x in out], pa.list_(pa.int32()))], names=["lang", "b", "c"])

    got = some.select("lang", "text").mapInArrow(count, "lang string, b array<int>, c array<int>").toArrow()
    cols = [[np.asarray(x.values) for x in got.column(c)] for c in ("b", "c")]
    return fit(list(zip(*cols)), got.column("lang").to_pylist())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with lang_pred, score, accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        k = len(m.langs)
        index: dict[str, int] = {}
        table = np.zeros((_CACHE, k + 1), np.float64)

        def learn(new: list[str]) -> None:
            grams = [subwords(w) for w in new]
            n = np.fromiter(map(len, grams), np.int64, len(grams))
            flat = np.fromiter(itertools.chain.from_iterable(grams), np.int64, int(n.sum()))
            at = len(index)
            table[at : at + len(new), :k] = np.add.reduceat(m.logits[flat].astype(np.float64), np.cumsum(n) - n)
            table[at : at + len(new), k] = n
            index.update(zip(new, range(at, at + len(new))))

        def total(ws: list[str]) -> np.ndarray:
            out = np.zeros(k + 1)
            for lo in range(0, len(ws), _CACHE // 4):
                part = ws[lo : lo + _CACHE // 4]
                new = list(set(part).difference(index))
                if len(index) + len(new) > _CACHE:
                    index.clear()
                    new = list(set(part))
                if new:
                    learn(new)
                out += table[np.fromiter(map(index.__getitem__, part), np.int64, len(part))].sum(0)
            return out

        for batch in batches:
            langs, probs, accepted = [], [], []
            for text in binary_list(batch.column("text")):
                ws = words(text)
                if not ws or not k:
                    langs.append(UNKNOWN)
                    probs.append(0.0)
                    accepted.append(False)
                    continue
                sums = total(ws)
                z = (sums[:k] / sums[k] + m.bias) * m.temperature
                p = np.exp(z - z.max())
                p /= p.sum()
                i = int(p.argmax())
                langs.append(m.langs[i])
                probs.append(float(p[i]))
                accepted.append(bool(p[i] >= m.level))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                                              pa.array(probs, pa.float64()), pa.array(accepted, pa.bool_())],
                                             names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        score, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")
