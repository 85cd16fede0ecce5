"""Quality classifier as a sparse rule ensemble.

Statistics of a text are Spark column expressions. On a bounded sample of
labelled documents, small boosted trees over the statistics are grown;
every path from a root to a node becomes a conjunctive rule; a logistic
model with an L1 penalty keeps the few rules that matter; the kept rules
are compiled back into one Spark column. Scoring runs no Python.

Texts: null counts as empty, and an empty text has all statistics 0 and so a
score like any other. Rows without a usable label never train. Repeated
labels of one doc_id count as the lowest of them. With no labelled rows the
score is 0.5; with one class it is that class's smoothed share. Columns
other than text are never read by the score.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shield, store, word_array

#: Labelled documents that the model is fitted on, at most (those with the
#: smallest hash of doc_id). The sample goes to the driver: 12,000 rows of
#: about a dozen numbers.
SAMPLE_ROWS = 12_000

STATS = ("n_words", "word_len", "upper", "digits", "symbols", "marks", "pipes", "line_words",
         "line_repeat", "word_variety", "char_runs")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``stat_<name>`` for each name in ``STATS``.
    Columns ``stat_*`` and ``raw_*`` must not exist.

    The numbers are flat columns: the optimizer copies the parts of a struct
    into each place that reads them, and every rule would count anew.
    """
    t = F.coalesce(F.col(text), F.lit(""))

    def per(n: Column, of: Column) -> Column:
        return n / F.greatest(of, F.lit(1.0))

    def chars(pattern: str) -> Column:
        """Characters that the pattern covers (replacing takes one pass)."""
        return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))).cast("double")

    raw = [
        F.length(t).cast("double").alias("chars"),
        word_array(F.lower(t)).alias("words"),
        F.split(t, "\n").alias("lines"),
        chars("[A-Z]+").alias("upper"), chars("[0-9]+").alias("digits"), chars(r"[#$%&*<>=+^~_@{}\[\]\\/]+").alias("symbols"),
        chars("[.,;:!?]+").alias("marks"), chars(r"\|+").alias("pipes"), chars(r"(.)\1{2,}").alias("runs"),
    ]
    raw = {f"raw_{n}": x for n, x in zip(("chars", "words", "lines", "upper", "digits", "symbols", "marks", "pipes", "runs"), raw)}

    def c(name: str) -> Column:
        return F.col(f"raw_{name}")

    words, lines = F.size(c("words")).cast("double"), F.size(c("lines")).cast("double")
    stats = [
        words.alias("n_words"),
        per(c("chars"), words).alias("word_len"),
        per(c("upper"), c("chars")).alias("upper"),
        per(c("digits"), c("chars")).alias("digits"),
        per(c("symbols"), c("chars")).alias("symbols"),
        per(c("marks"), words).alias("marks"),
        per(c("pipes"), words).alias("pipes"),
        per(words, lines).alias("line_words"),
        (1 - F.size(F.array_distinct(c("lines"))) / F.greatest(lines, F.lit(1.0))).alias("line_repeat"),
        per(F.size(F.array_distinct(c("words"))).cast("double"), words).alias("word_variety"),
        per(c("runs"), words).alias("char_runs"),
    ]
    return docs.withColumns(raw).withColumns({f"stat_{n}": x for n, x in zip(STATS, stats)}).drop(*raw)


@dataclass(frozen=True)
class Rule:
    """Conjunction of (statistic, at_most, bound): value <= bound or > bound."""

    terms: tuple[tuple[int, bool, float], ...]

    def on(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for i, at_most, bound in self.terms:
            out &= (x[:, i] <= bound) == at_most
        return out

    def column(self) -> Column:
        def one(i, at_most, bound):
            c = F.col(f"stat_{STATS[i]}")
            return c <= F.lit(float(bound)) if at_most else c > F.lit(float(bound))

        return functools.reduce(operator.and_, [one(*t) for t in self.terms])


@dataclass
class RuleModel:
    bias: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self) -> Column:
        """Score 0 to 1 of a row with its statistics, as one Spark expression."""
        z = F.lit(float(self.bias))
        for rule, w in self.rules:
            z = z + F.when(rule.column(), F.lit(float(w))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, bins: int = 24, rate: float = 0.3, least: int = 8) -> list[Rule]:
    """Paths of gradient-boosted trees on quantile bins, without repeats."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    z = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    found: dict[Rule, None] = {}
    for _ in range(trees):
        p = _sigmoid(z)
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        open_nodes = [(np.arange(len(y)), ())]
        for level in range(depth + 1):
            below = []
            for rows, path in open_nodes:
                best = (1e-3, None)
                g, h = grad[rows], hess[rows]
                if level < depth and len(rows) >= 2 * least:
                    whole = g.sum() ** 2 / (h.sum() + 1)
                    for j, c in enumerate(cuts):
                        b = binned[rows, j]
                        n = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                        gl = np.cumsum(np.bincount(b, g, len(c) + 1))[:-1]
                        hl = np.cumsum(np.bincount(b, h, len(c) + 1))[:-1]
                        gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - whole
                        gain[(n < least) | (len(rows) - n < least)] = -1
                        if len(gain) and gain.max() > best[0]:
                            best = (gain.max(), (j, int(gain.argmax())))
                if best[1] is None:
                    z[rows] += rate * g.sum() / (h.sum() + 1)
                    continue
                j, k = best[1]
                left = binned[rows, j] <= k
                for at_most, part in ((True, rows[left]), (False, rows[~left])):
                    child = (*path, (j, at_most, float(cuts[j][k])))
                    found[Rule(tuple(sorted(child)))] = None
                    below.append((part, child))
            open_nodes = below
    return list(found)


def fit_lasso(on: np.ndarray, y: np.ndarray, penalty: float = 2e-3, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic weights of 0/1 columns under an L1 penalty (accelerated
    proximal gradient); the bias is not penalised."""
    n, m = on.shape
    a = np.hstack([np.ones((n, 1)), on])
    v = np.ones(m + 1)
    for _ in range(30):  # largest eigenvalue of a'a / 4n bounds the step
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    step = 1 / (np.linalg.norm(a @ v) ** 2 / (4 * n) * 1.05 + 1e-9)
    w = np.zeros(m + 1)
    prev, t = w, 1.0
    for _ in range(steps):
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u = w + (t - 1) / t2 * (w - prev)
        u = u - step * (a.T @ (_sigmoid(a @ u) - y) / n)
        u[1:] = np.sign(u[1:]) * np.maximum(np.abs(u[1:]) - step * penalty, 0)
        prev, w, t = w, u, t2
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> RuleModel:
    if len(y) == 0:
        return RuleModel()
    share = (y.sum() + 1) / (len(y) + 2)
    if len(np.unique(y)) < 2:
        return RuleModel(float(np.log(share / (1 - share))))
    rules = grow_rules(x, y)
    if not rules:
        return RuleModel(float(np.log(share / (1 - share))))
    bias, w = fit_lasso(np.stack([r.on(x) for r in rules], 1).astype(float), y)
    return RuleModel(bias, [(r, float(c)) for r, c in zip(rules, w) if abs(c) > 1e-6])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on documents with a label: ``labels`` holds (doc_id, label 0/1).

    The label sample has at most ``rows`` rows, a proven bound, so it is
    broadcast and the documents are scanned once, without a shuffle.
    """
    some = (labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    joined = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    # repeated doc_ids could bring more rows than labels: the same bound holds
    got = (with_statistics(joined).select(F.xxhash64("doc_id", "text").alias("h"), "label", *[F.col(f"stat_{s}").alias(s) for s in STATS])
           .orderBy("h", "label").limit(rows).collect())
    x = np.array([[r[s] for s in STATS] for r in got], float).reshape(-1, len(STATS))
    return fit(x, np.array([r["label"] for r in got], float))


def score(docs: DataFrame, model: RuleModel, name: str = "score") -> DataFrame:
    """``docs`` with column ``name`` (0 to 1, higher: label 1 likelier),
    which replaces a column of that name."""
    own, new, _ = shield(docs)
    scored = with_statistics(own, new["text"]).withColumn("model_score", model.column())
    return scored.select(*[F.col(n).alias(c) for c, n in new.items() if c != name], F.col("model_score").alias(name))


def keep_good(docs: DataFrame, model: RuleModel, level: float = 0.5) -> DataFrame:
    """``docs`` whose score reaches ``level``, with their own columns. The
    scored rows are written first: a filter over them would be pushed below
    the statistics, which would then be counted once for each rule."""
    own, new, restore = shield(docs)
    scored = with_statistics(own, new["text"]).select(*new.values(), model.column().alias("model_score"))
    return restore(store(scored, "rules_scored").where(F.col("model_score") >= level))
