"""Metric-tree k-means against plain k-means with Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import metrictree
from tidemark.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(vec_id, code, error, label_error) of the kept rows, and the digest."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(r[1]) for r in good), default=0) // parts) * parts
    x = [[math.floor(float(np.float32(v)) * scale) for v in r[1]] + [0] * (width - len(r[1])) for r in good]
    size = width // parts
    cut = [[v[p * size : (p + 1) * size] for v in x] for p in range(parts)]
    books = [c[:entries] for c in cut]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = [near(v, books[p])[1] for v in cut[p]]
            for e in range(len(books[p])):
                own = [v for v, o in zip(cut[p], of) if o == e]
                if own:
                    books[p] = books[p][:e] + [[sum(c) // len(own) for c in zip(*own)]] + books[p][e + 1 :]
    final = [[near(v, books[p]) for v in cut[p]] for p in range(parts)]
    code = ["".join(f"{final[p][i][1]:02x}" for p in range(parts)) for i in range(len(good))]
    error = [sum(final[p][i][0] for p in range(parts)) for i in range(len(good))]
    by = {}
    for r, e in zip(good, error):
        by[r[2]] = by.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    return sorted(((r[0], c, e, by[r[2]]) for r, c, e in zip(good, code, error)), key=str), sha


def coded(spark, rows, **kw):
    prepare(spark)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = metrictree.with_label_error(*metrictree.compress(df, **kw)).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in out), key=str), {r.codebooks_sha256 for r in out}


def test_codes_equal_plain_k_means_with_ties_copies_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.25, 0.5, 1.0]) + (i % 3) * rng.random() for _ in range(16)], i % 4 or None, "x") for i in range(300)]
    rows += [(1000 + i, rows[5][1], 7, "x") for i in range(200)]  # a third of all rows is one vector
    rows += [(5, rows[5][1], 1, "x"), (5, rows[6][1], 1, "x"), (None, rows[9][1], None, "x"), (None, None, 1, "x"),
             (2000, None, 2, "x"), (2001, [0.0] * 16, 2, "x"), (2002, [float("nan")] + [0.0] * 15, 2, "x"), (2003, [float("inf")] * 16, 2, "x"),
             (2004, [None] + [0.0] * 15, 2, "x"), (2005, [1.0] * 5, 2, "x"), (2006, [], 2, "x")]
    want, sha = plain(rows)
    got, shas = coded(spark, rows, chunk=64)
    assert got == want and shas == {sha}


def test_lengths_that_are_no_multiple_of_the_parts_and_huge_components(spark):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(11)], 1, "x") for i in range(20)]
    want, sha = plain(rows)
    assert coded(spark, rows) == (want, {sha})
    huge = rows + [(30, [3e38] * 11, 2, "x"), (31, [-3e38] * 11, 2, "x"), (32, [1e15] * 11, 3, "x")]
    want, sha = plain(huge)
    got, shas = coded(spark, huge)
    cap = lambda v: v if v < 2**63 else None
    by = {}
    for r, e in want and [(next(h[2] for h in huge if h[0] == w[0]), w[2]) for w in want]:
        by[r] = by.get(r, 0) + (e if e < 2**63 else 0)
    assert [g[:3] for g in got] == [(w[0], w[1], cap(w[2])) for w in want] and shas == {sha}


def test_few_and_no_vectors(spark):
    rows = [(3, [0.1] * 8, None, "x"), (1, [0.2] * 8, 1, "x")]
    want, sha = plain(rows)
    assert coded(spark, rows) == (want, {sha})
    assert coded(spark, []) == ([], set())
    assert coded(spark, [(1, None, 1, "x")]) == ([], set())


@pytest.mark.parametrize("kind", [np.int64, object])
def test_balls_hold_their_points_and_lists_stay_exact(kind):
    rng = np.random.default_rng(3)
    for n, width, big in ((1, 2, 3), (400, 4, 50), (300, 2, 2), (200, 3, 0)):
        middle = rng.integers(-big, big + 1, (6, width)) * 20
        x = (middle[rng.integers(0, 6, n)] + rng.integers(-big, big + 1, (n, width))).astype(kind)
        tree = metrictree.Tree(x, leaf=8)
        assert sorted(tree.order.tolist()) == list(range(n))
        for b in range(len(tree.child)):
            own = tree.x[tree.lo[b] : tree.hi[b]]
            assert (tree.sum[b] == own.sum(0)).all() and tree.count[b] == len(own)
            assert (np.sqrt(metrictree.to_one(own, tree.centre[b]).astype(float)) <= float(tree.radius[b])).all()
        book = x[:16].copy()
        for _ in range(4):
            of, count, total, opened = tree.assign(book)
            best = metrictree.square_distances(x, book).argmin(1)
            assert (of == best[tree.order]).all() and opened <= len(tree.child)
            for e in range(len(book)):
                assert count[e] == (best == e).sum() and (total[e] == x[best == e].sum(0)).all()
                if count[e]:
                    book[e] = total[e] // count[e]
    # well-separated groups: most balls are owned without a look at their points
    x = (rng.integers(-3, 4, (1000, 4)) + np.repeat(np.arange(10), 100)[:, None] * 1000).astype(kind)
    assert metrictree.Tree(x, leaf=4).assign(x[::100].copy())[3] < 60


def test_anchors_own_the_points_nearest_to_them():
    rng = np.random.default_rng(8)
    x = rng.integers(-100, 100, (500, 5))
    lists = metrictree.anchor_lists(x, np.arange(500), 22)
    assert sorted(np.concatenate(lists).tolist()) == list(range(500)) and len(lists) == 22
    pivots = [own[-1] for own in lists]  # a pivot is at no distance from itself
    d = metrictree.square_distances(x, x[pivots])
    for i, own in enumerate(lists):
        assert (d[own, i] == d[own].min(1)).all()
