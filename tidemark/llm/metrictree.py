"""Vector codes by k-means over anchors-hierarchy metric trees.

Each component x becomes the integer floor(scale * x). A vector is cut into
``parts`` equal consecutive parts; each part position has a codebook of up to
``entries`` entries, which starts as that part of the first vectors by id.
Every round assigns each part to its nearest entry (squared Euclidean
distance, ties to the lower index) and replaces an entry by the floor of the
mean of its parts; unused entries stay. All of it is exact integer
arithmetic, so the result is that of plain k-means.

Method: vectors are dealt into chunks of ``CHUNK``, and for every part
position of a chunk an anchors hierarchy is built, middle out:

- about sqrt(n) anchors: each new one is the point farthest from its anchor
  in the widest anchor's list, and takes over the points that are nearer to
  it; a list is sorted by distance, so points within half the anchors'
  distance are never looked at;
- the anchors' balls are merged in pairs, always the two whose common ball
  is smallest, up to the root; below, each anchor's points are divided by
  the same method until a ball holds ``LEAF`` points.

A ball caches its count, the sum of its points, their floored mean as centre
and its radius. In a round, balls inherit the list of entries that may own
one of their points. An entry is struck off where the entry nearest to the
centre is nearer for every point of the ball; a ball with one entry left is
wholly owned and adds its cached count and sum; a leaf with several entries
compares its points with these alone. The trees are built once and written;
a round is one pass over them that gives each task's sums for the
``parts * entries`` entries, added up in Spark; only those reach the driver.

Defined results: vectors that are null or hold null or non-finite components
are dropped; repeated ids are rows of their own, null ids come last among
the first vectors, equal ids go by their vector; a vector shorter than the
longest counts zeros for what it lacks, and zeros fill the last parts if the
length is no multiple of ``parts``; components may be of any finite size
(beyond 64-bit range slower, with exact Python integers); an error beyond a
long is null. Fewer than ``entries`` vectors give as many entries. Empty
input gives no rows. Other columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Vectors in a chunk, and the most points of a ball that is not divided.
CHUNK = 2048
LEAF = 24

_CHUNK = pa.schema([("vec_id", pa.list_(pa.int64())), ("label", pa.list_(pa.string())), ("trees", pa.list_(pa.binary()))])
#: Sums travel as limbs to this base, so that they fit Spark's decimals
#: whatever the size of the components.
LIMB = 10**18


def kept(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null and has only finite components."""
    inf = float("inf")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x != F.lit(inf)) & (x != F.lit(-inf)))
    return vectors.where(F.col(vector).isNotNull() & F.coalesce(good, F.lit(False)))


def integers(vectors: list, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the vectors as rows, zeros behind short ones;
    int64 where every square sum fits, else Python integers."""
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, : len(v)] = v
    big = float(np.abs(x).max(initial=0.0)) * scale
    if big < 2.0**1000 and fits(big, width, len(vectors)):
        return np.floor(x * scale).astype(np.int64)
    # scale is a whole number: exact, whatever the size of x
    flat = [math.floor(v * scale) if abs(v) < 2.0**900 else int(v) * scale for v in x.ravel().tolist()]
    return np.array(flat, object).reshape(x.shape)


def fits(big: float, width: int, n: int) -> bool:
    """Whether square distances and sums of n rows fit 64 bits."""
    return 16.0 * (big + 1) * (big + 1) * max(1, width) < 2.0**62 and (big + 1) * max(1, n) < 2.0**62


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of a from all rows of b."""
    if a.dtype == object or b.dtype == object:
        a, b = a.astype(object), b.astype(object)
    out = np.zeros((len(a), len(b)), a.dtype)
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        out += gap * gap
    return out


def to_one(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of a from the row b."""
    gap = a - b
    return (gap * gap).sum(1)


def _root(square) -> np.ndarray:
    """An upper bound of the square root (0 of 0): doubles, or integers of
    any size."""
    square = np.asarray(square)
    if square.dtype == object:
        return np.array([v and math.isqrt(v) + 1 for v in square.ravel().tolist()], object).reshape(square.shape)
    return np.sqrt(square.astype(np.float64)) * (1 + 1e-9)


class Ball:
    """A node while the tree is built: its points, and its children."""

    __slots__ = ("points", "children", "centre", "square")

    def __init__(self, x: np.ndarray, points: np.ndarray, children: tuple = ()):
        self.points, self.children = points, children
        own = x[points]
        self.centre = own.sum(0) // len(points)
        self.square = to_one(own, self.centre).max()


def anchor_lists(x: np.ndarray, points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """``points`` divided among up to ``wanted`` anchors, each with the points
    that are nearer to it than to the others (fewer anchors if all points of
    a list equal their anchor)."""
    d = to_one(x[points], x[points[0]])
    order = np.argsort(-d, kind="stable")
    pivots, lists, far = [points[0]], [points[order]], [d[order]]  # by falling distance
    while len(lists) < wanted:
        widest = max(range(len(lists)), key=lambda i: far[i][0])
        if far[widest][0] == 0:
            break
        new = lists[widest][0]
        between = to_one(x[np.array(pivots)], x[new])
        got, got_d = [], []
        for i, own in enumerate(lists):
            # nearer than half the way to the new anchor: stays, unseen;
            # 4 d^2 <= between^2 with exact integers
            look = int(np.searchsorted(-(4 * far[i]), -between[i], "left"))
            if not look:
                continue
            near = to_one(x[own[:look]], x[new])
            take = near < far[i][:look]
            if take.any():
                got.append(own[:look][take])
                got_d.append(near[take])
                lists[i] = np.concatenate([own[:look][~take], own[look:]])
                far[i] = np.concatenate([far[i][:look][~take], far[i][look:]])
        mine, d = np.concatenate(got), np.concatenate(got_d)
        order = np.argsort(-d, kind="stable")
        pivots.append(new)
        lists.append(mine[order])
        far.append(d[order])
    return lists


def middle_out(x: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Ball:
    """The tree over ``points``: anchors in the middle, merged upwards and
    divided downwards."""
    if len(points) <= leaf:
        return Ball(x, points)
    lists = anchor_lists(x, points, max(2, math.isqrt(len(points))))
    if len(lists) == 1:  # all points are equal
        return Ball(x, points)
    balls = [middle_out(x, p, leaf) for p in lists]
    centre = np.array([b.centre for b in balls], x.dtype)
    radius = _root(np.array([b.square for b in balls], x.dtype))
    # width of the smallest ball around two balls, for all pairs
    width = _root(square_distances(centre, centre)) + radius[:, None] + radius[None]
    width = np.maximum(width, 2 * np.maximum(radius[:, None], radius[None]))
    np.fill_diagonal(width, np.inf)
    alive = list(range(len(balls)))
    while len(alive) > 1:
        i, j = divmod(int(np.argmin(width)), len(width))
        a, b = balls[i], balls[j]
        balls[i] = Ball(x, np.concatenate([a.points, b.points]), (a, b))
        width[j] = width[:, j] = np.inf
        alive.remove(j)
        centre[i], radius[i] = balls[i].centre, _root(balls[i].square)
        rest = np.array([k for k in alive if k != i], int)
        gap = _root(to_one(centre[rest], centre[i])) + radius[i] + radius[rest]
        width[i, rest] = width[rest, i] = np.maximum(gap, 2 * np.maximum(radius[i], radius[rest]))
    return balls[alive[0]]


class Tree:
    """A finished hierarchy over the rows of ``x`` as flat arrays, level by
    level: the points of ball b are ``order[lo[b]:hi[b]]``; its children are
    the balls ``child[b]`` and ``child[b] + 1`` (0: a leaf)."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        balls, child, lo, hi = [middle_out(x, np.arange(len(x)), leaf)], [], [0], [len(x)]
        order = np.empty(len(x), np.int64)
        i = 0
        while i < len(balls):
            b = balls[i]
            child.append(len(balls) if b.children else 0)
            if b.children:
                cut = lo[i] + len(b.children[0].points)
                balls += b.children
                lo += [lo[i], cut]
                hi += [cut, hi[i]]
            else:
                order[lo[i] : hi[i]] = b.points
            i += 1
        self.order, self.x = order, x[order]
        self.child, self.lo, self.hi = np.array(child), np.array(lo), np.array(hi)
        self.centre = np.array([b.centre for b in balls], x.dtype)
        self.radius = _root(np.array([b.square for b in balls], x.dtype))
        self.count = self.hi - self.lo
        self.sum = np.array([x[b.points].sum(0) for b in balls], x.dtype)

    def _points(self, balls: np.ndarray) -> np.ndarray:
        n = self.count[balls]
        return np.repeat(self.lo[balls] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(entry of each point in tree order, counts and sums by entry,
        balls opened) for the entries ``book``."""
        k = len(book)
        apart = _root(square_distances(book, book))
        of = np.empty(len(self.x), np.int64)
        count, total = np.zeros(k, np.int64), np.zeros((k, self.x.shape[1]), self.x.dtype if book.dtype != object else object)
        balls, may, opened = np.array([0]), np.ones((1, k), bool), 0
        far = np.iinfo(np.int64).max
        while len(balls):
            opened += len(balls)
            d = square_distances(self.centre[balls], book)
            d = np.where(may, d, far) if d.dtype != object else np.where(may, d, d.max() + 1)
            best = np.argmin(d, 1)
            # for a point y of the ball, |y-c|^2 - |y-best|^2 is at least the
            # difference at the centre - 2 * radius * |c-best|; with a reach
            # of zero the tie at the centre holds for every point
            reach = 2 * self.radius[balls][:, None] * apart[best]
            lead = d - np.take_along_axis(d, best[:, None], 1)
            may &= ~((lead > reach) | (reach == 0))
            may[np.arange(len(balls)), best] = True
            owned = may.sum(1) == 1
            of[self._points(balls[owned])] = np.repeat(best[owned], self.count[balls[owned]])
            np.add.at(count, best[owned], self.count[balls[owned]])
            np.add.at(total, best[owned], self.sum[balls[owned]])
            ends = ~owned & (self.child[balls] == 0)
            if ends.any():
                at = self._points(balls[ends])
                point, entry = np.nonzero(np.repeat(may[ends], self.count[balls[ends]], 0))
                gap = self.x[at[point]] - book[entry]
                near = (gap * gap).sum(1)
                d = np.full((len(at), k), far if near.dtype != object else near.max() + 1, near.dtype)
                d[point, entry] = near
                e = np.argmin(d, 1)
                of[at] = e
                np.add.at(count, e, 1)
                np.add.at(total, e, self.x[at])
            more = ~owned & ~ends
            first = self.child[balls[more]]
            balls = np.concatenate([first, first + 1])
            may = np.concatenate([may[more], may[more]])
        return of, count, total, opened


def plant(vectors: DataFrame, width: int, parts: int, scale: int, chunk: int = CHUNK) -> DataFrame:
    """The stored chunks (vec_id, label, trees) of ``vectors`` (vec_id,
    label, vector)."""
    size = width // parts

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(t: pa.Table):
            x = integers(t.column("vector").to_pylist(), width, scale)
            trees = [pickle.dumps(Tree(x[:, p * size : (p + 1) * size]), 5) for p in range(parts)]
            return pa.RecordBatch.from_pylist([{"vec_id": t.column("vec_id").to_pylist(), "label": t.column("label").to_pylist(), "trees": trees}], schema=_CHUNK)

        n = 0
        for batch in batches:
            while n + len(batch) >= chunk:
                held.append(batch.slice(0, chunk - n))
                batch = batch.slice(chunk - n)
                yield flush(pa.Table.from_batches(held))
                held, n = [], 0
            if len(batch):
                held.append(batch)
                n += len(batch)
        if held:
            yield flush(pa.Table.from_batches(held))

    return store(vectors.mapInArrow(build, "vec_id array<bigint>, label array<string>, trees array<binary>"), "metric_trees")


def _limbs(v: int, n: int) -> list[str]:
    out = []
    for _ in range(n - 1):
        v, low = divmod(v, LIMB)
        out.append(str(low))
    return [*out, str(v)]


def _sums(chunks: DataFrame, books: list[np.ndarray], limbs: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> (count, sums) over all chunks."""
    size = books[0].shape[1]

    def add(batches):
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            for trees in batch.column("trees").to_pylist():
                for p, blob in enumerate(trees):
                    _, c, t, _ = pickle.loads(blob).assign(books[p])
                    counts[p] += c
                    totals[p] += t.astype(object)
        rows = [{"part": p, "entry": e, "n": int(counts[p][e]), "sums": [x for v in totals[p][e] for x in _limbs(int(v), limbs)]}
                for p in range(len(books)) for e in range(len(books[p])) if counts[p][e]]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SUMS)

    rows = chunks.select("trees").mapInArrow(add, "part int, entry int, n long, sums array<string>")
    added = [F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(size * limbs)]
    got = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*added).alias("sums")).collect()  # parts * entries rows at most
    return {(r["part"], r["entry"]): (r["n"], [sum(int(v) * LIMB**i for i, v in enumerate(r["sums"][j * limbs : (j + 1) * limbs])) for j in range(size)])
            for r in got}


_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))])


def _book(rows: list[list[int]], size: int) -> np.ndarray:
    big = max((abs(v) for r in rows for v in r), default=0)
    kind = np.int64 if big < 2**62 and fits(float(big), size, CHUNK) else object
    return np.array(rows, kind).reshape(len(rows), size)


def fit(vectors: DataFrame, chunks: DataFrame, width: int, biggest: float, parts: int, entries: int, rounds: int, scale: int) -> list[np.ndarray]:
    """The final codebooks, one array of entries by part position."""
    size = width // parts
    # a task's sums stay below 2^63 times the biggest component
    limbs = len(str((int(biggest) + 1) * scale * 2**63)) // 18 + 1
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    x = integers([r["vector"] for r in first], width, scale).tolist()
    books = [[row[p * size : (p + 1) * size] for row in x] for p in range(parts)]
    for _ in range(rounds if size else 0):
        for (p, e), (n, total) in _sums(chunks, [_book(b, size) for b in books], limbs).items():
            books[p][e] = [t // n for t in total]
    return [_book(b, size) for b in books]


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, chunk: int = CHUNK) -> tuple[DataFrame, list[np.ndarray]]:
    """Stored (vec_id, label, code, error) of the kept vectors, the code as
    two hex digits a part, and the codebooks. Labels come back as text."""
    rows = kept(vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                               F.col(vector_col).cast("array<double>").alias("vector")), "vector")
    longest, biggest = rows.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    width = -(-(longest or 0) // parts) * parts
    chunks = plant(rows, width, parts, scale, chunk)
    books = fit(rows, chunks, width, biggest or 0.0, parts, entries, rounds, scale)
    size = width // parts

    def encode(batches):
        for batch in batches:
            for ids, labels, trees in zip(*[batch.column(c).to_pylist() for c in ("vec_id", "label", "trees")]):
                codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), object)
                for p in range(parts if size else 0):
                    t = pickle.loads(trees[p])
                    of, *_ = t.assign(books[p])
                    gap = (t.x.astype(object) - books[p][of]) if books[p].dtype == object or t.x.dtype == object else t.x - books[p][of]
                    codes[t.order, p] = of
                    error[t.order] += (gap * gap).sum(1).astype(object)
                hexed = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array([hexed[i * 2 * parts : (i + 1) * 2 * parts] for i in range(len(ids))], pa.string()),
                    pa.array([int(e) if e < 2**63 else None for e in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    return store(chunks.mapInArrow(encode, "vec_id long, label string, code string, error long"), "metric_codes"), books


def with_label_error(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``codes`` with label_error, the errors summed over equal labels (nulls
    together; null beyond a long), and the digest of the codebooks."""
    text = ",".join(str(v) for b in books for entry in b.tolist() for v in entry)
    sums = codes.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "own_label")
    return (codes.join(sums, F.col("label").eqNullSafe(F.col("own_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256")))
