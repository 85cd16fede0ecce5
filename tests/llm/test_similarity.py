"""Group join, decontamination and substring operators against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import anchors, decontam, groupjoin, rlz, suffixes

SEED = random.Random(5)
VOCAB = [f"w{i}" for i in range(300)]


def words(n, rng):
    return [rng.choice(VOCAB) for _ in range(n)]


def corpus(rng):
    """Unique texts, exact copies, near copies in a chain, a passage that
    many documents share, short texts, repeats within a document."""
    base = words(120, rng)
    passage = words(60, rng)
    out = [" ".join(words(rng.randint(1, 80), rng)) for _ in range(30)]
    out += [" ".join(base)] * 4
    step = list(base)
    for i in range(6):
        step = list(step)
        step[rng.randrange(len(step))] = f"new{i}"
        out.append(" ".join(step))
    out += [" ".join(words(10, rng) + passage + words(rng.randint(5, 60), rng)) for _ in range(12)]
    out += ["a b c", "A b C", "a b", "x", "", " ".join(["same"] * 90), " ".join(["p q r s"] * 30), "line one two three four five six\n" * 9]
    rng.shuffle(out)
    return list(enumerate(out))


def brute_components(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_group_join_equals_brute_force(docs, seed, monkeypatch):
    monkeypatch.setattr(groupjoin, "GROUP", 3)  # several groups of one component
    rows = corpus(random.Random(seed))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in groupjoin.join_components(docs(rows)).collect()}
    assert got == brute_components(rows)


def test_group_join_odd_rows(odd):
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in groupjoin.join_components(odd).collect()], key=str)
    assert len(got) == odd.count()
    assert (1, 0, 1) in got and (2, 0, 2) in got and (None, 0, None) in got
    assert got.count((5, 1, 4)) == 2 and (4, 1, 4) in got
    kept = groupjoin.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "None", "None", "6", "7", "8"])


def test_operators_on_empty_tables(docs, spark):
    empty = docs([(1, "x")]).where("false")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert groupjoin.join_components(empty).count() == 0
    assert groupjoin.keep_one(empty).count() == 0
    assert decontam.contaminated(empty, bench).count() == 0
    assert decontam.decontaminate(docs([(1, "x y z")]), bench).count() == 1
    assert rlz.removed(empty).count() == 0 and suffixes.removed(empty).count() == 0


def test_shingles_are_bytes_words_and_short_sequences():
    assert len(groupjoin.shingle_set("A b\x0bc d\x1ce".encode())) == 1
    same = groupjoin.shingle_set(b"A B c")
    assert (same == groupjoin.shingle_set(b"a b C")).all() and len(same) == 1
    assert (groupjoin.shingle_set(b"a a") != groupjoin.shingle_set(b"a a a")).all()


def test_decontamination_finds_exact_and_substituted_passages(docs, spark):
    rng = random.Random(9)
    items = [(i, " ".join(words(30, rng))) for i in range(5)] + [(9, "too short item"), (10, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, " ".join(words(60, rng))) for i in range(20)]
    rows.append((100, "intro " + items[0][1].upper() + " outro"))
    changed = items[1][1].split()
    for at in (4, 11, 19, 26):
        changed[at] = "swapped"
    rows.append((101, " ".join(words(9, rng)) + " " + " ".join(changed)))
    rows.append((102, "prefix " + " ".join(items[2][1].split()[3:20])))
    rows.append((103, " ".join(items[3][1].split()[:6])))  # too little of the item
    rows.append((104, "x too short item y"))
    found = {(r.doc_id, r.item_id): (r.overlap_tokens, r.equal_tokens) for r in decontam.contaminated(docs(rows), bench).collect()}
    assert found == {(100, 0): (30, 30), (101, 1): (30, 26), (102, 2): (17, 17)}
    assert sorted(r.doc_id for r in decontam.decontaminate(docs(rows), bench).collect()) == [*range(20), 103, 104]


def test_decontamination_finds_short_items_with_any_token_substituted(docs, spark):
    rng = random.Random(12)
    items = {n: rng.sample(VOCAB, n) for n in range(8, 21)}
    bench = spark.createDataFrame([(n, " ".join(t)) for n, t in items.items()], "item_id long, text string")
    rows, wanted = [], set()
    for n, t in items.items():
        for at in [(i,) for i in range(n)] + [(2, n - 3)] * (n >= 10):
            changed = [f"new{i}" if i in at else x for i, x in enumerate(t)]
            wanted.add((len(rows), n, n - len(at)))
            rows.append((len(rows), "intro of it " + " ".join(changed) + " and outro"))
    found = {(r.doc_id, r.item_id, r.equal_tokens) for r in decontam.contaminated(docs(rows), bench).collect()}
    assert found == wanted


def test_longest_overlap_against_all_stretches():
    rng = np.random.default_rng(3)
    for _ in range(300):
        item = rng.integers(0, 9, int(rng.integers(8, 30))).astype(np.uint64)
        doc = np.where(rng.random(len(item)) < 0.7, item, 99).astype(np.uint64)
        equal = doc == item
        n = len(item)
        sizes = [j - i for i in range(n) for j in range(i + 1, n + 1)
                 if equal[i] and equal[j - 1] and 5 * equal[i:j].sum() >= 4 * (j - i)]
        whole = 5 * equal.sum() >= 4 * n
        assert decontam.overlap(doc, item, 0)[1] == (n if whole else max(sizes, default=0))


def brute_contaminated(rows, items):
    """Every alignment of every document and item at which some mask's
    tokens are equal, verified on the tokens themselves."""
    out = set()
    for d, text in rows:
        t = [x.lower() for x in re.findall(r"[0-9A-Za-z]+", text or "")]
        for i, item in items:
            s = [x.lower() for x in re.findall(r"[0-9A-Za-z]+", item or "")]
            if len(s) < decontam.MIN_ITEM:
                continue
            if len(s) < decontam.EXACT_BELOW:
                masks = ["1" * len(s)]
            else:
                masks = decontam.MASKS + (decontam.SHORT_MASKS if len(s) <= decontam.SHORT_ITEM else ())
            for shift in range(-len(s) + 1, len(t)):
                same = [0 <= shift + k < len(t) and t[shift + k] == s[k] for k in range(len(s))]
                if not any(all(same[p + j] for j, b in enumerate(m) if b == "1") for m in masks for p in range(len(s) - len(m) + 1)):
                    continue
                whole = sum(same) >= 0.8 * len(s) and 0 <= shift <= len(t) - len(s)
                if whole or any(same[a] and same[b] and b - a + 1 >= min(13, len(s)) and sum(same[a : b + 1]) >= 0.8 * (b - a + 1)
                                for a in range(len(s)) for b in range(a, len(s))):
                    out.add((d, i))
                    break
    return out


def test_decontamination_equals_brute_force(docs, spark):
    """Copies of items whole or in part, with substituted words, short items
    word for word, and words that repeat."""
    rng = random.Random(21)
    few = [f"t{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(few if i % 3 == 0 else VOCAB) for _ in range(n))) for i, n in enumerate([3, 4, 5, 6, 7, 7, 8, 9, 12, 13, 16, 20, 21, 30, 45, 40])]
    items += [(90, "same " * 20), (91, "a b " * 15), (92, "one two"), (93, "x")]
    rows = []
    for d in range(60):
        text = words(rng.randint(0, 25), rng)
        for _ in range(rng.randint(0, 2)):
            copy = rng.choice(items)[1].split()
            a = rng.randint(0, max(0, len(copy) - 14)) if rng.random() < 0.4 else 0
            copy = copy[a : len(copy) - (rng.randint(0, 5) if rng.random() < 0.3 else 0)]
            for _ in range(rng.randint(0, max(1, len(copy) // 5))):
                if copy and rng.random() < 0.7:
                    copy[rng.randrange(len(copy))] = "zzz"
            text += copy + words(rng.randint(0, 9), rng)
        rows.append((d, " ".join(text)))
    rows += [(100, "same " * 300), (101, "b a " * 200), (102, "one two x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(rows), bench).collect()}
    want = brute_contaminated(rows, items)
    assert got == want and len(want) > 25 and any(0 < i < 4 for _, i in want)
    assert decontam.left_out(bench) == 3


def test_repeated_tokens_meet_as_runs():
    t = decontam.tokens(b"w " * 4000)
    places, n, h = decontam.runs(*decontam.seeds(t))
    assert len(h) == len(decontam.MASKS + decontam.SHORT_MASKS) and n.sum() == sum(4001 - len(m) for m in decontam.MASKS + decontam.SHORT_MASKS)


def test_decontamination_odd_rows(odd, spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h"), (1, "a b c d e f g h"), (None, "é ü " * 10), (2, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(odd, bench).collect()}
    assert found == {(None, 1), (6, None)}
    left = decontam.decontaminate(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count() - 2


def brute_words(rows, window):
    seen, out = set(), {}
    for d, t in sorted(rows):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if k in seen:
                gone[i : i + window] = [True] * window
            seen.add(k)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def brute_bytes(rows, window):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        own = {b[i : i + window] for i in range(len(b) - window + 1)}
        for i in range(len(b) - window + 1):
            if b[i : i + window] in seen:
                gone[i : i + window] = True
        seen |= own
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [2, 1000])
def test_substring_operators_equal_brute_force(docs, hot, monkeypatch):
    """With a low hot limit every repeated anchor goes window by window;
    small blocks make segments meet across blocks."""
    monkeypatch.setattr(anchors, "HOT", hot)
    monkeypatch.setattr(anchors, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(anchors, "INDEX_BYTES", 2000)
    rows = corpus(random.Random(3))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rlz.removed(docs(rows)).collect()}
    assert got == brute_words(rows, 20)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removed(docs(rows)).collect()}
    assert got == brute_bytes(rows, 50)


@pytest.mark.parametrize("hot", [2, 1000])
def test_equal_rows_keep_their_words(docs, hot, monkeypatch):
    """Long repeated rows, some with inner repeats: copies of a row are not
    earlier places, and every copy gets the one verdict."""
    monkeypatch.setattr(anchors, "HOT", hot)
    rng = random.Random(hot)
    own = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(3)]
    shared = " ".join(rng.choice("abcdefgh") + str(i) for i in range(35))
    rows = [(1, own[0]), (2, f"{own[1]} {shared} tail {shared}"), (3, shared), (4, own[2]), (5, own[0] + " end")]
    want = brute_words(rows, 20)
    assert want[1][1] == 0 and want[2][1] == 35 and want[3][1] == 35
    for copies in (2, 7):
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rlz.removed(docs(rows * copies)).collect())
        assert got == sorted((d, *v) for d, v in want.items() for _ in range(copies))
        low = brute_bytes(rows, 50)
        got = sorted((r.doc_id, r.n_removed, r.kept_sha256) for r in suffixes.removed(docs(rows * copies)).collect())
        assert got == sorted((d, v[1], v[-1]) for d, v in low.items() for _ in range(copies))


def test_substring_operators_odd_rows(odd):
    """Null ids, equal rows and rows with one doc_id do not remove each
    other's words; within one long document repeats go."""
    got = [(r.doc_id, r.n_words, r.n_removed) for r in rlz.removed(odd).collect()]
    assert len(got) == odd.count() and (6, 60_000, 59_998) in got
    assert all(n == 0 for d, _, n in got if d != 6)
    got = [(r.doc_id, r.n_removed) for r in suffixes.removed(odd).collect()]
    assert len(got) == odd.count() and all(n == 0 for _, n in got)


def test_suffix_sort_orders_and_survives_collisions():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 3000, dtype=np.uint8).tobytes() + b"abc" * 400
    s = suffixes.Suffixes(data, 20)
    at = rng.permutation(len(data) - 20)
    order = s.sort(at)
    windows = [data[i : i + 20] for i in at[order]]
    assert windows == sorted(windows)
    heads = s.equal_runs(order)
    assert heads.sum() == len(set(windows))
    s.full[:] = 0  # as if all hashes met
    assert s.equal_runs(order) is None


def test_suffix_sort_merges_one_suffix_a_tied_window(monkeypatch):
    """First bytes that differ need no merge; equal windows are merged once."""
    merged = []
    real = suffixes.Suffixes.merged
    monkeypatch.setattr(suffixes.Suffixes, "merged", lambda self, x: merged.append(len(x)) or real(self, x))
    unlike = bytes(range(40))
    for data, n in ((unlike, None), (unlike * 30, None), ((b"a" * 12 + b"b" + b"a" * 12 + b"c") * 30, 26)):
        merged.clear()
        s = suffixes.Suffixes(data, 20)
        at = np.arange(len(data) - 20)
        windows = [data[i : i + 20] for i in at[s.sort(at)]]
        assert windows == sorted(windows)
        assert (not merged) if n is None else merged[0] <= n
    assert len(s.sort(np.arange(0))) == 0


def test_segments_cover_each_window_once():
    rng = np.random.default_rng(2)
    lens = np.array([0, 5, 20, 19, 200, 0, 21, 64])
    codes = rng.integers(0, 3, int(lens.sum())).astype(np.uint64) * np.uint64(77)
    for by_place in (True, False):
        starts, counts, _ = anchors.segments(anchors.PrefixHash(codes), lens, 8, 20, by_place)
        got = sorted(int(a) + i for a, c in zip(starts, counts) for i in range(c))
        base = np.cumsum(lens) - lens
        assert got == [int(b) + i for b, n in zip(base, lens) for i in range(max(0, n - 19))]
