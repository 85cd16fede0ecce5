"""Rule classifier, language ID, language model, nearest neighbours."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import bilinear, langid, nndescent, rules


def good(rng):
    return ". ".join(" ".join(rng.choice("the of and river stone light walked over".split()) for _ in range(8)).capitalize() for _ in range(4)) + "."


def junk(rng):
    return " ".join(rng.choice(["BUY!!", "$$$", "%%%", "CLICK!!", "NOW!!"]) for _ in range(30))


def test_rules_learn_and_compile_to_columns(docs, spark):
    rng = random.Random(3)
    rows = [(i, junk(rng) if i % 4 == 0 else good(rng)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(300)] + [(None, 1), (5, None), (7, 9)], "doc_id long, label int")
    model = rules.train(docs(rows), labels)
    assert model.rules
    scored = rules.score(docs(rows), model)
    assert all("Python" not in line for line in scored._jdf.queryExecution().executedPlan().toString().splitlines())
    got = {r.doc_id: r.score for r in scored.collect()}
    assert all((got[i] >= 0.5) == (i % 4 != 0) for i in range(300, 400))
    assert rules.train(docs(rows), labels).column()._jc.toString() == model.column()._jc.toString()


def test_rules_match_numpy_on_the_same_statistics(docs):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, len(rules.STATS)))
    y = ((x[:, 0] > 0.2) & (x[:, 3] <= 0.5)).astype(float)
    model = rules.fit(x, y)
    z = model.bias + sum(w * r.on(x) for r, w in model.rules)
    assert ((z > 0) == (y > 0)).mean() > 0.97


def test_rules_odd_rows(odd, docs, spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in rules.score(odd, rules.train(odd, none)).collect()} == {0.5}
    one = rules.train(docs([(1, "a b"), (2, "c d")]), spark.createDataFrame([(1, 1), (2, 1), (2, 1)], "doc_id long, label int"))
    assert not one.rules and one.bias > 0
    assert rules.score(odd, one).count() == odd.count()
    assert rules.train(odd.where("false"), none).rules == []
    kept = rules.keep_good(odd, one)
    assert kept.columns == odd.columns and kept.count() == odd.count() and kept.select("score").distinct().collect()[0][0] == 7


ALPHABETS = {"aa": "abcdef", "bb": "uvwxyz", "cc": "ghijkl"}


def lang_text(lang, rng, n=30):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_language_id(docs):
    rng = random.Random(6)
    rows = [(i, lang_text(lang, rng), lang) for i in range(240) for lang in [rng.choice(list(ALPHABETS))]]
    model = langid.train(docs(rows).where("doc_id < 200"))
    assert model.langs == sorted(ALPHABETS)
    test = docs(rows[200:] + [(1000, None), (1001, "123 !!"), (1002, ""), (1003, "½ ² 3 ① Ⅷ ٣ _")]).withColumn("held_out", F.lit(True))
    got = {r.doc_id: r for r in langid.predict(test, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[200:])
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [(got[i].lang_pred, got[i].score, got[i].accepted) for i in (1000, 1001, 1002, 1003)] == [("und", 0.0, False)] * 4
    assert langid.words("x²y Ⅷé 漢字".encode()) == ["x", "y", "é", "漢字"]
    # against the mean embedding and the softmax, text by text
    for i, text, _ in rows[200:]:
        grams = [g for w in langid.words(text.encode()) for g in langid.subwords(w)]
        z = (model.logits[grams].astype(float).mean(0) + model.bias) * model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert got[i].score == pytest.approx(p.max(), rel=1e-9) and got[i].lang_pred == model.langs[int(p.argmax())]


def test_language_id_odd_rows(odd):
    model = langid.train(odd.where("false"))
    assert {r.lang_pred for r in langid.predict(odd.withColumn("held_out", F.lit(False)), model).collect()} == {"und"}
    model = langid.train(odd)
    got = langid.predict(odd.withColumn("held_out", F.lit(False)), model).collect()
    assert len(got) == odd.count() and {r.lang_pred for r in got} <= {"und", "en", "de"}


def test_language_model_counts_and_normalisation(docs):
    rng = random.Random(4)
    pairs = [("salt", "pepper"), ("day", "night"), ("cat", "dog")]
    rows = [(i, " ".join(w for _ in range(40) for w in rng.choice(pairs)) + f" Rare{i}") for i in range(60)]
    df = docs(rows).withColumn("held_out", F.col("doc_id") % 5 == 0)
    got = {r.doc_id: r for r in bilinear.score_documents(df).collect()}
    counts = Counter()
    for i, t in rows:
        if i % 5:
            counts.update([*t.lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        tokens = [*t.lower().split(), None]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
        assert r.score > r.base_score  # the next word depends on the last
    p = bilinear.Params.start(np.array([0.5, 0.3, 0.2]))
    scorer = bilinear.Scorer(p)
    for a in range(4):
        for b in range(4):
            assert math.isclose(sum(math.exp(scorer.logp(np.array([a]), np.array([b]), np.array([t]))[0]) for t in range(3)), 1, rel_tol=1e-5)


def test_language_model_scores_equal_a_direct_sum(docs, monkeypatch):
    """Every token's probability from the parameters by a plain softmax over
    all rows; few model words, so that most words are known by their class."""
    rng = random.Random(8)
    monkeypatch.setattr(bilinear, "WORDS", 6)
    rows = [(i, " ".join(rng.choice(["aa", "bb", "cc", "dd"]) + rng.choice(["ing", "ed", "es", ""]) + rng.choice(["", "", str(rng.randint(0, 40))]) for _ in range(30))) for i in range(40)]
    df = docs(rows).withColumn("held_out", F.col("doc_id") % 4 == 0)
    kept = {}
    monkeypatch.setattr(bilinear, "train", lambda blocks, top, totals, f=bilinear.train: kept.setdefault("x", (f(blocks, top, totals), top, totals))[0])
    count = bilinear.count_words
    monkeypatch.setattr(bilinear, "count_words", lambda blocks: count(blocks, 6))
    got = {r.doc_id: r.score for r in bilinear.score_documents(df).collect()}
    p, top, totals = kept["x"]
    counts = Counter(w for i, t in rows if i % 4 for w in t.encode().split())
    place = {h: i for i, (h, _) in enumerate(top)}
    sub = lambda w: xxhash.xxh32_intdigest(w[-3:]) % bilinear.CLASSES
    row = lambda w: place.get(int(bilinear.hash_words([w]).view(np.int64)[0]), len(top) + sub(w))
    inside = [w for w in counts if row(w) >= len(top)]
    end = len(top) + bilinear.CLASSES
    assert totals.class_tokens.sum() == sum(counts[w] for w in inside) and totals.class_distinct.sum() == len(inside)
    for i, t in rows:
        last, before, want = end + 1, end + 1, 0.0
        for w in [*t.encode().split(), None]:
            k = end if w is None else row(w)
            z = ((p.inp[last] * p.place[0] + p.inp[before] * p.place[1]).astype(float) @ p.out.T.astype(float)) + p.bias
            want += (z[k] - z.max() - np.log(np.exp(z - z.max()).sum())) / math.log(10)
            if w is not None and k >= len(top):
                mine = [x for x in inside if row(x) == k]
                want += math.log10((counts[w] + 1) / (sum(counts[x] for x in mine) + len(mine) + 1))
            last, before = k, last
        assert got[i] == pytest.approx(want, rel=1e-4)


def test_language_model_odd_rows(odd, docs):
    got = bilinear.score_documents(odd.withColumn("held_out", F.lit(False))).collect()
    assert len(got) == odd.count() and all(math.isfinite(r.score) for r in got)
    assert sorted(r.n_tokens for r in got)[0] == 1
    held = bilinear.score_documents(docs([(1, "a b")]).withColumn("held_out", F.lit(True))).first()
    assert (held.train_tokens, held.n_known, held.base_score) == (0, 0, 0.0)
    assert bilinear.score_documents(odd.where("false").withColumn("held_out", F.lit(False))).count() == 0


def brute_near(vectors, every, k):
    out = {}
    for q, x in vectors.items():
        if q % every == 0:
            d = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))), i) for i, y in vectors.items() if i != q)
            out[q] = d[:k]
    return out


def test_nearest_neighbours_recall_and_exact_scores(spark, docs):
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=8).astype(np.float32).astype(float).tolist() for i in range(600)}
    for i in range(100, 160):  # copies of one vector
        vectors[i] = vectors[100]
    rows = [(i, [float(x) for x in v]) for i, v in vectors.items()]
    df = spark.createDataFrame([*rows, (1000, None), (1100, [0.0] * 8), (1200, [float("nan")] * 8), (1300, [None, *[1.0] * 7]),
                                (1400, [float("inf")] * 8), (None, [1.0] * 8), (1500, [1.0])], "vec_id long, embedding array<float>")
    got = {}
    for r in nndescent.neighbours(df, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = brute_near(vectors, 20, 10)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    assert [i for _, i in got[100]] == list(range(101, 111))  # ties to the smaller id
    for q, found in got.items():
        for s, i in found:
            assert math.isclose(s, math.dist(vectors[q], vectors[i]), rel_tol=1e-12, abs_tol=1e-12)


def test_nearest_neighbours_few_rows(spark, docs):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [0.0, 3.0]), (2, [0.0, 3.0])], "vec_id long, embedding array<double>")
    assert [(r["rank"], r.vec_id) for r in nndescent.neighbours(df, 100).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert nndescent.neighbours(df.where("false"), 100).count() == 0


def test_subwords_hold_all_grams_up_to_four():
    import xxhash

    grams = set(langid.subwords("haus"))
    w = "<haus>"
    for n in (1, 2, 3, 4):
        assert {xxhash.xxh32_intdigest(w[i : i + n]) % langid.BUCKETS for i in range(len(w) - n + 1)} <= grams


def test_row_sums_are_those_of_one_count_a_column():
    rng = np.random.default_rng(5)
    index, rows = rng.integers(0, 40, 5000), rng.normal(size=(5000, 24)).astype(np.float32)
    single = np.stack([np.bincount(index, rows[:, j], 50) for j in range(24)], 1).astype(np.float32)
    assert np.array_equal(bilinear._sum_rows(index, rows, 50), single)
    assert not bilinear._sum_rows(index[:0], rows[:0], 50).any()
