"""Wavelet shards, tokenizer cache and mixing."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import mixing, wavelet
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import END_ID, tokenizer_path


def test_wavelet_round_trip_access_count_occurrences():
    rng = np.random.default_rng(4)
    for n, top in ((0, 5), (1, 1), (513, 2), (5000, 49_408), (4096, 70_000)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        shard = wavelet.Shard(n, *wavelet.build_planes(ids))
        assert (shard.decode() == ids).all()
        if not n:
            continue
        at = rng.integers(0, n, 20)
        assert (shard.access(at) == ids[at]).all()
        for token in {int(ids[0]), int(ids[-1]), top + 1, 0}:
            assert shard.count(token) == int((ids == token).sum())
            assert (shard.occurrences(token) == np.flatnonzero(ids == token)).all()


def test_word_encoder_equals_the_tokenizer():
    tok = Tokenizer.from_file(tokenizer_path())
    enc = wavelet.WordEncoder(tokenizer_path())
    texts = ["Hello, World!! don't WE'LL 'S 12ab3", "é́ ﬁn Σας ΟΔΟΣ İstanbul ǅ ñandú,,.", "<|endoftext|> a<|startoftext|>b", "", "  \t x y z",
             "naïve café ÀÉÎ 漢字 emoji🙂!! _under_score ʼn ŉ ß ẞ", "x" * 500, "́lead ́"]
    ids, lens = enc.encode([t.encode() for t in texts], END_ID)
    want = [tok.encode(t, add_special_tokens=False).ids + [END_ID] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and lens.tolist() == [len(w) for w in want]


def test_encoder_of_another_tokenizer_file():
    """A file without the settings for which words are proved to be enough
    is used on whole texts; its ids are the tokenizer's own."""
    path = tokenizer_path("byte_bpe_50k.json")
    tok, enc = Tokenizer.from_file(path), wavelet.WordEncoder(path)
    assert not enc.by_word and wavelet.WordEncoder(tokenizer_path()).by_word
    texts = ["Hello,  World!! don't", "", " \n\n x", "é́ ﬁn 漢字 🙂 <|endoftext|>"]
    ids, lens = enc.encode([t.encode() for t in texts], END_ID)
    want = [tok.encode(t, add_special_tokens=False).ids + [END_ID] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and lens.tolist() == [len(w) for w in want]


def test_word_encoder_survives_a_full_cache(monkeypatch):
    monkeypatch.setattr(wavelet, "CACHE_PIECES", 5)
    tok, enc = Tokenizer.from_file(tokenizer_path()), wavelet.WordEncoder(tokenizer_path())
    rng = random.Random(3)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice("aéZ.,'1ñ×Ωǅ") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 9))) for _ in range(4)]
        ids, lens = enc.encode([t.encode() for t in texts], END_ID)
        want = [tok.encode(t, add_special_tokens=False).ids + [END_ID] for t in texts]
        assert ids.tolist() == [i for w in want for i in w] and lens.tolist() == [len(w) for w in want]


def test_token_shards_equal_direct_encoding(docs, odd, spark):
    tok = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(1)
    rows = [(i * 3 % 101, " ".join(rng.choice(["alpha", "Beta!", "gamma,"]) for _ in range(rng.randint(0, 40)))) for i in range(101)]
    path = wavelet.write_shards(docs(rows), tokenizer_path(), END_ID, shard_tokens=200)
    got = [tuple(r) for r in wavelet.document_digests(spark, path).orderBy("doc_id").collect()]
    start, want, stream = 0, [], []
    for d, t in sorted(rows):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [END_ID], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
        stream += ids.tolist()
    assert got == want
    assert spark.read.parquet(path).count() > 3
    common, n = Counter(stream).most_common(1)[0]
    assert wavelet.token_counts(spark, path, [common, 1]).where(f"token = {common}").first().n == n
    assert sorted(r.place for r in wavelet.token_occurrences(spark, path, common).collect()) == [i for i, x in enumerate(stream) if x == common]
    odd_rows = wavelet.document_digests(spark, wavelet.write_shards(odd, tokenizer_path(), END_ID)).collect()
    assert len(odd_rows) == odd.count() and min(r.n_tokens for r in odd_rows) == 1
    places = sorted((r.start, r.n_tokens) for r in odd_rows)
    assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))


def test_empty_shards(docs, spark):
    path = wavelet.write_shards(docs([(1, "x")]).where("false"), tokenizer_path(), END_ID)
    assert wavelet.document_digests(spark, path).count() == 0


def mixed(df):
    return sorted([(r.doc_id, r.source, r["size"], r.target, r.taken, r.copies) for r in mixing.mix(df).collect()], key=str)


def test_mix_targets_limits_and_reruns(docs):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), "en", rng.choice(["a", "b", "b", "b", "c", None, "hot", "hot", "hot", "hot"])) for i in range(600)]
    got = mixed(docs(rows))
    assert got == mixed(docs(list(reversed(rows))))
    sizes, taken, targets = Counter(), Counter(), {}
    for _, s, n, target, t, copies in got:
        sizes[s] += n
        taken[s] += t
        targets[s] = target
        assert 0 <= copies <= 2 and t == copies * n
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        assert targets[s] <= 2 * sizes[s] and abs(taken[s] - targets[s]) <= 31  # about one document


def test_mix_odd_rows(odd, docs):
    got = mixed(odd)
    assert len(got) == odd.count() and sum(1 for r in got if r[2] == 0) == 4
    assert mixed(odd.where("false")) == []
    blank = mixed(docs([(1, None), (2, "")]))
    assert [r[3:5] for r in blank] == [(0.0, 0), (0.0, 0)]


def test_mix_equals_its_sql(docs):
    rng = random.Random(8)
    rows = [(i, "a " * rng.randint(0, 9), "en", rng.choice(["x", "y", "z", "zz", None])) for i in range(200)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    rel = con.sql(ORACLE["op5_systematic_mix"])
    want = sorted(dict(zip(rel.columns, r))["doc_id"] * 10**6 + dict(zip(rel.columns, r))["taken"] for r in rel.fetchall())
    assert sorted(r.doc_id * 10**6 + r.taken for r in mixing.mix(docs(rows)).collect()) == want
