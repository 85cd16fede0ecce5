"""The manifest against a straightforward recursion."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves, fan):
    """(root, siblings before and after by level) of each leaf."""
    paths = [[] for _ in leaves]
    under = [[i] for i in range(len(leaves))]
    nodes = list(leaves)
    while len(nodes) > 1:
        up, below = [], []
        for a in range(0, len(nodes), fan):
            run = nodes[a : a + fan]
            for s in range(len(run)):
                for i in under[a + s]:
                    paths[i].append(("".join(run[:s]), "".join(run[s + 1 :])))
            up.append(H(*run))
            below.append([i for u in under[a : a + fan] for i in u])
        nodes, under = up, below
    return (nodes[0] if nodes else None), paths


def brute(rows, fan=3):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for s in order:
        ranked = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r) for r in groups[s]), key=lambda x: x[:3])
        own[s] = ranked, *tree([x[2] for x in ranked], fan)
    root, tops = tree([own[s][1] for s in order], fan)
    out = []
    for s, top in zip(order, tops):
        ranked, subroot, paths = own[s]
        for (_, _, h, r), path in zip(ranked, paths):
            path = path + top
            even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            now = leaf(r, r["text"].replace("\n", "") if even and r["text"] is not None else r["text"])
            for before, after in path:
                now = H(before, now, after)
            out.append((r["doc_id"], h, subroot, root, H(*[b + a for b, a in path]), now, now == root))
    return sorted(out, key=str)


def audit(df, fan=3):
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    out = merkle.tamper_report(df, even, {"text": F.translate("text", "\n", "")}, fan=fan)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("fan", [2, 3, 4])
def test_manifest_equals_the_recursion(docs, fan):
    rows = [(i, f"line {i}\nand more{chr(10) * (i % 3)}", "en", ["hot", "hot", "b", None, "é", "B"][i % 6]) for i in range(60)]
    rows += [(100, "x\n", "en", "alone"), (101, None, None, "pair"), (102, "", "en", "pair")]
    df = docs(rows)
    got = audit(df, fan)
    assert got == brute([r.asDict() for r in df.collect()], fan)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_odd_rows_and_one_row(odd, docs):
    assert audit(odd) == brute([r.asDict() for r in odd.collect()])
    one = docs([(7, "a\nb")])
    assert audit(one) == brute([r.asDict() for r in one.collect()])
    assert audit(one.where("false")) == []


def test_verify_finds_what_changed(docs, tmp_root):
    df = docs([(i, f"text {i}", "en", f"s{i % 3}") for i in range(20)])
    path = merkle.write_manifest(df, tmp_root)
    assert merkle.verify(df, path).count() == 0
    changed = df.where("doc_id <> 4").withColumn("text", F.when(F.col("doc_id") == 9, "other").otherwise(F.col("text")))
    got = sorted((r.key, r.state) for r in merkle.verify(changed.unionByName(docs([(4, "moved", "en", "s1")])), path).collect())
    assert got == [(4, "missing"), (4, "unexpected"), (9, "missing"), (9, "unexpected")]


def test_sibling_indices():
    import itertools

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    idx = spark.range(12)
    for fan in (2, 3, 5):
        got = idx.select("id", *[merkle.sibling(F.col("id"), o, fan).alias(f"s{o}") for o in range(1, fan)]).collect()
        for r in got:
            run = [i for i in range(r.id - r.id % fan, r.id - r.id % fan + fan) if i != r.id]
            assert sorted(itertools.islice(r, 1, None)) == run
