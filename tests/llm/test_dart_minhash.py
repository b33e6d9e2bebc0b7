import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from navlib.llm import dart_minhash as D
from navlib.llm._words import text_bytes


def shingles(text):
    w = (text or "").encode().split()
    n = min(len(w), D.SHINGLE_WORDS)
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else Counter()


def similarity(a, b):
    either = sum((a | b).values())
    return sum((a & b).values()) / either if either else 1.0


def brute_classes(docs):
    """Smallest doc_id of each row's component, links between all pairs compared."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (docs[i][1] or "") == (docs[j][1] or "") or sets[i] and sets[j] and similarity(sets[i], sets[j]) >= D.THRESHOLD:
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc_id, _) in enumerate(docs):
        ids.setdefault(root(i), []).append(doc_id)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(((d, least[root(i)], len(ids[root(i)])) for i, (d, _) in enumerate(docs)), key=repr)


def near_copies(rng, n, edits):
    base = [f"w{rng.randint(0, 3000)}" for _ in range(n)]
    out = []
    for e in edits:
        w = list(base)
        for _ in range(e):
            w[rng.randrange(n)] = f"e{rng.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(1)
    pairs = []
    for n, edits in ((400, 3), (400, 12), (60, 2), (8, 1), (3000, 30)):
        pairs += [tuple(near_copies(rng, n, [0, edits])) for _ in range(30)]
    pairs += [("a b c d e f " * k, "a b c d e f " * (k + 2)) for k in range(2, 12)]  # only weights differ
    row, hashes, weights = D.elements(*text_bytes(pa.array([t for p in pairs for t in p])))
    s = D.signatures(row, hashes, weights, 2 * len(pairs))
    errors = [float(np.mean(s[2 * i] == s[2 * i + 1])) - similarity(shingles(a), shingles(b)) for i, (a, b) in enumerate(pairs)]
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06


def test_real_weights():
    row = np.repeat([0, 1], 50)
    hashes = np.tile(np.arange(1, 51).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 2)
    a, b = np.linspace(0.2, 3.3, 50), np.linspace(2.8, 0.4, 50)
    same = [np.mean(np.equal(*D.signatures(row, hashes + np.uint64(k), np.concatenate([a, b]), 2))) for k in range(200)]
    assert np.mean(same) == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.02)


def test_classes_match_brute_force(make_docs, odd_texts, extra):
    rng = random.Random(2)
    texts = [t for t in odd_texts if t is None or len(t) < 50000]
    for k in range(12):
        texts += near_copies(rng, rng.choice([12, 60, 200]), [0, 0, 1, 2, 3, 5, 9][: rng.randint(2, 7)])
    docs = [(3 * i % 1009, t) for i, t in enumerate(texts)] + [(None, texts[-1]), (5, texts[-2]), (5, texts[-2])]
    rows = D.near_duplicates(extra(make_docs(docs)))
    assert sorted(map(tuple, rows.collect()), key=repr) == brute_classes(docs)


@pytest.mark.parametrize("block_rows", [256, 16])
def test_large_group_of_near_copies(make_docs, monkeypatch, block_rows):
    """Copies at 0.5 to 1 of each other: links between copies that are far from the leader count too."""
    monkeypatch.setattr(D, "BLOCK_ROWS", block_rows)
    rng = random.Random(3)
    docs = list(enumerate(near_copies(rng, 150, [rng.randint(0, 12) for _ in range(250)])))
    got = sorted(map(tuple, D.near_duplicates(make_docs(docs)).collect()), key=repr)
    assert got == brute_classes(docs)


def test_components(spark):
    rng = random.Random(4)
    name = lambda i: bytes([i // 256, i % 256])
    links = [(i, i + 1) for i in range(40)] + [(100 + rng.randint(0, 60), 100 + rng.randint(0, 60)) for _ in range(40)]
    links = [(a, b) for a, b in links if a != b]
    nodes = spark.createDataFrame([(name(i),) for i in range(200)], "node binary")
    got = {r.node: r["class"] for r in D.components(nodes, spark.createDataFrame([(name(a), name(b)) for a, b in links], "a binary, b binary")).collect()}
    want = {i: i for i in range(200)}
    for _ in range(200):
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert {k: v for k, v in got.items()} == {name(i): name(c) for i, c in want.items()}


def test_one_row_of_each_class(make_docs, extra):
    rng = random.Random(5)
    a = near_copies(rng, 100, [0, 1, 1])
    docs = [(9, a[0]), (4, a[1]), (4, a[1]), (None, a[2]), (None, "alone here"), (7, None), (8, ""), (1, "short"), (1, "short"), (2, "short too")]
    df = extra(make_docs(docs))
    out = D.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([(4, a[1]), (None, "alone here"), (7, None), (1, "short"), (2, "short too")], key=repr)
    assert D.near_duplicates(make_docs([]).limit(0)).collect() == [] and D.deduplicate(make_docs([]).limit(0)).collect() == []


def test_given_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = sorted(map(tuple, D.near_duplicates(docs).collect()), key=repr)
    assert got == brute_classes([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert any(size > 1 for _, _, size in got)
