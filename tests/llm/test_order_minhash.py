import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from navlib.llm import order_minhash as M


def edited(docs):
    """(doc_id, text) rows in the order of the contract, each with its edited text."""
    rows = sorted(docs, key=lambda r: -r[0])
    out = {}
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out[doc_id] = (text, text[: len(text) - half] + after[:half], after)
    return out


def prints(spark, make_docs, texts):
    rows = M.fingerprint(make_docs(list(enumerate(texts))).select("doc_id", "text"), "text", "f").collect()
    return [sorted(r.f) for r in sorted(rows, key=lambda r: r.doc_id)]


def brute_prints(spark, texts):
    """Numbered k-mers by plain Python; Spark only for its two hash functions."""
    wanted = []
    for t in texts:
        w = re.findall("[^ \t\n\x0b\f\r]+", t or "")
        n = max(len(w) - M.K_WORDS + 1, min(len(w), 1))
        wanted.append([w[i : i + M.K_WORDS] + [None] * (M.K_WORDS - len(w[i : i + M.K_WORDS])) for i in range(n)])
    mers = sorted({tuple(m) for ms in wanted for m in ms}, key=repr)
    names = [f"w{j}" for j in range(M.K_WORDS)]
    df = spark.createDataFrame(mers, ", ".join(f"{n} string" for n in names))
    hashes = {tuple(r[:-1]): r[-1] >> M._BITS for r in df.select(*names, F.xxhash64(*names)).collect()}
    numbered = []
    for ms in wanted:
        seen: dict = {}
        row = []
        for place, m in enumerate(ms):
            h = hashes[tuple(m)]
            row.append((h, seen.get(h, 0), place))
            seen[h] = seen.get(h, 0) + 1
        numbered.append(row)
    pairs = sorted({(h, c) for row in numbered for h, c, _ in row})
    df = spark.createDataFrame(pairs, "h bigint, c int")
    second = {(r.h, r.c): r.x >> M._BITS for r in df.select("h", "c", F.xxhash64("h", "c").alias("x")).collect()}
    tuples = []
    for row in numbered:
        classes: dict = {}
        for h, c, place in row:
            x = second[h, c]
            classes.setdefault((x % (1 << 36)) >> 30, []).append((x, place))
        order = sorted(classes)
        picks = {c: sorted(classes[c])[: M.PICKS] for c in order}
        for k, c in enumerate(order):
            if len(picks[c]) == 1 and len(row) > 1:
                picks[c] = picks[c] + sorted(classes[order[(k + 1) % len(order)]])[:1]
        tuples.append({c: [x for x, _ in sorted(v, key=lambda z: z[1])] for c, v in picks.items()})
    flat = sorted({tuple(v) for t in tuples for v in t.values()})
    one = spark.createDataFrame([(a[0],) for a in flat if len(a) == 1] or [(0,)], "a bigint").select("a", F.hash("a")).collect()
    two = spark.createDataFrame([a for a in flat if len(a) == 2] or [(0, 0)], "a bigint, b bigint").select("a", "b", F.hash("a", "b")).collect()
    entry = {tuple(r[:-1]): r[-1] for r in one + two}
    return [[c << 32 | entry[tuple(t[c])] & 0xFFFFFFFF for c in sorted(t)] for t in tuples]


def test_fingerprints_match_brute_force(spark, make_docs, odd_texts):
    texts = [t for t in odd_texts if t is None or len(t) < 20000] + ["a b c d e f g " * 50, "x y"]
    assert prints(spark, make_docs, texts) == brute_prints(spark, texts)


def test_given_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = edited([tuple(r) for r in docs.select("doc_id", "text").collect()])
    rows = {r.doc_id: r for r in M.edits(docs).collect()}
    assert set(rows) == set(want)
    plain = {r.doc_id: r.fingerprint for r in M.fingerprints(docs).collect()}
    by_text: dict = {}
    for doc_id, (text, edit, _) in want.items():
        r = rows[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert r.fingerprint == plain[doc_id] == by_text.setdefault(text, r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    long = [r for r in rows.values() if r.n_chars > 400]
    mean = lambda xs: sum(xs) / len(xs)
    assert mean([r.near_edited for r in long]) > 5 * mean([r.near_next for r in long])


def test_sensitive_to_edits_and_order(spark, make_docs):
    rng = random.Random(8)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    moved = words[200:] + words[:200]
    texts = [" ".join(words), " ".join(words[:390] + ["x"] + words[391:]), " ".join(moved), " ".join(words) + " " + " ".join(words)]
    a, near, swapped, twice = prints(spark, make_docs, texts)
    agree = lambda x, y: len({*x} & {*y}) / M.BUCKETS
    assert agree(a, near) > 0.85
    assert 0.3 < agree(a, swapped) < 0.75  # plain MinHash would see no difference
    assert agree(a, twice) < 0.6  # second occurrences count


@pytest.mark.parametrize("n", [20, 40, 68, 150])
def test_short_texts_see_order_too(spark, make_docs, n):
    """Halves swapped: without order nearly all k-mers, and so nearly all entries, would be the same."""
    rng = random.Random(n)
    texts = []
    for _ in range(30):
        w = [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
        texts += [" ".join(w), " ".join(w[n // 2 :] + w[: n // 2]), " ".join(w[:-1] + ["x"])]
    f = prints(spark, make_docs, texts)
    share = lambda x, y: len({*x} & {*y}) / len({e >> 32 for e in x + y})
    swapped = sum(share(f[k], f[k + 1]) for k in range(0, 90, 3)) / 30
    near = sum(share(f[k], f[k + 2]) for k in range(0, 90, 3)) / 30
    assert swapped < 0.62 and near > swapped + 0.1, (swapped, near)


def test_odd_rows(spark, make_docs, extra):
    docs = [(5, "a b c d"), (5, "a b c d"), (5, "other words here now"), (None, None), (None, ""), (7, "é" * 5001), (1, "word " * 40000)]
    rows = M.edits(extra(make_docs(docs))).collect()
    assert len(rows) == len(docs)
    by = {(r.doc_id, r.n_chars): r for r in rows}
    empty = [r for r in rows if r.n_chars == 0]
    assert len(empty) == 2 and all(r.fingerprint == '' for r in empty)
    assert M.edits(make_docs([]).limit(0)).collect() == []
    alone = M.edits(make_docs(["abcd efgh"])).collect()[0]
    assert alone.edited_sha256 == hashlib.sha256(b"abcd abcd").hexdigest() and alone.near_next == 1.0


def test_no_python_in_the_plan(make_docs):
    plan = M.edits(make_docs(["x y"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("a, b, want", [([1, 2 << 32], [1, 2 << 32 | 1], 0.5), ([], [], 1.0), ([1], [1 << 32], 0.0), ([5], [], 0.0)])
def test_likeness(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>")
    assert df.select(M.likeness(F.col("a"), F.col("b"))).first()[0] == want
