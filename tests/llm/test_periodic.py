import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from navlib.llm import periodic as R
from navlib.llm._words import NONSPACE, distinct_words, find_words, text_bytes

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words, min_length=6, min_repeats=4):
    """All (start, length, period): every stretch with every period, the smallest period only."""
    out, n = [], len(words)
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            part = words[i : i + length]
            if length >= max(min_length, min_repeats * q) and all(part[p:] != part[:-p] for p in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(docs):
    rows = []
    for doc_id, text in docs:
        w = WORD.findall(text or "")
        n = len(w)
        h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        milli = None if q is None else 1000 * length // q
        rows.append((doc_id, len(runs), s, length, q, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(rows, key=repr)


def runs_of(texts, **limits):
    data, offsets = text_bytes(pa.array(texts))
    start, end, first = find_words(data, offsets, NONSPACE)
    code = distinct_words(data, start, end).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found = list(zip(*[x.tolist() for x in R.find_runs(code, first, **limits)], strict=True))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        out.append([(s - a, length, q) for s, length, q in found if a <= s < b])
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_of_random_words(letters):
    rng = random.Random(letters)
    texts = []
    for _ in range(400):
        words = [rng.choice("abcdefg"[:letters]) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            root = [rng.choice("abcdefg"[: letters + 1]) for _ in range(rng.randint(1, 9))]
            at = rng.randint(0, len(words))
            words[at:at] = (root * 7)[: rng.randint(1, 6 * len(root))]
        texts.append(" ".join(words))
    for text, got in zip(texts, runs_of(texts), strict=True):
        assert got == brute_runs(text.split()), text


def test_other_limits_and_periods():
    rng = random.Random(9)
    for q in (1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100):
        root = [f"r{i}" for i in range(q)]
        words = ["x"] + (root * 9)[: 5 * q + rng.randint(0, 3 * q)] + ["y"]
        assert runs_of([" ".join(words)]) == [brute_runs(words)] and (q == 1 or len(brute_runs(words)) == 1)
        assert runs_of([" ".join(words)], min_length=20, min_repeats=6) == [brute_runs(words, 20, 6)]
    assert runs_of(["a b " * 9, "a b " * 9]) == [[(0, 18, 2)], [(0, 18, 2)]]  # texts don't run into each other
    with pytest.raises(ValueError):
        R.periodic_runs(None, min_repeats=3)


def test_long_texts():
    assert runs_of(["a " * 300_000, "b c " * 200_000]) == [[(0, 300_000, 1)], [(0, 400_000, 2)]]
    root = " ".join(f"r{i}" for i in range(30_000)) + " "
    assert runs_of(["z " + root * 5 + "r0 r1"]) == [[(1, 150_002, 30_000)]]


def test_matches_brute_force(make_docs, odd_texts, extra):
    rng = random.Random(4)
    docs = list(enumerate(odd_texts[:-1])) + [(None, odd_texts[30]), (None, None), (12, odd_texts[12])]
    docs += [(1000 + i, " ".join(rng.choice("ab") for _ in range(60))) for i in range(60)]
    docs += [(-5 - i, "Été 日本　x  Été 日本　x\tÉté 日本　x\nÉté 日本　x") for i in range(30)]
    got = R.run_digests(extra(make_docs(docs)).repartition(3))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == brute(docs)
    assert sum(r[1] > 0 for r in rows) > 20


def test_given_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = sorted(map(tuple, R.run_digests(docs).collect()), key=repr)
    rows = [(i, t if len(t or "") < 20_000 else None) for i, t in map(tuple, docs.select("doc_id", "text").collect())]
    short = {i for i, t in rows if t is not None}
    assert [r for r in got if r[0] in short] == [r for r in brute(rows) if r[0] in short]
    assert len(short) > 0.9 * len(rows)


def test_collapse_keeps_columns(make_docs, extra):
    docs = extra(make_docs(["x " + "a b " * 6 + "c", None, ""]))
    out = R.collapse_repeats(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.select("doc_id", "text", "n_chars").collect()}
    assert texts == {0: ("x a b c", 7), 1: ("", 0), 2: ("", 0)}
    assert R.run_digests(make_docs(["x"]).limit(0)).collect() == []
