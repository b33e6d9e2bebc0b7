import hashlib
import re

from navlib.llm import substring as S

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, n=13):
    big = 1 << 63
    least = {}
    rows = []
    for doc_id, text in docs:
        w = WORD.findall(text or "")
        key = big if doc_id is None else doc_id
        rows.append((doc_id, key, w))
        for i in range(len(w) - n + 1):
            g = tuple(w[i : i + n])
            least[g] = min(least.get(g, big), key)
    out = []
    for doc_id, key, w in rows:
        gone = set()
        for i in range(len(w) - n + 1):
            if least[tuple(w[i : i + n])] < key:
                gone |= set(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_matches_brute_force(make_docs, odd_texts, extra):
    docs = [(i if i % 9 else i - 2, t) for i, t in enumerate(odd_texts)] + [(None, odd_texts[30]), (None, odd_texts[31]), (12, odd_texts[12])]
    rows = S.removals(extra(make_docs(docs)))
    assert sorted(map(tuple, rows.collect()), key=repr) == brute(docs)


def test_windows_in_other_surroundings(make_docs):
    """Shared runs of 13 to 20 words at shifting places: first segments are settled window by window."""
    import random

    rng = random.Random(3)
    run = [f"r{i}" for i in range(20)]
    docs = []
    for _ in range(200):
        a = rng.randint(0, 7)
        b = rng.randint(a + 13, 20)
        docs.append(" ".join([f"x{rng.randint(0, 5)}" for _ in range(rng.randint(0, 9))] + run[a:b] + [f"y{rng.randint(0, 5)}" for _ in range(rng.randint(0, 9))]))
    got = sorted(map(tuple, S.removals(make_docs(docs)).collect()), key=repr)
    assert got == brute(list(enumerate(docs)))


def test_given_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = sorted(map(tuple, S.removals(docs).collect()), key=repr)
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert any(r[2] for r in got)


def test_interface_and_empty(spark, make_docs):
    run = " ".join(f"r{i}" for i in range(13))
    docs = make_docs([f"a {run}", f"b {run} c"])
    out = S.substring_dedup(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(0, f"a {run}", len(run) + 2), (1, "b c", 3)]
    spans = {r.c0: [tuple(x) for x in r.removed] for r in S.remove_substrings(docs).collect()}
    assert spans == {0: [], 1: [(1, 14)]}
    assert S.removals(docs.limit(0)).collect() == []
