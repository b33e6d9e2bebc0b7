import hashlib
import re

import pytest

from navlib.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for item, t in items:
            iw = words_of(t)
            n = min(10, len(iw))
            if item is None or not n:
                continue
            grams = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def case(spark, make_docs, odd_texts):
    docs = [(i if i % 7 else i - 1, t) for i, t in enumerate(odd_texts)] + [(None, odd_texts[30])]
    items = [(i, odd_texts[20 + i]) for i in range(8)] + [(10, "X'Y été"), (11, None), (12, "?!"), (None, odd_texts[40]), (2, odd_texts[50])]
    return docs, items, make_docs(docs), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("slice_windows", [200_000, 40])
def test_matches_brute_force(case, extra, monkeypatch, slice_windows):
    docs, items, df, bench = case
    monkeypatch.setattr(D, "SLICE_WINDOWS", slice_windows)
    rows = D.contamination(extra(df), extra(bench))
    assert rows.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, rows.collect()), key=repr) == brute(docs, items)


def test_given_tables(spark, sf_small):
    docs, bench = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    got = sorted(map(tuple, D.contamination(docs, bench).collect()), key=repr)
    assert got == want and any(r[-1] for r in got)


def test_modes(spark, make_docs):
    item = " ".join(f"q{i}" for i in range(12))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = make_docs(["clean text", f"before {item.upper()}, after", None])
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(0, "clean text"), (2, None)]
    cut = {r.doc_id: (r.text, r.n_chars) for r in D.decontaminate(docs, bench, "span").collect()}
    assert cut == {0: ("clean text", 10), 1: ("before , after", 14), 2: (None, None)}


def test_empty_tables(spark, make_docs):
    docs, bench = make_docs(["a b"]), spark.createDataFrame([], "item_id bigint, text string")
    assert [r.contaminated for r in D.contamination(docs, bench).collect()] == [False]
    assert D.contamination(docs.limit(0), bench).collect() == []
