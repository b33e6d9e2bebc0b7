import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import pandas as pd

from navlib.llm import line_dedup as L


def kept_texts(rows, ratio=L.RATIO, deviations=L.DEVIATIONS):
    """The texts of (text, source) rows without the lines that are boilerplate on their source."""
    pages, counts = defaultdict(set), Counter()
    for text, source in rows:
        if source is not None:
            pages[source].add(text)
    for source, texts in pages.items():
        counts.update((source, line) for t in texts if t is not None for line in {x.strip(" ") for x in t.split("\n")} - {""})
    size = {source: len(texts) for source, texts in pages.items()}
    needed = {source: n * ratio + deviations * math.sqrt(n * ratio * (1 - ratio)) for source, n in size.items()}
    gone = {k for k, n in counts.items() if n >= 2 and n > needed[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" ")) not in gone) for t, s in rows]


def test_brute_force_and_sql(spark, odd_texts, extra):
    """Odd texts, copies, hosts of 1 to 120 pages, very long texts: operator, brute force and SQL give the same."""
    rng = random.Random(7)
    lines = [f"line {i}" for i in range(30)] + [" menu ", "menu", "", "  ", "Été", "x" * 300]
    rows = [(t, f"host{i % 3}") for i, t in enumerate(odd_texts)]
    for host, n in (("one", 1), ("two", 2), ("four", 4), ("ten", 10), ("fifty", 50), ("many", 120)):
        for i in range(n):
            page = ["menu"] * (i % 2) + [rng.choice(lines) for _ in range(rng.randint(0, 12))] + ["foot"] * (i < 9)
            rows.append(("\n".join(page), host))
        rows += rows[-1:] * (n // 2)  # copies
    rows += [("menu\n" * 30_000 + "tail", "many"), ("menu", None), (None, None), (None, "two"), (None, "two")]
    rng.shuffle(rows)
    docs = [(i - i % 7 // 6, t, "en", s, 0) for i, (t, s) in enumerate(rows)]  # some ids twice
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = kept_texts(rows)
    want = []
    for (i, t, _, s, _), k in zip(docs, kept, strict=True):
        n = 0 if t is None else len(t.split("\n"))
        gone = 0 if t is None else n - (len(k.split("\n")) if k else sum(x.strip(" ") == "" for x in t.split("\n")))
        want.append((i, s, n, gone, None if k is None else len(k), None if k is None else hashlib.sha256(k.encode()).hexdigest()))
    got = sorted(map(tuple, L.dropped_lines(extra(df).repartition(5)).collect()), key=repr)
    assert got == sorted(want, key=repr)
    assert {r[1] for r in got if r[3]} >= {"two", "four", "ten", "fifty", "many"} and not any(r[3] for r in got if r[1] in (None, "one"))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype(object))
    assert sorted(con.execute(L.ORACLE).fetchall(), key=repr) == got


def test_small_host_loses_its_menu(make_docs):
    docs = make_docs([f"menu\nbody {i}\nfoot" for i in range(4)])
    assert [r.text for r in L.drop_boilerplate_lines(docs).collect()] == [f"body {i}" for i in range(4)]


def test_drops_site_lines_only(spark, extra):
    rows = [(i, f"menu\nbody {i}\n  menu ", "en", "a", 1) for i in range(20)]
    rows += [(100 + i, f"menu\nbody {i}" if i == 0 else f"only {i}\n\nx", "en", "b", 1) for i in range(10)]
    rows += [(200, None, "en", "a", 0), (201, "", "en", "a", 0), (202, "menu", "en", None, 4), (0, "menu\nbody 0\n  menu ", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = L.drop_boilerplate_lines(extra(docs))
    assert out.columns == extra(docs).columns
    got = {(r.doc_id, r.source): (r.text, r.n_chars) for r in out.collect()}
    assert out.count() == len(rows)
    assert got[(3, "a")] == ("body 3", 6)
    assert got[(100, "b")] == ("menu\nbody 0", 11)
    assert got[(105, "b")] == ("only 5\n", 7)  # x is on nine of ten pages of b; blank lines stay
    assert got[(200, "a")] == (None, None) and got[(201, "a")] == ("", 0) and got[(202, None)] == ("menu", 4)


def test_small_hosts_and_empty(make_docs):
    docs = make_docs(["same", "same", "same"])
    assert [r.n_dropped for r in L.dropped_lines(docs).collect()] == [0, 0, 0]
    assert L.dropped_lines(docs.limit(0)).collect() == []


def test_copies_are_one_page(make_docs):
    """A group of copies holding a third of a host keeps its lines; the host's own lines go, from copies too."""
    copy = "menu\nan article\nof two lines"
    docs = make_docs([f"menu\nbody {i}" for i in range(20)] + [copy] * 10)
    got = {r.doc_id: r.text for r in L.drop_boilerplate_lines(docs).collect()}
    assert got == {**{i: f"body {i}" for i in range(20)}, **{20 + i: "an article\nof two lines" for i in range(10)}}
    # copies don't thin out the host's lines either: foot is on 6 of 26 pages, and of 226 rows
    docs = make_docs([f"foot\nbody {i}" if i < 6 else f"body {i}" for i in range(25)] + ["x"] * 201)
    assert sum(r.n_dropped for r in L.dropped_lines(docs).collect()) == 6


def test_shuffled_join_gives_the_same(spark, sf_small, monkeypatch):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    a = sorted(map(tuple, L.dropped_lines(docs, 0.02, 0.5).collect()))
    monkeypatch.setattr(L, "BROADCAST_HOSTS", 0)
    assert sorted(map(tuple, L.dropped_lines(docs, 0.02, 0.5).collect())) == a and any(r[3] for r in a)
