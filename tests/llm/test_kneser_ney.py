import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from navlib.llm import kneser_ney as K

SF = "/root/testdata/sf0.01"


def brute_model(texts, order):
    """Interpolated modified Kneser-Ney by dictionaries; probability of a byte after its history."""
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        b = b"\0" * (order - 1) + (t or "").encode()
        counts[order].update(b[i - order + 1 : i + 1] for i in range(order - 1, len(b)))
    for k in range(order - 1, 0, -1):
        counts[k].update(g[1:] for g in counts[k + 1])
    discount, total, held = {}, {}, {}
    for k in range(1, order + 1):
        n = [sum(v == j for v in counts[k].values()) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0
        d = [1 - 2 * y * n[1] / n[0] if n[0] else 0, 2 - 3 * y * n[2] / n[1] if n[1] else 0, 3 - 4 * y * n[3] / n[2] if n[2] else 0]
        discount[k] = [x if 0 < x <= i + 1 else (i + 1) / 2 for i, x in enumerate(d)]
        total[k], held[k] = Counter(), defaultdict(float)
        for g, v in counts[k].items():
            total[k][g[:-1]] += v
            held[k][g[:-1]] += discount[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        k, h = len(g), g[:-1]
        if h not in total[k]:
            return p(g[1:])
        v = counts[k][g]
        own = v - discount[k][min(v, 3) - 1] if v else 0
        return own / total[k][h] + held[k][h] / total[k][h] * p(g[1:])

    def cost(t):
        b = b"\0" * (order - 1) + (t or "").encode()
        return -sum(math.log(p(b[i - order + 1 : i + 1])) for i in range(order - 1, len(b)))

    return p, cost


@pytest.fixture(scope="module")
def trained(make_docs, odd_texts):
    trusted = make_docs(odd_texts[8:40])
    return trusted, K.stored(K.train(trusted))


def test_matches_dictionaries(make_docs, odd_texts, trained):
    p, cost = brute_model(odd_texts[8:40], K.ORDER)
    assert sum(p(b"w1 w" + bytes([x])) for x in range(256)) == pytest.approx(1)
    docs = make_docs(odd_texts + ["never seen: Ω≈ç√", "a"])
    for r in K.score(docs, trained[1]).collect():
        text = (r.c1 or "").encode()
        assert r.n_bytes == len(text)
        assert r.cost / 1e6 == pytest.approx(cost(r.c1), abs=1e-5 * (1 + len(text)))


def test_sharded_join_gives_the_same(make_docs, odd_texts, trained, monkeypatch):
    docs = make_docs(odd_texts + ["never seen: Ω≈ç√"] + [(None, "x"), (3, "twice"), (3, "twice")])
    here = sorted(K.score(docs, trained[1]).select("c0", "c1", "cost", "n_bytes").collect(), key=repr)
    monkeypatch.setattr(K, "MODEL_ROWS", 10)
    assert sorted(K.score(docs, trained[1]).select("c0", "c1", "cost", "n_bytes").collect(), key=repr) == here


def test_quantile_by_counts(spark):
    rows = [("a", i % 7, 1) for i in range(70)] + [(None, 3, 5), (None, 9, 1)]
    bins = spark.createDataFrame(rows, "lang string, bin bigint, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    got = {r.lang: (r.bin, r.texts) for r in K._quantile(bins, ["lang"], 0.9).collect()}
    assert got == {"a": (6, 70), None: (9, 6)}


def test_small_languages_have_their_own_quantiles(spark):
    """A language's threshold moves from the pooled to its own quantile as its texts grow, without a jump."""
    spread = lambda lang, n, far: [(lang, 1000 * (1_000_000 + (far if i % 2 else -far)), 1000) for i in range(n)]
    over = {}
    for n in (40, 198, 200, 2000):
        rows = spread("wide", n, 300_000) + spread("narrow", 20000, 10_000)
        limits, _ = K._thresholds(spark.createDataFrame(rows, "lang string, cost bigint, n_bytes bigint"), 0.9)
        over[n] = {r.lang: r.limit for r in limits.collect()}
    wide = [over[n]["wide"] for n in (40, 198, 200, 2000)]
    assert over[40]["narrow"] < wide[0] < wide[1] < wide[2] < wide[3]
    assert wide[2] - wide[1] < 0.02 * wide[2]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where((F.col("quality") == 0) | (F.col("doc_id") % 4 != 0))  # a fourth of the good ones is held out
    out = K.classified(docs, seen).join(labels, "doc_id")
    assert out.where((F.col("perplexity") <= F.col("threshold") * 0.999999) != F.col("keep")).count() == 0
    good = out.where((F.col("quality") == 1) & (F.col("doc_id") % 4 == 0)).agg(F.avg(F.col("keep").cast("int"))).scalar()
    bad = out.where(F.col("quality") == 0).agg(F.avg(F.col("keep").cast("int"))).scalar()
    kept, wrong = out.select(good, bad).first()
    assert kept > 0.97 and wrong < 0.06, (kept, wrong)


def test_long_texts_are_judged_narrowly(make_docs, spark):
    """One word over and over is a little dearer a byte than usual: short it passes, long it doesn't."""
    import random

    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 200))) for _ in range(600)]
    odd = "zq " + " ".join(rng.choice(words) for _ in range(5))
    docs = make_docs([*texts, odd, " ".join([odd] * 60), " ".join(rng.choice(words) for _ in range(2000))])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(600)], "doc_id bigint, quality int, toxic int")
    rows = {r.doc_id: r for r in K.classified(docs, labels).collect()}
    assert [rows[600 + k].keep for k in range(3)] == [True, False, True]
    assert rows[601].threshold < rows[600].threshold and sum(rows[i].keep for i in range(600)) > 590


def test_odd_rows(spark, make_docs, extra):
    docs = make_docs(["good text here"] * 5 + [None, "", (None, "good text"), (0, "good text here"), "x" * 100000])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, None), (1, 1, 0), (2, 1, 1), (3, 0, 0), (3, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    out = K.judge(extra(docs), extra(labels))
    rows = out.collect()
    assert len(rows) == 10 and [r.keep for r in rows if not r.c1] == [False, False]
    assert K.good_documents(extra(docs), labels).columns == extra(docs).columns
    none = K.classified(docs, labels.limit(0)).collect()
    assert [r.keep for r in none] == [bool(r.n_bytes) for r in none]
    assert K.classified(docs.limit(0), labels).collect() == []
