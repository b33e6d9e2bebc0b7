import random
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from navlib.llm import hard_negatives as H

TYPE = "vec_id bigint, embedding array<float>, label int"


def whole(e):
    return [max(-H.LARGEST, min(H.LARGEST, int(np.floor(256 * float(np.float32(x)))))) for x in e]


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    ok = lambda e: e is not None and all(x is not None and np.isfinite(np.float32(x)) for x in e)
    rows = [(i, label, whole(e)) for i, e, label in rows if label is not None and ok(e)]
    out = []
    for n, (anchor, label, a) in enumerate(rows):
        if anchor is None or not is_anchor(anchor):
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), i is None, i or 0, m, lab) for m, (i, lab, v) in enumerate(rows)]  # noqa: B905
        scored.sort()
        for s, none, i, *_ in [t for t in scored if t[4] == label and t[3] != n][:positives]:
            hits = [t for t in scored if t[4] != label and low * -s <= 100 * -t[0] <= high * -s]
            for rank, t in enumerate(hits[:negatives], 1):
                out.append((anchor, None if none else i, rank, None if t[1] else t[2], -s, -t[0]))
    return sorted(out, key=repr)


def got(frame):
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, frame.collect()), key=repr)


def vectors(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (spread * rng.normal(0, 0.2, dim)).tolist(), int(rng.integers(0, 4))) for i in range(n)]


def odd_rows():
    rng = random.Random(3)
    rows = vectors(1, 300, 8)
    rows += [(300 + k, e, label) for k, (_, e, label) in enumerate(rows[:40])]  # copies: ties between ids
    rows += [rows[0], rows[20], rows[33], rows[33]]  # repeated rows
    rows += [(None, rows[5][1], 1), (None, rows[6][1], 2), (400, None, 1), (401, [0.1] * 8, None)]
    rows += [(402, [0.1, None] + [0.2] * 6, 1), (403, [float("nan")] * 8, 1), (404, [float("inf")] + [0.0] * 7, 2)]
    rows += [(405, [], 1), (406, [0.5, -0.5], 2), (420, [0.0] * 8, 3), (440, [0.01] * 8, 3), (460, [3e38] * 8, 0), (480, [-1e9] * 8, 1)]
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark, extra):
    rows = odd_rows()
    df = extra(spark.createDataFrame(rows, TYPE).repartition(4))
    want = brute(rows, lambda i: i % 20 == 0)
    assert got(H.mine(df, F.col("id") % 20 == 0)) == want
    assert {0, 20, 420, 480} & {r[0] for r in want} and len(want) > 500
    limits = dict(positives=2, negatives=3)
    assert got(H.mine(df, F.col("id") % 7 == 1, low_percent=0, high_percent=100, **limits)) == brute(rows, lambda i: i % 7 == 1, low=0, high=100, **limits)


def test_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 50)
    monkeypatch.setattr(H, "SLICE_ANCHORS", 7)
    rows = vectors(2, 400, 16)
    df = spark.createDataFrame(rows, TYPE)
    assert got(H.mine(df, F.col("id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)


def test_one_vector_in_most_rows(spark):
    rows = vectors(4, 200, 8)
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, TYPE)
    assert got(H.mine(df, F.col("id").isin(3, 100, 1500))) == brute(rows, lambda i: i in (3, 100, 1500))


def test_reading_stops_early_and_rightly():
    """With few dimensions the threshold falls fast: most rows are never scored, and the result is that of all rows."""
    rng = np.random.default_rng(7)
    x = np.floor(256 * rng.normal(0, 1, (20_000, 2)))
    block = H.Block(x, np.arange(20_000), np.arange(20_000))
    scored = 0

    class Counted(np.ndarray):
        def __getitem__(self, item):
            nonlocal scored
            scored += np.size(item)
            return super().__getitem__(item)

    block.x = x.view(Counted)
    for a in (np.array([100.0, -30.0]), np.array([0.0, 7.0]), np.array([-5.0, -5.0])):
        score = (x @ a).astype(np.int64)
        top = int(score.max())
        windows = [(-(1 << 62), 1 << 62), (top // 3, top * 9 // 10), (5, 4)]
        scored = 0
        kept = block.best(a, np.ones(len(x), bool), windows, 5)
        assert 0 < scored < 8_000
        for (rows, scores), (low, high) in zip(kept, windows, strict=True):
            order = [r for r in np.lexsort((np.arange(len(x)), -score)).tolist() if low <= score[r] <= high][:5]
            assert sorted(rows.tolist()) == sorted(order) and sorted(scores.tolist()) == sorted(score[order].tolist())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_given_tables_and_sql(spark, size):
    path = Path("/root/testdata") / size / "embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = sorted(con.execute(H.ORACLE).fetchall(), key=repr)
    assert got(H.mined(spark.read.parquet(str(path)))) == want and want


def test_sql_on_odd_rows(spark):
    import pandas as pd

    rows = [r for r in odd_rows() if r[0] is not None and (r[1] is None or len(r[1]) == 8)]
    rows = [r for k, r in enumerate(rows) if r[0] not in (460, 480) and r[0] not in {q[0] for q in rows[:k]}]
    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["vec_id", "embedding", "label"]).astype({"label": "Int32"}))
    con.execute("CREATE TABLE embeddings AS SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS FLOAT[]) AS embedding, CAST(label AS INTEGER) AS label FROM given")
    assert got(H.mined(spark.createDataFrame(rows, TYPE))) == sorted(con.execute(H.ORACLE).fetchall(), key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], TYPE)
    assert got(H.mined(df)) == []
    assert got(H.mined(spark.createDataFrame([(0, None, 1), (100, [0.1], None)], TYPE))) == []
