import hashlib
from collections import defaultdict

import duckdb
import pytest

from navlib.llm import sharding as S

SF = "/root/testdata/sf0.01"


def brute(docs, limit):
    """Split bucket by bucket on the next bit."""
    md5 = lambda b: hashlib.md5(b).hexdigest()
    rows = []
    for doc_id, text in docs:
        raw = (text or "").encode()
        h = int(md5(f"{'' if doc_id is None else doc_id}/{md5(raw)}".encode())[:15], 16)
        rows.append((format(h, f"0{S.BITS}b"), doc_id, len(raw)))
    out, todo = [], [("", rows)] if rows else []
    while todo:
        bits, inside = todo.pop()
        size = sum(r[2] for r in inside)
        if size <= limit or len(inside) == 1:
            out += [(r[1], r[2], bits, len(bits), len(inside), size) for r in inside]
            continue
        for bit in "01":
            part = [r for r in inside if r[0].startswith(bits + bit)]
            if part:
                todo.append((bits + bit, part))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [50, 3000, 10**9])
def test_matches_splitting(make_docs, odd_texts, extra, limit):
    docs = list(enumerate(odd_texts)) + [(None, "null id"), (3, "same id")]
    got = sorted(map(tuple, S.shards(extra(make_docs(docs)), limit).collect()), key=repr)
    assert got == brute(docs, limit)
    assert all(r[5] <= limit or r[4] == 1 for r in got)


def test_oracle_at_a_small_limit(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(S.oracle(100_000))
    got = S.shards(spark.read.parquet(f"{SF}/documents.parquet"), 100_000)
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted(map(tuple, got.select(*rel.columns).collect())) == sorted(rel.fetchall())


def test_repeated_rows_are_dealt(make_docs):
    docs = [(1, "abcdefghij")] * 25 + [(2, "x")]
    sizes = defaultdict(list)
    for r in S.shards(make_docs(docs), 40).collect():
        sizes[r.shard].append((r.n_bytes, r.shard_rows, r.shard_bytes))
    assert sorted(len(v) for v in sizes.values()) == [1, 1, 4, 4, 4, 4, 4, 4]
    assert all(rows == len(v) and size == sum(b for b, _, _ in v) for v in sizes.values() for _, rows, size in v)


def test_growth_moves_nothing_else(make_docs):
    docs = [(i, "x" * 100) for i in range(200)]
    before = {r.doc_id: r.shard for r in S.shards(make_docs(docs), 1000).collect()}
    after = {r.doc_id: r.shard for r in S.shards(make_docs(docs + [(1000 + i, "y" * 100) for i in range(20)]), 1000).collect()}
    assert all(after[i].startswith(b) for i, b in before.items())
    assert len(set(before.values()) & set(after.values())) > 5


def test_write_and_empty(spark, make_docs, tmp_path):
    docs = make_docs([f"text {i}" for i in range(50)])
    S.write_shards(docs, str(tmp_path / "s"), 60)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(tuple, back.select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    assert S.directory(docs, 60).count() == back.select("_shard").distinct().count() > 5
    assert S.shards(docs.limit(0)).collect() == []
