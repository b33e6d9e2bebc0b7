import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from test_dart_minhash import brute_classes
from test_decontaminate import words_of
from test_line_dedup import kept_texts
from test_packing import check

SF = "/root/testdata/sf0.001"


def brute_lines(docs):
    return dict(zip([r.doc_id for r in docs], kept_texts([(r.text, r.source) for r in docs]), strict=True))


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    rows = {}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows[name] = docs.collect()
    first, cleaned, single, clean, pieces = (rows[name] for name, _ in P.STAGES)

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in first}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) > 0.9 * len(good) and len(kept) < 200

    assert {r.doc_id: r.text for r in cleaned} == brute_lines(first) and len(cleaned) == len(first)
    assert all(r.n_chars == len(r.text) for r in cleaned)

    least = {c for _, c, _ in brute_classes([(r.doc_id, r.text) for r in cleaned])}
    assert sorted(r.doc_id for r in single) == sorted(least)

    def hit(text):
        w = words_of(text)
        return any(tuple(w[i : i + 10]) in grams for i in range(len(w)))

    assert sorted(map(tuple, clean)) == sorted(tuple(r) for r in single if not hit(r.text))

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference = lambda texts: [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]
    check(pieces, [(r.doc_id, r.text) for r in clean], reference)
    whole = P.run(spark, SF)
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(*columns).collect())) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces)


def test_every_operator_is_registered():
    names = [n.split("_")[0] for n in E.queries() if n.startswith("op")]
    assert [f"op{k}" for k in range(1, 14)] == sorted(names, key=lambda n: int(n[2:])) and "pipeline" in E.queries()


def _tables(spark, folder, docs, extra):
    extra(docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("q", "a b c d e f g h i j k"), ("n", None)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_odd_rows_in_every_stage(spark, tmp_path, make_docs, odd_texts, extra):
    """Nulls in all columns, empty and very long texts, repeated rows, clashing columns: every stage keeps the columns."""
    docs = make_docs([*enumerate(odd_texts), (None, None), (None, "text without id"), (3, odd_texts[3])])
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).selectExpr(*[f"CAST(NULL AS {t}) AS {n}" for n, t in docs.dtypes]))
    _tables(spark, tmp_path, docs, extra)
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES[:-1]:  # each on the whole table
        out = stage(spark, given, str(tmp_path))
        assert out.columns == given.columns, name
        assert 0 < out.count() <= given.count(), name
    assert P.lines(spark, given, str(tmp_path)).count() == given.count()
    pieces = P.packed(spark, given, str(tmp_path))
    assert pieces.select("doc_id").distinct().count() == given.select("doc_id").distinct().count()
    assert P.run(spark, str(tmp_path)).count() > 0


def test_empty_documents(spark, tmp_path, make_docs, extra):
    _tables(spark, tmp_path, make_docs(["x"]).limit(0), extra)
    assert P.run(spark, str(tmp_path)).collect() == []


def test_stage_folders_go(spark, tmp_path, make_docs, extra):
    import os

    from navlib.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    _tables(spark, tmp_path, make_docs([f"some words of text number {i} and more of it" for i in range(30)]), extra)
    before = {d for d in os.listdir(root) if d.startswith("pipeline-")}
    pieces = P.run(spark, str(tmp_path))
    new = {d for d in os.listdir(root) if d.startswith("pipeline-")} - before
    assert len(new) == 1 and os.listdir(f"{root}/{new.pop()}") == ["packing"] and pieces.count() > 0
