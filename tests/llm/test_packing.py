import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from navlib.llm import packing as P
from navlib.llm._words import text_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]


def check(rows, docs, reference, window=2048):
    """Exact round trip: ids of every piece, their cover, gapless sequences."""
    ids = {i: x + [1] for i, x in enumerate(reference([t or "" for _, t in docs]))}
    spans, places = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        places[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        want[doc_id].append(ids[i])
    assert set(spans) == set(want)
    for doc_id, pieces in spans.items():
        expected = []
        for x in want[doc_id]:
            for s in range(0, len(x), window):
                piece = np.array(x[s : s + window], "<u4")
                expected.append((s, len(piece), zlib.crc32(piece.tobytes()), len(x)))
        assert sorted(pieces) == sorted(expected)
    padding = total = 0
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
        total += at
    return padding, total


def test_pieces_match_the_tokenizer(reference):
    rng = random.Random(1)
    alphabet = list("abcdst'' '  \n\t\r lvreLM12½Ⅷé日本 　\u0085​,.!?_-😀́ß\u001c\u001f")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["don't", "it''s", "a 't b", "x\n'll", "'re're", "'sam", "a  ", "a \n b", "<|endoftext|>", "", "'"]
    ids, first = P.BatchTokenizer(PATH).encode(*text_bytes(pa.array(texts)))
    for i, expected in enumerate(reference(texts)):
        assert ids[first[i] : first[i + 1]].tolist() == expected, texts[i]


@pytest.fixture(scope="module")
def unchanged():
    """The tokenizer as its file gives it, which finds added tokens inside texts."""
    t = Tokenizer.from_file(PATH)
    return lambda texts: [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]


def test_added_tokens_match_the_tokenizer(unchanged):
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<|endoftext|>", "<|endof", "text|>", "<", " ", "\n", "a", "don", "'t", "12", "日本", ""]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", "<|endoftext|>", "", "<|endof", "text|>", "a  <|endoftext|>  ", "'<|endoftext|>s"]
    ids, first = P.BatchTokenizer(PATH).encode_documents(*text_bytes(pa.array(texts)))
    assert len(first) == len(texts) + 1
    for i, expected in enumerate(unchanged(texts)):
        assert ids[first[i] : first[i + 1]].tolist() == expected, texts[i]
    assert 50256 in ids


def test_pack_with_added_tokens(make_docs, odd_texts, unchanged):
    texts = [t if t is None or i % 2 else t[: len(t) // 2] + "<|endoftext|>" + t[len(t) // 2 :] for i, t in enumerate(odd_texts)]
    docs = list(enumerate(texts)) + [(900, "x<|endoftext|>" * 3000)]
    check(P.pack(make_docs(docs).repartition(3), PATH).collect(), docs, unchanged)


def test_best_fit_decreasing_against_search():
    rng = random.Random(2)
    for window in (7, 64, 100):
        lengths = np.array([rng.randint(1, window) for _ in range(300)])
        sequence, offset, made = P.best_fit_decreasing(lengths, window)
        rooms: list[int] = []
        used = defaultdict(list)
        for n in sorted(lengths.tolist(), reverse=True):
            fits = [(room, k) for k, room in enumerate(rooms) if room >= n]
            if fits:
                rooms[min(fits)[1]] -= n
            else:
                rooms.append(window - n)
        for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths.tolist(), strict=True):
            used[s].append((o, n))
        got = sorted(window - sum(n for _, n in x) for x in used.values())
        assert made == len(rooms) == len(used) and got == sorted(rooms)
        assert all(o == sum(m for p, m in x if p < o) for x in used.values() for o, _ in x)


def test_round_trip(make_docs, odd_texts, extra, reference):
    docs = list(enumerate(odd_texts)) + [(None, "null id"), (3, odd_texts[3])]
    rows = P.pack(extra(make_docs(docs)).repartition(3), PATH).collect()
    check(rows, docs, reference)


def test_given_tables_little_padding(spark, reference):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    padding, total = check(P.pack(df, PATH).collect(), [tuple(r) for r in df.select("doc_id", "text").collect()], reference)
    assert padding < 0.01 * total


def test_flushes_and_sequences(make_docs, reference, monkeypatch):
    monkeypatch.setattr(P, "FLUSH", 4)
    docs = make_docs(["a b c"] * 30 + ["d " * 5000])
    pieces = P.pack(docs, PATH, window=64, with_ids=True)
    check(pieces.collect(), [(i, t) for i, t in enumerate(["a b c"] * 30 + ["d " * 5000])], reference, 64)
    for r in P.sequences(pieces, window=64).collect():
        assert len(r.ids) == 64 or len(r.ids) & (len(r.ids) - 1) == 0


def test_empty_table(make_docs):
    assert P.pack(make_docs(["x"]).limit(0), PATH).collect() == []
