import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from navlib.llm import exact_packing as E
from navlib.llm._words import text_bytes

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]


def test_words_match_the_tokenizer(reference):
    rng = random.Random(1)
    alphabet = list("abST'' \t\n\v\f\r'lvre12½Ⅷé日本　ΣİǅKß\u0085.!-😀̧́\u001c\u001f‍<|>") + ["<|endoftext|>", "<|startoftext|>", "text|>", "\r\n", " ́", "a.", "b,,", "s?)", "a;̸", ":'s"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["", " ", "ΑΣ ΑΣ", "don't 's", "'LL x", "é e ́", None]
    tokenizer, plain = E.WordTokenizer(PATH), E.WordTokenizer(PATH)
    plain.cuts, plain.mark = False, None
    assert tokenizer.cuts and tokenizer.mark["content"] == "<|startoftext|>"
    expected = reference([t or "" for t in texts])
    for t in (tokenizer, plain):
        for at in (0, 1000, 2000):  # words of the first slice are known in the next
            ids, first = t.encode(*text_bytes(pa.array(texts[at : at + 1000] if at < 2000 else texts[at:])))
            for i, want in enumerate(expected[at : at + 1000] if at < 2000 else expected[at:]):
                assert ids[first[i] : first[i + 1]].tolist() == want, texts[at + i]
    ids, first = E.WordTokenizer(PATH).encode(*text_bytes(pa.array(["a", ".b", "c.", ")"])))
    assert np.diff(first).tolist() == [1, 2, 2, 1]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        E.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def planned(counts, window):
    plan = E.fill_plan(np.array(counts), window)
    used = Counter()
    for members, copies in plan:
        assert copies > 0 and sum(k * n for k, n in members.items()) <= window
        for k, n in members.items():
            used[k] += n * copies
    assert {k: n for k, n in used.items() if n} == {k: n for k, n in enumerate(counts) if n}
    return sum(copies for _, copies in plan)


def fewest(counts, window):
    """The least number of sequences, by search."""

    @lru_cache(None)
    def fill(left, room):
        """Least further sequences; the open one has ``room``."""
        if not any(left):
            return 0
        best = 99
        for k in range(len(left) - 1, 0, -1):
            if left[k]:
                less = left[:k] + (left[k] - 1,) + left[k + 1 :]
                best = min(best, fill(less, room - k) if k <= room else 1 + fill(less, window - k))
        return best

    return fill(tuple(counts), 0)


def test_plan_against_search():
    rng = random.Random(2)
    over = 0
    for _ in range(150):
        window = rng.randint(5, 12)
        counts = [0] * (window + 1)
        for _ in range(rng.randint(0, 9)):
            counts[rng.randint(1, window)] += 1
        least, got = fewest(counts, window), planned(counts, window)
        assert least <= got <= least + 1
        over += got > least
    assert over <= 5


def test_plan_of_few_lengths():
    counts = np.zeros(4097, np.int64)
    counts[[1, 700, 1365, 1366, 2048]] = 4000
    assert planned(counts.tolist(), 4096) <= sum(c for _, c in E._best_fit(counts, 4096))


@pytest.mark.parametrize("kind", ["short", "long", "mixed", "huge counts"])
def test_plan_nears_the_bound(kind):
    rng = np.random.default_rng(3)
    window = 4096
    lengths = {
        "short": rng.integers(1, 400, 20_000),
        "long": rng.integers(2100, 4097, 5_000),
        "mixed": np.minimum(4096, rng.lognormal(5.5, 1.2, 30_000).astype(int) + 1),
        "huge counts": rng.integers(1, 3000, 20_000),
    }[kind]
    counts = np.bincount(lengths, minlength=window + 1)
    if kind == "huge counts":
        counts *= 10**9
    total = int(counts @ np.arange(window + 1))
    bound = max(-(-total // window), int(counts[window // 2 + 1 :].sum()))
    assert planned(counts.tolist(), window) <= bound * 1.002 + 2


def test_best_fit_is_decreasing_best_fit():
    rng = random.Random(5)
    for _ in range(200):
        window = rng.randint(6, 40)
        counts = np.zeros(window + 1, np.int64)
        for _ in range(rng.randint(1, 60)):
            counts[rng.randint(1, window)] += 1
        rooms: list[int] = []
        for n in np.repeat(np.arange(window + 1), counts)[::-1].tolist():
            fits = [(room, k) for k, room in enumerate(rooms) if room >= n]
            if fits:
                rooms[min(fits)[1]] -= n
            else:
                rooms.append(window - n)
        got = [window - sum(k * n for k, n in m.items()) for m, c in E._best_fit(counts, window) for _ in range(c)]
        assert sorted(got) == sorted(rooms)


def check(rows, docs, reference, window=4096):
    ids = reference([t or "" for _, t in docs])
    want = []
    for (doc_id, _), x in zip(docs, ids, strict=True):
        x = [*x, 1]
        for piece, start in enumerate(range(0, len(x), window)):
            cut = np.array(x[start : start + window], "<u4")
            want.append((doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    total = sum(r.length for r in rows)
    return len(places), -(-total // window)


def test_round_trip(make_docs, odd_texts, extra, reference):
    docs = list(enumerate(odd_texts)) + [(None, "null id"), (3, odd_texts[3]), (700, "x " * 30_000), (701, "<|endoftext|> y" * 3000)]
    rows = E.pack_exactly(extra(make_docs(docs)).repartition(5), PATH)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(rows.collect(), docs, reference)


def test_given_tables_few_sequences(spark, reference):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    used, bound = check(E.pack_exactly(df, PATH).collect(), [tuple(r) for r in df.select("doc_id", "text").collect()], reference)
    assert used <= bound + 1


def test_hot_length_and_ids(make_docs, reference):
    docs = [(i, "a b c") for i in range(3000)] + [(5000 + i, "d " * (i % 70)) for i in range(500)]
    pieces = E.pack_exactly(make_docs(docs).repartition(7), PATH, window=64, with_ids=True)
    rows = pieces.collect()
    used, bound = check(rows, docs, reference, 64)
    assert used <= bound + 1
    whole = {r.sequence_id: r for r in E.joined(pieces).collect()}
    for r in rows:
        assert whole[r.sequence_id].ids[r.offset : r.offset + r.length] == r.ids


def test_empty_table(make_docs):
    assert E.pack_exactly(make_docs(["x"]).limit(0), PATH).collect() == []
