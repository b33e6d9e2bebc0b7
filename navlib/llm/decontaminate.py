"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are runs of digits, a-z and non-ASCII characters after lower-casing
A-Z.  A window is ``WINDOW_WORDS`` consecutive words of a benchmark item (an
item with fewer words is one window).  Every document is scanned once: hashes
of all its word runs are looked up in the set, each hit is verified word by
word, and words inside an occurring window are marked.

The windows travel in slices of at most ``SLICE_WINDOWS`` windows, so what is
broadcast has a fixed size bound; a larger benchmark takes one pass over the
documents for each slice, with the marks so far stored in between.

Defined cases: a null text has no words; an item without words has no
window; items with a null id are left out; item ids that repeat count once;
repeated documents are treated alike, each on its own; an empty benchmark
marks nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navlib.llm._frames import and_fields, pick, positional, replace_columns, stored
from navlib.llm._words import ALNUM, LOWER, chunks, find_words, hash_spans, row_of, window_hashes, window_starts
from navlib.session import checkpointed

WINDOW_WORDS = 10
SLICE_WINDOWS = 200_000

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_MARKS = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(item string, words string): the distinct normalised windows of every item."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    items = (
        pick(benchmark, item="item_id", text="text")
        .where(F.col("item").isNotNull())
        .select(F.col("item").cast("string").alias("item"), words.alias("w"))
        .where(F.size("w") > 0)
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (
        items.select("item", "w", F.explode(starts).alias("i"))
        .select("item", F.concat_ws(" ", F.slice("w", F.col("i"), F.lit(window))).alias("words"))
        .distinct()
    )


class _Windows:
    """A slice of windows, looked up by hash and then by their words."""

    def __init__(self, rows: pa.Table):
        self.items: dict[bytes, list[str]] = {}
        for item, words in zip(rows.column("item").to_pylist(), rows.column("words").to_pylist(), strict=True):
            self.items.setdefault(words.encode(), []).append(item)
        by_length: dict[int, list[bytes]] = {}
        for words in self.items:
            by_length.setdefault(words.count(b" ") + 1, []).append(words)
        self.hashes = {n: np.unique(self._hash(texts, n)) for n, texts in by_length.items()}
        self.filters = {}
        for n, hashes in self.hashes.items():
            bits = np.zeros(1 << max(16, int(len(hashes)).bit_length() + 4), bool)
            bits[(hashes & np.uint64(len(bits) - 1)).astype(np.int64)] = True
            self.filters[n] = bits

    @staticmethod
    def _hash(texts: list[bytes], length: int) -> np.ndarray:
        data = np.frombuffer(b" ".join(texts), np.uint8)
        start, end, _ = find_words(data, np.array([0, len(data)]), ALNUM)
        return window_hashes(hash_spans(data, start, end), length)[::length]

    def occurrences(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        """(first word, window length, items) of each verified occurrence."""
        word_hash = hash_spans(data, start, end)
        for length, hashes in self.hashes.items():
            runs = window_hashes(word_hash, length)
            bits = self.filters[length]
            near = np.flatnonzero(bits[(runs & np.uint64(len(bits) - 1)).astype(np.int64)] & window_starts(first, length))
            at = np.minimum(np.searchsorted(hashes, runs[near]), len(hashes) - 1)
            for i in near[hashes[at] == runs[near]].tolist():
                words = b" ".join([data[s:e].tobytes() for s, e in zip(start[i : i + length], end[i : i + length], strict=True)])
                if words in self.items:
                    yield i, length, self.items[words]


def _merged(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _scan(windows, text: str, again: bool):
    """Task function: the marks of each row (``again``: added to those it has)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Windows(windows.value)
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                data = LOWER[data]
                start, end, first = find_words(data, offsets, ALNUM)
                hit = np.zeros(len(start), bool)
                items: dict[int, set[str]] = {}
                rows = row_of(first)
                if again:
                    before = part.columns[-2:]
                    for row, (ids, spans) in enumerate(zip(*(c.to_pylist() for c in before), strict=True)):
                        items[row] = set(ids)
                        for span in spans:
                            hit[first[row] + span["start"] : first[row] + span["end"]] = True
                for i, length, ids in found.occurrences(data, start, end, first):
                    hit[i : i + length] = True
                    items.setdefault(int(rows[i]), set()).update(ids)
                per_row = np.add.reduceat(np.append(hit, False).astype(np.int64), first[:-1]) if len(first) > 1 else np.zeros(0, np.int64)
                per_row[np.diff(first) == 0] = 0
                spans = [_merged(hit[a:b]) if n else [] for a, b, n in zip(first[:-1], first[1:], per_row, strict=True)]
                kept = part.columns[:-4] if again else part.columns
                yield pa.RecordBatch.from_arrays(
                    [
                        *kept,
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(per_row, pa.int64()),
                        pa.array([sorted(items.get(r, ())) for r in range(part.num_rows)], pa.list_(pa.string())),
                        pa.array(spans, _SPANS),
                    ],
                    [f"c{i}" for i in range(len(kept))] + ["n_words", "n_hit", "items", "spans"],
                )

    return run


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Columns of ``docs`` as c0, c1, … plus n_words, n_hit, items (occurring item ids, sorted) and spans (of words)."""
    windows = stored(benchmark_windows(benchmark, window))
    slices = max(1, -(-windows.count() // SLICE_WINDOWS))
    numbered = windows.withColumn("slice", F.pmod(F.xxhash64("item", "words"), F.lit(slices)))
    text = f"c{docs.columns.index('text')}"
    base = positional(docs)
    schema = and_fields(base, _MARKS)
    out = base
    for k in range(slices):
        rows = numbered.where(F.col("slice") == k).select("item", "words").toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(rows)
        if k:
            out = checkpointed(out)
        out = out.mapInArrow(_scan(shared, text, k > 0), schema)
    return out


def _cut(text: str | None, spans: list, word: np.ndarray = ALNUM) -> str | None:
    if text is None or not spans:
        return text
    raw = text.encode()
    data = LOWER[np.frombuffer(raw, np.uint8)]
    start, end, _ = find_words(data, np.array([0, len(data)]), word)
    at, kept = 0, []
    for span in spans:
        kept.append(raw[at : start[span["start"]]])
        at = end[span["end"] - 1]
    return b"".join([*kept, raw[at:]]).decode()


def _cutter(text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [_cut(t, s) for t, s in zip(batch.column(text).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(cut, pa.string())], [*batch.schema.names[:-1], "cut"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "document", window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` without benchmark passages.

    ``mode="document"`` drops each document with a hit; ``"span"`` cuts the
    hit words and what stands between them out of the text (and renews
    n_chars).  Same columns as ``docs``.
    """
    marked = scan(docs, benchmark, window)
    if mode == "document":
        return replace_columns(marked.where(F.col("n_hit") == 0), docs, {})
    if mode != "span":
        raise ValueError(f"unknown mode {mode!r}")
    base = marked.drop("n_words", "n_hit", "items")
    cut = base.mapInArrow(_cutter(docs.columns.index("text")), and_fields(base.drop("spans"), "cut string"))
    return replace_columns(cut.withColumn("cut_chars", F.length("cut").cast("bigint")), docs, {"text": "cut", "n_chars": "cut_chars"})


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = scan(pick(docs, doc_id="doc_id", text="text"), benchmark, window)
    return marked.select(
        F.col("c0").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
