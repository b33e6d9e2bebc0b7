"""Substring dedup: Rabin-Karp hashes of every 13-word window, counted in Spark.

A word is a run of bytes other than ASCII white space.  A word is removed if
a window of ``WINDOW_WORDS`` words that covers it also starts, with the same
words, in a document with a smaller doc_id.

Every window is judged, but few travel.  The windows of a document fall into
segments: consecutive windows whose smallest ``SEED_WORDS``-word hash is at
the same place (equal windows have equal seeds).  (1) Seeds are counted; only
those that occur in two or more documents go on.  (2) Segments with the same
words share all their windows, so the smallest doc_id of a segment settles
the later ones whole.  (3) First segments whose seed occurs in an earlier
document, in other surroundings, are settled window by window.  All three
steps aggregate map-side before they shuffle and join on hashes, where
adaptive execution can split a hot key; a group is never gathered.

Defined cases: null text has no words; fewer than 13 words are never
removed; rows with one doc_id are no earlier than each other; a null doc_id
counts as larger than all others; repeated rows get the same result each.
Segments are told apart by two 64-bit hashes (seed and words), single
windows by two as well; they are not compared word by word.  A document may have
up to 2^29 words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navlib.llm._frames import and_fields, pick, positional, replace_columns, stored
from navlib.llm._words import NONSPACE, chunks, find_words, hash_spans, mix, row_of, window_hashes, window_starts

WINDOW_WORDS = 13
SEED_WORDS = 7

_LAST = (1 << 63) - 1
_U = np.uint64
_OTHER = _U(0xA24BAED4963EE407)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, text): null ids last."""
    return pick(docs, doc="doc_id", text="text").withColumn("doc", F.coalesce(F.col("doc").cast("bigint"), F.lit(_LAST)))


def _texts_crc(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tells the texts of repeated doc_ids apart."""
    raw = data.tobytes()
    return np.array([zlib.crc32(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)


def _segments_of(data: np.ndarray, offsets: np.ndarray, window: int, seed: int):
    """Per segment of the chunk: seed hash, first window (word), windows, row; and the word hashes and rows' first words."""
    start, end, first = find_words(data, offsets, NONSPACE)
    word_hash = hash_spans(data, start, end)
    whole = np.flatnonzero(window_starts(first, window))
    seeds = window_hashes(word_hash, seed)
    width = window - seed + 1
    n = len(word_hash) - window + 1
    if len(whole) == 0:
        return None
    least = seeds[:n].copy()
    for j in range(1, width):
        np.minimum(least, seeds[j : j + n], out=least)
    place = np.zeros(n, np.int64)
    for j in range(width - 1, -1, -1):
        same = seeds[j : j + n] == least
        place[same] = np.flatnonzero(same) + j
    at = place[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1] + 1)
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(whole)))
    return seeds[at[head]], whole[head], size, at[head] - whole[head], word_hash, first


def _segments(window: int, seed: int, full: bool):
    """Task function: (seed, doc) of each segment, with ``full`` also segment hash and tag.

    tag: CRC of the text, first window and number of windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch):
                found = _segments_of(data, offsets, window, seed)
                if found is None:
                    continue
                seeds, whole, size, shift, word_hash, first = found
                row = row_of(first)[whole]
                doc = part.column("doc").to_numpy()[row]
                if not full:
                    yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(doc)], ["seed", "doc"])
                    continue
                # all words of the segment: its first and last window with their distance to the seed say it all
                windows = window_hashes(word_hash, window)
                segment = mix(windows[whole] + mix(windows[whole + size - 1] + (size * 64 + shift).astype(_U)))
                tag = (_texts_crc(part, data, offsets)[row] << 32) | ((whole - first[row]) << 3) | size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds.view(np.int64)), pa.array(segment.view(np.int64)), pa.array(doc), pa.array(tag)],
                    ["seed", "segment", "doc", "tag"],
                )

    return run


def _with_crc(keyed: DataFrame, text: str = "text") -> DataFrame:
    """``keyed`` with the CRC of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_texts_crc(part, data, offsets))], [*part.schema.names, "crc"])

    return keyed.mapInArrow(run, and_fields(keyed, "crc bigint"))


def _windows(window: int):
    """Task function: hashes of the windows in the segments listed with each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch):
                start, end, first = find_words(data, offsets, NONSPACE)
                word_hash = hash_spans(data, start, end)
                hashes, others = window_hashes(word_hash, window), window_hashes(mix(word_hash + _OTHER), window)
                listed = part.column("tags")
                tags = listed.flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), listed.value_lengths().to_numpy())
                size = tags & 7
                pos = np.repeat((tags & 0xFFFFFFFF) >> 3, size)
                pos += np.arange(len(pos)) - np.repeat(np.cumsum(size) - size, size)
                row = np.repeat(row, size)
                late = np.repeat((tags >> 32) & 1, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[first[row] + pos].view(np.int64)),
                        pa.array(others[first[row] + pos].view(np.int64)),
                        pa.array(part.column("doc").to_numpy()[row]),
                        pa.array(part.column("crc").to_numpy()[row]),
                        pa.array(pos),
                        pa.array(late.astype(bool)),
                    ],
                    ["hash", "other", "doc", "crc", "pos", "late"],
                )

    return run


def repeated_windows(docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS) -> DataFrame:
    """(doc, crc, pos, size): runs of ``size`` windows from word ``pos`` on that start in an earlier document too."""
    keyed = _keyed(docs)
    seeds = keyed.mapInArrow(_segments(window, seed, False), "seed bigint, doc bigint")
    repeated = stored(
        seeds.groupBy("seed").agg(F.min("doc").alias("seed_doc"), F.max("doc").alias("last")).where("seed_doc < last").drop("last")
    )
    segments = keyed.mapInArrow(_segments(window, seed, True), "seed bigint, segment bigint, doc bigint, tag bigint")
    known = stored(segments.join(repeated, "seed"))
    # stored, like every sum that is joined back: only a join of two shuffles can split a hot key
    firsts = stored(known.groupBy("seed", "segment").agg(F.min("doc").alias("segment_doc")))
    known = stored(known.join(firsts, ["seed", "segment"]).drop("segment"))
    place = (
        F.col("doc"),
        F.shiftrightunsigned("tag", 32).alias("crc"),
        F.shiftright(F.col("tag").bitwiseAND(F.lit(0xFFFFFFFF)), 3).alias("pos"),
        F.col("tag").bitwiseAND(F.lit(7)).alias("size"),
    )
    settled = known.where("segment_doc < doc").select(*place)
    first = known.where("segment_doc = doc")
    open_seeds = stored(first.groupBy("seed").agg(F.max(F.col("seed_doc") < F.col("doc")).alias("open")).where("open").select("seed"))
    late = F.when(F.col("seed_doc") < F.col("doc"), F.lit(1 << 32)).otherwise(F.lit(0))
    listed = (
        first.join(open_seeds, "seed")
        .select("doc", F.shiftrightunsigned("tag", 32).alias("crc"), F.col("tag").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(late).alias("tag"))
        .groupBy("doc", "crc")
        .agg(F.collect_set("tag").alias("tags"))
    )
    windows = stored(
        _with_crc(keyed)
        .join(listed, ["doc", "crc"])
        .select("doc", "crc", "text", "tags")
        .mapInArrow(_windows(window), "hash bigint, other bigint, doc bigint, crc bigint, pos bigint, late boolean")
    )
    least = stored(windows.groupBy("hash", "other").agg(F.min("doc").alias("least")))
    single = windows.where("late").join(least, ["hash", "other"]).where("least < doc").select("doc", "crc", "pos", F.lit(1).cast("bigint").alias("size"))
    return settled.unionByName(single)


def _remove(window: int, text: str):
    """Task function: texts without the listed windows, and the maximal intervals removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, texts, intervals = [], [], [], []
            for value, runs in zip(batch.column(text), batch.column("runs"), strict=True):
                words = (value.as_py() or "").encode().split()
                merged: list[list[int]] = []
                for pos, size in sorted((r["pos"], r["size"]) for r in runs.as_py() or ()):
                    end = pos + size - 1 + window
                    if merged and pos <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([pos, end])
                kept, at = [], 0
                for a, b in merged:
                    kept += words[at:a]
                    at = b
                kept = kept + words[at:] if merged else words
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept).decode())
                intervals.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(texts, pa.string()),
                    pa.array(intervals, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                [*batch.schema.names[:-1], "n_words", "n_removed", "kept", "removed"],
            )

    return run


def remove_substrings(docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS) -> DataFrame:
    """Columns of ``docs`` as c0, c1, … plus n_words, n_removed, kept (words joined by a space), removed (intervals of words)."""
    runs = (
        repeated_windows(docs, window, seed)
        .groupBy("doc", "crc")
        .agg(F.collect_list(F.struct("pos", "size")).alias("runs"))
    )
    base = positional(docs)
    text, doc = (f"c{docs.columns.index(n)}" for n in ("text", "doc_id"))
    keyed = _with_crc(base.withColumn("doc", F.coalesce(F.col(doc).cast("bigint"), F.lit(_LAST))), text)
    joined = keyed.join(runs, ["doc", "crc"], "left").select(*base.columns, "runs")
    made = "n_words bigint, n_removed bigint, kept string, removed array<struct<start:bigint,end:bigint>>"
    return joined.mapInArrow(_remove(window, text), and_fields(base, made))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated windows removed from text (n_chars renewed); same columns."""
    out = remove_substrings(docs).withColumn("kept_chars", F.length("kept").cast("bigint"))
    return replace_columns(out, docs, {"text": "kept", "n_chars": "kept_chars"})


def removals(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    return remove_substrings(pick(docs, doc_id="doc_id", text="text")).select(
        F.col("c0").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
