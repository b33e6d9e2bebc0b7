"""Periodic run detection with a dictionary of basic factors.

A run is a stretch of consecutive words that repeats itself with smallest
period q (words q apart are identical), is at least ``min_repeats`` periods
and ``min_length`` words long, and can't be made longer on either side.

Every text gets a dictionary of its basic factors: the factors of 1, 2, 4, …
words, each named by the pair of names of its halves, so that equal factors
have equal names.  At length L the successor of a factor is its next
occurrence in the text, looked for within twice the length that the step
before looked at.  Three occurrences at equal gaps d are an arithmetic
progression and propose the period d at their place; proposals of one period
at consecutive places are one stretch, which is the progression extended to
both sides.  Each run is reported once, as a period d is taken at the one
length with L/2 < d <= L: there a run of four periods has room for the three
occurrences, and as L >= d, the successor gap inside a run is the smallest
period itself at every place, so the stretch is the whole run.

Names are exact (words are told apart by their bytes, not by hashes).  Only
factors with three occurrences in their text go to the next length, so
ordinary texts end after two or three lengths, and memory is a few arrays
over the words of one batch slice, at any length of a text.

Nothing is shuffled: a task reads its own rows, a slice of whole texts at a time.

Defined cases: null text has no words and no runs; repeated rows get the same
result each; an empty table gives no rows; a null doc_id is a row like any
other, whose text ``repeat_tails`` leaves as it is.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navlib.llm._frames import and_fields, pick, positional, replace_columns
from navlib.llm._words import NONSPACE, chunks, distinct_words, find_words, row_of

MIN_LENGTH = 6
MIN_REPEATS = 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def find_runs(code: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS):
    """(start, length, period) of all runs in rows of word codes, by start, then period; ``first`` as in ``find_words``."""
    row = row_of(first)
    row_end = first[1:][row]
    at, size = np.arange(len(code)), 1
    key = row * (int(code.max(initial=0)) + 1) + code
    found = []
    while len(at):
        # names: places of equal factors stand together, in text order
        order = np.argsort(key, kind="stable")
        place, key = at[order], key[order]
        same = key[1:] == key[:-1]
        name = np.concatenate([[0], np.cumsum(~same)])
        gap = np.where(same, place[1:] - place[:-1], 0)
        # progressions: the successor's successor is as far away
        three = (gap[1:] == gap[:-1]) & (2 * gap[1:] > size) & (gap[1:] <= size)
        period = np.zeros(len(code), np.int64)
        period[place[:-2][three]] = gap[:-1][three]
        here = np.flatnonzero(period)
        if len(here):
            p = period[here]
            new = np.concatenate([[True], (np.diff(here) != 1) | (np.diff(p) != 0)])
            begin = np.flatnonzero(new)
            last = np.concatenate([begin[1:], [len(here)]]) - 1
            length = here[last] - here[begin] + 2 * p[begin] + size
            long = length >= np.maximum(min_length, min_repeats * p[begin])
            found.append(np.stack([here[begin], length, p[begin]])[:, long])
        # the next length: both halves occur three times in the text
        often = np.bincount(name)[name] >= 3
        named = np.full(len(code), -1, np.int64)
        named[place[often]] = name[often]
        at = np.sort(place[often])
        at = at[at + 2 * size <= row_end[at]]
        at = at[named[at + size] >= 0]
        key = named[at] * (int(name[-1]) + 1) + named[at + size]
        size *= 2
    runs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    return runs[:, np.lexsort((runs[2], runs[0]))]


def _row_lists(values: pa.Array, counts: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64()), values)


def _periodic(text: str, min_length: int, min_repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                start, end, first = find_words(data, offsets, NONSPACE)
                words = distinct_words(data, start, end)
                code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                begin, length, period = find_runs(code, first, min_length, min_repeats)
                # words that repeat the first period of a run go
                change = np.zeros(len(code) + 1, np.int64)
                np.add.at(change, begin + period, 1)
                np.add.at(change, begin + length, -1)
                kept = np.cumsum(change[:-1]) == 0
                row = row_of(first)
                rows = part.num_rows
                of = row[begin]
                runs = pa.StructArray.from_arrays([pa.array(begin - first[of]), pa.array(length), pa.array(period)], fields=list(_RUN))
                left = words.dictionary.take(pa.array(code[kept]))
                collapsed = pc.binary_join(_row_lists(left, np.bincount(row[kept], minlength=rows)), pa.scalar(b" ", pa.large_binary()))
                made = [
                    pa.array(np.diff(first)),
                    _row_lists(runs, np.bincount(of, minlength=rows)).cast(pa.list_(_RUN)),
                    collapsed.cast(pa.large_string()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """Columns of ``docs`` as c0, c1, … with n_words, runs (word numbers from 0) and the text without repeats (collapsed).

    ``min_repeats`` is 4 or more: three occurrences of a factor of up to two
    periods have room only in four periods.
    """
    if min_repeats < 4 or min_length < 1:
        raise ValueError("min_repeats must be at least 4 and min_length at least 1")
    base = positional(docs)
    return base.mapInArrow(_periodic(f"c{docs.columns.index('text')}", min_length, min_repeats), and_fields(base, _FOUND))


def collapse_repeats(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``docs`` with each run cut to its first period, words joined by one space (n_chars renewed); same columns."""
    out = periodic_runs(docs, min_length, min_repeats).withColumn("_chars", F.length("collapsed").cast("bigint"))
    return replace_columns(out, docs, {"text": "collapsed", "n_chars": "_chars"})


def _repeat_tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    word = re.compile(rb"[^\x20\x09-\x0d]+")
    for batch in batches:
        texts = batch.column("text")
        edits: list[str | None] = [None] * batch.num_rows
        for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
            if h % 10:
                continue
            text = texts[k].as_py()
            words = word.findall(text.encode()) if text else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = words[:a] + [words[a + i % p] for i in range(n - a)]
            edits[k] = b" ".join(words).decode()
        edited = pa.array(edits, pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pc.coalesce(edited, texts.cast(pa.string()))], ["doc_id", "text"])


def repeat_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten (by the checksum of its id) with its tail made periodic."""
    rows = pick(docs, doc_id="doc_id", text="text")
    return rows.mapInArrow(_repeat_tails, rows.schema)


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document, after ``repeat_tails``: n_runs, the longest run and digests of all runs and of the text without repeats."""
    found = periodic_runs(repeat_tails(docs))
    runs = F.col("runs")
    # the greatest length, then the smallest start, then the smallest period
    best = F.array_max(F.transform(runs, lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.when(F.size(runs) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("_best", best).select(
        F.col("c0").alias("doc_id"),
        F.size(runs).cast("bigint").alias("n_runs"),
        (-F.col("_best.s")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.p")).alias("period"),
        F.expr("_best.length * 1000 div -_best.p").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
