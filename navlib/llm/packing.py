"""Sequence packing by best-fit decreasing.

Documents are tokenised with a byte-level BPE vocabulary file (one end id
after each document).  A document longer than the window is first cut into
full windows; what is left of each, longest first, goes into the open
sequence with the least room that still holds it, which a segment tree over
remaining capacity finds.

Every task packs the documents of its own input split, in flushes of
``FLUSH`` remainders, so there is no shuffle and memory doesn't grow with the
split; sequence ids carry the partition in their high bits.  Padding is what
stays free in the last few sequences of a flush.

Tokenising works on a batch at a time: numpy finds the pieces that the
vocabulary's split pattern would give (checked against the tokenizer in
tests), and the tokenizer sees each distinct piece once.  Pieces are told
apart by 64-bit hashes of their bytes.

Texts are split at the vocabulary file's added tokens first, as the tokenizer
does: such a string gives its id, the parts between are tokenised each.

Defined cases: null text counts as empty, so its document is the end id
alone; repeated rows are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navlib.llm._frames import pick
from navlib.llm._words import chunks, hash_spans

WINDOW = 2048
END_ID = 1
FLUSH = 200_000
CACHE_PIECES = 100_000

_PARTITION_SHIFT = 40
_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint"
)
SPACE, LETTER, NUMBER, OTHER = range(4)


def _code_point_classes() -> np.ndarray:
    """Class of every code point, as in the split pattern's \\s, \\p{L}, \\p{N} and the rest."""
    import regex

    classes = np.full(0x110000, OTHER, np.uint8)
    kinds = [(regex.compile(pattern), kind) for pattern, kind in ((r"\s+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER))]
    for block in range(0, 0x110000, 0x800):  # no more memory than a few of them take
        if 0xD800 <= block < 0xE000:
            continue
        text = "".join(map(chr, range(block, block + 0x800)))
        for pattern, kind in kinds:
            for m in pattern.finditer(text):
                classes[block + m.start() : block + m.end()] = kind
    return classes


class Pieces:
    """Pre-tokens of many texts at once."""

    def __init__(self) -> None:
        self.classes = _code_point_classes()

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte starts of all pieces, first piece of each row and one more)."""
        if len(data) == 0:
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte place of each code point
        kind = self.classes[codes]
        n = len(codes)
        rows = np.searchsorted(lead, offsets)
        border = np.zeros(n + 1, bool)
        border[rows] = True
        start = np.empty(n, bool)
        start[0] = True
        start[1:] = kind[1:] != kind[:-1]
        start |= border[:n]
        space = kind == SPACE
        # the last white space before other characters of its row stands alone, or joins them if it is a blank
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~border[1:n]
        start |= last
        blank = last & (codes == 0x20)
        joined = np.flatnonzero(blank) + 1
        start[joined] = False
        # contractions: an apostrophe alone, at the start of a piece, then letters
        quote = np.flatnonzero((codes == 0x27) & start)
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == LETTER) & ~border[quote + 1]]
        for q in quote.tolist():
            two = codes[q + 1 : q + 3]
            if two[0] in (0x73, 0x74, 0x6D, 0x64):
                end = q + 2
            elif len(two) == 2 and not border[q + 2] and (int(two[0]), int(two[1])) in ((0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)):
                end = q + 3
            else:
                continue
            start[q + 1] = False
            if end < n:
                start[end] = True
        at = np.flatnonzero(start)
        return lead[at], np.searchsorted(at, rows)


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write byte b as chr(b) if that can be seen, else as the next free one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    unseen = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(unseen)}


def load_encoder(path: str):
    """The vocabulary file as a tiktoken encoding (whose merges follow the ids, as in this kind of file)."""
    import tiktoken

    with open(path) as f:
        file = json.load(f)
    byte = _byte_of_character()
    special = {t["content"] for t in file["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in file["model"]["vocab"].items() if token not in special}
    merged = [ranks[bytes(byte[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in file["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"merges of {path} are not in the order of the ids")
    return tiktoken.Encoding("vocabulary", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def load_added(path: str) -> dict[bytes, int]:
    """The ids of the vocabulary file's added tokens, longest first; they are found as plain strings."""
    with open(path) as f:
        tokens = json.load(f)["added_tokens"]
    odd = [t["content"] for t in tokens if any(t.get(k) for k in ("single_word", "lstrip", "rstrip"))]
    if odd:
        raise ValueError(f"added tokens of {path} that are not plain strings: {odd}")
    found = {t["content"].encode(): t["id"] for t in tokens if t["content"]}
    return dict(sorted(found.items(), key=lambda x: -len(x[0])))


class BatchTokenizer:
    """Ids of many texts; each distinct piece is encoded once and then kept."""

    def __init__(self, path: str):
        self.encoder = load_encoder(path)
        self.added = load_added(path)
        self.added_pattern = re.compile(b"|".join(map(re.escape, self.added))) if self.added else None
        self.pieces = Pieces()
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = array("I")
        self.ends = array("q", [0])

    def encode_documents(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, but with added tokens by their ids."""
        raw = data.tobytes()
        found = []
        if self.added_pattern is not None and self.added_pattern.search(raw):
            rows = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            found = [m for a, b in rows for m in self.added_pattern.finditer(raw, a, b)]
        if not found:
            return self.encode(data, offsets)
        start = np.array([m.start() for m in found], np.int64)
        borders = np.unique(np.concatenate([offsets, start, [m.end() for m in found]]))
        ids, first = self.encode(data, borders)
        # of a part that is an added token, the first id becomes the token's and the others go
        keep = np.ones(len(ids), bool)
        part = np.searchsorted(borders, start)
        for a, b in zip(first[part].tolist(), first[part + 1].tolist(), strict=True):
            keep[a + 1 : b] = False
        ids[first[part]] = [self.added[m[0]] for m in found]
        kept = np.concatenate([[0], np.cumsum(keep)])
        return ids[keep], kept[first[np.searchsorted(borders, offsets)]]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows as ordinary text, one after the other; row offsets in them)."""
        at, first = self.pieces.split(data, offsets)
        if len(at) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        end = np.append(at[1:], len(data))
        hashes, where, back = np.unique(hash_spans(data, at, end), return_index=True, return_inverse=True)
        if len(self.known) > CACHE_PIECES:
            self._clear()
        known = self.known
        number = np.array([known.get(h, -1) for h in hashes.tolist()], np.int64)
        new = np.flatnonzero(number < 0)
        raw = data.tobytes()
        spans = zip(at[where[new]].tolist(), end[where[new]].tolist(), strict=True)
        count, encode = len(self.ends) - 1, self.encoder.encode_ordinary
        for a, b in spans:
            self.ids.extend(encode(raw[a:b].decode()))
            self.ends.append(len(self.ids))
        number[new] = np.arange(count, count + len(new))
        known.update(zip(hashes[new].tolist(), range(count, count + len(new)), strict=True))
        ids, ends = np.array(self.ids), np.array(self.ends)
        used = number[back]
        size = (ends[1:] - ends[:-1])[used]
        total = np.concatenate([[0], np.cumsum(size)])
        source = np.arange(total[-1])
        source += np.repeat(ends[used] - total[:-1], size)
        return ids[source], total[first]


class _OpenSequences:
    """Open sequences by remaining room; the tightest that fits is found in a segment tree."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()  # leaves 0 … size-1: one for each room
        self.count = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, sequence: int) -> None:
        self.at[room].append(sequence)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(sequence, room) of the tightest open sequence with room for ``need``."""
        count, node = self.count, need + self.size
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node <<= 1
                if not count[node]:
                    node += 1
        room = node - self.size
        while node:
            count[node] -= 1
            node >>= 1
        return self.at[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each length and the number of sequences; equal lengths keep their order."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, made = _OpenSequences(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = open_.take(need)
        if found is None:
            found = (made, window)
            made += 1
        sequence[i], offset[i] = found[0], window - found[1]
        if found[1] > need:
            open_.add(found[1] - need, found[0])
    return sequence, offset, made


def _pack(path: str, window: int, end_id: int, flush: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = BatchTokenizer(path)
        base = TaskContext.get().partitionId() << _PARTITION_SHIFT
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

        def out(rows: list[tuple], sequence, offset) -> pa.RecordBatch:
            columns = list(zip(*[r[:5] for r in rows], strict=True)) if rows else [()] * 5
            arrays = [pa.array(c, pa.int64()) for c in (*columns, sequence, offset)]
            if with_ids:
                arrays.append(pa.array([r[5] for r in rows], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names)

        rest: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            nonlocal base
            sequence, offset, made = best_fit_decreasing(np.array([r[2] for r in rest], np.int64), window)
            batch = out(rest, sequence + base, offset)
            base += made
            rest.clear()
            return batch

        for batch in batches:
            for part, data, offsets in chunks(batch):
                ids, first = tokenizer.encode_documents(data, offsets)
                full: list[tuple] = []
                end = np.array([end_id], "<u4")
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                    document = np.concatenate([ids[a:b], end]).astype("<u4")
                    total = b - a + 1
                    for start in range(0, total, window):
                        piece = document[start : start + window]
                        row = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), total, *([piece.astype(np.int32)] * with_ids))
                        (full if len(piece) == window else rest).append(row)
                if full:
                    yield out(full, np.arange(len(full)) + base, np.zeros(len(full), np.int64))
                    base += len(full)
                if len(rest) >= flush:
                    yield flushed()
        if rest:
            yield flushed()

    return run


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of documents with their place in sequences of at most ``window`` ids.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and with ``with_ids`` the piece's ids.  ``vocabulary`` is the path of a
    tokenizer file that every executor can read.
    """
    kind = _PIECES + (", ids array<int>" if with_ids else "")
    return pick(docs, doc_id="doc_id", text="text").mapInArrow(_pack(vocabulary, window, end_id, FLUSH, with_ids), kind)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """(sequence_id, length, ids): whole sequences from pieces with ids, padded unless their length is a power of two."""
    rows = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten("p.ids")
    length = F.size(ids)
    power = F.bit_count(length) == 1
    padding = F.array_repeat(F.lit(pad_id), F.when(power, 0).otherwise(F.lit(window) - length))
    return rows.select("sequence_id", length.alias("length"), F.concat(ids, padding).alias("ids"))
