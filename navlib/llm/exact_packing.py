"""Packing by exact complements: combinations of lengths that fill a sequence to the last token.

Documents are tokenised with a word-level BPE vocabulary file (one end id
after each document); only documents longer than the window are cut, into
full windows and a rest.  What is packed where depends on lengths alone:

1. Tasks tokenise their rows, count their pieces by length and write the
   pieces with their number among the task's pieces of that length.
2. The number of pieces of each length, at most ``window`` numbers whatever
   the size of the corpus, is all the driver sees.  ``fill_plan`` makes
   sequence patterns from it, each with a number of copies.
3. A piece's number among all pieces of its length is its task's number plus
   the counts of the tasks before; the plan gives that number its sequence
   and place.  One join by (task, length) brings the counts to the pieces.

``fill_plan`` opens a sequence with the longest length left and closes the
gap exactly by one, two or three lengths that are still available.  Sums of
one, two and three lengths are indexed by their value: the entries of a sum are
listed when it is first asked for, longest first, and passed for good once a
member is used up, as counts only fall.  A gap that has no such combination
takes the longest length that fits and is tried again.  A sequence that
closes is used as often as the counts allow.  Openers that can't be closed
wait; what is left in the end is packed best-fit decreasing, by length too.

Defined cases: null text counts as empty, so its document is the end id
alone; repeated rows are packed each; an empty table gives no pieces; doc_id
is carried as it is.  Retried tasks give the same pieces; ranks and plan come
from the written pieces, so a lost executor changes nothing.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navlib.llm._frames import pick, stored
from navlib.llm._words import NONSPACE, byte_class, chunks, distinct_words, find_words

WINDOW = 4096
END_ID = 1
CACHE_WORDS = 1_000_000
SLICE_BYTES = 4 << 20  # words of a slice are told apart once
TOGETHER = 100

# Fixed value: the split pattern of vocabularies that keep letters, digits and other characters apart.
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_ASCII_LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A))
_MARKS = byte_class(*((ord(c), ord(c)) for c in ".,;:!?)"))

_RANK_BITS = 44
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, number bigint"


class WordTokenizer:
    """Ids of many texts by a vocabulary whose tokens never span white space; each distinct word is encoded once and then kept.

    Where the file splits letters from punctuation, a word is cut there too,
    which leaves fewer distinct ones.  Words go to the tokenizer many at a
    time, with an added token between them that tells where each ends.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        one, two = self._ids(["a", "'s"])
        for space in " \t\n\v\f\r":
            if self._ids([f"{space}a{space}{space}'s{space}"])[0] != one + two:
                raise ValueError(f"{path} keeps white space, so texts can't be encoded word by word")
        with open(path) as f:
            file = json.load(f)
        steps = (file["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.cuts = steps[0].get("pattern") == {"Regex": LETTERS_APART}
        plain = [t for t in file["added_tokens"] if not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])]
        self.mark = plain[0] if plain else None
        self._clear()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        mark = self.mark["content"] if self.mark else None
        if mark is None or any(mark in t for t in texts):
            lists = self._ids(texts)
            ids, ends = np.array([i for x in lists for i in x], np.uint32), np.cumsum([len(x) for x in lists])
        else:
            joined = [mark.join(texts[k : k + TOGETHER]) + mark for k in range(0, len(texts), TOGETHER)]
            found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
            marks = ids == self.mark["id"]
            ends = np.flatnonzero(marks) - np.arange(len(texts))
            ids = ids[~marks]
        self.known.update(zip(words, range(len(self.ends) - 1, len(self.ends) - 1 + len(words)), strict=True))
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, one after the other; row offsets in them)."""
        start, end, first = find_words(data, offsets, NONSPACE)
        if len(start) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.cuts:
            # a row never starts with a cut, as a letter of the word stands before it
            at = np.flatnonzero(_MARKS[data[1:]] & _ASCII_LETTERS[data[:-1]]) + 1
            at = at[~np.isin(at, offsets)]
            start, end = np.sort(np.concatenate([start, at])), np.sort(np.concatenate([end, at]))
            first = np.searchsorted(start, offsets)
        words = distinct_words(data, start, end)
        distinct = words.dictionary.to_pylist()
        if len(self.known) > CACHE_WORDS:
            self._clear()
        new = [w for w in distinct if w not in self.known]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        number = number[words.indices.to_numpy(zero_copy_only=False)]
        begin = self.ends[number]
        size = self.ends[number + 1] - begin
        total = np.concatenate([[0], np.cumsum(size)])
        source = np.arange(total[-1])
        source += np.repeat(begin - total[:-1], size)
        return self.ids[source], total[first]


class _Sums:
    """Available lengths and the index of their one-, two- and three-member sums."""

    def __init__(self, left: np.ndarray):
        self.left = left  # pieces left by length
        self.pairs: dict[int, list[int]] = {}
        self.triples: dict[int, list[int]] = {}

    def pair(self, total: int, beside: int = 0) -> list[int] | None:
        """Two available lengths of that sum, the longer one as long as can be; ``beside`` is taken already."""
        left = self.left
        if total not in self.pairs:
            low = np.arange(1, min(total // 2, len(left) - 1) + 1)
            low = low[(total - low < len(left))]
            self.pairs[total] = low[(left[low] > 0) & (left[total - low] > 0)][::-1].tolist()  # the last has the longest partner
        entries = self.pairs[total]
        for k in range(len(entries) - 1, -1, -1):
            a, b = entries[k], total - entries[k]
            if not left[a] or left[b] < 1 + (a == b):
                if k == len(entries) - 1:
                    entries.pop()
                continue
            if left[a] >= 1 + (a == b) + (a == beside) and left[b] >= 1 + (a == b) + (b == beside):
                return [b, a]
        return None

    def triple(self, total: int) -> list[int] | None:
        left = self.left
        if total not in self.triples:
            high = np.arange(-(-total // 3), min(total - 2, len(left) - 1) + 1)
            self.triples[total] = high[left[high] > 0].tolist()
        entries = self.triples[total]
        while entries:
            a = entries[-1]
            two = self.pair(total - a, a) if left[a] else None
            if two:
                return [a, *two]
            entries.pop()
        return None

    def close(self, gap: int) -> list[int] | None:
        """One, two or three available lengths whose sum is ``gap``."""
        return [gap] if self.left[gap] else self.pair(gap) or self.triple(gap)

    def longest(self, most: int) -> int:
        """The longest available length up to ``most``, or 0."""
        found = np.flatnonzero(self.left[: most + 1])
        return int(found[-1]) if len(found) else 0


def _exact(counts: np.ndarray, window: int) -> tuple[list[tuple[Counter, int]], np.ndarray]:
    """Patterns that fill the window exactly with their copies, and the counts that no pattern used."""
    sums = _Sums(counts)
    left, waiting, patterns = sums.left, np.zeros_like(counts), []
    while opener := sums.longest(window):
        members = Counter([opener])
        left[opener] -= 1
        gap = window - opener
        while gap and not (rest := sums.close(gap)):
            longest = sums.longest(gap)
            if not longest:
                break
            n = max(1, min(int(left[longest]), gap // longest - 3))  # three more than that could close
            members[longest] += n
            left[longest] -= n
            gap -= n * longest
        else:
            for length in rest if gap else ():
                members[length] += 1
                left[length] -= 1
            copies = 1 + min(int(left[length]) // n for length, n in members.items())
            for length, n in members.items():
                left[length] -= (copies - 1) * n
            patterns.append((members, copies))
            continue
        for length, n in members.items():
            left[length] += n
        waiting[opener] += left[opener]
        left[opener] = 0
    return patterns, waiting


def _best_fit(counts: np.ndarray, window: int) -> list[tuple[Counter, int]]:
    """Best-fit decreasing of all pieces, with equal sequences handled at once."""
    open_: dict[int, list[tuple[Counter, int]]] = {window: []}  # by room left
    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        for room in sorted(r for r in open_ if r >= length):
            for members, copies in open_.pop(room) if n else ():
                each = room // length
                full = min(copies, n // each)
                n -= full * each
                parts = [(each, full)]
                if full < copies and n:
                    parts.append((n, 1))
                    n = 0
                parts.append((0, copies - sum(c for _, c in parts)))
                for more, c in parts:
                    if c:
                        open_.setdefault(room - more * length, []).append((members + Counter({length: more}), c))
        each = window // length
        for more, c in ((each, n // each), (n % each, 1)):
            if more and c:
                open_.setdefault(window - more * length, []).append((Counter({length: more}), c))
    return [p for same in open_.values() for p in same]


def fill_plan(counts: np.ndarray, window: int) -> list[tuple[Counter, int]]:
    """(lengths of a sequence, copies of it): every piece counted in ``counts[length]`` is in one sequence."""
    exact, rest = _exact(np.array(counts, np.int64), window)
    return exact + _best_fit(rest, window)


def _slots(plan: list[tuple[Counter, int]]) -> np.ndarray:
    """Rows (key of length and first rank, pieces of that length per sequence, first sequence, first offset), by key."""
    used: Counter = Counter()
    slots, sequence = [], 0
    for members, copies in plan:
        offset = 0
        for length, n in sorted(members.items(), reverse=True):
            slots.append(((length << _RANK_BITS) | used[length], n, sequence, offset))
            used[length] += n * copies
            offset += n * length
        sequence += copies
    return np.array(sorted(slots), np.int64).reshape(-1, 4).T


def _tokenise(path: str, window: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(path)
        task, end = TaskContext.get().partitionId(), np.array([end_id], "<u4")
        made = np.zeros(window + 1, np.int64)
        for batch in batches:
            for part, data, offsets in chunks(batch, size=SLICE_BYTES):
                ids, first = tokenizer.encode(data, offsets)
                rows: list[tuple] = []
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                    document = np.concatenate([ids[a:b], end]).astype("<u4")
                    for piece, start in enumerate(range(0, len(document), window)):
                        cut = document[start : start + window]
                        rows.append((doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes()), task, int(made[len(cut)]), cut.astype(np.int32)))
                        made[len(cut)] += 1
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number", "ids"]
                n = 7 + with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:n], kinds, strict=False)], names[:n])

    return run


def _place(slots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, each, sequence, offset = slots
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, (length << _RANK_BITS) | rank, "right") - 1
            turn = rank - (key[at] & ((1 << _RANK_BITS) - 1))
            places = [pa.array(sequence[at] + turn // each[at]), pa.array(offset[at] + turn % each[at] * length)]
            kept = [(batch.column(c), c) for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([c for c, _ in kept] + places, [c for _, c in kept] + ["sequence_id", "offset"])

    return run


def pack_exactly(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of documents with their place in as few sequences of at most ``window`` ids as the plan needs.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    with ``with_ids`` the piece's ids (before sequence_id).  ``vocabulary``
    is the path of a tokenizer file that every executor can read.
    """
    ids = ", ids array<int>" if with_ids else ""
    rows = pick(docs, doc_id="doc_id", text="text")
    pieces = stored(rows.mapInArrow(_tokenise(vocabulary, window, end_id, with_ids), _PIECES + ids))
    by_task = stored(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")))
    counts = np.zeros(window + 1, np.int64)
    for length, n in by_task.groupBy("length").agg(F.sum("n")).collect():  # at most ``window`` rows
        counts[length] = n
    slots = _slots(fill_plan(counts, window))
    # one row per task and length: a window holds as many rows as there are tasks
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # the counts grow with the tasks, so they are no side to broadcast
    ranked = pieces.join(base.hint("merge"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, (F.col("number") + F.col("base")).alias("rank")
    )
    kind = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ids + ", sequence_id bigint, `offset` bigint"
    return ranked.mapInArrow(_place(slots), kind)


def joined(pieces: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): whole sequences from pieces with ids."""
    rows = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten("p.ids")
    return rows.select("sequence_id", F.size(ids).alias("length"), ids.alias("ids"))
