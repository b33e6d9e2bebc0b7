"""Near-duplicate classes by DartMinHash signatures and a banded join.

Elements are the ``SHINGLE_WORDS``-word shingles of a text (one of all its
words, if it has fewer), weighted by how often they occur; likeness is the
weighted Jaccard similarity, and texts at ``THRESHOLD`` or more are linked.

Signature: for each element, hashed darts fall on the plane of weight and
rank, one a unit of area on average.  A dart counts if it lies below the
element's weight; it belongs to one of ``COORDINATES`` coordinates, and each
keeps its dart of lowest rank.  Rank regions are thrown in rising order until
every coordinate has one, so a signature costs about the text's length.  Two
texts agree in a coordinate with the probability of their similarity.

Join: equal texts are one node.  Nodes that agree in one of ``BANDS`` bands of
``BAND_ROWS`` coordinates are candidates (a pair at 0.8 is missed with
probability 5e-5).  No bucket emits its pairs: each member meets the bucket's
leader, the member that shares most buckets with others, and then, where
members are still in different classes, a second leader.  Pairs are checked by
their exact similarity; links form classes (connected components).  What is
left, members of one bucket in different classes, is settled exactly: members
whose elements occur in other classes often enough for a link are compared
with each other, in blocks that give links and no pairs.

Defined cases: null and empty texts are equal texts without elements, their
documents form one class; class_id is the smallest doc_id of the class, null
if it has none; repeated rows are in one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navlib.llm._frames import pick, positional, replace_columns, small_side, stored, unstore
from navlib.llm._words import NONSPACE, chunks, find_words, hash_spans, mix, window_hashes

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS = 25
BAND_ROWS = 5
COORDINATES = BANDS * BAND_ROWS
BROADCAST_NODES = 500_000
BLOCK_ROWS = 256
BLOCK_ELEMENTS = 500_000

_NO_ID = -(1 << 63)

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
#: rank regions: a part of the first unit, the rest of it, then doubling
_REGIONS = [(0.0, 1 / 16), (1 / 16, 1 / 4), (1 / 4, 1.0)] + [(float(1 << k), float(2 << k)) for k in range(40)]


def elements(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, weight) of the distinct shingles of each row, by row and hash."""
    start, end, first = find_words(data, offsets, NONSPACE)
    word_hash = hash_spans(data, start, end)
    n = np.diff(first)
    runs = window_hashes(word_hash, SHINGLE_WORDS)
    size = np.maximum(n - SHINGLE_WORDS + 1, 0)
    row = np.repeat(np.arange(len(n)), size)
    hashes = runs[np.repeat(first[:-1], size) + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)]
    short = np.flatnonzero((n > 0) & (n < SHINGLE_WORDS))
    whole = np.array([_fold(word_hash[first[r] : first[r + 1]]) for r in short], _U)
    row, hashes = np.concatenate([row, short]), np.concatenate([hashes, whole])
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return row[at], hashes[at], np.diff(np.append(at, len(row))).astype(float)


def _fold(words: np.ndarray) -> int:
    h = np.array([len(words)], _U)
    for w in words:
        h = mix(h * _STEP + w)
    return int(h[0])


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> _U(11)).astype(float) * 2.0**-53


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    term, total, bounds = np.exp(-mean), 0.0, []
    for k in range(1, 40):
        total += term
        bounds.append(total)
        term *= mean / k
    return np.searchsorted(bounds, u, "right")


def signatures(row: np.ndarray, hashes: np.ndarray, weights: np.ndarray, rows: int, coordinates: int = COORDINATES) -> np.ndarray:
    """rows x coordinates: the id of the earliest dart of each coordinate; rows without elements stay at 0."""
    none = _U(0xFFFFFFFFFFFFFFFF)
    best = np.full(rows * coordinates, none)
    has = np.zeros(rows, bool)
    has[row] = True
    cells = np.ceil(weights).astype(np.int64)  # cells of unit weight; the last may count in part
    element = np.repeat(np.arange(len(row)), cells)
    floor = (np.arange(len(element)) - np.repeat(np.cumsum(cells) - cells, cells)).astype(float)
    seed = mix(hashes[element] + mix(floor.astype(_U) + _STEP))
    part = weights[element] - floor
    cell_row = row[element]
    for k, (low, high) in enumerate(_REGIONS):
        if len(cell_row) == 0:
            break
        pieces = max(1, int(high - low))  # a region of more than unit area is cut into units
        area = (high - low) / pieces
        cell = np.repeat(np.arange(len(cell_row)), pieces)
        piece = np.tile(np.arange(pieces), len(cell_row))
        base = mix(seed[cell] + mix((piece + (k << 42)).astype(_U)))
        darts = _poisson(_unit(base), area)
        which = np.repeat(np.arange(len(cell)), darts)
        number = np.arange(len(which)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(base[which] + (number + 1).astype(_U) * _STEP)
        rank = (piece[which] + _unit(mix(dart ^ _U(0xA5A5A5A5)))) / pieces
        counts = _unit(mix(dart ^ _U(0x5A5A5A5A))) < part[cell[which]]
        place = cell_row[cell[which]] * coordinates + ((dart >> _U(32)) % _U(coordinates)).astype(np.int64)
        open_ = best == none  # a coordinate filled in an earlier region has a lower rank
        counts &= open_[place]
        value = ((rank * 2.0**31).astype(_U) << _U(32)) | (dart & _U(0xFFFFFFFF))
        np.minimum.at(best, place[counts], value[counts])
        more = (has & (best.reshape(rows, coordinates) == none).any(axis=1))[cell_row]
        seed, part, cell_row = seed[more], part[more], cell_row[more]
    return (best & _U(0xFFFFFFFF)).reshape(rows, coordinates)


def _node(text: Column) -> Column:
    """Equal texts are one node: 16 bytes that stand for the text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, node) for each band of each row that has elements."""
    for batch in batches:
        for part, data, offsets in chunks(batch):
            row, hashes, weights = elements(data, offsets)
            signature = signatures(row, hashes, weights, part.num_rows)
            rows = np.unique(row)
            if len(rows) == 0:
                continue
            band = np.tile(mix(np.arange(1, BANDS + 1).astype(_U)), (len(rows), 1))
            for k in range(BAND_ROWS):
                band = mix(band * _STEP + signature[rows][:, k::BAND_ROWS])
            node = part.column("node").take(pa.array(np.repeat(rows, BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(band.ravel().view(np.int64)), node], ["band", "node"])


def _element_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, set): elements numbered by occurrence, so that set similarity is weighted similarity."""
    for batch in batches:
        for part, data, offsets in chunks(batch):
            row, hashes, weights = elements(data, offsets)
            n = weights.astype(np.int64)
            which = np.repeat(np.arange(len(row)), n)
            number = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            values = mix(hashes[which] + mix(number.astype(_U) + _STEP)).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[which], minlength=part.num_rows))])
            sets = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(values)).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("node"), sets], ["node", "set"])


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose similarity is at least THRESHOLD.  ``pairs`` has a and b."""
    left, right = sets.select(F.col("node").alias("a"), F.col("set").alias("x")), sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    linked = common >= F.lit(THRESHOLD) * (F.size("x") + F.size("y") - common)
    return both.where(linked).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, class): the least node that can be reached over ``links`` (a, b); nodes without links are their own.

    Each step takes the least label of the neighbours and then that label's
    label, so that chains shrink by halves; every step is stored, and the one before is deleted.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels, mark = nodes.select("node", F.col("node").alias("class")), None
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "class"), "b").select(F.col("a").alias("node"), "class")
        least = stored(near.unionByName(labels).groupBy("node").agg(F.min("class").alias("class")))
        up = least.select(F.col("node").alias("n"), F.col("class").alias("c"))
        last, labels = labels if mark is not None else None, stored(least.join(up, F.col("class") == F.col("n")).select("node", F.col("c").alias("class")))
        for done in (least, last):
            if done is not None:
                unstore(done)
        # labels only ever fall, so an equal sum of their hashes means that none did
        before, mark = mark, labels.agg(F.sum(F.xxhash64("node", "class").cast("decimal(38,0)"))).first()[0]
        if mark == before:
            unstore(both)
            return labels


def _candidates(keyed: DataFrame) -> DataFrame:
    """(band, node, members): the buckets of two or more nodes."""
    bands = stored(keyed.mapInArrow(_bands, "band bigint, node binary").distinct())
    # stored, like every sum that is joined back: only a join of two shuffles can split a hot key
    counts = stored(bands.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    return stored(bands.join(counts, "band"))


def _leader_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each member with the bucket's member of the most shared buckets.  ``members`` has band, node, weight."""
    leaders = stored(members.groupBy("band").agg(F.max(F.struct("weight", "node")).alias("top")).select("band", F.col("top.node").alias("b")))
    return members.join(leaders, "band").where(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b").distinct()


def _in_mixed_buckets(rows: DataFrame) -> DataFrame:
    """The rows of the buckets (band) with more than one class."""
    rows = stored(rows)
    span = rows.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return stored(rows.join(stored(span.where("low <> high").select("band")), "band"))


def _unsettled(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(band, node, weight, class) of the buckets whose members are in more than one class."""
    known = members.join(classes, "node")
    return _in_mixed_buckets(known)


def _second_leader_pairs(rest: DataFrame) -> DataFrame:
    """(a, b): members with the best member outside the first leader's class, if in other classes."""
    best = F.max(F.struct("weight", "node", "class")).alias("top")
    first = stored(rest.groupBy("band").agg(best).select("band", F.col("top.class").alias("first")))
    others = rest.join(first, "band").where(F.col("class") != F.col("first"))
    second = stored(others.groupBy("band").agg(best).select("band", F.col("top.node").alias("b"), F.col("top.class").alias("other")))
    return rest.join(second, "band").where(F.col("class") != F.col("other")).select(F.col("node").alias("a"), "b").distinct()


def _open_rows(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """(band, node, class, size): members that may still be linked to a member of their bucket in another class.

    A node's elements that occur in other classes bound what it can have in
    common with a node there.
    """
    nodes = rest.select("node", "class").distinct()
    each = stored(sets.join(nodes, "node").select("node", "class", F.size("set").alias("size"), F.explode("set").alias("element")))
    span = each.groupBy("element").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    shared = stored(span.where("low <> high").select("element"))
    common = each.join(shared, "element").groupBy("node").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("common"))
    may = common.where(F.col("common") >= F.lit(THRESHOLD) * F.col("size")).drop("common")
    return _in_mixed_buckets(rest.join(may, "node").select("band", "node", "class", "size"))


def _block_links(key: tuple, rows: pa.Table) -> pa.Table:
    """(a, b): for each right row and class of left rows, one link between them, if there is any."""
    left, right = (rows.filter(pc.equal(rows["side"], s)).combine_chunks() for s in (0, 1))
    out_a, out_b = [], []
    if left.num_rows and right.num_rows:
        sets = left["set"].combine_chunks()
        size = sets.value_lengths().to_numpy()
        values, owner = sets.flatten().to_numpy(), np.repeat(np.arange(len(size)), size)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        classes = left["class"].to_pylist()
        for i in range(right.num_rows):
            own = right["set"][i].values.to_numpy()
            low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            n = high - low
            places = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            common = np.bincount(owner[places], minlength=len(size))
            linked = np.flatnonzero(common >= THRESHOLD * (size + len(own) - common))
            for k in {classes[k]: k for k in linked.tolist() if classes[k] != right["class"][i].as_py()}.values():
                out_a.append(left["node"][k].as_py())
                out_b.append(right["node"][i].as_py())
    return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})


def _last_links(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between members of a bucket in different classes, by comparing all that may be linked.

    Of two classes at most one is the bucket's largest, so it is enough to
    compare each member with those outside the largest class.  Both sides are
    cut into blocks of about ``BLOCK_ROWS`` rows or ``BLOCK_ELEMENTS``
    elements; a task compares two blocks and gives links only, so no bucket
    comes together in one task and no pairs are written.
    """
    rows = _open_rows(rest, sets)
    counts = rows.groupBy("band", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("elements"))
    total = counts.groupBy("band").agg(F.max(F.struct("n", "class", "elements")).alias("top"), F.sum("n").alias("n"), F.sum("elements").alias("elements"))
    blocks = lambda n, elements: F.ceil(F.greatest(n / BLOCK_ROWS, elements / BLOCK_ELEMENTS, F.lit(1.0))).cast("int")
    total = stored(
        total.select(
            "band",
            F.col("top.class").alias("largest"),
            blocks(F.col("n"), F.col("elements")).alias("left"),
            blocks(F.col("n") - F.col("top.n"), F.col("elements") - F.col("top.elements")).alias("right"),
        )
    )
    rows = rows.join(total, "band").join(sets, "node")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.select("band", own("left").alias("i"), every("right").alias("j"), F.lit(0).alias("side"), "node", "class", "set")
    right = rows.where(F.col("class") != F.col("largest")).select(
        "band", every("left").alias("i"), own("right").alias("j"), F.lit(1).alias("side"), "node", "class", "set"
    )
    found = left.unionByName(right).groupBy("band", "i", "j").applyInArrow(_block_links, "a binary, b binary")
    return found.distinct()


def _id(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID))


def node_classes(keyed: DataFrame) -> DataFrame:
    """(node, class) of the nodes that share a bucket with another.  ``keyed`` has id, text and node."""
    members = _candidates(keyed)
    weights = members.groupBy("node").agg(F.sum("members").alias("weight"))
    members = stored(members.drop("members").join(weights, "node"))
    nodes = stored(members.select("node").distinct())
    # the text of each of those nodes, from the row with its smallest id
    first = keyed.select("node", "id").join(small_side(nodes, BROADCAST_NODES), "node", "left_semi").groupBy("node").agg(F.min("id").alias("id"))
    one = keyed.join(small_side(first, BROADCAST_NODES), ["node", "id"], "left_semi")
    sets = stored(one.mapInArrow(_element_sets, "node binary, set array<bigint>").dropDuplicates(["node"]))

    links = stored(_links(_leader_pairs(members), sets))
    for more in (lambda rest: _links(_second_leader_pairs(rest), sets), lambda rest: _last_links(rest, sets)):
        classes = components(nodes, links)
        rest = _unsettled(members, classes)
        if rest.limit(1).count() == 0:
            return classes
        links = stored(links.unionByName(more(rest)))
    return components(nodes, links)


def _grouped(docs: DataFrame) -> DataFrame:
    """(id, doc_id, node, group): the class of each row, named by a node."""
    keyed = pick(docs, doc_id="doc_id", text="text").select(_id().alias("id"), "doc_id", "text", _node(F.col("text")).alias("node"))
    classes = node_classes(keyed.select("id", "text", "node"))
    return keyed.select("id", "doc_id", "node").join(classes, "node", "left").select("id", "doc_id", "node", F.coalesce("class", "node").alias("group"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id (the smallest doc_id of its class) and class_size (rows)."""
    rows = stored(_grouped(docs).select("doc_id", "group"))
    groups = stored(rows.groupBy("group").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")))
    return rows.join(groups, "group").select("doc_id", "class_id", "class_size")


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest doc_id (a null one only if there is no other)."""
    ids = stored(_grouped(docs).select("id", "node", "group"))
    order = F.struct((F.col("id") == _NO_ID).alias("none"), "id", "node")
    best = ids.groupBy("group").agg(F.min(order).alias("best")).select("group", F.col("best.id").alias("best_id"), F.col("best.node").alias("best_node"))
    best = stored(best)
    gone = ids.join(best, "group").where((F.col("id") != F.col("best_id")) | (F.col("node") != F.col("best_node")))
    gone = small_side(gone.select("id", "node").distinct(), BROADCAST_NODES)
    base = positional(docs)
    doc_id, text = (f"c{docs.columns.index(n)}" for n in ("doc_id", "text"))
    keyed = base.withColumn("id", _id(doc_id)).withColumn("node", _node(F.col(text)))
    kept = keyed.join(gone, ["id", "node"], "left_anti")
    twice = ids.groupBy("id", "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "node")
    twice = small_side(twice, BROADCAST_NODES)
    if twice.limit(1).count():
        again = kept.join(twice, ["id", "node"], "left_semi").dropDuplicates(["id", "node"])
        kept = kept.join(twice, ["id", "node"], "left_anti").unionByName(again)
    return replace_columns(kept, docs, {})
