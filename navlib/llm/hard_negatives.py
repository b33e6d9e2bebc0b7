"""Hard-negative mining with Fagin's threshold algorithm.

For an anchor vector, its best rows of the same label are its positives; for
each positive the negatives are the best rows of other labels whose score lies
in a window below the positive's.  Scores are integer inner products of scaled
vectors, so that they are exact and the order is total.

Rows are dealt at random into blocks, anchors into slices, and every (block,
slice) pair is one group with a bounded number of rows; the whole query set
meets all rows, and no pair is shuffled.  In a group the block has one sorted
list per dimension.  An anchor reads all lists in step from the end that its
sign favours (sorted access); each row met is scored whole (random access), and
the sum of the contributions at the current depth bounds every row not met
yet.  Reading stops when that threshold is strictly below the k-th score of
each of the anchor's windows, or below the window's lower end; ties are thus
never cut.  What the groups keep, k rows a window, is merged by Spark.

One such job finds the positives, a second one the negatives of all windows
of an anchor in one pass over the lists.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part; missing components of shorter vectors count as 0;
scaled components are held to +-2^26, so that scores of up to 1,024 components
are longs; a null id is no anchor and comes last among ties; repeated rows are
rows of their own, and only the anchor's own row is not its positive; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navlib.llm._frames import pick, stored

BLOCK_ROWS = 16384
SLICE_ANCHORS = 2048
SMALL_BLOCK = 1024  # blocks aren't made smaller than this to give every core work
FIRST_DEPTH = 16
LARGEST = 1 << 26
MOST_DIMENSIONS = 1024

_NONE = (1 << 63) - 1


class Block:
    """Vectors of one block with a sorted list per dimension."""

    def __init__(self, x: np.ndarray, key: np.ndarray, rid: np.ndarray):
        self.x, self.key, self.rid = x, key, rid
        lists = np.ascontiguousarray(x.T)
        self.order = np.argsort(lists, axis=1, kind="stable")
        self.values = np.take_along_axis(lists, self.order, axis=1)

    def best(self, a: np.ndarray, eligible: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, scores) of the first ``k`` eligible rows of each window [low, high], by score, then key."""
        n = len(self.x)
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        seen = np.zeros(n, bool)
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(windows)
        depth, threshold = 0, None
        running = {w for w, (low, high) in enumerate(windows) if low <= high}
        while running and not seen.all():
            to = min(n, max(FIRST_DEPTH, 2 * depth))
            met = np.zeros(n, bool)
            met[self.order[up, n - to : n - depth]] = True
            met[self.order[down, depth:to]] = True
            if not len(up) + len(down):
                met[:] = True  # all rows score 0 and no list orders them
            new = np.flatnonzero(met & ~seen & eligible)
            seen |= met
            depth = to
            score = (self.x[new] @ a).astype(np.int64)
            # no row that is not met yet has more than this
            threshold = int(a[up] @ self.values[up, n - depth] + a[down] @ self.values[down, depth - 1])
            for w in list(running):
                low, high = windows[w]
                hit = (score >= low) & (score <= high)
                rows, scores = np.concatenate([kept[w][0], new[hit]]), np.concatenate([kept[w][1], score[hit]])
                if len(rows) > k:
                    least = np.partition(scores, len(scores) - k)[len(scores) - k]
                    rows, scores = rows[scores >= least], scores[scores >= least]
                    first = np.lexsort((self.rid[rows], self.key[rows], -scores))[:k]
                    rows, scores = rows[first], scores[first]
                kept[w] = rows, scores
                if threshold < (int(scores.min()) if len(rows) == k else low):
                    running.remove(w)
        return kept


def _matrix(column: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    """Rows of the column, filled up with zeros."""
    lists = column.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    x = np.zeros((len(lists), dimensions), np.int64)
    x[np.arange(dimensions) < size[:, None]] = lists.flatten().to_numpy()
    return x


def _groups(search: Callable, dimensions: int):
    """Task function over one (block, slice): ``search`` gives the result rows of an anchor."""

    def run(group: pa.Table) -> pa.Table:
        names = ["anchor", "turn", "rid", "id", "score"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        is_anchor = group.column("is_anchor")
        rows, anchors = group.filter(pa.compute.invert(is_anchor)), group.filter(is_anchor)
        out: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            x, a = _matrix(rows.column("v"), dimensions), _matrix(anchors.column("v"), dimensions)
            # as doubles where all inner products are exact in them
            if int(abs(x).max(initial=0)) * int(abs(a).max(initial=0)) * max(dimensions, 1) < 1 << 53:
                x, a = x.astype(np.float64), a.astype(np.float64)
            ids = rows.column("id")
            key = pa.compute.fill_null(ids, _NONE).to_numpy()
            block = Block(x, key, rows.column("rid").to_numpy())
            label = rows.column("label").to_numpy()
            for k, anchor in enumerate(anchors.select(["rid", "label", "scores"]).to_pylist()):
                for turn, (found, scores) in enumerate(search(block, label, a[k], anchor)):
                    for r, s in zip(found.tolist(), scores.tolist(), strict=True):
                        out.append((anchor["rid"], turn, int(block.rid[r]), ids[r].as_py(), s))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    return run


def _positives(k: int):
    def search(block: Block, label: np.ndarray, a: np.ndarray, anchor: dict):
        return block.best(a, (label == anchor["label"]) & (block.rid != anchor["rid"]), [(-_NONE, _NONE)], k)

    return search


def _negatives(k: int, low_percent: int, high_percent: int):
    def search(block: Block, label: np.ndarray, a: np.ndarray, anchor: dict):
        # whole numbers s with low * p <= 100 * s <= high * p
        windows = [(-(-p * low_percent // 100), p * high_percent // 100) for p in anchor["scores"]]
        return block.best(a, label != anchor["label"], windows, k)

    return search


def _search(rows: DataFrame, anchors: DataFrame, slices: int, blocks: int, search: Callable, dimensions: int, k: int) -> DataFrame:
    """(anchor, turn, rid, id, score, place): the first ``k`` rows of each window of each anchor; ``place`` from 1."""
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    left = rows.select("block", every(slices, "slice"), F.lit(False).alias("is_anchor"), "rid", "label", "id", "v", F.lit(None).cast("array<bigint>").alias("scores"))
    right = anchors.select(every(blocks, "block"), "slice", F.lit(True).alias("is_anchor"), "rid", "label", "id", "v", "scores")
    found = left.unionByName(right).groupBy("block", "slice").applyInArrow(_groups(search, dimensions), "anchor bigint, turn int, rid bigint, id bigint, score bigint")
    first = Window.partitionBy("anchor", "turn").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "rid")
    return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)


def prepared(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(rid, label, id, v) of the rows that take part, with scaled whole components and a place by chance; stored."""
    rows = pick(vectors, id="vec_id", label="label", e="embedding")
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("e").isNotNull()).where(finite)
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")
    return stored(
        rows.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col("label").cast("int").alias("label"),
            F.col("id").cast("bigint").alias("id"),
            F.transform("e", whole).alias("v"),
            F.rand(1).alias("p"),
            F.rand(2).alias("q"),
        )
    )


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: int = 256,
) -> DataFrame:
    """Hard negatives of the rows for which ``is_anchor`` (over ``id`` and ``label``) holds.

    ``vectors`` has vec_id, embedding and label.  Returns anchor_id,
    positive_id, rank (from 1), negative_id, positive_score and
    negative_score.  Negatives have scores from ``low_percent`` to
    ``high_percent`` of the positive's.
    """
    rows = prepared(vectors, scale)
    chosen = F.col("id").isNotNull() & F.coalesce(is_anchor, F.lit(False))
    n, n_anchors, dimensions = rows.agg(F.count(F.lit(1)), F.count_if(chosen), F.max(F.size("v"))).first()
    dimensions = dimensions or 0
    if dimensions > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {dimensions} components, more than {MOST_DIMENSIONS}")
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // BLOCK_ROWS), min(2 * cores, n // SMALL_BLOCK))
    slices = max(1, -(-n_anchors // SLICE_ANCHORS))
    rows = rows.withColumn("block", F.floor(F.col("p") * blocks).cast("int")).withColumn("slice", F.floor(F.col("q") * slices).cast("int"))
    anchors = rows.where(chosen)
    none = F.lit(None).cast("array<bigint>")
    best = stored(_search(rows, anchors.withColumn("scores", none), slices, blocks, _positives(positives), dimensions, positives))
    asked = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("w"))
    asked = stored(asked.join(anchors.withColumnRenamed("rid", "anchor").withColumnRenamed("id", "anchor_id"), "anchor"))
    again = asked.select(F.col("anchor").alias("rid"), F.col("anchor_id").alias("id"), "label", "v", "slice", F.col("w.score").alias("scores"))
    found = _search(rows, again, slices, blocks, _negatives(negatives, low_percent, high_percent), dimensions, negatives)
    pairs = asked.select("anchor", "anchor_id", F.posexplode("w").alias("turn", "w"))
    return found.join(pairs, ["anchor", "turn"]).select(
        "anchor_id",
        F.col("w.id").alias("positive_id"),
        F.col("place").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("w.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def mined(embeddings: DataFrame) -> DataFrame:
    """The registered query: labels of every seventh id are moved on, every hundredth id is an anchor."""
    rows = pick(embeddings, vec_id="vec_id", embedding="embedding", label="label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM a.vec_id),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""
