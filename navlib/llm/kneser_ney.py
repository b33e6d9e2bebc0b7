"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model has n-grams of ``ORDER`` UTF-8 bytes, so an n-gram is an integer and
no vocabulary is needed.  It is trained on the trusted documents (labelled
good and not toxic) but every fourth, by a hash of doc_id, which is held out:
a model knows its own text too well to set thresholds on it.  Tasks pre-count n-grams, Spark sums them sharded by
n-gram, and joins between the orders give continuation counts, discounts,
back-off weights and probabilities.  A document's perplexity is compared with
its language's ``QUANTILE`` among held-out trusted documents.

Scoring broadcasts the finished model only if it has at most ``MODEL_ROWS``
rows; a larger one is joined, sharded by n-gram, with the documents' n-gram
counts.  Log probabilities are whole millionths, so both ways and any order of
summing give the same result.

The mean over few bytes varies most, so thresholds narrow with a document's length:
what is compared is how far its log perplexity lies above its language's trusted
mean in units of the spread of such a mean, which falls with the root of the
bytes (and ``PRIOR_BYTES`` more).  A long text of one repeated word is then
as far out as it is, though its bytes are only a little dearer than usual.

Defined cases: a null or empty text has no perplexity and is rejected; a null
language is a language of its own; a language without trusted documents takes
the threshold and mean of all of them; without any held-out trusted document
nothing is rejected but empty texts; repeated rows are judged alike; label rows that
repeat count once, and a document with contradicting labels is not trusted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navlib.llm._frames import and_fields, pick, positional, replace_columns, small_side, stored
from navlib.llm._words import chunks

ORDER = 5
QUANTILE = 0.99
#: one trusted document in so many is kept out of training, for the thresholds
HELD_OUT = 4
#: a language's quantile is drawn towards that of all as by so many texts
PRIOR_TEXTS = 200
PRIOR_BYTES = 100
#: added to every threshold, in the units compared, for the spread of quantiles of few texts
SLACK = 0.8
MAX_LANGUAGES = 10_000
MODEL_ROWS = 2_000_000
BROADCAST_TRUSTED = 2_000_000

_UNIT = 1_000_000  # log probabilities are kept as whole millionths
_STEP = _UNIT // 100
_HELD_GRAMS = 400_000
_CHUNK = 1 << 19  # bytes at a time; each takes about 60 bytes of memory
_NO_ID = -(1 << 63)


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each byte, as an integer; bytes before a text count as 0."""
    pad, rows = order - 1, len(offsets) - 1
    at = np.arange(len(data)) + np.repeat(pad * np.arange(1, rows + 1), np.diff(offsets))
    padded = np.zeros(len(data) + pad * rows, np.int64)
    padded[at] = data
    gram = padded.copy()
    for k in range(1, order):
        gram[k:] += padded[:-k] << (8 * k)
    return gram[at]


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
            grams, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return grams, np.bincount(back, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)

        held: list = []
        for batch in batches:
            for _, data, offsets in chunks(batch, size=_CHUNK):
                held.append(np.unique(_grams(data, offsets, order), return_counts=True))
                if sum(len(p[0]) for p in held) > _HELD_GRAMS:
                    held = [summed(held)]
                    if len(held[0][0]) > _HELD_GRAMS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held.pop()], ["gram", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in summed(held)], ["gram", "n"])

    return run


def _suffix(gram: Column, size: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (8 * size)) - 1))


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ of an order, from its counts of counts; the usual middle values where they are not defined."""
    n = counts.agg(*[F.sum((F.col("n") == k).cast("int")).alias(f"n{k}") for k in range(1, 5)]).first()
    n1, n2, n3, n4 = (x or 0 for x in n)
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    found = [1 - 2 * y * n2 / n1 if n1 else 0, 2 - 3 * y * n3 / n2 if n2 else 0, 3 - 4 * y * n4 / n3 if n3 else 0]
    return [d if 0 < d <= k + 1 else (k + 1) / 2 for k, d in enumerate(found)]


def train(trusted: DataFrame, order: int = ORDER) -> DataFrame:
    """(size, history, gram, cost): cost of each seen n-gram, and of backing off from each seen history.

    ``trusted`` has a text column.  Costs are negative log probabilities in
    millionths; a history row costs its back-off weight.
    """
    counted = trusted.select("text").mapInArrow(_count(order), "gram bigint, n bigint")
    counts = {order: stored(counted.groupBy("gram").agg(F.sum("n").alias("n")))}
    for size in range(order - 1, 0, -1):
        counts[size] = counts[size + 1].groupBy(_suffix(F.col("gram"), size).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    rows, lower = None, None
    for size in range(1, order + 1):
        level = counts[size] = counts[size] if size == order else stored(counts[size])
        d1, d2, d3 = _discounts(level)
        n = F.col("n")
        discount = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        level = level.withColumn("history", F.shiftright("gram", 8)).withColumn("discount", discount)
        histories = level.groupBy("history").agg(F.sum("n").alias("total"), F.sum("discount").alias("held_back"))
        histories = histories.select("history", "total", (F.col("held_back") / F.col("total")).alias("back"))
        level = level.join(histories, "history").withColumn("suffix", _suffix(F.col("gram"), size - 1))
        if lower is None:
            level = level.withColumn("p_lower", F.lit(1 / 256))
        else:
            level = level.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("p_lower")), "suffix")
        p = (n - F.col("discount")) / F.col("total") + F.col("back") * F.col("p_lower")
        lower = stored(level.select("gram", p.alias("p")))
        part = lower.select(F.lit(size).alias("size"), F.lit(False).alias("history"), "gram", F.col("p").alias("x")).unionByName(
            histories.select(F.lit(size).alias("size"), F.lit(True).alias("history"), F.col("history").alias("gram"), F.col("back").alias("x"))
        )
        rows = part if rows is None else rows.unionByName(part)
    return stored(rows.select("size", "history", "gram", F.round(-F.log("x") * _UNIT).cast("bigint").alias("cost")))


_UNSEEN = round(np.log(256) * _UNIT)


class _Lookup:
    """The model as sorted arrays."""

    def __init__(self, rows: pa.Table, order: int):
        self.order = order
        size, history, gram, cost = (rows.column(c).to_numpy() for c in ("size", "history", "gram", "cost"))
        self.tables = {}
        for k in range(1, order + 1):
            for back in (False, True):
                use = (size == k) & (history == back)
                by = np.argsort(gram[use])
                self.tables[k, back] = gram[use][by], cost[use][by]

    def _find(self, size: int, back: bool, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, costs = self.tables[size, back]
        if len(keys) == 0:
            return np.zeros(len(gram), bool), np.zeros(len(gram), np.int64)
        at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
        return keys[at] == gram, costs[at]

    def cost(self, gram: np.ndarray) -> np.ndarray:
        """Cost of each n-gram, backing off where it wasn't seen."""
        total = np.zeros(len(gram), np.int64)
        open_ = np.arange(len(gram))
        for size in range(self.order, 0, -1):
            g = gram[open_] & ((1 << (8 * size)) - 1)
            seen, cost = self._find(size, False, g)
            known, back = self._find(size, True, g >> 8)
            total[open_] += np.where(seen, cost, np.where(known, back, 0))
            open_ = open_[~seen]
        total[open_] += _UNSEEN
        return total


def _score(model, column: str, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(model.value, order)
        for batch in batches:
            for part, data, offsets in chunks(batch, column, _CHUNK):
                grams, back = np.unique(_grams(data, offsets, order), return_inverse=True)
                sums = np.concatenate([[0], np.cumsum(lookup.cost(grams)[back])])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(sums[offsets])), pa.array(np.diff(offsets), pa.int64())],
                    [*part.schema.names, "cost", "n_bytes"],
                )

    return run


def _row_grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, size=_CHUNK):
                grams = _grams(data, offsets, order)
                for row in range(part.num_rows):
                    gram, n = np.unique(grams[offsets[row] : offsets[row + 1]], return_counts=True)
                    keys = [pa.array(np.full(len(gram), part.column(k)[row].as_py()), pa.int64()) for k in ("key", "hash")]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array(gram), pa.array(n, pa.int64())], ["key", "hash", "gram", "n"])

    return run


def _score_by_join(base: DataFrame, doc_id: str, text: str, model: DataFrame, order: int) -> DataFrame:
    """The same sums with the model sharded by n-gram; equal (doc_id, text) rows share one sum."""
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID))
    keyed = base.withColumn("key", key).withColumn("hash", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    grams = (
        keyed.select("key", "hash", F.col(text).alias("text"))
        .mapInArrow(_row_grams(order), "key bigint, hash bigint, gram bigint, n bigint")
        .groupBy("key", "hash", "gram")
        .agg(F.max("n").alias("n"))
    )
    costs = grams.select("gram").distinct().withColumn("cost", F.lit(0).cast("bigint")).withColumn("done", F.lit(False))
    for size in range(order, 0, -1):
        seen = model.where((F.col("size") == size) & ~F.col("history")).select(F.col("gram").alias("g"), F.col("cost").alias("seen"))
        back = model.where((F.col("size") == size) & F.col("history")).select(F.col("gram").alias("h"), F.col("cost").alias("back"))
        g = _suffix(F.col("gram"), size)
        more = F.when(F.col("done"), 0).otherwise(F.coalesce("seen", "back", F.lit(0)))
        costs = (
            costs.join(seen, g == F.col("g"), "left")
            .join(back, F.shiftright(g, 8) == F.col("h"), "left")
            .select("gram", (F.col("cost") + more).alias("cost"), (F.col("done") | F.col("seen").isNotNull()).alias("done"))
        )
    costs = costs.select("gram", (F.col("cost") + F.when(F.col("done"), 0).otherwise(_UNSEEN)).alias("cost"))
    sums = grams.join(costs, "gram").groupBy("key", "hash").agg(F.sum(F.col("n") * F.col("cost")).alias("cost"))
    n_bytes = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint")
    return (
        keyed.join(sums, ["key", "hash"], "left")
        .select(*base.columns, F.coalesce("cost", F.lit(0)).cast("bigint").alias("cost"), n_bytes.alias("n_bytes"))
    )


def score(docs: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """Columns of ``docs`` as c0, c1, … plus cost (millionths of nats) and n_bytes."""
    base = positional(docs)
    doc_id, text = (f"c{docs.columns.index(n)}" for n in ("doc_id", "text"))
    if model.limit(MODEL_ROWS + 1).count() > MODEL_ROWS:
        return _score_by_join(base, doc_id, text, model, order)
    shared = docs.sparkSession.sparkContext.broadcast(model.toArrow())  # plain data: executors build the lookup
    return base.mapInArrow(_score(shared, text, order), and_fields(base, "cost bigint, n_bytes bigint"))


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, lang) of the documents that are labelled good, and not toxic, by all their labels."""
    ids = (
        pick(labels, doc_id="doc_id", quality="quality", toxic="toxic")
        .where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"))
        .where("good")
        .select("doc_id")
    )
    return pick(docs, doc_id="doc_id", text="text", lang="lang").join(small_side(ids, BROADCAST_TRUSTED), "doc_id", "left_semi")


def _above(mean: Column) -> Column:
    """How far the log perplexity lies above ``mean``, in units of its spread."""
    return (F.col("cost") - F.col("n_bytes") * mean) / F.sqrt(F.col("n_bytes") + PRIOR_BYTES)


def _quantile(bins: DataFrame, by: list[str], quantile: float) -> DataFrame:
    """The least bin up to which at least ``quantile`` of each group's texts lie."""
    group = Window.partitionBy(*by)
    running = bins.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("texts", F.sum("n").over(group))
    return running.where(F.col("upto") >= F.col("texts") * quantile).groupBy(*by).agg(F.min("bin").alias("bin"), F.max("texts").alias("texts"))


def _thresholds(scored: DataFrame, quantile: float) -> tuple[DataFrame, tuple[float | None, float | None]]:
    """(lang, mean a byte, limit in the units compared) of each language, and the pair for any other.

    ``scored`` has lang, cost and n_bytes.  The quantile is taken of how far
    texts lie above their language's mean, in steps of a hundredth: counts by step, then running sums, so a language with a third of all
    texts is no large group.  Each language takes its own quantile, averaged by
    numbers of texts with that of all, which counts as ``PRIOR_TEXTS`` texts.
    """
    texts = scored.where(F.col("n_bytes") > 0)
    means = small_side(texts.groupBy("lang").agg((F.sum("cost") / F.sum("n_bytes")).alias("mean")), MAX_LANGUAGES)
    means = means.select(F.col("lang").alias("own"), "mean")
    above = F.ceil(_above(F.col("mean")) / _STEP)
    bins = stored(
        texts.join(means, F.col("lang").eqNullSafe(F.col("own"))).groupBy("lang", above.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    pooled = _quantile(bins.groupBy("bin").agg(F.sum("n").alias("n")).withColumn("all", F.lit(True)), ["all"], quantile).first()
    mean = texts.agg(F.sum("cost") / F.sum("n_bytes")).first()[0]
    if pooled is None:
        return means.select(F.col("own").alias("lang"), "mean", F.lit(0.0).alias("limit")), (None, None)
    shrunk = (F.col("texts") * F.col("bin") + PRIOR_TEXTS * pooled.bin) / (F.col("texts") + PRIOR_TEXTS)
    step = shrunk + round(SLACK * _UNIT / _STEP)
    limits = means.join(_quantile(bins, ["lang"], quantile), F.col("own").eqNullSafe(F.col("lang")))
    return limits.select(F.col("own").alias("lang"), "mean", (step * _STEP).alias("limit")), (mean, pooled.bin * _STEP + SLACK * _UNIT)


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, order: int = ORDER) -> DataFrame:
    """Columns of ``docs`` as c0, c1, … plus n_bytes, perplexity, threshold (both per byte, for a text of that length) and keep."""
    trusted = trusted_documents(docs, labels)
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    model = train(trusted.where(~held_out), order)
    scored = score(trusted.where(held_out), model, order).select(F.col("c2").alias("lang"), "cost", "n_bytes")
    limits, (mean, limit) = _thresholds(stored(scored), quantile)
    lang = F.col(f"c{docs.columns.index('lang')}")
    own = limits.select(F.col("lang").alias("l"), F.col("mean").alias("m"), F.col("limit").alias("t"))
    scored = score(docs, model, order).join(small_side(own, MAX_LANGUAGES), lang.eqNullSafe(F.col("l")), "left")
    scored = scored.withColumn("mean", F.coalesce("m", F.lit(mean).cast("double")))
    scored = scored.withColumn("limit", F.coalesce("t", F.lit(limit).cast("double")))
    good = F.coalesce(_above(F.col("mean")) <= F.col("limit"), F.lit(True))
    n = F.col("n_bytes")
    highest = F.col("mean") + F.col("limit") * F.sqrt(n + PRIOR_BYTES) / n
    return scored.select(
        *[f"c{i}" for i in range(len(docs.columns))],
        "n_bytes",
        F.when(F.col("n_bytes") > 0, F.exp(F.col("cost") / F.col("n_bytes") / _UNIT)).alias("perplexity"),
        F.when(n > 0, F.exp(highest / _UNIT)).alias("threshold"),
        ((F.col("n_bytes") > 0) & good).alias("keep"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``docs`` without the rejected ones; same columns."""
    return replace_columns(judge(docs, labels, quantile).where("keep"), docs, {})


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, lang, n_bytes, perplexity, threshold, keep."""
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang")
    return judge(rows, labels).select(F.col("c0").alias("doc_id"), F.col("c2").alias("lang"), "n_bytes", "perplexity", "threshold", "keep")
