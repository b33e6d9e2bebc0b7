"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a document's hash.  It starts
with one bucket; a bucket above the byte limit splits on its next bit, others
stay, until every bucket (shard) fits.  So adding documents splits the shards
that overflow and moves nothing else.

Bytes are summed by hash prefix in Spark, a few bits deeper than the size
calls for; the sums of all shorter prefixes follow from those, and a bucket is
the shortest prefix that fits.  Only prefixes that are still too large at that
depth go on, over their own rows, to deeper bits.  Texts don't move: the
directory is joined to them, broadcast behind a row check.

The hash covers doc_id and text, so a large group of copies under different
ids spreads.  Repeated rows (same doc_id and text) share all bits; if they
exceed the limit they are numbered and dealt to parts named after the bucket.

Defined cases: a null text has 0 bytes; null ids are hashed like others; a
single document above the limit is a shard of its own; an empty table has no
shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navlib.functions.ranking import global_row_number
from navlib.llm._frames import pick, positional, small_side, stored

SHARD_BYTES = 64 << 20

BITS = 60
_MORE = 4  # depth beyond one bucket for each full shard
_DEEPER = 12
BROADCAST_CELLS = 500_000


def _hash(doc_id: Column, text: Column) -> Column:
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("/"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _buckets(cells: DataFrame, depth: int, least: int, limit: int) -> DataFrame:
    """(cell, bucket, depth, shard_rows, shard_bytes): the shortest prefix of each cell that fits, if any does."""
    prefixes = cells.select("cell", "rows", "bytes", F.explode(F.sequence(F.lit(least), F.lit(depth))).alias("d")).withColumn(
        "prefix", F.expr(f"shiftright(cell, {depth} - d)")
    )
    sums = prefixes.groupBy("d", "prefix").agg(F.sum("rows").alias("shard_rows"), F.sum("bytes").alias("shard_bytes"))
    fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
    best = F.min(F.struct("d", "prefix", "shard_rows", "shard_bytes")).alias("b")
    found = prefixes.select("cell", "d", "prefix").join(fits, ["d", "prefix"]).groupBy("cell").agg(best)
    return found.select("cell", F.col("b.prefix").alias("bucket"), F.col("b.d").alias("depth"), "b.shard_rows", "b.shard_bytes")


def _levels(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """(depth, buckets by cell) for growing depths, until all rows have a bucket or all bits are used."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth, least, open_ = min(BITS, max(0, (total // max(1, limit)).bit_length()) + _MORE), 0, rows
    levels = []
    while True:
        cell = F.shiftright("hash", BITS - depth)
        cells = stored(open_.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("rows"), F.sum("n_bytes").alias("bytes")))
        found = stored(_buckets(cells, depth, least, limit))
        levels.append((depth, found))
        left = small_side(cells.join(found, "cell", "left_anti").select("cell"), BROADCAST_CELLS)
        if depth == BITS or left.limit(1).count() == 0:
            return levels
        open_ = open_.join(left, cell == F.col("cell"), "left_semi")
        least, depth = depth + 1, min(BITS, depth + _DEEPER)


def _name(bucket: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(bucket), depth, F.lit("0")))


def assign(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Columns of ``docs`` as c0, c1, … plus n_bytes, shard (its bits), depth, shard_rows and shard_bytes."""
    base = positional(docs)
    doc_id, text = (F.col(f"c{docs.columns.index(n)}") for n in ("doc_id", "text"))
    n_bytes = F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint")
    rows = base.withColumn("hash", _hash(doc_id, text)).withColumn("n_bytes", n_bytes)
    levels = _levels(rows.select("hash", "n_bytes"), limit)
    placed = rows
    kinds = {"bucket": "bigint", "depth": "int", "shard_rows": "bigint", "shard_bytes": "bigint"}
    for name, kind in kinds.items():
        placed = placed.withColumn(name, F.lit(None).cast(kind))
    for depth, buckets in levels:
        side = small_side(buckets.withColumnsRenamed({n: f"{n}_" for n in kinds}), BROADCAST_CELLS)
        placed = placed.join(side, F.shiftright("hash", BITS - depth) == F.col("cell"), "left")
        placed = placed.withColumns({n: F.coalesce(n, f"{n}_") for n in kinds}).drop("cell", *[f"{n}_" for n in kinds])
    names = [*base.columns, "n_bytes", "shard", "depth", "shard_rows", "shard_bytes"]
    settled = placed.withColumn("shard", _name(F.col("bucket"), F.col("depth"))).select(*names)
    last_depth, last = levels[-1]
    if last_depth < BITS:
        return settled
    # repeated rows that no bit tells apart: any order will do, as they are equal
    repeated = placed.where(F.col("bucket").isNull())
    if repeated.limit(1).count() == 0:
        return settled
    ranked = stored(global_row_number(repeated, ["hash"], "rank"))
    groups = ranked.groupBy(F.col("hash").alias("h")).agg(
        F.min("rank").alias("from"), F.count(F.lit(1)).alias("copies"), F.greatest(F.floor(F.lit(limit) / F.max("n_bytes")), F.lit(1)).alias("room")
    )
    parts = ranked.join(groups, F.col("hash") == F.col("h")).withColumn("part", F.floor((F.col("rank") - F.col("from")) / F.col("room")))
    in_part = F.least(F.col("room"), F.col("copies") - F.col("part") * F.col("room")).cast("bigint")
    dealt = parts.select(
        *base.columns,
        "n_bytes",
        F.concat(_name(F.col("hash"), F.lit(BITS)), F.lit("+"), F.col("part").cast("string")).alias("shard"),
        F.lit(BITS).alias("depth"),
        in_part.alias("shard_rows"),
        (in_part * F.col("n_bytes")).alias("shard_bytes"),
    )
    return placed.where(F.col("bucket").isNotNull()).withColumn("shard", _name(F.col("bucket"), F.col("depth"))).select(*names).unionByName(dealt)


def directory(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """(shard, depth, shard_rows, shard_bytes) of each shard."""
    return assign(docs, limit).select("shard", "depth", "shard_rows", "shard_bytes").distinct()


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """``docs`` as Parquet, one folder a shard."""
    names = docs.columns
    out = assign(docs, limit)
    out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], F.concat(F.lit("b"), "shard").alias("_shard")).repartition(
        "_shard"
    ).write.partitionBy("_shard").parquet(path)


def shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Per document: doc_id, n_bytes, shard, depth, shard_rows, shard_bytes."""
    out = assign(pick(docs, doc_id="doc_id", text="text"), limit)
    return out.select(F.col("c0").alias("doc_id"), "n_bytes", "shard", "depth", "shard_rows", "shard_bytes")


def oracle(limit: int = SHARD_BYTES) -> str:
    return f"""
WITH r AS (
  SELECT row_number() OVER () AS k, doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS hash FROM documents),
s AS (SELECT d, hash >> ({BITS} - d) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM r, range(0, {BITS + 1}) t(d) GROUP BY ALL),
f AS (SELECT r.k, min(s.d) AS depth FROM r JOIN s ON r.hash >> ({BITS} - s.d) = s.prefix WHERE s.shard_bytes <= {limit} OR s.shard_rows = 1 GROUP BY r.k)
SELECT r.doc_id, r.n_bytes, CASE WHEN f.depth = 0 THEN '' ELSE lpad(bin(s.prefix), f.depth::INTEGER, '0') END AS shard,
  f.depth::INTEGER AS depth, s.shard_rows, s.shard_bytes
FROM r JOIN f ON f.k = r.k JOIN s ON s.d = f.depth AND s.prefix = r.hash >> ({BITS} - f.depth)
"""
