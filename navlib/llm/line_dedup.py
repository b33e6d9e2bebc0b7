"""Line dedup by site-relative frequency, in DataFrame functions only.

Pages are grouped by host (here ``source``).  A line is boilerplate on its
host if its share of the host's pages is above ``RATIO``, judged with the
same certainty on hosts of every size: of n pages more than
``n * RATIO + DEVIATIONS * sqrt(n * RATIO * (1 - RATIO))`` must have it (the lower
end of the share's score interval is then above the ratio), and two at
least.  Boilerplate lines leave the pages of that host.

Lines are compared trimmed, by two 64-bit hashes; each page contributes a
line once.  Counts combine map-side, so a host with a third of all pages adds
one row per line and task.  What is joined back is at most
(lines per page / RATIO) hashes a host; it is broadcast behind a row check,
else shuffled, where adaptive execution splits a hot host.

Defined cases: null text stays null; blank lines are kept and not counted;
pages of a null host are left as they are; repeated rows count as one page, and
so do a host's null texts; a page may end up empty, its row stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navlib.llm._frames import positional, replace_columns, small_side

RATIO = 0.05
DEVIATIONS = 2.0

BROADCAST_HOSTS = 2_000


def _two(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(7)).alias("b"))


def _hash(line: Column) -> Column:
    return _two(F.trim(line))


def boilerplate(pages: DataFrame, ratio: float = RATIO, deviations: float = DEVIATIONS) -> DataFrame:
    """(host, a, b, pages, host_pages): hashes of the lines above the ratio.  ``pages`` has host and text."""
    hosts = pages.where(F.col("host").isNotNull())
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    distinct = hosts.select("host", _two(F.col("text")).alias("page"), F.array_distinct(F.transform(lines, _hash)).alias("lines"))
    counts = (
        distinct.where(F.col("lines").isNotNull())
        .dropDuplicates(["host", "page"])
        .select("host", F.explode("lines").alias("line"))
        .groupBy("host", F.col("line.a").alias("a"), F.col("line.b").alias("b"))
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= 2)
    )
    totals = distinct.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    n = F.col("host_pages")
    return counts.join(totals, "host").where(F.col("pages") > n * ratio + F.sqrt(n * (ratio * (1 - ratio))) * deviations)


def _marked(docs: DataFrame, ratio: float, deviations: float) -> DataFrame:
    """Columns of ``docs`` as c0, c1, … plus n_lines, n_dropped and kept (text)."""
    names = docs.columns
    base = positional(docs)
    host, text = F.col(f"c{names.index('source')}"), F.col(f"c{names.index('text')}")
    drop = boilerplate(base.select(host.alias("host"), text.alias("text")), ratio, deviations)
    drop = small_side(drop.groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("drop")), BROADCAST_HOSTS)
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("drop"), _hash(x)))
    return (
        base.join(drop, host == F.col("host"), "left")
        .withColumn("n_lines", F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("bigint"))
        .withColumn("rest", F.when(F.col("drop").isNull(), lines).otherwise(kept))
        .withColumn("n_dropped", F.when(text.isNull(), 0).otherwise(F.col("n_lines") - F.size("rest")).cast("bigint"))
        .withColumn("kept", F.array_join("rest", "\n"))
        .drop("host", "drop", "rest")
    )


def drop_boilerplate_lines(docs: DataFrame, ratio: float = RATIO, deviations: float = DEVIATIONS) -> DataFrame:
    """``docs`` without boilerplate lines (n_chars renewed); same columns and rows."""
    marked = _marked(docs, ratio, deviations).withColumn("kept_chars", F.length("kept").cast("bigint"))
    return replace_columns(marked, docs, {"text": "kept", "n_chars": "kept_chars"})


def dropped_lines(docs: DataFrame, ratio: float = RATIO, deviations: float = DEVIATIONS) -> DataFrame:
    """Per document: doc_id, source, n_lines, n_dropped, n_chars (kept), kept_sha256 (of the kept text)."""
    id_, source = (f"c{docs.columns.index(n)}" for n in ("doc_id", "source"))
    return _marked(docs, ratio, deviations).select(
        F.col(id_).alias("doc_id"),
        F.col(source).alias("source"),
        "n_lines",
        "n_dropped",
        F.length("kept").cast("bigint").alias("n_chars"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH p AS (
  SELECT source, text, row_number() OVER () AS page
  FROM (SELECT DISTINCT source, text FROM documents WHERE source IS NOT NULL)),
h AS (SELECT source, count(*) AS n FROM p GROUP BY source),
l AS (SELECT DISTINCT page, source, trim(x, ' ') AS line FROM (SELECT page, source, unnest(string_split(text, chr(10))) AS x FROM p) WHERE trim(x, ' ') <> ''),
drops AS (
  SELECT l.source, l.line FROM l JOIN h ON h.source = l.source GROUP BY l.source, l.line, h.n
  HAVING count(*) >= 2 AND count(*) > h.n * {RATIO} + sqrt(h.n * {RATIO * (1 - RATIO)}) * {DEVIATIONS}),
d AS (SELECT row_number() OVER () AS row, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
x AS (SELECT row, source, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM d),
k AS (
  SELECT x.row, count(*) AS n_lines, count(drops.line) AS n_dropped,
         coalesce(string_agg(x.line, chr(10) ORDER BY x.i) FILTER (WHERE drops.line IS NULL), '') AS kept
  FROM x LEFT JOIN drops ON drops.source = x.source AND drops.line = trim(x.line, ' ')
  GROUP BY x.row)
SELECT doc_id, d.source, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, length(kept) AS n_chars, sha256(kept) AS kept_sha256
FROM d LEFT JOIN k ON k.row = d.row
"""
