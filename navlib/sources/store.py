"""Parquet tables: write, read, as-of reads, idempotent ingest, compaction, profile
(OP02-OP05, OP07, OP08).

Storage is plain Parquet, NAV partitioned by (year, month).  There is no
transaction log: a table has one writer at a time.  Rewrites (master
refresh, compaction) never overwrite a path they read from in the same plan:
the new content is first checkpointed or written to a new path, which then
takes the old one's place.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from navlib.operators.master import dated_master, with_partition_columns
from navlib.schema import MASTER_COLUMNS, NAV_COLUMNS, NEWEST_SCHEMA, PARTITION_COLUMNS, STORED_NAV_SCHEMA, typed_empty
from navlib.session import checkpointed, ensure_checkpoint_dir

KEY = "scheme_code"
WRITE_MODES = ("append", "overwrite", "ignore", "error", "errorifexists")
DEFAULT_CLUSTERING = ["date", KEY]
NEWEST_BUCKETS = 32


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's checkpoint folder (shared by all executors)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/navlib-tables/{uuid.uuid4().hex}/{name}"


def write_table(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] | None = None,
    mode: str = "append",
    touched_only: bool = False,
) -> None:
    """OP02: save as Parquet, optionally partitioned; modes append/overwrite/ignore/error.

    With ``touched_only`` an overwrite replaces only the partitions that
    ``df`` has rows of.

    A partitioned write is first rebalanced on the partition columns: rows of
    one partition value meet in few tasks (no file per task per directory),
    and adaptive execution splits a hot value into advisory-size files and
    merges small ones.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode(mode)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if touched_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)


def finish_replacement(spark: SparkSession, path: str) -> None:
    """Complete a replacement of the table at ``path`` that broke off; nothing to do otherwise."""
    files, at = _files(spark, path)
    if not files.exists(at(path)) and files.exists(at(f"{path}_next/_SUCCESS")):
        files.rename(at(f"{path}_next"), at(path))
    files.delete(at(f"{path}_old"), True)


def replace_table(df: DataFrame, path: str, partition_cols: Sequence[str] | None = None) -> None:
    """Overwrite the table at ``path`` so that a crash at any step leaves a whole table, the old or the new one.

    The new content is written beside the table and takes its name when it is
    complete.  A crash between the two renames leaves the new content under
    ``<path>_next``, which the next replacement or ``finish_replacement`` puts in place.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    finish_replacement(spark, path)
    write_table(df, f"{path}_next", partition_cols, "overwrite")
    files, at = _files(spark, path)
    if files.exists(at(path)):
        files.rename(at(path), at(f"{path}_old"))
    files.rename(at(f"{path}_next"), at(path))
    files.delete(at(f"{path}_old"), True)


def _missing_path(err: AnalysisException) -> bool:
    condition = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    return condition is not None and condition() == "PATH_NOT_FOUND"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame | None:
    """OP03: load a table.

    With ``schema`` the files are read with it (no inference; columns that
    older files lack read as NULL).  Otherwise the schema comes from the
    files; ``merge_schema`` unions the columns of all files, which reads
    every footer.  A missing path gives an empty frame of ``schema`` (or
    None without one); every other error propagates.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", str(merge_schema).lower())
    try:
        return reader.parquet(path)
    except AnalysisException as err:
        if not _missing_path(err):
            raise
        return typed_empty(spark, schema) if schema is not None else None


def nav_as_of(
    nav: DataFrame,
    load_id: int | None = None,
    ts: str | dt.datetime | None = None,
    tie_cols: Sequence[str] = (),
) -> DataFrame:
    """OP04: the table as it was after load ``load_id`` (or at time ``ts``).

    Rows loaded later are ignored; of the rows left, the newest load wins per
    (scheme_code, date), then ``tie_cols`` descending, then the other columns.  The version wins when
    both are given.  An aggregate rather than a window: it combines map-side.
    """
    if load_id is not None:
        rows = nav.where(F.col("load_id") <= F.lit(load_id))
    elif ts is not None:
        rows = nav.where(F.col("loaded_at") <= F.lit(ts).cast("timestamp"))
    else:
        rows = nav
    order = [c for c in ("load_id", "loaded_at") if c in nav.columns] + list(tie_cols)
    if not order:
        raise ValueError("nav has no load_id / loaded_at column")
    cols = nav.columns
    # the remaining columns complete a total order, so the kept row never depends on task order
    order += [c for c in cols if c not in order and c not in (KEY, "date")]
    # the order holds every column but the key: its greatest value is the row, and nothing is carried twice
    newest = F.max(F.struct(*order)).alias("_row")
    row = [c if c in (KEY, "date") else F.col(f"_row.{c}").alias(c) for c in cols]
    return rows.groupBy(KEY, "date").agg(newest).select(*row)


def deduplicate_nav(batch: DataFrame) -> DataFrame:
    """One row per (scheme_code, date): the largest (nav, name, house, other columns) of the copies.

    An aggregate, so copies are collapsed map-side before any shuffle: a key
    or scheme repeated in a third of the rows costs no single task more
    than its distinct keys.  Rows without code, date or NAV are dropped.
    """
    cols = [c for c in batch.columns if c not in (KEY, "date")]
    first = [c for c in ("nav", "scheme_name", "fund_house") if c in batch.columns]
    # a total order over the row, so the kept copy does not depend on task order
    order = first + [c for c in cols if c not in first]
    pick = F.max(F.struct(*order))  # holds the whole row
    return (
        batch.where(F.col(KEY).isNotNull() & F.col("date").isNotNull() & F.col("nav").isNotNull())
        .groupBy(KEY, "date")
        .agg(pick.alias("_r"))
        .select(KEY, "date", *[F.col(f"_r.{c}").alias(c) for c in cols])
    )


def month_fingerprints(rows: DataFrame) -> dict[tuple[int, int], tuple]:
    """Per (year, month) of deduplicated NAV rows: row count and sums of two row hashes, which no row order changes.

    One aggregate; a calendar-bounded number of rows comes back.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit("\0"))
    row = [KEY, "date", "nav", text("scheme_name"), text("fund_house")]
    sums = [F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(20,0)")).cast("string").alias(f"h{seed}") for seed in (1, 2)]
    found = rows.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("rows"), *sums).collect()
    return {(r.year, r.month): (r.rows, r.h1, r.h2) for r in found}


def _loads_path(nav_path: str) -> str:
    # hidden from readers of the table, and gone with it when the table is overwritten
    return f"{nav_path.rstrip('/')}/_loads"


_LOADS = "step bigint, load_id bigint, year int, month int, rows bigint, h1 string, h2 string"


def _newest_loads(spark: SparkSession, nav_path: str) -> tuple[int, dict[tuple[int, int], tuple]]:
    """(last step, fingerprint of the last load that touched each month)."""
    log = read_table(spark, _loads_path(nav_path), T.StructType.fromDDL(_LOADS))
    newest = log.groupBy(*PARTITION_COLUMNS).agg(F.max(F.struct("step", "rows", "h1", "h2")).alias("l")).collect()
    return max((r.l.step for r in newest), default=0), {(r.year, r.month): (r.l.rows, r.l.h1, r.l.h2) for r in newest}


def _log_load(spark: SparkSession, nav_path: str, step: int, load_id: int, months: dict[tuple[int, int], tuple]) -> None:
    rows = [(step, load_id, *month, *print_) for month, print_ in months.items()]
    spark.createDataFrame(rows, _LOADS).coalesce(1).write.mode("append").parquet(_loads_path(nav_path))


def ingest_nav(
    batch: DataFrame,
    nav_path: str,
    master_path: str | None = None,
    load_id: int | None = None,
    newest_path: str | None = None,
) -> DataFrame:
    """OP05: append the batch's new and corrected rows; loading twice = once.

    The batch is deduplicated on its key and compared with the current
    version of the stored keys, in the months it touches only (a static
    filter on the year/month partition columns).  Keys that are new, or whose
    NAV, name or house differ, are appended under ``load_id`` (default: epoch
    milliseconds) and ``loaded_at``; older versions stay for ``nav_as_of``,
    and readers take the newest.  The returned frame reads this load's rows
    back.  A failed append commits nothing, and a rerun appends only what
    differs.  With ``master_path`` the scheme master and with ``newest_path``
    the table of newest rows (``refresh_newest``) is refreshed from the
    whole batch, so a rerun after a crash between the steps does that too.

    A month that arrives again with the same rows as in the last load that
    touched it holds nothing new, and its stored rows are not read: loads keep
    each month's fingerprint beside the table.  A load announces its months
    there before it appends, so a month whose load broke off is compared.
    Only ingest may write to the table (an overwrite or a compacted copy starts anew).
    """
    spark = batch.sparkSession
    load_id = int(time.time() * 1000) if load_id is None else int(load_id)
    # The deduplicated batch does not depend on the table, so caching it while
    # it is used is safe: a lost block is recomputed to the same rows.
    rows = deduplicate_nav(with_partition_columns(batch).select(*NAV_COLUMNS)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        months = month_fingerprints(rows)
        step, before = _newest_loads(spark, nav_path)
        changed = {m: f for m, f in months.items() if before.get(m) != f}
        stored = read_table(spark, nav_path, STORED_NAV_SCHEMA) if before else read_table(spark, nav_path)
        if changed:
            # a calendar-bounded list, used as a static partition filter on the stored table
            in_changed_months = (F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in changed])
            new = rows.where(in_changed_months)
            if stored is not None:
                _log_load(spark, nav_path, step + 1, load_id, {m: (None, None, None) for m in changed})
                values = ("nav", "scheme_name", "fund_house")
                stored = stored.where(in_changed_months)
                current = nav_as_of(stored) if "load_id" in stored.columns else deduplicate_nav(stored)
                current = current.select(KEY, "date", *[F.col(c).alias(f"_{c}") for c in values], F.lit(True).alias("_known"))
                same = F.lit(True)
                for c in values:
                    same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
                new = new.join(current, [KEY, "date"], "left").where(F.col("_known").isNull() | ~same)
            stamped = (
                new.select(*NAV_COLUMNS)
                .withColumn("load_id", F.lit(load_id).cast("bigint"))
                .withColumn("loaded_at", F.current_timestamp())
            )
            write_table(stamped, nav_path, PARTITION_COLUMNS, "append")
            _log_load(spark, nav_path, step + 2, load_id, changed)
        if master_path is not None:
            refresh_master(spark, master_path, rows)
        if newest_path is not None:
            stamped = rows.withColumn("load_id", F.lit(load_id).cast("bigint")).withColumn("loaded_at", F.current_timestamp())
            refresh_newest(spark, newest_path, stamped)
    finally:
        rows.unpersist()
    in_batch_months = (F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in months])
    return read_table(spark, nav_path, STORED_NAV_SCHEMA).where(in_batch_months & (F.col("load_id") == F.lit(load_id)))


def refresh_master(spark: SparkSession, master_path: str, nav: DataFrame, rebuild: bool = False) -> DataFrame:
    """Merge the rows of ``nav`` into the stored scheme master; returns the master (scheme_code, scheme_name, fund_house).

    The stored table also keeps each row's date, and the row with the newest
    date wins (ties: greater name, house), so loading older rows later can't
    turn a name back.  A stored row without a date yields to any dated one.
    ``rebuild=True`` ignores the stored table: ``nav`` is all of history.
    The table is replaced whole (``replace_table``), so a crash never leaves half a master.
    """
    merged = dated_master(nav)
    finish_replacement(spark, master_path.rstrip("/"))
    old = None if rebuild else read_table(spark, master_path)
    if old is not None:
        if "last_date" not in old.columns:
            old = old.withColumn("last_date", F.lit(None).cast("date"))
        both = merged.unionByName(old.select(*MASTER_COLUMNS, "last_date"))
        merged = dated_master(both.withColumnRenamed("last_date", "date"))
    merged = checkpointed(merged)
    replace_table(merged, master_path)
    return merged.select(*MASTER_COLUMNS)


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The maintained table of newest rows, one per scheme (empty if there is none yet)."""
    return read_table(spark, path, NEWEST_SCHEMA)


def refresh_newest(
    spark: SparkSession, path: str, nav: DataFrame, buckets: int = NEWEST_BUCKETS, rebuild: bool = False
) -> None:
    """Bring the table of newest NAV rows up to date with the rows of ``nav``.

    The table is a view kept by increments: (scheme_code, scheme_name,
    fund_house, nav, date, load_id, loaded_at), the row with the newest date
    of each scheme, of one date that of the newest load, in ``buckets``
    folders by a hash of the code.  Schemes that get a newer row are found by a
    join with the small table, and only the buckets that hold some are
    rewritten (dynamic partition overwrite); older rows, as in a backfill, rewrite
    nothing.  The rows don't depend on the order of loads, so a repeated
    refresh changes nothing.  The table is derived data with one writer: if a rewrite is cut
    off, ``rebuild=True`` with all of ``nav`` makes it anew.  The number of
    buckets is that of the first refresh.
    """
    loads = [F.col(c) if c in nav.columns else F.lit(None).cast(t).alias(c) for c, t in (("load_id", "bigint"), ("loaded_at", "timestamp"))]
    values = ("date", "load_id", "loaded_at", "nav", "scheme_name", "fund_house")
    fresh = (
        nav.where(F.col(KEY).isNotNull() & F.col("date").isNotNull())
        .select(KEY, "date", *loads, "nav", "scheme_name", "fund_house")
        .groupBy(KEY)
        .agg(F.max(F.struct(*values)).alias("_new"))
    )
    old = read_newest(spark, path)
    first = None if rebuild else old.select("buckets").first()
    if first is None:
        made = fresh.select(KEY, "_new.*").withColumn("buckets", F.lit(buckets))
        bucket = F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")
        replace_table(checkpointed(made).withColumn("bucket", bucket), path, ["bucket"])
        return
    buckets = first.buckets
    bucket = F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")
    known = old.select(KEY, F.struct(*values).alias("_old"))
    same = F.lit(True)
    for c in ("date", "nav", "scheme_name", "fund_house"):
        same = same & F.col(f"_new.{c}").eqNullSafe(F.col(f"_old.{c}"))
    newer = F.col("_old").isNull() | ((F.col("_new") > F.col("_old")) & ~same)  # as ingest: equal values are no new version
    changed = checkpointed(fresh.join(known, KEY, "left").where(newer).select(KEY, "_new.*", F.lit(buckets).alias("buckets"), bucket.alias("bucket")))
    touched = [r.bucket for r in changed.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    kept = old.where(F.col("bucket").isin(touched)).join(changed.select(KEY), KEY, "left_anti")
    merged = checkpointed(kept.select(*changed.columns).unionByName(changed))
    write_table(merged, path, ["bucket"], "overwrite", touched_only=True)


def compact_table(
    spark: SparkSession,
    path: str,
    out_path: str,
    cluster_cols: Sequence[str] | None = None,
    rows_per_file: int = 2_000_000,
) -> DataFrame:
    """OP07: rewrite a table into range-clustered files at a new path.

    Rows are range-partitioned on (partition columns, cluster columns) and
    sorted inside each file, so Parquet row-group min/max statistics skip
    data for filters on those columns.  Cluster columns that the table lacks
    are ignored; the NAV default is (date, scheme_code).  The row count of
    the copy is verified before it is returned; the caller then swaps paths.
    The number of output ranges follows the row count (``rows_per_file``),
    not a fixed partition setting, so files keep their size as the table grows.
    """
    src = read_table(spark, path)
    if src is None:
        raise ValueError(f"no table at {path}")
    before = src.count()  # Parquet row counts come from the footers
    n_ranges = max(1, -(-before // rows_per_file))
    wanted = list(cluster_cols) if cluster_cols else [c for c in DEFAULT_CLUSTERING if c in src.columns]
    cols = [c for c in wanted if c in src.columns]
    parts = [c for c in PARTITION_COLUMNS if c in src.columns]
    order = parts + [c for c in cols if c not in parts]
    out = src.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order) if order else src
    writer = out.write.mode("overwrite")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(out_path)
    copy = read_table(spark, out_path)
    after = copy.count()
    if before != after:
        raise RuntimeError(f"compaction lost rows: {before} → {after}")
    return copy


def compact_tables(
    spark: SparkSession,
    paths: dict[str, str],
    table: str | None = None,
    suffix: str = "compact",
    rows_per_file: int = 2_000_000,
) -> tuple[dict[str, str], DataFrame]:
    """OP07 for one named table or all: (new path of each table, status per table).

    ``paths`` names the tables.  Each copy goes to a new folder
    ``<path>_<suffix>_<id>`` and is returned as the table's path only when
    its row count is verified: that is the swap, done by whoever keeps the
    paths, and the old folder stays readable for running queries.  The status
    frame has table, status (success, skipped: no such folder, failed) and
    message; one table's failure doesn't stop the others.
    """
    if table is not None and table not in paths:
        raise ValueError(f"unknown table {table!r}; known: {sorted(paths)}")
    current, rows = dict(paths), []
    for name in [table] if table is not None else sorted(paths):
        out = f"{paths[name].rstrip('/')}_{suffix}_{uuid.uuid4().hex[:8]}"
        if read_table(spark, paths[name]) is None:
            rows.append((name, "skipped", f"no table at {paths[name]}"))
            continue
        try:
            compact_table(spark, paths[name], out, rows_per_file=rows_per_file)
        except Exception as err:  # reported in the status, as the other tables go on
            rows.append((name, "failed", str(err)[:500]))
            continue
        current[name] = out
        rows.append((name, "success", out))
    return current, spark.createDataFrame(rows, "table string, status string, message string")


def table_schema(df: DataFrame) -> DataFrame:
    """OP08 (third frame): column and type, in order."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def table_profile(df: DataFrame) -> DataFrame:
    """OP08: column_count, row_count, partition_count (distinct year/month)."""
    parts = [c for c in PARTITION_COLUMNS if c in df.columns]
    part_count = F.count_distinct(*[F.col(c) for c in parts]) if parts else F.lit(0)
    return df.agg(
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.count(F.lit(1)).alias("row_count"),
        part_count.cast("bigint").alias("partition_count"),
    )


def table_partitions(df: DataFrame) -> DataFrame:
    """OP08 (second frame): one row per ``year=Y/month=MM`` partition with its row count."""
    return (
        df.groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.format_string("year=%d/month=%02d", "year", "month").alias("partition"), "rows")
    )


def _by_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The table through the reader that answers count, min and max from file footers (aggregate push-down)."""
    apart = spark.newSession()  # the settings are this reader's only
    apart.conf.set("spark.sql.sources.useV1SourceList", "")
    apart.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return apart.read.parquet(path)


def stored_partitions(spark: SparkSession, path: str) -> DataFrame:
    """``table_partitions`` of a stored table from its file footers: no row is read."""
    return table_partitions(_by_metadata(spark, path))


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """``table_profile`` of a stored table from its file footers."""
    df = _by_metadata(spark, path)
    parts = [c for c in PARTITION_COLUMNS if c in df.columns]
    per = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows"))
    return per.agg(
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count_if(F.lit(bool(parts))).alias("partition_count"),
    )


_RANGE = "rows bigint, min_nav double, max_nav double, earliest_date date, latest_date date"


def nav_range(nav: DataFrame) -> DataFrame:
    """One row: number of rows, least and greatest NAV, first and last date."""
    return nav.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("nav").alias("min_nav"),
        F.max("nav").alias("max_nav"),
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
    )


def stored_range(spark: SparkSession, path: str) -> DataFrame:
    """``nav_range`` of a stored table from its file footers; by a scan where a file has no statistics (NaN, all null)."""
    try:
        row = nav_range(_by_metadata(spark, path)).first()
    except Exception as missing:
        if "aggregatePushdown" not in str(missing):
            raise
        return nav_range(spark.read.parquet(path))
    return spark.createDataFrame([row], _RANGE)


def stored_latest_date(spark: SparkSession, path: str) -> DataFrame:
    """``latest_nav_date`` of a stored table from its file footers."""
    return stored_range(spark, path).select(F.col("latest_date"))
