"""Distributed global row numbers.

``Window.orderBy(...)`` without ``partitionBy`` moves every row to one task.
Here the rows are range-partitioned on the full sort key instead (Spark samples
the key, so a value shared by a third of the rows is still split by the
tie-break columns), sorted inside each partition and numbered there; a
per-partition count (one row per partition: a bound set by the partition
count) turns local numbers into global ones through a broadcast join.

The numbered frame is checkpointed to the cluster's checkpoint folder so that
the counts and the numbers are read from the same materialised data even if
an executor is lost and a stage has to be recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navlib.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the record number in the low 33 bits


def global_row_number(
    df: DataFrame,
    order_cols: Sequence[Column | str],
    name: str = "row_number",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order_cols`` order.

    ``order_cols`` must be a total order (end it with a unique key) for the
    numbering to be deterministic.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # Without an explicit count, adaptive execution may merge neighbouring
    # ranges (only contiguous ones, so the order across partitions holds) to
    # partitions of the advisory size.
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    numbered = (
        ranged.sortWithinPartitions(*order_cols)
        .withColumn("_gid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    part = F.shiftright(F.col("_gid"), _LOCAL_BITS)
    local = F.col("_gid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition: the window below sees at most the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        numbered.join(F.broadcast(offsets), part == F.col("_part"))
        .withColumn(name, F.col("_offset") + local + 1)
        .drop("_gid", "_part", "_offset")
    )


def global_ranks(
    df: DataFrame,
    key: str,
    orders: dict[str, tuple[str, bool]],
    num_partitions: int | None = None,
) -> DataFrame:
    """Several rankings of the same rows in one distributed sort.

    ``orders`` maps an output column to (numeric column, descending).  Each
    ranking sorts NULLs last and breaks ties on ``key`` (unique).  The
    rankings are stacked as (kind, nulls-last flag, signed value, key) and
    numbered once; every kind holds all rows of ``df``, so the rank is the
    global position minus kind × rows.  Returns (key, one column per ranking).
    """
    names = list(orders)
    parts = []
    for kind, name in enumerate(names):
        col, descending = orders[name]
        value = F.col(col).cast("double")
        parts.append(
            df.select(
                F.lit(kind).alias("_kind"),
                value.isNull().alias("_null"),
                (-value if descending else value).alias("_v"),
                F.col(key).alias("_key"),
            )
        )
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    rows = df.select(F.count(F.lit(1))).scalar()
    numbered = global_row_number(stacked, ["_kind", "_null", "_v", "_key"], "_pos", num_partitions)
    rank = F.col("_pos") - F.col("_kind") * rows
    return numbered.groupBy(F.col("_key").alias(key)).agg(
        *[F.max(F.when(F.col("_kind") == kind, rank)).alias(name) for kind, name in enumerate(names)]
    )
