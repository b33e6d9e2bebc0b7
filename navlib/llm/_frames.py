"""Frame helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from navlib.session import ensure_checkpoint_dir

_CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positional(df: DataFrame) -> DataFrame:
    """``df`` with its columns renamed c0, c1, … so that clashing names can't matter."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Columns by exact name under new names: ``pick(docs, id="doc_id")``.

    Of several columns with one name the first counts; names that differ
    only in case are different columns.
    """
    names = df.columns
    return positional(df).select(*[F.col(f"c{names.index(name)}").alias(new) for new, name in wanted.items()])


def and_fields(df: DataFrame, more: str) -> StructType:
    """Schema of ``df`` with the fields of a DDL string after its own."""
    return StructType(df.schema.fields + StructType.fromDDL(more).fields)


def replace_columns(df: DataFrame, source: DataFrame, changed: dict[str, str]) -> DataFrame:
    """Columns of ``source`` (present in ``df`` as c0, c1, …), some replaced by other columns of ``df``."""
    names = source.columns
    new = [f"c{i}" for i in range(len(names))]
    for name, column in changed.items():
        if name in names:
            new[names.index(name)] = column
    return df.select(*new).toDF(*names)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffle_cleanup(spark: SparkSession):
    """Jobs inside drop their shuffle files when they end (their result is stored elsewhere)."""
    return settings(spark, _CLEANUP)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Delete a folder when the application ends; until then lazy results may read it."""
    files, at = _file_system(spark, path)
    files.deleteOnExit(at)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the cluster's checkpoint folder and read again, its shuffle files removed.

    A checkpointed frame would keep the size that its plan was estimated at,
    and a join multiplies such sizes, so that in a loop of joins they grow
    to numbers of millions of digits.  A table has the size of its files.
    It goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    with shuffle_cleanup(spark):
        df.select("*").write.parquet(path)  # a frame takes the setting up when it is made
    remove_at_end(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def unstore(df: DataFrame) -> None:
    """Delete the table of a ``stored`` frame that nothing reads any more."""
    remove(df.sparkSession, df._stored_at)


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """A stored join side, broadcast only if it has at most ``max_rows`` rows; else a shuffled join."""
    df = stored(df)
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
