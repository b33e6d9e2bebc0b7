"""Table schemas and typed empty frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NAV_SCHEMA = T.StructType(
    [
        T.StructField("scheme_code", T.StringType()),
        T.StructField("scheme_name", T.StringType()),
        T.StructField("nav", T.DoubleType()),
        T.StructField("date", T.DateType()),
        T.StructField("fund_house", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

# Columns added by ingest_nav so older loads can be read back (nav_as_of).
LOAD_FIELDS = [
    T.StructField("load_id", T.LongType()),
    T.StructField("loaded_at", T.TimestampType()),
]
STORED_NAV_SCHEMA = T.StructType(NAV_SCHEMA.fields + LOAD_FIELDS)

MASTER_SCHEMA = T.StructType(
    [
        T.StructField("scheme_code", T.StringType()),
        T.StructField("scheme_name", T.StringType()),
        T.StructField("fund_house", T.StringType()),
    ]
)

# The maintained table of newest rows, one per scheme.
NEWEST_SCHEMA = T.StructType(
    [
        T.StructField("scheme_code", T.StringType()),
        T.StructField("date", T.DateType()),
        *LOAD_FIELDS,
        T.StructField("nav", T.DoubleType()),
        T.StructField("scheme_name", T.StringType()),
        T.StructField("fund_house", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)

NAV_COLUMNS = [f.name for f in NAV_SCHEMA.fields]
MASTER_COLUMNS = [f.name for f in MASTER_SCHEMA.fields]
PARTITION_COLUMNS = ["year", "month"]


def typed_empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame that still carries the operator's schema."""
    return spark.createDataFrame([], schema)
