"""Feed text → typed NAV rows (OP01).

The daily feed is ``;``-separated text: ``code;isin1;isin2;name;nav;dd-MMM-yyyy``
lines between heading, blank and title lines.  Bad fields become NULL through
the ``try_`` functions (ANSI mode would otherwise fail the whole job on one
line) and those rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "scheme_code"

# Fixed values of the feed format.
FEED_SEPARATOR = ";"
FEED_DATE_FORMAT = "dd-MMM-yyyy"
HEADING_PREFIX = "Scheme Code"
MISSING_NAV = ["N.A.", "-", ""]
UNMAPPED_HOUSE = "To be mapped"


def read_feed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed feed files (a file, folder or glob) as one ``value`` line per row."""
    return spark.read.text(path)


def parse_nav_text(
    lines: DataFrame,
    house_map: DataFrame | None = None,
    default_house: str = UNMAPPED_HOUSE,
) -> DataFrame:
    """OP01: feed lines → scheme_code, scheme_name, nav, date, fund_house, year, month.

    ``house_map`` (scheme_code, fund_house) fills the house (the smallest one
    when a code has several); codes without an entry, or every code when no
    map is given, get ``default_house``.
    """
    v = F.col("value")
    data = lines.where(v.isNotNull() & (v != "") & ~v.startswith(HEADING_PREFIX) & v.contains(FEED_SEPARATOR))
    parts = F.split(v, FEED_SEPARATOR)
    fields = data.select(
        F.trim(F.get(parts, 0)).alias(KEY),
        F.trim(F.get(parts, 3)).alias("scheme_name"),
        F.trim(F.get(parts, 4)).alias("_nav"),
        F.trim(F.get(parts, 5)).alias("_date"),
    ).where(
        F.col(KEY).isNotNull()
        & F.col("scheme_name").isNotNull()
        & F.col("_nav").isNotNull()
        & F.col("_date").isNotNull()
        & ~F.col("_nav").isin(MISSING_NAV)
    )
    typed = fields.select(
        KEY,
        "scheme_name",
        F.col("_nav").try_cast("double").alias("nav"),
        F.try_to_date(F.col("_date"), FEED_DATE_FORMAT).alias("date"),
    ).where(F.col("nav").isNotNull() & F.col("date").isNotNull())
    if house_map is not None:
        houses = house_map.groupBy(KEY).agg(F.min("fund_house").alias("_house"))
        typed = typed.join(houses, KEY, "left").withColumn(
            "fund_house", F.coalesce(F.col("_house"), F.lit(default_house))
        ).drop("_house")
    else:
        typed = typed.withColumn("fund_house", F.lit(default_house))
    return typed.select(
        KEY,
        "scheme_name",
        "nav",
        "date",
        "fund_house",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
    )
