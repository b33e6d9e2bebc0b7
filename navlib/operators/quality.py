"""NAV summary, data-quality checks and duplicate-scheme checks (OP18-OP28).

Each check is one aggregate pass (count_if per rule) instead of one Spark
action per column and rule; checks that need the duplicate-key count read it
through a scalar subquery.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navlib.functions.stats import half_up

KEY = "scheme_code"

# The rules and thresholds of the quality report.
NULL_CHECK_COLUMNS = ["scheme_code", "scheme_name", "nav", "date"]
NAV_MIN_EXCLUSIVE = 0
NAV_MAX_INCLUSIVE = 10000
CODE_PATTERN = "^[0-9]+$"
SCORE_EXCELLENT = 95
SCORE_GOOD = 85
SIMILAR_MAX_LENGTH_GAP = 3
DUPLICATE_REVIEW_LIMIT = 10


def _as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def _percent(part: Column, total: Column, digits: int = 2) -> Column:
    return F.when(total > 0, half_up(F.try_divide(part, total) * 100, digits)).otherwise(F.lit(0.0))


def nav_summary(nav: DataFrame, as_of: str | dt.date) -> DataFrame:
    """OP18: row count, houses, NAV range and mean (2 dp), date range, freshness on ``as_of``."""
    d = _as_date(as_of)
    s = nav.agg(
        F.count(F.lit(1)).alias("total_schemes"),
        F.count_distinct("fund_house").alias("total_fund_houses"),
        half_up(F.min("nav"), 2).alias("min_nav"),
        half_up(F.max("nav"), 2).alias("max_nav"),
        half_up(F.avg("nav"), 2).alias("avg_nav"),
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
    )
    fresh = F.when(F.datediff(F.lit(d), F.col("latest_date")) <= 1, F.lit("Current")).otherwise(F.lit("Stale"))
    return s.withColumn("data_freshness", fresh)


def _is_invalid_nav(nav: Column) -> Column:
    return (nav <= NAV_MIN_EXCLUSIVE) | (nav > NAV_MAX_INCLUSIVE)


def dq_null_checks(nav: DataFrame) -> DataFrame:
    """OP19: per checked column, NULL count and % of rows (one pass for all columns)."""
    cols = [c for c in NULL_CHECK_COLUMNS if c in nav.columns]
    counts = nav.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols])
    rows = counts.select("_total", F.explode(items).alias("_c"))
    return rows.select(
        "_c.column_name",
        "_c.null_count",
        _percent(F.col("_c.null_count"), F.col("_total")).alias("null_percentage"),
    )


def dq_invalid_nav(nav: DataFrame) -> DataFrame:
    """OP20: rows with nav ≤ 0 or nav > 10000, count and %."""
    s = nav.agg(F.count(F.lit(1)).alias("_total"), F.count_if(_is_invalid_nav(F.col("nav"))).alias("count"))
    return s.select("count", _percent(F.col("count"), F.col("_total")).alias("percentage"))


def dq_duplicates(nav: DataFrame) -> DataFrame:
    """OP21: (scheme_code, date) keys held by more than one row."""
    return (
        nav.groupBy(KEY, "date")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .where(F.col("record_count") > 1)
    )


def dq_date_consistency(nav: DataFrame) -> DataFrame:
    """OP22: earliest and latest date, number of distinct dates."""
    return nav.agg(
        F.min("date").alias("earliest"),
        F.max("date").alias("latest"),
        F.count_distinct("date").alias("unique_dates"),
    )


def dq_code_format(nav: DataFrame) -> DataFrame:
    """OP23: codes that are not all digits (NULL codes are not counted), count and %."""
    bad = F.count_if(~F.col(KEY).rlike(CODE_PATTERN))
    s = nav.agg(F.count(F.lit(1)).alias("_total"), bad.alias("invalid_format_count"))
    return s.select("invalid_format_count", _percent(F.col("invalid_format_count"), F.col("_total")).alias("percentage"))


def dq_overall(nav: DataFrame) -> DataFrame:
    """OP24: score = max(0, 100 - 100·issues/rows) (2 dp) and its status.

    issues = NULLs over the checked columns + invalid NAVs + duplicate key
    groups + badly formatted codes.
    """
    cols = [c for c in NULL_CHECK_COLUMNS if c in nav.columns]
    duplicate_groups = dq_duplicates(nav).select(F.count(F.lit(1))).scalar()
    nulls = [F.count_if(F.col(c).isNull()) for c in cols]
    s = nav.agg(
        F.count(F.lit(1)).alias("total_records"),
        sum(nulls[1:], nulls[0]).alias("_nulls") if nulls else F.lit(0).alias("_nulls"),
        F.count_if(_is_invalid_nav(F.col("nav"))).alias("_invalid"),
        F.count_if(~F.col(KEY).rlike(CODE_PATTERN)).alias("_codes"),
    )
    issues = F.col("_nulls") + F.col("_invalid") + duplicate_groups + F.col("_codes")
    score = F.when(
        F.col("total_records") > 0,
        F.greatest(F.lit(0.0), half_up(100 - F.try_divide(issues, F.col("total_records")) * 100, 2)),
    ).otherwise(F.lit(0.0))
    return s.select(
        score.alias("score"),
        "total_records",
        issues.cast("bigint").alias("total_issues"),
    ).withColumn(
        "status",
        F.when(F.col("score") >= SCORE_EXCELLENT, "excellent")
        .when(F.col("score") >= SCORE_GOOD, "good")
        .otherwise("needs_attention"),
    )


def duplicate_codes(master: DataFrame) -> DataFrame:
    """OP25: master rows whose scheme_code occurs more than once, with the code's row count.

    One row per (code, name) row rather than a collected name list, so a
    code with very many rows never becomes one array in one task.
    """
    counts = (
        master.where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
    )
    return master.select(KEY, "scheme_name").join(counts, KEY).select(KEY, "count", "scheme_name")


def duplicate_names(master: DataFrame) -> DataFrame:
    """OP27: master rows whose scheme_name is shared, with the count and the name's (min) house."""
    named = master.where(F.col("scheme_name").isNotNull())
    counts = (
        named.groupBy("scheme_name")
        .agg(F.count(F.lit(1)).alias("count"), F.min("fund_house").alias("fund_house"))
        .where(F.col("count") > 1)
    )
    return named.select("scheme_name", KEY).join(counts, "scheme_name").select(
        "scheme_name", "count", KEY, "fund_house"
    )


def _normalized(master: DataFrame) -> DataFrame:
    norm = F.regexp_replace(F.lower(F.col("scheme_name")), "[ -]", "")
    return master.where(F.col("scheme_name").isNotNull()).select("fund_house", norm.alias("name_norm"), KEY, "scheme_name")


def _name_groups(master: DataFrame) -> DataFrame:
    return _normalized(master).groupBy("fund_house", "name_norm").agg(F.count(F.lit(1)).alias("members"))


def _similar_norm_pairs(groups: DataFrame) -> DataFrame:
    """(fund_house, short, long) normalised names where short ⊂ long, 1-3 characters shorter.

    Containment with a gap of d characters means short = long with a leading
    and b trailing characters cut, a + b = d: nine cuts per name, then one
    equi-join on (house, cut) = (house, name).  Linear in the distinct names.
    """
    # (lead, gap): cut `lead` characters in front and `gap - lead` at the end
    cuts = [(lead, gap) for gap in range(1, SIMILAR_MAX_LENGTH_GAP + 1) for lead in range(gap + 1)]
    length = F.length("name_norm")
    trims = F.array(
        *[F.when(length >= gap, F.col("name_norm").substr(F.lit(lead + 1), length - gap)) for lead, gap in cuts]
    )
    longs = groups.select(
        "fund_house",
        F.col("name_norm").alias("long_norm"),
        F.col("members").alias("long_members"),
        F.explode(F.array_distinct(F.array_compact(trims))).alias("short_norm"),
    )
    shorts = groups.select(
        F.col("fund_house").alias("_house"),
        F.col("name_norm").alias("short_norm"),
        F.col("members").alias("short_members"),
    )
    return longs.join(
        shorts,
        F.col("fund_house").eqNullSafe(F.col("_house")) & (longs.short_norm == shorts.short_norm),
    ).select(
        "fund_house",
        shorts.short_norm.alias("short_norm"),
        "long_norm",
        "short_members",
        "long_members",
    )


def similar_names(master: DataFrame) -> DataFrame:
    """OP26: similar scheme names within a fund house, as name-level pairs.

    Two schemes are similar when one normalised name (lower case, spaces
    and '-' removed) contains the other and the lengths differ by at most 3.
    Rows: (fund_house, name_norm_1, name_norm_2, members_1, members_2,
    pair_count).  Identical normalised names give name_norm_1 = name_norm_2
    and m·(m-1)/2 scheme pairs; containment gives the shorter name first and
    m1·m2 pairs.  The scheme pairs themselves are implied by
    ``similar_name_members`` and are never all emitted, so a name shared by
    many schemes costs one row, not a quadratic number.
    """
    groups = _name_groups(master)
    same = groups.where(F.col("members") > 1).select(
        "fund_house",
        F.col("name_norm").alias("name_norm_1"),
        F.col("name_norm").alias("name_norm_2"),
        F.col("members").alias("members_1"),
        F.col("members").alias("members_2"),
        (F.col("members") * (F.col("members") - 1) / 2).cast("bigint").alias("pair_count"),
    )
    contained = _similar_norm_pairs(groups).select(
        "fund_house",
        F.col("short_norm").alias("name_norm_1"),
        F.col("long_norm").alias("name_norm_2"),
        F.col("short_members").alias("members_1"),
        F.col("long_members").alias("members_2"),
        (F.col("short_members") * F.col("long_members")).cast("bigint").alias("pair_count"),
    )
    return same.unionByName(contained)


def similar_name_members(master: DataFrame) -> DataFrame:
    """Schemes behind the OP26 name pairs: (fund_house, name_norm, scheme_code, scheme_name)."""
    pairs = similar_names(master)
    norms = pairs.select("fund_house", F.col("name_norm_1").alias("name_norm")).unionByName(
        pairs.select("fund_house", F.col("name_norm_2").alias("name_norm"))
    ).distinct()
    return _normalized(master).join(norms, ["fund_house", "name_norm"], "left_semi")


def duplicate_summary(master: DataFrame) -> DataFrame:
    """OP28: duplicate codes + similar-name pairs + duplicate names, % of schemes, status."""
    dup_codes = (
        master.where(F.col(KEY).isNotNull()).groupBy(KEY).count().where(F.col("count") > 1).select(F.count(F.lit(1))).scalar()
    )
    dup_names = (
        master.where(F.col("scheme_name").isNotNull())
        .groupBy("scheme_name")
        .count()
        .where(F.col("count") > 1)
        .select(F.count(F.lit(1)))
        .scalar()
    )
    pairs = similar_names(master).select(F.coalesce(F.sum("pair_count"), F.lit(0))).scalar()
    total = (dup_codes + pairs + dup_names).cast("bigint")
    s = master.agg(F.count(F.lit(1)).alias("total_schemes_analyzed"))
    return s.select(
        total.alias("total_potential_duplicates"),
        "total_schemes_analyzed",
        _percent(total, F.col("total_schemes_analyzed")).alias("duplicate_percentage"),
    ).withColumn(
        "status",
        F.when(F.col("total_potential_duplicates") == 0, "clean")
        .when(F.col("total_potential_duplicates") <= DUPLICATE_REVIEW_LIMIT, "needs_review")
        .otherwise("significant_issues"),
    )
