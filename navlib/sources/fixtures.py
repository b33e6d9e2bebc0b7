"""NAV-shaped views over the driver's TPC-H-style tables.

The driver ships no fund data, so the test inputs are derived from its tables
(see FIXTURES.md).  Each view has a Spark builder here and an SQL twin in
``FIXTURE_SQL`` that DuckDB runs for the oracle; both produce identical
doubles because the NAV is an exact decimal sum divided by a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The new-name date for the renamed-schemes master and the refresh date of the
# older master used by scheme_details.
RENAME_DATE = "1998-01-01"
MASTER_REFRESH_DATE = "1996-01-01"

# The feed heading and section title lines, as the feed prints them.
FEED_HEADING = "Scheme Code;ISIN Div Payout/ ISIN Growth;ISIN Div Reinvestment;Scheme Name;Net Asset Value;Date"
FEED_TITLES = [
    "Open Ended Schemes(Debt Scheme - Banking and PSU Fund)",
    "Open Ended Schemes(Equity Scheme - Large Cap Fund)",
    "Close Ended Schemes(Income)",
]

# schemes in one partition of the dense series, each with a row for every day
DENSE_SCHEMES = 64
# rows of lineitem for one partition of the series that are dealt by scheme
SCHEME_ROWS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ship_date() -> Column:
    return F.col("l_shipdate").cast("date")


def _avg_price_nav() -> Column:
    # exact decimal sum, then double division: identical in Spark and DuckDB
    return (F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)) / 10).alias("nav")


def _by_scheme(spark: SparkSession, sf_dir: str, daily: DataFrame, key: str, schemes: DataFrame) -> DataFrame:
    """``daily`` with the names of ``schemes``, in partitions by scheme whose rows don't grow with the table.

    It has one row for each scheme and day, so no partition is much larger.  What groups by
    scheme behind it (aggregates, windows) needs no other shuffle of the rows; the names, several
    times as wide as they are, come behind it, dealt alike so that a sort-merge join leaves the rows where they are.
    """
    parts = table(spark, sf_dir, "lineitem").count() // SCHEME_ROWS + 1  # from the footers
    known = daily.where(F.col(key).isNotNull())
    rows = known.select(F.col(key).cast("string").alias("scheme_code"), "date", "nav").repartition(parts, "scheme_code")
    named = rows.join(schemes.repartition(parts, "scheme_code"), "scheme_code")
    return named.select("scheme_code", "scheme_name", "fund_house", "date", "nav")


def nav_s(spark: SparkSession, sf_dir: str, by_scheme: bool = False) -> DataFrame:
    """A scheme is a supplier, its fund house the supplier's nation (dense daily series); the same rows ``by_scheme``."""
    daily = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", _ship_date().alias("date"))
        .agg(_avg_price_nav())
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    if by_scheme:
        houses = sup.join(nat, sup.s_nationkey == nat.n_nationkey).select(
            F.col("s_suppkey").cast("string").alias("scheme_code"),
            F.col("s_name").alias("scheme_name"),
            F.col("n_name").alias("fund_house"),
        )
        return _by_scheme(spark, sf_dir, daily, "l_suppkey", houses)
    return (
        daily.join(sup, daily.l_suppkey == sup.s_suppkey)
        .join(nat, sup.s_nationkey == nat.n_nationkey)
        .select(
            F.col("l_suppkey").cast("string").alias("scheme_code"),
            F.col("s_name").alias("scheme_name"),
            F.col("n_name").alias("fund_house"),
            "date",
            "nav",
        )
    )


def nav_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scheme is a part (short series; many under 30 rows)."""
    daily = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", _ship_date().alias("date"))
        .agg(_avg_price_nav())
    )
    return _by_scheme(spark, sf_dir, daily, "l_partkey", master_p(spark, sf_dir))


def nav_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scheme is a part type: a few dense series, used for correlation."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy("p_type", _ship_date().alias("date"))
        .agg(_avg_price_nav())
        .select(
            F.col("p_type").alias("scheme_code"),
            F.col("p_type").alias("scheme_name"),
            F.lit("all").alias("fund_house"),
            "date",
            "nav",
        )
    )


def _step() -> Column:
    # a whole number from -20 to 20, the same in Spark and DuckDB
    return F.floor(F.col("nav") * 100) % 41 - 20


def _path(start: Column, step: Column) -> Column:
    """A price that compounds: a start and a running sum of whole steps, so that both engines agree to the bit."""
    running = Window.partitionBy("scheme_code").orderBy("date")
    return (F.greatest(start + F.sum(step).over(running), F.lit(50)).cast("double") / 10).alias("nav")


def nav_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nav_s as compounded series: the start price, and so the volatility, depends on the code."""
    start = F.lit(400) * (1 + (F.col("scheme_code").cast("bigint") % 7) * (F.col("scheme_code").cast("bigint") % 7))
    return nav_s(spark, sf_dir).select("scheme_code", "scheme_name", "fund_house", "date", _path(start, _step()))


def nav_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nav_t as compounded series that share a market step, by code length: market only, both, own only."""
    nav = nav_t(spark, sf_dir)
    market = nav.groupBy("date").agg((F.sum(F.floor(F.col("nav") * 100)) % 41 - 20).alias("market"))
    kind = F.length("scheme_code") % 3
    step = F.when(kind == 0, F.col("market")).when(kind == 1, F.col("market") * 2 + _step()).otherwise(_step())
    return nav.join(market, "date").select("scheme_code", "scheme_name", "fund_house", "date", _path(F.lit(20000), step))


def nav_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's compounded price on every day of the table's calendar; suppliers of a nation share its step.

    By code % 4 a price follows the nation's step alone, mostly, partly or not at all.
    """
    # with the filters of both uses, so that they read one shuffle of the table
    nav = nav_s(spark, sf_dir).where(F.col("date").isNotNull() & F.col("scheme_code").isNotNull())
    days = table(spark, sf_dir, "lineitem").agg(F.min(_ship_date()).alias("lo"), F.max(_ship_date()).alias("hi"))
    lo, hi = days.select("lo").scalar(), days.select("hi").scalar()
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    schemes = sup.join(nat, sup.s_nationkey == nat.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("scheme_code"),
        F.col("s_name").alias("scheme_name"),
        F.col("n_name").alias("fund_house"),
    )
    market = nav.groupBy("fund_house", "date").agg((F.sum(F.floor(F.col("nav") * 100)) % 41 - 20).alias("_market"))
    # One shuffle, of the steps by scheme, in partitions of a fixed number of schemes; the days are added behind it.
    parts = sup.count() // DENSE_SCHEMES + 1  # from the footers
    own = nav.select("scheme_code", "date", _step().alias("_own")).repartition(parts, "scheme_code")
    own = own.groupBy("scheme_code").agg(F.collect_list(F.struct("date", "_own")).alias("_days"))
    known = F.coalesce("_days", F.array().cast("array<struct<date:date,_own:bigint>>"))
    others = F.array_except(F.sequence(lo, hi), known["date"]).alias("_others")
    day = F.concat("_known", F.transform("_others", lambda d: F.struct(d.alias("date"), F.lit(None).cast("bigint").alias("_own"))))
    rows = schemes.repartition(parts, "scheme_code").join(own, "scheme_code", "left").select("*", known.alias("_known"), others)
    rows = rows.select("scheme_code", "scheme_name", "fund_house", F.explode(day).alias("_day"))
    # a row for each house and day
    rows = rows.select("scheme_code", "scheme_name", "fund_house", "_day.*").join(F.broadcast(market), ["fund_house", "date"], "left")
    own, market = F.coalesce("_own", F.lit(0)), F.coalesce("_market", F.lit(0))
    kind = F.col("scheme_code").cast("bigint") % 4
    step = F.when(kind == 0, market).when(kind == 1, market * 2 + own).when(kind == 2, market * 2 + own * 3).otherwise(own)
    return rows.select("scheme_code", "scheme_name", "fund_house", "date", _path(F.lit(20000), step))


def nav_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem row, with duplicates, bad codes, null names/NAVs and load ids."""
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    code = F.col("l_suppkey").cast("string")
    return (
        li.join(sup, li.l_suppkey == sup.s_suppkey)
        .join(nat, sup.s_nationkey == nat.n_nationkey)
        .select(
            F.when(F.col("l_suppkey") % 10 == 7, F.concat(F.lit("X"), code)).otherwise(code).alias("scheme_code"),
            F.when(F.col("l_suppkey") % 10 == 3, F.lit(None).cast("string")).otherwise(F.col("s_name")).alias("scheme_name"),
            F.when(F.col("l_quantity") == 13, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice") / 10).alias("nav"),
            _ship_date().alias("date"),
            F.col("n_name").alias("fund_house"),
            F.col("l_linenumber").cast("bigint").alias("load_id"),
            F.col("l_orderkey").alias("tie"),
        )
    )


def master_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheme master of parts: repeated and near-identical names within a brand."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("scheme_code"),
        F.concat_ws(" ", "p_name", "p_type").alias("scheme_name"),
        F.col("p_brand").alias("fund_house"),
    )


def master_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (code, name, house) of a part feed whose names changed on RENAME_DATE.

    Parts traded on both sides of the date appear under two names: the
    duplicate-code case of the scheme master.
    """
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .select(
            F.col("l_partkey").cast("string").alias("scheme_code"),
            F.when(_ship_date() < F.lit(RENAME_DATE).cast("date"), F.col("p_name"))
            .otherwise(F.concat_ws(" ", "p_name", "p_type"))
            .alias("scheme_name"),
            F.col("p_brand").alias("fund_house"),
        )
        .distinct()
    )


def nav_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nav_s on a coarse price grid, so unchanged-NAV runs occur."""
    return nav_s(spark, sf_dir).withColumn("nav", (F.floor(F.col("nav") / 2500) + 1).cast("double"))


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed text (one column ``value``) built from nav_s, with every kind of bad line.

    By day of month: 1 → NAV ``N.A.``, 2 → ``-``, 3 → ``bad``, 4 → date
    ``31-Foo-2024``, 5 → a line with only two fields.  Plus a heading, blank
    lines, section titles and one fund-house title per nation.
    """
    nav = nav_s(spark, sf_dir)
    day = F.dayofmonth("date")
    cents = F.floor(F.col("nav") * 100)
    nav_text = (
        F.when(day == 1, F.lit("N.A."))
        .when(day == 2, F.lit("-"))
        .when(day == 3, F.lit("bad"))
        .otherwise(F.format_string("%d.%02d", F.floor(cents / 100), cents % 100))
    )
    date_text = F.when(day == 4, F.lit("31-Foo-2024")).otherwise(F.date_format("date", "dd-MMM-yyyy"))
    line = F.when(day == 5, F.concat_ws(";", "scheme_code", F.lit("INF"))).otherwise(
        F.concat_ws(";", "scheme_code", F.lit("INF"), F.lit(""), "scheme_name", nav_text, date_text)
    )
    rows = nav.select(line.alias("value"))
    houses = table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"))
    extra = spark.createDataFrame([(FEED_HEADING,), ("",), ("",)] + [(t,) for t in FEED_TITLES], "value string")
    return rows.unionByName(houses).unionByName(extra)


BUILDERS = {
    "nav_s": nav_s,
    "nav_p": nav_p,
    "nav_t": nav_t,
    "nav_c": nav_c,
    "nav_m": nav_m,
    "nav_d": nav_d,
    "nav_ticks": nav_ticks,
    "master_p": master_p,
    "master_renamed": master_renamed,
    "nav_stale": nav_stale,
    "feed_lines": feed_lines,
}


# SQL twins (DuckDB and Spark SQL both run these unchanged).
FIXTURE_SQL = {
    "nav_s": """
SELECT CAST(l_suppkey AS VARCHAR) AS scheme_code, s_name AS scheme_name, n_name AS fund_house,
       CAST(l_shipdate AS DATE) AS date,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 10 AS nav
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
GROUP BY l_suppkey, s_name, n_name, CAST(l_shipdate AS DATE)""",
    "nav_p": """
SELECT CAST(l_partkey AS VARCHAR) AS scheme_code, CONCAT(p_name, ' ', p_type) AS scheme_name, p_brand AS fund_house,
       CAST(l_shipdate AS DATE) AS date,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 10 AS nav
FROM lineitem JOIN part ON p_partkey = l_partkey
GROUP BY l_partkey, p_name, p_type, p_brand, CAST(l_shipdate AS DATE)""",
    "nav_t": """
SELECT p_type AS scheme_code, p_type AS scheme_name, 'all' AS fund_house,
       CAST(l_shipdate AS DATE) AS date,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 10 AS nav
FROM lineitem JOIN part ON p_partkey = l_partkey
GROUP BY p_type, CAST(l_shipdate AS DATE)""",
    "nav_ticks": """
SELECT CASE WHEN l_suppkey % 10 = 7 THEN CONCAT('X', CAST(l_suppkey AS VARCHAR)) ELSE CAST(l_suppkey AS VARCHAR) END AS scheme_code,
       CASE WHEN l_suppkey % 10 = 3 THEN NULL ELSE s_name END AS scheme_name,
       CASE WHEN l_quantity = 13 THEN NULL ELSE l_extendedprice / 10 END AS nav,
       CAST(l_shipdate AS DATE) AS date, n_name AS fund_house,
       CAST(l_linenumber AS BIGINT) AS load_id, l_orderkey AS tie
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "master_p": """
SELECT CAST(p_partkey AS VARCHAR) AS scheme_code, CONCAT(p_name, ' ', p_type) AS scheme_name, p_brand AS fund_house
FROM part""",
    "master_renamed": f"""
SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS scheme_code,
       CASE WHEN CAST(l_shipdate AS DATE) < DATE '{RENAME_DATE}' THEN p_name ELSE CONCAT(p_name, ' ', p_type) END AS scheme_name,
       p_brand AS fund_house
FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "nav_c": """
SELECT scheme_code, scheme_name, fund_house, date,
       CAST(GREATEST(400 * (1 + (CAST(scheme_code AS BIGINT) % 7) * (CAST(scheme_code AS BIGINT) % 7))
            + SUM(CAST(FLOOR(nav * 100) AS BIGINT) % 41 - 20) OVER (PARTITION BY scheme_code ORDER BY date), 50) AS DOUBLE) / 10 AS nav
FROM nav_s""",
    "nav_m": """
SELECT scheme_code, scheme_name, fund_house, date,
       CAST(GREATEST(20000 + SUM(CASE WHEN length(scheme_code) % 3 = 0 THEN market WHEN length(scheme_code) % 3 = 1 THEN market * 2 + own ELSE own END)
            OVER (PARTITION BY scheme_code ORDER BY date), 50) AS DOUBLE) / 10 AS nav
FROM (SELECT *, CAST(FLOOR(nav * 100) AS BIGINT) % 41 - 20 AS own,
             CAST(SUM(CAST(FLOOR(nav * 100) AS BIGINT)) OVER (PARTITION BY date) AS BIGINT) % 41 - 20 AS market FROM nav_t)""",
    "nav_d": """
SELECT scheme_code, scheme_name, fund_house, date,
       CAST(GREATEST(20000 + SUM(CASE kind WHEN 0 THEN market WHEN 1 THEN market * 2 + own WHEN 2 THEN market * 2 + own * 3 ELSE own END)
            OVER (PARTITION BY scheme_code ORDER BY date), 50) AS DOUBLE) / 10 AS nav
FROM (SELECT d.*, s_suppkey % 4 AS kind, COALESCE(CAST(FLOOR(nav_s.nav * 100) AS BIGINT) % 41 - 20, 0) AS own, COALESCE(market, 0) AS market
      FROM (SELECT CAST(s_suppkey AS VARCHAR) AS scheme_code, s_suppkey, s_name AS scheme_name, n_name AS fund_house, CAST(day AS DATE) AS date
            FROM supplier JOIN nation ON n_nationkey = s_nationkey
            CROSS JOIN (SELECT UNNEST(generate_series(MIN(CAST(l_shipdate AS DATE)), MAX(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS day
                        FROM lineitem)) d
      LEFT JOIN nav_s ON nav_s.scheme_code = d.scheme_code AND nav_s.date = d.date
      LEFT JOIN (SELECT fund_house, date, CAST(SUM(CAST(FLOOR(nav * 100) AS BIGINT)) AS BIGINT) % 41 - 20 AS market FROM nav_s GROUP BY ALL) m
             ON m.fund_house = d.fund_house AND m.date = d.date)""",
    "nav_stale": """
SELECT scheme_code, scheme_name, fund_house, date, CAST(FLOOR(nav / 2500) + 1 AS DOUBLE) AS nav FROM nav_s""",
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the fixture views it uses, as CTEs (dependencies first)."""
    order = []
    for name in names:
        base = {"nav_stale": "nav_s", "nav_c": "nav_s", "nav_d": "nav_s", "nav_m": "nav_t"}.get(name)
        if base and base not in order:
            order.append(base)
        if name not in order:
            order.append(name)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]}\n)" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
