"""Risk reports from month states (OP31, OP38, OP40-OP42, OP44, OP47, OP49).

A month state is what the rows of one scheme in one month add to the reports:
first and last row, counts, means and second to fourth central moments of
the returns, the runs of unchanged NAV at its start, at its end and the
longest, and numbers of jumps and invalid values.  States don't depend on other months, so a new or corrected month
reads its own rows only (``refresh_month_states``), and all of history is a table with
one row per scheme and month.

The return across a month border belongs to no state: it comes from the last
row of the month before and the first of this one, and counts as a segment of
one row.  Moments of segments add up around the scheme's common mean (no value is
subtracted from a sum); runs are folded over a scheme's segments in date order, a
calendar-bounded list.

Extreme returns depend on the mean and sd of all returns, so no state can count
them; but its least and greatest return tell whether a month has any, and only
the rows of such scheme-months are read (``anomaly_summary``).

Reports equal those over all rows (``operators.risk``, ``operators.anomaly``)
to the displayed digits.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navlib.functions.stats import ANNUAL_SQRT, excess_kurtosis, sample_skewness
from navlib.operators import anomaly as A
from navlib.operators import returns as P
from navlib.operators import risk as V
from navlib.operators.master import with_partition_columns
from navlib.schema import PARTITION_COLUMNS
from navlib.session import checkpointed
from navlib.sources.store import read_table, write_table

KEY = "scheme_code"
# returns counted: all, and of rows with a name those of any, of negative and of positive sign
SETS = ("all", "named", "negative", "positive")


def _moments(r: Column) -> Column:
    """Aggregate: n, mean and sums of powers of deviations from it, least and greatest value."""
    n = F.count(r).cast("double")
    m2 = F.coalesce(F.var_pop(r) * n, F.lit(0.0))
    m3 = F.when(m2 > 0, F.skewness(r) * F.pow(m2, 1.5) / F.sqrt(n)).otherwise(F.lit(0.0))
    m4 = F.when(m2 > 0, (F.kurtosis(r) + 3) * m2 * m2 / n).otherwise(F.lit(0.0))
    return F.struct(
        F.count(r).alias("n"),
        F.coalesce(F.avg(r), F.lit(0.0)).alias("mean"),
        m2.alias("m2"),
        F.coalesce(m3, F.lit(0.0)).alias("m3"),
        F.coalesce(m4, F.lit(0.0)).alias("m4"),
        F.min(r).alias("low"),
        F.max(r).alias("high"),
    )


def _one_return(r: Column) -> Column:
    """The moments of a single return (of none, where it is null)."""
    zero = F.lit(0.0)
    return F.struct(
        F.when(r.isNull(), 0).otherwise(1).cast("bigint").alias("n"),
        F.coalesce(r, zero).alias("mean"),
        zero.alias("m2"),
        zero.alias("m3"),
        zero.alias("m4"),
        r.alias("low"),
        r.alias("high"),
    )


def _sets(r: Column, name: Column) -> dict[str, Column]:
    named = F.when(name.isNotNull(), r)
    return {"all": r, "named": named, "negative": F.when(named < 0, named), "positive": F.when(named > 0, named)}


def _is_jump(nav: Column, before: Column, threshold: float = A.JUMP_THRESHOLD) -> Column:
    return F.abs(F.try_divide(nav - before, before)) > threshold


def _month_returns(nav: DataFrame) -> DataFrame:
    """Current rows with year, month and the return on the row before in the same month."""
    rows = P.current_rows(nav).withColumn("year", F.year("date")).withColumn("month", F.month("date"))
    series = Window.partitionBy(KEY, *PARTITION_COLUMNS).orderBy("date")
    return rows.withColumn("r", F.try_divide(F.col("nav"), F.lag("nav").over(series)) - 1)


def month_states(nav: DataFrame) -> DataFrame:
    """One row per scheme, year and month with the state of its rows."""
    month = [KEY, *PARTITION_COLUMNS]
    series = Window.partitionBy(*month).orderBy("date")
    x = _month_returns(nav)
    # analysed rows: those with a return and a name; unchanged runs go from one to the next
    x = x.withColumn("_analysed", F.col("r").isNotNull() & F.col("scheme_name").isNotNull())
    seen = F.last(F.when(F.col("_analysed"), F.col("nav")), ignorenulls=True)
    before = seen.over(series.rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("_before", before)
    x = x.withColumn("_same", F.col("_analysed") & F.coalesce(F.col("nav") == F.col("_before"), F.lit(False)))
    running = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("_island", F.count_if(F.col("_analysed") & ~F.col("_same")).over(running))
    island = Window.partitionBy(*month, "_island")
    x = x.withColumn("_run", F.count_if("_same").over(island))
    at = F.when(F.col("_analysed"), F.col("date"))
    analysed = lambda c: F.when(F.col("_analysed"), F.col(c))
    return x.groupBy(*month).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(F.struct("date", "nav", "scheme_name")).alias("first"),
        F.max(F.struct("date", "nav")).alias("last"),
        *[_moments(r).alias(name) for name, r in _sets(F.col("r"), F.col("scheme_name")).items()],
        F.count_if(F.col("r") > 0).alias("up"),
        F.count_if(F.col("r") < 0).alias("down"),
        F.min(at).alias("start_date"),
        F.max(at).alias("end_date"),
        F.min_by("scheme_name", at).alias("start_name"),
        F.struct(
            F.count_if("_analysed").alias("n"),
            F.min_by("nav", at).alias("first"),
            F.max_by("nav", at).alias("last"),
            F.coalesce(F.max(F.when(F.col("_island") == 1, analysed("_run"))), F.lit(0)).cast("bigint").alias("prefix"),
            F.coalesce(F.max_by("_run", at), F.lit(0)).cast("bigint").alias("suffix"),
            F.coalesce(F.max(analysed("_run")), F.lit(0)).cast("bigint").alias("best"),
            (F.max("_island") <= 1).alias("whole"),
            F.count_if(F.col("_analysed") & F.coalesce(_is_jump(F.col("nav"), F.col("_before")), F.lit(False))).alias("jumps"),
            F.count_if(F.col("_analysed") & A._is_invalid()).alias("invalid"),
        ).alias("runs"),
    )


def refresh_month_states(
    spark: SparkSession, path: str, nav: DataFrame, months: Iterable[tuple[int, int]] | None = None
) -> DataFrame:
    """Write the states of the given (year, month) pairs of ``nav`` (None: all) to the table at ``path``; returns the table.

    The months' folders are replaced, other months are neither read nor
    written where ``nav`` is partitioned by (year, month).
    """
    if months is not None:
        wanted = sorted({y * 100 + m for y, m in months})  # a calendar-bounded list
        nav = nav.where((F.col("year") * 100 + F.col("month")).isin(wanted))
    write_table(month_states(nav), path, PARTITION_COLUMNS, "overwrite", touched_only=months is not None)
    return read_table(spark, path)


def _with_border(states: DataFrame) -> DataFrame:
    """States with the return over the border to the month before (null for a scheme's first month)."""
    before = F.lag("last").over(Window.partitionBy(KEY).orderBy(*PARTITION_COLUMNS))
    r = F.try_divide(F.col("first.nav"), before.getField("nav")) - 1
    return states.withColumn("_r", r).withColumn("_named", F.col("_r").isNotNull() & F.col("first.scheme_name").isNotNull())


def merged_states(states: DataFrame) -> DataFrame:
    """One row per scheme: rows, days up and down, first analysed date and name, last one, and the moments of each set."""
    x = _with_border(states)
    border_sets = _sets(F.col("_r"), F.col("first.scheme_name"))
    day = F.when(F.col("_named"), F.col("first.date"))
    zero = F.lit(0).cast("bigint")
    border = F.struct(
        zero.alias("rows"),
        F.when(F.col("_r") > 0, 1).otherwise(0).cast("bigint").alias("up"),
        F.when(F.col("_r") < 0, 1).otherwise(0).cast("bigint").alias("down"),
        day.alias("start_date"),
        day.alias("end_date"),
        F.when(F.col("_named"), F.col("first.scheme_name")).alias("start_name"),
        *[_one_return(r).alias(name) for name, r in border_sets.items()],
    )
    inner = F.struct("rows", "up", "down", "start_date", "end_date", "start_name", *SETS)
    parts = x.select(KEY, F.inline(F.array(border, inner)))
    whole = Window.partitionBy(KEY)
    for s in SETS:
        n = F.col(f"{s}.n")
        parts = parts.withColumn(f"_{s}", F.try_divide(F.sum(n * F.col(f"{s}.mean")).over(whole), F.sum(n).over(whole)))

    def total(s: str) -> Column:
        n, m2, m3, m4 = (F.col(f"{s}.{c}") for c in ("n", "m2", "m3", "m4"))
        d = F.col(f"{s}.mean") - F.col(f"_{s}")
        return F.struct(
            F.sum(n).alias("n"),
            F.first(f"_{s}").alias("mean"),
            F.sum(m2 + n * d * d).alias("m2"),
            F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("m3"),
            F.sum(m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("m4"),
            F.min(f"{s}.low").alias("low"),
            F.max(f"{s}.high").alias("high"),
        ).alias(s)

    return parts.groupBy(KEY).agg(
        *[F.sum(c).alias(c) for c in ("rows", "up", "down")],
        F.min("start_date").alias("start_date"),
        F.max("end_date").alias("end_date"),
        F.min_by("start_name", "start_date").alias("scheme_name"),
        *[total(s) for s in SETS],
    )


def _sd(s: str) -> Column:
    return F.when(F.col(f"{s}.n") > 1, F.sqrt(F.col(f"{s}.m2") / (F.col(f"{s}.n") - 1)))


def _analysed(merged: DataFrame, min_rows: int = V.MIN_NAV_ROWS, min_returns: int = V.MIN_RETURNS) -> DataFrame:
    return merged.where((F.col("rows") >= min_rows) & (F.col("named.n") >= min_returns))


def return_stats(merged: DataFrame) -> DataFrame:
    """OP31 from ``merged_states``."""
    per = merged.where(F.col("all.n") > 0).select(
        KEY,
        F.col("all.n").alias("_nr"),
        _sd("all").alias("_sd"),
        F.col("all.high").alias("_rmax"),
        F.col("all.low").alias("_rmin"),
        F.col("up").alias("positive_days"),
        F.col("down").alias("negative_days"),
    )
    return per.select(KEY, *P._stat_columns())


def basic_volatility(merged: DataFrame) -> DataFrame:
    """OP38 from ``merged_states``."""
    per = _analysed(merged)
    return V.basic_columns(per.withColumn("total_days", F.col("named.n")).withColumn("_sd", _sd("named")))


def _side(merged: DataFrame, s: str) -> DataFrame:
    return _analysed(merged).select(
        KEY, F.col(f"{s}.n").alias("_m"), F.col("named.n").alias("_n"), _sd(s).alias("_sd"), F.col(f"{s}.mean").alias("_mean"), F.col(f"{s}.low").alias("_low"), F.col(f"{s}.high").alias("_high")
    )


def downside_risk(merged: DataFrame) -> DataFrame:
    """OP40 from ``merged_states``."""
    return V.downside_columns(_side(merged, "negative").withColumnRenamed("_low", "_ext"))


def upside_potential(merged: DataFrame) -> DataFrame:
    """OP41 from ``merged_states``."""
    return V.upside_columns(_side(merged, "positive").withColumnRenamed("_high", "_ext"))


def risk_statistics(merged: DataFrame) -> DataFrame:
    """OP42 from ``merged_states``."""
    n, m2, m3, m4 = (F.col(f"named.{c}") for c in ("n", "m2", "m3", "m4"))
    g1 = F.try_divide(F.sqrt(n) * m3, F.pow(m2, 1.5))
    g2 = F.try_divide(n * m4, m2 * m2) - 3
    per = _analysed(merged).select(
        KEY,
        F.col("named.mean").alias("_mean"),
        _sd("named").alias("_sd"),
        sample_skewness(n, g1, m2 == 0).alias("_skew"),
        excess_kurtosis(n, g2, m2 == 0).alias("_kurt"),
    )
    return V.statistics_columns(per)


def volatility_regime(merged: DataFrame) -> DataFrame:
    """OP44 from ``merged_states``."""
    return V.regime_columns(_analysed(merged).select(KEY, (_sd("named") * F.lit(ANNUAL_SQRT)).alias("_vol")))


def _folded(states: DataFrame) -> DataFrame:
    """Per scheme, its segments in date order: longest run, jumps and invalid values, first analysed name."""
    nav, none = F.col("first.nav"), F.lit(0).cast("bigint")
    border = F.struct(
        F.when(F.col("_named"), 1).otherwise(0).cast("bigint").alias("n"),
        nav.alias("first"),
        nav.alias("last"),
        none.alias("prefix"),
        none.alias("suffix"),
        none.alias("best"),
        F.lit(True).alias("whole"),
        none.alias("jumps"),
        F.when((nav <= A.NAV_MIN_EXCLUSIVE) | (nav > A.NAV_MAX_INCLUSIVE), 1).otherwise(0).cast("bigint").alias("invalid"),
    )
    x = _with_border(states)
    segment = lambda part, s: F.struct("year", "month", F.lit(part).alias("part"), s.alias("s"))
    day = F.when(F.col("_named"), F.col("first.date")).otherwise(F.col("start_date"))
    name = F.when(F.col("_named"), F.col("first.scheme_name")).otherwise(F.col("start_name"))
    per = x.groupBy(KEY).agg(
        F.array_sort(F.flatten(F.collect_list(F.array(segment(0, border), segment(1, F.col("runs")))))).alias("_segments"),
        F.min_by(name, day).alias("scheme_name"),
    )

    def append(done: Column, segment: Column) -> Column:
        s = segment.getField("s")
        joined = F.coalesce(done.getField("last") == s.getField("first"), F.lit(False))
        lead = F.when(joined, done.getField("run") + 1 + s.getField("prefix")).otherwise(s.getField("prefix"))
        jump = F.when(_is_jump(s.getField("first"), done.getField("last")), 1).otherwise(0)
        return F.struct(
            s.getField("last").alias("last"),
            F.when(s.getField("whole"), lead).otherwise(s.getField("suffix")).alias("run"),
            F.greatest(done.getField("best"), lead, s.getField("best")).alias("best"),
            (done.getField("jumps") + s.getField("jumps") + jump).alias("jumps"),
            (done.getField("invalid") + s.getField("invalid")).alias("invalid"),
        )

    start = F.struct(F.lit(None).cast("double").alias("last"), *[none.alias(c) for c in ("run", "best", "jumps", "invalid")])
    rows = F.filter("_segments", lambda g: g.getField("s").getField("n") > 0)
    return per.select(KEY, "scheme_name", F.aggregate(rows, start, append).alias("_f"))


def stale_nav(states: DataFrame, min_run: int = A.STALE_MIN_RUN) -> DataFrame:
    """OP47 from ``month_states``: a scheme's segments are folded in date order."""
    return A.stale_columns(_folded(states).withColumn("max_consecutive_unchanged", F.col("_f.best")), min_run)


def anomaly_summary(
    states: DataFrame,
    nav: DataFrame,
    threshold_std: float = A.DEFAULT_STD_THRESHOLD,
    min_run: int = A.STALE_MIN_RUN,
    min_data_points: int = A.MIN_DATA_POINTS,
) -> DataFrame:
    """OP49 from ``month_states``; of ``nav`` only the scheme-months that have an extreme return are read.

    ``min_data_points`` counts one row a scheme and date.  Jumps are those
    above the threshold that the states were made with.
    """
    named = lambda c: F.col(f"named.{c}")
    merged = checkpointed(merged_states(states).select(KEY, "rows", "start_date", "end_date", "named"))
    n, mean = merged.agg(F.sum(named("n")), F.try_divide(F.sum(named("n") * named("mean")), F.sum(named("n")))).first()
    rows = merged.agg(F.sum("rows")).first()[0] or 0
    enough = bool(n) and rows >= min_data_points
    apart = named("mean") - F.lit(mean or 0.0)
    m2 = merged.agg(F.sum(named("m2") + named("n") * apart * apart)).first()[0] if enough else None
    sd = (m2 / (n - 1)) ** 0.5 if enough and n > 1 else None
    low, high = (mean - threshold_std * sd, mean + threshold_std * sd) if sd is not None else (None, None)
    limit = lambda x: F.lit(x).cast("double")
    outside = lambda r: (r < limit(low)) | (r > limit(high))

    x = _with_border(states)
    borders = x.where(F.col("_named") & outside(F.col("_r"))).select(F.count(F.lit(1))).scalar()
    flagged = checkpointed(states.where((named("low") < limit(low)) | (named("high") > limit(high))).select(KEY, *PARTITION_COLUMNS))
    months = sorted(r.year * 100 + r.month for r in flagged.select(*PARTITION_COLUMNS).distinct().collect())  # a calendar-bounded list
    read = with_partition_columns(nav).where((F.col("year") * 100 + F.col("month")).isin(months))
    inner = _month_returns(read.join(flagged, [KEY, *PARTITION_COLUMNS], "left_semi"))
    extremes = inner.where(outside(F.col("r")) & F.col("scheme_name").isNotNull()).select(F.count(F.lit(1))).scalar()

    folded = _folded(states).select(
        F.sum("_f.jumps").alias("jumps"), F.sum("_f.invalid").alias("invalid"), F.count_if(F.col("_f.best") >= min_run).alias("stale")
    )
    total = merged.agg(
        F.sum(named("n")).alias("total_data_points_analyzed"),
        F.count_if(named("n") > 0).alias("unique_schemes_analyzed"),
        F.min("start_date").alias("start"),
        F.max("end_date").alias("end"),
    ).where(F.lit(enough))
    figure = lambda c: folded.select(c).scalar()
    s = total.select(
        "*",
        (borders + extremes).alias("extreme_returns"),
        figure("jumps").alias("nav_jumps"),
        figure("stale").alias("suspicious_patterns"),
        figure("invalid").alias("data_quality_issues"),
    )
    return A.summary_columns(s)
