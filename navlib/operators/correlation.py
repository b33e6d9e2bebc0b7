"""Return correlation between schemes (OP50-OP56).

The schemes compared are an explicit list, the ``top_k`` most observed ones
(OP50), or with ``codes="all"`` every scheme with enough rows; one of these must
be asked for, as the result has a row for every pair.  Returns are computed after the
``since`` cut, then dates are kept only where every scheme with enough data
has a return (listwise deletion).

Pearson's r is a tiled matrix product.  Every scheme is one row with its
returns on the common dates (bounded by the calendar).  Up to ``TILE`` schemes, and
``TILE_BYTES`` of centred and scaled rows, are packed into one stored row, a tile, some of them
into a partition, and the cartesian product gives each two partitions to a task, which
multiplies each two of their tiles.  Its tasks read the stored tiles: nothing is shuffled, and the bytes
stored are those of one row for each scheme.  A task holds the tiles of one partition, whatever
the number of schemes, and no scheme code or pair reaches the driver.

``high_correlation_pairs`` and the statistics multiply in single precision and
compute again in doubles what its error could change.  For the high pairs, random
hyperplanes give each scheme a signature of bits, schemes that agree
on a whole band of bits are candidates, the number of bits in which two
signatures differ drops those that are far off, and r itself decides the rest.
"""

from __future__ import annotations

import datetime as dt
import functools
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navlib.functions.stats import half_up
from navlib.session import checkpointed

# executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = "scheme_code"

# Defaults and thresholds of the correlation report.
DEFAULT_MIN_OVERLAP = 100
DEFAULT_TOP_K = 10
HIGH_CORRELATION = 0.8
LOW_CORRELATION = 0.3
SCORE_EXCELLENT = 70
SCORE_GOOD = 50
CONCENTRATION_MEDIUM = 2
REDUCE_ADVICE_ABOVE = 3

ALL = "all"
TILE = 4096  # most schemes of a tile
TILE_BYTES = 1 << 23  # most bytes of a tile's rows (one scheme's, if longer)
TILES_HELD = 8  # full tiles of a stored partition, all held by a task that multiplies them by another partition's
SMALL_TILE, TILES_WANTED = 256, 8  # fewer schemes are dealt to so many tiles, of 256 at least
BLOCK_PAIRS = 1 << 18
ONE = 1 - 1e-12  # r of a pair in proportion, but for rounding
# random-hyperplane signatures: two schemes of r = 0.8 agree on one band at least with probability 0.9998
BAND_BITS = 12
BANDS = 128
VERIFY_PAIRS = 1 << 11


def _since(nav: DataFrame, since: str | dt.date | None) -> DataFrame:
    if since is None:
        return nav
    d = since if isinstance(since, dt.date) else dt.date.fromisoformat(str(since))
    return nav.where(F.col("date") >= F.lit(d))


def most_observed_schemes(
    nav: DataFrame,
    since: str | dt.date | None = None,
    min_rows: int = DEFAULT_MIN_OVERLAP,
    k: int = DEFAULT_TOP_K,
) -> DataFrame:
    """OP50: the ``k`` schemes with most NAV rows since ``since`` (at least ``min_rows``)."""
    counts = (
        _since(nav, since)
        .where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(
            F.count(F.lit(1)).alias("data_points"),
            F.min_by("scheme_name", F.struct("date", "scheme_name")).alias("scheme_name"),
        )
        .where(F.col("data_points") >= min_rows)
    )
    return counts.orderBy(F.col("data_points").desc(), F.col(KEY)).limit(k)


@dataclass
class _Inputs:
    series: DataFrame  # a row for each scheme with returns, see _prepare
    availability: DataFrame
    valid: DataFrame  # scheme_code
    matrix: DataFrame
    n_valid: Column
    usable: Column  # the matrix has rows: two schemes and enough common dates
    common: Column  # struct of the first common date and a flag for every day from there
    days: DataFrame  # the common dates


def _requested(recent: DataFrame, codes: Sequence[str] | None, min_overlap: int, top_k: int | None) -> DataFrame:
    if codes is None:
        return most_observed_schemes(recent, None, min_overlap, top_k).select(KEY)
    return recent.sparkSession.createDataFrame([(c,) for c in dict.fromkeys(str(c) for c in codes)], f"{KEY} string")


def _daily(rows: DataFrame) -> DataFrame:
    """``current_rows``, a null ``_v`` for keys without a date or NAV, and how many rows each key has: one pass gives returns and counts."""
    loads = [c for c in ("load_id", "loaded_at") if c in rows.columns]
    newest = F.when(F.col("date").isNotNull() & F.col("nav").isNotNull(), F.struct(*loads, "nav", "scheme_name"))
    return rows.groupBy(KEY, "date").agg(F.max(newest).alias("_v"), F.count(F.lit(1)).alias("_rows"))


def _prepare(
    nav: DataFrame,
    codes: Sequence[str] | str | None,
    since: str | dt.date | None,
    min_overlap: int,
    top_k: int | None,
) -> _Inputs:
    if codes is None and not top_k:
        raise ValueError('give the codes to correlate, top_k or codes="all": the result has a row for every pair of them')
    if isinstance(codes, str) and codes != ALL:
        raise ValueError('codes is a list of scheme codes or "all"')
    rows = _since(nav, since).where(F.col(KEY).isNotNull())
    requested = None
    if codes != ALL:
        requested = checkpointed(_requested(rows, codes, min_overlap, top_k))
        rows = rows.join(requested, KEY, "left_semi")
    # Read by every later step, computed once.  A scheme is one row with its dates and returns in two
    # lists as long as the calendar: a tenth of the bytes of a row for each date, and no later shuffle by scheme.
    before = Window.partitionBy(KEY).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    r = F.try_divide(F.col("_v.nav"), F.last("_v.nav", ignorenulls=True).over(before)) - 1
    rets = _daily(rows).select(KEY, "date", "_rows", "_v.scheme_name", r.alias("r"))
    used = F.when(F.col("r").isNotNull() & F.col("scheme_name").isNotNull(), F.col("date"))
    series = (
        rets.select("*", used.alias("_used"))
        .groupBy(KEY)
        .agg(
            F.sum("_rows").alias("_rows"),
            F.count("_used").alias("total_days"),
            F.min("_used").alias("start_date"),
            F.max("_used").alias("end_date"),
            F.min_by("scheme_name", "_used").alias("scheme_name"),
            F.array_sort(F.collect_list(F.when(F.col("_used").isNotNull(), F.struct("date", "r")))).alias("_v"),
        )
    )
    if requested is None:
        series = series.where(F.col("_rows") >= min_overlap)
    series = checkpointed(
        series.select(KEY, "scheme_name", "total_days", "start_date", "end_date", F.col("_v.date").alias("date"), F.col("_v.r").alias("r"))
    )
    known = series.drop("date", "r")
    availability = (known if requested is None else requested.join(known, KEY, "left")).select(
        KEY,
        "scheme_name",
        F.coalesce(F.col("total_days"), F.lit(0)).cast("bigint").alias("total_days"),
        "start_date",
        "end_date",
    )
    kept = series.where(F.col("total_days") >= max(min_overlap, 1))
    valid = checkpointed(kept.select(KEY))
    n_valid = valid.select(F.count(F.lit(1))).scalar()
    per_day = kept.select(F.explode("date").alias("date")).groupBy("date").agg(F.count(F.lit(1)).alias("_k"))
    common = checkpointed(per_day.where(F.col("_k") == n_valid).select("date"))
    ok = (n_valid >= 2) & (common.select(F.count(F.lit(1))).scalar() >= min_overlap)
    rows = kept.select(KEY, F.explode(F.arrays_zip("date", "r")).alias("_v")).select("_v.date", KEY, "_v.r")
    matrix = rows.join(F.broadcast(common), "date", "left_semi").where(ok).select("date", KEY, "r")  # common: a calendar at most
    span = common.agg(F.min("date").alias("first"), F.max("date").alias("last"), F.collect_set("date").alias("dates"))
    flags = F.transform(F.sequence("first", "last"), lambda d: F.array_contains("dates", d))
    return _Inputs(kept, availability, valid, matrix, n_valid, ok, span.select(F.struct("first", flags.alias("on"))).scalar(), common)


def returns_matrix(
    nav: DataFrame,
    codes: Sequence[str] | str | None = None,
    since: str | dt.date | None = None,
    min_overlap: int = DEFAULT_MIN_OVERLAP,
    top_k: int | None = None,
) -> DataFrame:
    """OP51: (date, scheme_code, r) on the dates where every scheme with enough data has a return."""
    return _prepare(nav, codes, since, min_overlap, top_k).matrix.select("date", KEY, "r")


def returns_matrix_wide(
    nav: DataFrame,
    codes: Sequence[str] | str | None = None,
    since: str | dt.date | None = None,
    min_overlap: int = DEFAULT_MIN_OVERLAP,
    top_k: int | None = None,
) -> DataFrame:
    """OP51, display form: one row per date, one column per scheme (for as many schemes as a table has columns)."""
    inp = _prepare(nav, codes, since, min_overlap, top_k)
    names = [r[KEY] for r in inp.valid.orderBy(KEY).collect()]
    return inp.matrix.groupBy("date").pivot(KEY, names).agg(F.first("r")).orderBy("date")


def data_availability(
    nav: DataFrame,
    codes: Sequence[str] | str | None = None,
    since: str | dt.date | None = None,
    min_overlap: int = DEFAULT_MIN_OVERLAP,
    top_k: int | None = None,
) -> DataFrame:
    """OP52: per requested scheme, number of returns, first/last date and name (0 when absent)."""
    return _prepare(nav, codes, since, min_overlap, top_k).availability


def _vectors(inp: _Inputs) -> DataFrame:
    """(scheme_code, scheme_name, x): each scheme's returns on the common dates, in date order; as many values as there are dates."""
    on = lambda v: F.coalesce(F.get("_common.on", F.date_diff(v["date"], F.col("_common.first"))), F.lit(False))
    x = F.filter(F.arrays_zip("date", "r"), on)["r"]
    rows = inp.series.where(inp.usable).withColumn("_common", inp.common)
    return rows.select(KEY, "scheme_name", x.alias("x")).where(F.size("x") > 0)


def _standard(x: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    """Centred rows of length 1; rows of one value become NaN."""
    flat = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    z = flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
    constant = z.max(axis=1) == z.min(axis=1)
    z = z - z.mean(axis=1, keepdims=True)
    size = np.sqrt((z * z).sum(axis=1, keepdims=True))
    size[constant | (size[:, 0] == 0)] = np.nan
    return z / size


def _packed(most: int, size: int, bits: int = 0, bands: int = 0):
    """Task function: a task's schemes as tiles of up to ``most`` schemes and ``size`` bytes of standardised rows, behind a row of nulls.

    With ``bands``, a tile has its schemes' signatures also.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pylist([dict.fromkeys(_TILE_SCHEMA.names)], _TILE_SCHEMA)
        held, n, room = [], 0, most
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, room - n)
                z = _standard(part.column("x"), part.num_rows)
                room = min(most, max(1, size // z[0].nbytes))
                part, z = part.slice(0, room - n), z[: room - n]
                held.append((part.column(KEY), part.column("scheme_name"), z))
                n, at = n + len(z), at + len(z)
                if n == room:
                    yield _tile_row(held, bits, bands)
                    held, n = [], 0
        if held:
            yield _tile_row(held, bits, bands)

    return run


_TILE_TYPE = "codes array<string>, names array<string>, z binary, bands binary"
_TILE_SCHEMA = pa.schema([("codes", pa.list_(pa.string())), ("names", pa.list_(pa.string())), ("z", pa.binary()), ("bands", pa.binary())])


def _tile_row(held: list[tuple[pa.Array, pa.Array, np.ndarray]], bits: int, bands: int) -> pa.RecordBatch:
    codes, names, z = zip(*held, strict=True)
    lists = [pa.ListArray.from_arrays([0, sum(map(len, c))], pa.concat_arrays(c)) for c in (codes, names)]
    rows = np.concatenate(z)
    values = [pa.array([x.tobytes()], pa.binary()) for x in (rows, _signatures(rows, bits, bands))]
    return pa.RecordBatch.from_arrays([*lists, *values], _TILE_SCHEMA.names)


def _signatures(z: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """Each scheme's bits against the hyperplanes of every band (the same in all tasks), one key for a band."""
    keys = np.empty((len(z), bands), np.int32)
    weights = 1 << np.arange(bits)
    for band in range(bands):
        planes = np.random.default_rng([band, bits]).standard_normal((z.shape[1], bits))
        keys[:, band] = (z @ planes > 0) @ weights
    return keys


class _Tile:
    """Codes, names and standardised rows of one tile of a pair."""

    def __init__(self, batch: pa.RecordBatch, row: int, side: int) -> None:
        self.codes, self.names = (batch.column(f"{c}{side}")[row].values for c in ("codes", "names"))
        self.rows = len(self.codes)
        self.z = np.frombuffer(batch.column(f"z{side}")[row].as_buffer(), np.float64).reshape(self.rows, -1)
        self.keys = np.frombuffer(batch.column(f"bands{side}")[row].as_buffer(), np.int32).reshape(self.rows, -1)

    @functools.cached_property
    def at(self) -> np.ndarray:
        """The rows that have an r, those of more than one value."""
        return np.nonzero(~np.isnan(self.z[:, 0]))[0]

    @functools.cached_property
    def varied(self) -> np.ndarray:
        return self.z if len(self.at) == self.rows else self.z[self.at]

    @functools.cached_property
    def single(self) -> np.ndarray:
        return self.varied.astype(np.float32)

    @functools.cached_property
    def total(self) -> np.ndarray:
        return self.varied.sum(axis=0)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Tile, _Tile]]:
    """Each two tiles of the partitions of ``_tile_pairs``; one object, where both are the same."""
    held, last = [], None
    for batch in batches:
        for row in range(batch.num_rows):
            cell = (batch.column("part1")[row].as_py(), batch.column("part2")[row].as_py())
            if cell != last:
                held, met, last = [], False, cell
            if batch.column("z1")[row].is_valid:
                one, met = _Tile(batch, row, 1), True
                for two in held:
                    yield one, two
                if cell[0] == cell[1]:
                    yield one, one
                    held.append(one)
            else:
                if met:
                    raise RuntimeError("a tile of the second partition came behind one of the first")
                held.append(_Tile(batch, row, 2))


def _blocks(one: _Tile, two: _Tile) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rho) for some rows of ``one`` at a time against all of ``two``: no task holds all its pairs."""
    step = max(1, BLOCK_PAIRS // two.rows)
    for at in range(0, one.rows, step):
        yield at, one.z[at : at + step] @ two.z.T


def _each_pair_once(one: _Tile, two: _Tile) -> Iterator[tuple[int, np.ndarray]]:
    """``_blocks`` with every pair of different schemes once, NaN in the other places."""
    for at, rho in _blocks(one, two):
        if one is two:
            rho[np.arange(len(rho))[:, None] + at >= np.arange(two.rows)] = np.nan
        yield at, rho


_PAIR_NAMES = ["scheme1", "scheme2", "rho", "overlap_days"]


def _product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All ordered pairs of the schemes of two tiles (of one tile, where both are the same)."""
    for one, two in _tiles(batches):
        for at, block in _blocks(one, two):
            rho = pa.array(block.ravel(), from_pandas=True)  # NaN is null
            a = one.codes.take(pa.array(np.repeat(np.arange(at, at + len(block)), two.rows)))
            b = two.codes.take(pa.array(np.tile(np.arange(two.rows), len(block))))
            days = pa.array(np.full(len(rho), one.z.shape[1]))
            yield pa.RecordBatch.from_arrays([a, b, rho, days], _PAIR_NAMES)
            if one is not two:
                yield pa.RecordBatch.from_arrays([b, a, rho, days], _PAIR_NAMES)


_NAMED = "scheme1 string, scheme1_name string, scheme2 string, scheme2_name string, rho double, kind string"


class _Names:
    """Codes and names of two tiles, and each code's place in the order of both, so that no pair compares strings."""

    def __init__(self, codes: list[pa.Array], names: list[pa.Array]) -> None:
        self.codes, self.names, self.second = pa.concat_arrays(codes), pa.concat_arrays(names), len(codes[0])
        self.place = np.empty(len(self.codes), np.int64)
        self.place[pa.compute.array_sort_indices(self.codes).to_numpy()] = np.arange(len(self.codes))  # by bytes, as Spark compares

    def rows(self, p: np.ndarray, q: np.ndarray, rho: np.ndarray, kinds: pa.Array) -> pa.RecordBatch:
        """Rows of ``_NAMED`` for row p of the first and q of the second, the smaller code first."""
        p, q = p.astype(np.int64), q.astype(np.int64) + self.second
        less = self.place[p] < self.place[q]
        a, b = (pa.array(np.where(less, *x)) for x in ((p, q), (q, p)))
        columns = [self.codes.take(a), self.names.take(a), self.codes.take(b), self.names.take(b), pa.array(rho), kinds]
        return pa.RecordBatch.from_arrays(columns, ["scheme1", "scheme1_name", "scheme2", "scheme2_name", "rho", "kind"])


def _notable(high: float, low: float):
    """Task function: the notable pairs of two tiles, so that no other pair leaves the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, two in _tiles(batches):
            named = _Names([one.codes, two.codes], [one.names, two.names])
            for at, rho in _each_pair_once(one, two):
                p, q = np.nonzero((rho > high) | (np.abs(rho) < low))
                r = rho[p, q]
                if len(r):
                    yield named.rows(p + at, q, r, pa.compute.if_else(pa.array(r > high), "high", "low"))

    return run


_FIGURES = "n bigint, total double, most double, least double, high bigint"


def _exact(z1: np.ndarray, z2: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """r of the pairs of rows (p, q) in doubles; of all pairs, where many are wanted."""
    if 64 * len(p) > len(z1) * len(z2):
        return (z1 @ z2.T)[p, q]
    parts = [np.einsum("ij,ij->i", z1[p[k : k + VERIFY_PAIRS]], z2[q[k : k + VERIFY_PAIRS]]) for k in range(0, len(p), VERIFY_PAIRS)]
    return np.concatenate(parts) if parts else np.empty(0)


def _error(z: np.ndarray) -> float:
    """Most that a product of two rows of length 1 differs, in single precision."""
    return (z.shape[1] + 4) * 2.0**-23


def _single_blocks(one: _Tile, two: _Tile) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rho in single precision) of the rows of more than one value, by blocks of rows of ``one``."""
    step = max(1, BLOCK_PAIRS // max(1, len(two.single)))
    for at in range(0, len(one.single), step):
        yield at, one.single[at : at + step] @ two.single.T


def _figures(high: float):
    """Task function: number, sum, greatest and least rho of the pairs of a task's tiles, and the number above ``high``.

    The products are made in single precision; whatever its error could change is compared
    again in doubles.  The sum of all products of two tiles is the product of their sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, most, least, above = 0, 0.0, -math.inf, math.inf, 0
        for one, two in _tiles(batches):
            z1, z2 = one.varied, two.varied
            error = _error(z1)
            if one is two:
                n += len(z1) * (len(z1) - 1) // 2
                total += (float(one.total @ one.total) - float(np.einsum("ij,ij->", z1, z1))) / 2
            else:
                n += len(z1) * len(z2)
                total += float(one.total @ two.total)
            for at, rho in _single_blocks(one, two):
                rows, pairs = z1[at : at + len(rho)], rho
                if one is two:  # the pairs above the diagonal
                    upper = np.arange(len(rho))[:, None] + at < np.arange(len(z2))
                    pairs = rho[upper]
                    rho[~upper] = np.nan
                if not pairs.size:
                    continue
                top, low = float(pairs.max()), float(pairs.min())
                # no r is above 1 or below -1: where one is reached, no other is compared again
                if most < ONE and top > most - error:
                    most = max(most, float(_exact(rows, z2, *np.nonzero(rho == top)).max()))
                    if most < ONE:
                        most = max(most, float(_exact(rows, z2, *np.nonzero(rho >= max(top - 2 * error, most - error))).max(initial=most)))
                if least > -ONE and low < least + error:
                    least = min(least, float(_exact(rows, z2, *np.nonzero(rho == low)).min()))
                    if least > -ONE:
                        least = min(least, float(_exact(rows, z2, *np.nonzero(rho <= min(low + 2 * error, least + error))).min(initial=least)))
                if top > high - error:
                    p, q = np.nonzero(rho > high - error)
                    unsure = rho[p, q] <= high + error
                    above += len(p) - int(unsure.sum()) + int((_exact(rows, z2, p[unsure], q[unsure]) > high).sum())
        if n:
            yield pa.RecordBatch.from_pylist([{"n": n, "total": total, "most": most, "least": least, "high": above}])

    return run


def _tile_count(inp: _Inputs) -> int:
    # a row goes to as many tasks as there are tiles, so tiles are large once all cores have work
    n = inp.valid.count()  # a count of a stored frame
    return max(1, -(-n // TILE), min(TILES_WANTED, -(-n // SMALL_TILE)))


def _tile_of(code: str, tiles: int) -> Column:
    return F.pmod(F.xxhash64(code), F.lit(tiles)).cast("int")


def _dealt(vectors: DataFrame, tiles: int) -> DataFrame:
    """The rows of each tile for every group (i, j) of two tiles that it belongs to."""
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("_other")
    dealt = vectors.select("*", _tile_of(KEY, tiles).alias("tile")).select("*", other)
    return dealt.select("*", F.least("tile", "_other").alias("i"), F.greatest("tile", "_other").alias("j")).drop("_other")


def _tile_pairs(inp: _Inputs, bits: int = 0, bands: int = 0) -> DataFrame:
    """(part, tile, codes, names, z) of the tiles of each two stored partitions, part1 <= part2, for ``_tiles``.

    Spark's cartesian product reads two stored partitions in a task, without a shuffle.  A tile
    meets the other partition's row of nulls only, so a task gets every tile once, those of the
    second partition first (of the first only, where both are one), and multiplies each two of them.
    """
    n, days = inp.valid.count(), inp.days.count()  # counts of stored frames
    fit = TILES_HELD * min(TILE, max(1, TILE_BYTES // (8 * max(days, 1))))
    parts = max(1, -(-n // fit), min(TILES_WANTED, -(-n // SMALL_TILE)))
    vectors = _vectors(inp)
    few = vectors.rdd.getNumPartitions() < parts
    vectors = vectors.repartition(parts, KEY) if few else vectors.coalesce(parts)
    packed = vectors.mapInArrow(_packed(TILE, TILE_BYTES, bits, bands), _TILE_TYPE)
    ids = packed.select(F.monotonically_increasing_id().alias("tile"), "*")
    tiles = checkpointed(ids.select(F.shiftright("tile", 33).alias("part"), "*"))  # the partition's number in the upper bits
    one, two = (tiles.select(*[F.col(c).alias(f"{c}{side}") for c in tiles.columns]) for side in (1, 2))
    first = F.col("z1").isNotNull() & F.col("z2").isNull()
    second = F.col("z1").isNull() & F.col("z2").isNotNull() & (F.col("part1") < F.col("part2"))
    met = one.hint("shuffle_replicate_nl").join(two, (F.col("part1") <= F.col("part2")) & (first | second))
    own = F.when(first & (F.col("part1") == F.col("part2")), F.col("tile1")).otherwise(F.when(second, F.col("tile2")))
    return met.withColumn("tile2", own).withColumn("tile1", F.when(first, F.col("tile1")))


def _pearson(inp: _Inputs) -> DataFrame:
    """Unrounded (scheme1, scheme2, rho, overlap_days) for all ordered pairs incl. the diagonal."""
    return _tile_pairs(inp).mapInArrow(_product, "scheme1 string, scheme2 string, rho double, overlap_days bigint")


def correlation_matrix(
    nav: DataFrame,
    codes: Sequence[str] | str | None = None,
    since: str | dt.date | None = None,
    min_overlap: int = DEFAULT_MIN_OVERLAP,
    top_k: int | None = None,
) -> DataFrame:
    """OP53: Pearson correlation (4 dp) for every ordered pair of schemes, diagonal included."""
    rho = _pearson(_prepare(nav, codes, since, min_overlap, top_k))
    return rho.select("scheme1", "scheme2", half_up("rho", 4).alias("correlation"), "overlap_days")


def _pairs_from(rho: DataFrame, inp: _Inputs, high: float, low: float) -> DataFrame:
    names = inp.availability.select(KEY, "scheme_name")
    upper = rho.where(F.col("scheme1") < F.col("scheme2"))
    kind = F.when(F.col("rho") > high, F.lit("high")).when(F.abs(F.col("rho")) < low, F.lit("low"))
    n1 = names.select(F.col(KEY).alias("scheme1"), F.col("scheme_name").alias("scheme1_name"))
    n2 = names.select(F.col(KEY).alias("scheme2"), F.col("scheme_name").alias("scheme2_name"))
    return (
        upper.withColumn("kind", kind)
        .where(F.col("kind").isNotNull())
        .join(n1, "scheme1", "left")
        .join(n2, "scheme2", "left")
    )


def notable_pairs(
    nav: DataFrame,
    codes: Sequence[str] | str | None = None,
    since: str | dt.date | None = None,
    min_overlap: int = DEFAULT_MIN_OVERLAP,
    top_k: int | None = None,
    high: float = HIGH_CORRELATION,
    low: float = LOW_CORRELATION,
) -> DataFrame:
    """OP54: pairs (scheme1 < scheme2) with r > ``high`` (kind high) or |r| < ``low`` (kind low)."""
    inp = _prepare(nav, codes, since, min_overlap, top_k)
    return _pair_columns(_tile_pairs(inp).mapInArrow(_notable(high, low), _NAMED))


def _pair_columns(pairs: DataFrame) -> DataFrame:
    return pairs.select("scheme1", "scheme1_name", "scheme2", "scheme2_name", half_up("rho", 4).alias("correlation"), "kind")


_FOUND = "codes1 array<string>, names1 array<string>, codes2 array<string>, names2 array<string>, p binary, q binary, rho binary"


def _found(high: float, most_apart: float):
    """Task function: the pairs above ``high`` whose signatures agree on a band and differ in few bits, 12 bytes for each.

    The products are made in single precision; pairs that its error leaves above ``high``
    are compared by their signatures, and r in doubles decides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, two in _tiles(batches):
            error = _error(one.varied)
            keys1, keys2 = one.keys[one.at], two.keys[two.at]
            for at, rho in _single_blocks(one, two):
                p, q = np.nonzero(rho > high - error)
                if one is two:
                    p, q = p[p + at < q], q[p + at < q]
                near = np.zeros(len(p), bool)
                for k in range(0, len(p), VERIFY_PAIRS):
                    apart = keys1[p[k : k + VERIFY_PAIRS] + at] ^ keys2[q[k : k + VERIFY_PAIRS]]
                    few = np.bitwise_count(apart).sum(axis=1, dtype=np.int32) <= most_apart
                    near[k : k + VERIFY_PAIRS] = few & (apart == 0).any(axis=1)
                p, q = p[near], q[near]
                r = _exact(one.varied[at : at + len(rho)], two.varied, p, q)
                p, q, r = one.at[p[r > high] + at], two.at[q[r > high]], r[r > high]
                if len(r):
                    yield _found_row(one, two, p, q, r)

    return run


def _found_row(one: _Tile, two: _Tile, p: np.ndarray, q: np.ndarray, r: np.ndarray) -> pa.RecordBatch:
    lists, places = [], []
    for tile, rows in ((one, p), (two, q)):
        used, place = np.unique(rows, return_inverse=True)
        lists += [pa.ListArray.from_arrays([0, len(used)], c.take(pa.array(used))) for c in (tile.codes, tile.names)]
        places.append(place.astype(np.uint16))  # a tile has 4,096 rows at most
    values = [pa.array([x.tobytes()], pa.binary()) for x in (*places, r)]
    return pa.RecordBatch.from_arrays([*lists, *values], ["codes1", "names1", "codes2", "names2", "p", "q", "rho"])


def _found_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: a row for each pair that ``_found`` stored."""
    for batch in batches:
        for row in range(batch.num_rows):
            p, q = (np.frombuffer(batch.column(c)[row].as_buffer(), np.uint16) for c in "pq")
            rho = np.frombuffer(batch.column("rho")[row].as_buffer(), np.float64)
            c1, n1, c2, n2 = (batch.column(c)[row].values for c in ("codes1", "names1", "codes2", "names2"))
            yield _Names([c1, c2], [n1, n2]).rows(p, q, rho, pa.array(["high"] * len(rho), pa.string()))


def high_correlation_pairs(
    nav: DataFrame,
    codes: Sequence[str] | str | None = None,
    since: str | dt.date | None = None,
    min_overlap: int = DEFAULT_MIN_OVERLAP,
    top_k: int | None = None,
    high: float = HIGH_CORRELATION,
    band_bits: int = BAND_BITS,
    bands: int = BANDS,
) -> DataFrame:
    """OP54, high pairs only: the rows of kind high of ``notable_pairs`` that the signatures find.

    Every row is right (r is computed); a pair is missed only if its schemes
    agree on none of the bands, at r = 0.8 with probability 2e-4 and less above.
    ``notable_pairs`` is the exact way.  The pairs are stored before they are
    returned, 12 bytes for each; rows of returns are stored once and never shuffled.
    """
    if not 0 < high < 1:
        raise ValueError("high must lie between 0 and 1")
    inp = _prepare(nav, codes, since, min_overlap, top_k)
    # bits apart are binomial with p = angle / pi; five standard deviations above what ``high`` gives
    n, p = band_bits * bands, math.acos(high) / math.pi
    most_apart = n * p + 5 * math.sqrt(n * p * (1 - p))
    found = checkpointed(_tile_pairs(inp, band_bits, bands).mapInArrow(_found(high, most_apart), _FOUND))
    return _pair_columns(found.mapInArrow(_found_pairs, _NAMED))


def _statistics_from(rho: DataFrame) -> DataFrame:
    # identical schemes (rho 1) count: a portfolio of copies is not diversified
    off = rho.where((F.col("scheme1") != F.col("scheme2")) & F.col("rho").isNotNull())
    return off.agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg("rho").alias("_mean"),
        F.max("rho").alias("_max"),
        F.min("rho").alias("_min"),
    ).where(F.col("_n") > 0)


def _statistics(inp: _Inputs, high: float = HIGH_CORRELATION) -> DataFrame:
    """``_statistics_from`` of all pairs and ``_high``, the number above ``high``; a task sends one row for its tiles."""
    figures = _tile_pairs(inp).mapInArrow(_figures(high), _FIGURES)
    return figures.agg(
        F.sum("n").alias("_n"),
        F.try_divide(F.sum("total"), F.sum("n")).alias("_mean"),
        F.max("most").alias("_max"),
        F.min("least").alias("_min"),
        F.sum("high").alias("_high"),
    ).where(F.col("_n") > 0)


def _statistics_columns(s: DataFrame) -> DataFrame:
    return s.select(
        half_up("_mean", 4).alias("average_correlation"),
        half_up("_max", 4).alias("highest_correlation"),
        half_up("_min", 4).alias("lowest_correlation"),
        F.greatest(F.lit(0.0), half_up((1 - F.col("_mean")) * 100, 1)).alias("diversification_score"),
    )


def _insights(s: DataFrame, n_high: Column, n_valid: Column) -> DataFrame:
    score = F.greatest(F.lit(0.0), half_up((1 - F.col("_mean")) * 100, 1))
    return s.select(
        # The report's grades and sentences.
        F.when(score > SCORE_EXCELLENT, "Excellent").when(score > SCORE_GOOD, "Good").otherwise("Poor").alias(
            "portfolio_diversification"
        ),
        F.when(n_high > n_valid, "High")
        .when(n_high > CONCENTRATION_MEDIUM, "Medium")
        .otherwise("Low")
        .alias("concentration_risk"),
        F.when(n_high > REDUCE_ADVICE_ABOVE, "Consider reducing highly correlated holdings")
        .otherwise("Well diversified portfolio")
        .alias("recommendation"),
    )


def correlation_statistics(
    nav: DataFrame,
    codes: Sequence[str] | str | None = None,
    since: str | dt.date | None = None,
    min_overlap: int = DEFAULT_MIN_OVERLAP,
    top_k: int | None = None,
) -> DataFrame:
    """OP55: mean / max / min of the off-diagonal correlations and the diversification score."""
    return _statistics_columns(_statistics(_prepare(nav, codes, since, min_overlap, top_k)))


def diversification_insights(
    nav: DataFrame,
    codes: Sequence[str] | str | None = None,
    since: str | dt.date | None = None,
    min_overlap: int = DEFAULT_MIN_OVERLAP,
    top_k: int | None = None,
    high: float = HIGH_CORRELATION,
) -> DataFrame:
    """OP56: diversification grade, concentration risk and a recommendation."""
    inp = _prepare(nav, codes, since, min_overlap, top_k)
    return _insights(_statistics(inp, high), F.col("_high"), inp.n_valid)
