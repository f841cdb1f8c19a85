"""Temporal composites and percentile stretches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastra.functions.algebra import BANDS, missing, stretch, thumbnail_value
from rastra.storage import settle


def temporal_composite(looks: DataFrame, method: str = "median", bands: tuple[str, ...] = BANDS) -> DataFrame:
    """Median or mean of each band over all looks at a pixel; NaN and null are left out, and so stay a pixel without a valid look null."""
    if method not in ("median", "mean"):
        raise ValueError(f"Unknown composite method: {method}")
    agg = F.median if method == "median" else F.avg
    return looks.groupBy("raster_id", "row", "col").agg(*[agg(missing(b)).alias(b) for b in bands])


#: Size of the quantile sketches, the rank error that such a sketch has in 99 of 100 cases, and how many errors a bracket is wide to either side.
SKETCH_K = 8192
SKETCH_ERROR, _MARGIN = 2.296 / SKETCH_K**0.9021, 3
#: Most values between two bounds that are put in order at once.
_SORTED = 1 << 16


def band_sketches(pixels: DataFrame, keys: list[str], bands: tuple[str, ...] = BANDS) -> DataFrame:
    """By key a mergeable quantile sketch ``<band>_sketch`` of each band and the number of values in it, ``<band>_n``; null and NaN are left out.

    Sketches of parts of a raster merge by ``kll_sketch_merge_double``.
    """
    return pixels.groupBy(*keys).agg(*[x for b in bands for x in (F.kll_sketch_agg_double(missing(b).cast("double"), SKETCH_K).alias(f"{b}_sketch"), F.count(missing(b)).alias(f"{b}_n"))])


def _quantile(sketch: str, n: str, rank: Column) -> Column:
    """The sketch's value at a rank from 0 to 1; null if nothing is in it."""
    return F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(sketch, F.least(F.greatest(rank.cast("double"), F.lit(0.0)), F.lit(1.0))))


#: Steps of the ranks that a sketch is asked for at once: they have to be constants.
_GRID = 1024


def _asked(sketch: str, n: str) -> Column:
    """The sketch's values at all ranks of the grid, which is one constant; null if nothing is in it."""
    ranks = F.split(F.lit(",".join(str(i / _GRID) for i in range(_GRID + 1))), ",").cast("array<double>")
    return F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def _bracket(asked: str, n: str, first: Column, last: Column, wider: int = 1) -> tuple[Column, Column]:
    """Of the asked values of ``n`` that which should lie at or below the one numbered ``first``, and at or above ``last``; the margin is so many times ``wider``."""
    margin, count = wider * _MARGIN * SKETCH_ERROR, F.greatest(F.col(n), F.lit(1))
    low, high = F.floor((first / count - margin) * _GRID), F.ceil(((last + 1) / count + margin) * _GRID)
    return tuple(F.get(asked, F.least(F.greatest(i, F.lit(0)), F.lit(_GRID)).cast("int")) for i in (low, high))


def sketched_limits(pixels: DataFrame, keys: list[str], bands: tuple[str, ...] = BANDS, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """As ``limits``, from sketches alone: one pass, and the value of a rank at most ``SKETCH_ERROR`` of all values away (in 99 of 100 cases)."""
    made = band_sketches(pixels, keys, bands)
    return made.select(*keys, *[_quantile(f"{b}_sketch", f"{b}_n", F.lit(p)).alias(f"{b}_{s}") for b in bands for s, p in (("lo", low), ("hi", high))])


def limits(pixels: DataFrame, keys: list[str], bands: tuple[str, ...] = BANDS, low: float = 0.02, high: float = 0.98, small: bool = False) -> DataFrame:
    """Lower and upper percentile of each band by key, as ``<band>_lo`` and ``<band>_hi``, with linear interpolation.

    With ``small`` groups, such as tiles, and where no group has more than 65,536 rows, one task holds a group's values. For
    groups of any size, such as rasters, sketches give a bracket for each percentile; a further pass counts
    what lies below it and sketches what lies inside, until so few values are left between the bounds that they can be put in order. Each pass is
    an aggregate with a row a key and task; both ways give the same. A bracket that turns out
    to miss its rank is opened to the whole range and narrowed again with four times the margin. ``pixels`` are read two or more times.
    """
    if small:
        at = F.array(F.lit(low), F.lit(high))
        found = pixels.groupBy(*keys).agg(*[F.percentile(missing(b), at).alias(b) for b in bands])
        return found.select(*keys, *[x for b in bands for x in (F.col(b)[0].alias(f"{b}_lo"), F.col(b)[1].alias(f"{b}_hi"))])
    if (pixels.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) <= _SORTED:
        return limits(pixels, keys, bands, low, high, small=True)
    sides = [(b, s, p) for b in bands for s, p in (("lo", low), ("hi", high))]
    rank = lambda b, p, end: end((F.col(f"{b}_n") - 1) * p)
    wider, share = 1, 2 * (_MARGIN * SKETCH_ERROR + 1 / _GRID)  # of what was sketched, between the bounds
    clean = pixels.select(*keys, *[missing(b).cast("double").alias(b) for b in bands])
    first = [x.alias(f"{b}_{s}_{e}") for b, s, p in sides for e, x in zip("az", _bracket(f"{b}_asked", f"{b}_n", rank(b, p, F.floor), rank(b, p, F.ceil)), strict=True)]
    ns = [f"{b}_n" for b in bands]
    sketched = settle(band_sketches(clean, keys, bands).select(*keys, *ns, *[_asked(f"{b}_sketch", f"{b}_n").alias(f"{b}_asked") for b in bands]), "limits_sketches")
    bounds = sketched.select(*keys, *ns, *first)
    expected = share * (bounds.agg(F.max(F.greatest(*ns, F.lit(0)))).first()[0] or 0) + 2
    held = [x for b, s, _ in sides for x in (f"{b}_{s}_a", f"{b}_{s}_z")]

    def counted(*more) -> DataFrame:
        """By key the bounds and what lies below, at and between them."""
        met = clean.join(bounds, keys)
        aggs = []
        for b, s, _ in sides:
            v, a, z = F.col(b), F.col(f"{b}_{s}_a"), F.col(f"{b}_{s}_z")
            inside = F.when((v > a) & (v < z), v)
            aggs += [F.count_if(v < a).alias(f"{b}_{s}_below"), F.count_if(v == a).alias(f"{b}_{s}_at"), F.count_if((v == z) & (z > a)).alias(f"{b}_{s}_end"), *[f(inside).alias(f"{b}_{s}_{n}") for n, f in more]]
        return settle(met.groupBy(*keys, *ns, *held).agg(*aggs), "limits_counts")

    while True:
        if expected <= _SORTED:
            found = counted(("list", lambda x: F.array_sort(F.collect_list(x))))
            known = lambda b, s: F.col(f"{b}_{s}_below") + F.col(f"{b}_{s}_at")
            missed = [(F.col(f"{b}_n") > 0) & ((rank(b, p, F.floor) < F.col(f"{b}_{s}_below")) | (rank(b, p, F.ceil) >= known(b, s) + F.size(f"{b}_{s}_list") + F.col(f"{b}_{s}_end"))) for b, s, p in sides]
            if found.where(F.greatest(*missed)).isEmpty():
                break
            whole = clean.groupBy(*keys).agg(*[f(b).alias(f"{b}_{n}") for b in bands for n, f in (("n", F.count), ("a", F.min), ("z", F.max))])
            bounds = settle(whole.select(*keys, *ns, *[F.col(f"{b}_{e}").alias(f"{b}_{s}_{e}") for b, s, _ in sides for e in "az"]), "limits_bounds")
            expected = bounds.agg(F.max(F.greatest(*ns, F.lit(0)))).first()[0] or 0
            wider, share, expected = 4 * wider, 4 * share, max(expected, _SORTED + 1)
            continue
        found = counted(("sketch", lambda x: F.kll_sketch_agg_double(x, SKETCH_K)), ("m", F.count))
        found = found.withColumns({f"{b}_{s}_asked": _asked(f"{b}_{s}_sketch", f"{b}_{s}_m") for b, s, _ in sides})
        narrower = []
        for b, s, p in sides:
            before, m = F.col(f"{b}_{s}_below") + F.col(f"{b}_{s}_at"), F.col(f"{b}_{s}_m")
            from_, to = rank(b, p, F.floor) - before, rank(b, p, F.ceil) - before
            low_, high_ = _bracket(f"{b}_{s}_asked", f"{b}_{s}_m", from_, to, wider)
            a = F.when(from_ < 0, F.col(f"{b}_{s}_a")).when(from_ < m, low_).otherwise(F.col(f"{b}_{s}_z"))
            z = F.when(to < 0, F.col(f"{b}_{s}_a")).when(to < m, high_).otherwise(F.col(f"{b}_{s}_z"))
            narrower += [a.alias(f"{b}_{s}_a"), z.alias(f"{b}_{s}_z")]
        most = found.agg(F.max(F.greatest(*[f"{b}_{s}_m" for b, s, _ in sides], F.lit(0)))).first()[0] or 0
        bounds, expected = settle(found.select(*keys, *ns, *narrower), "limits_bounds"), share * most + 2
        if share >= 0.5:  # no bracket can be trusted to narrow: put in order what there is
            expected = 0

    def value(b: str, s: str, r: Column) -> Column:
        place = r - F.col(f"{b}_{s}_below") - F.col(f"{b}_{s}_at")
        inner = F.get(f"{b}_{s}_list", place.cast("int"))
        return F.when(place < 0, F.col(f"{b}_{s}_a")).when(place < F.size(f"{b}_{s}_list"), inner).otherwise(F.col(f"{b}_{s}_z"))

    out = []
    for b, s, p in sides:
        at = (F.col(f"{b}_n") - 1) * p
        part, v0, v1 = at - F.floor(at), value(b, s, rank(b, p, F.floor)), value(b, s, rank(b, p, F.ceil))
        out.append(F.when(F.col(f"{b}_n") > 0, F.when(part == 0, v0).otherwise(v0 * (1 - part) + v1 * part)).alias(f"{b}_{s}"))
    return found.select(*keys, *out)


def percentile_stretch(pixels: DataFrame, keys: list[str] | None = None, bands: tuple[str, ...] = BANDS, low: float = 0.02, high: float = 0.98, small: bool = False) -> DataFrame:
    """Each band stretched between its own percentiles to 0..1. Unless groups are ``small``, the pixels are written once, as they are read several times."""
    keys = keys or ["raster_id"]
    pixels = pixels if small else settle(pixels, "stretch_pixels")
    joined = pixels.join(limits(pixels, keys, bands, low, high, small), keys, "left")
    return joined.withColumns({b: stretch(b, f"{b}_lo", f"{b}_hi") for b in bands}).drop(*[f"{b}_{s}" for b in bands for s in ("lo", "hi")])


def thumbnail(pixels: DataFrame, rgb: tuple[str, str, str] = ("red", "green", "blue"), low: float = 0.02, high: float = 0.98) -> DataFrame:
    """True-colour bytes of a window's pixels: ``raster_id, row, col, r, g, b``."""
    joined = pixels.join(limits(pixels, ["raster_id"], rgb, low, high, small=True), "raster_id")
    return joined.select("raster_id", "row", "col", *[thumbnail_value(b, f"{b}_lo", f"{b}_hi").alias(n) for b, n in zip(rgb, "rgb", strict=True)])
