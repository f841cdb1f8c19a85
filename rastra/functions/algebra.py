"""Raster algebra and scoring as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Band order of a stacked scene, and the index bands that are appended to it (fixed values).
BANDS = ("blue", "green", "red", "nir", "swir16", "swir22")
INDICES = ("ndvi", "ndwi", "ndbi", "bsi")
#: Scene classes that count as clear sky (fixed values).
CLEAR_CLASSES = (4, 5, 6, 7)
EPS = 1e-8


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Column | str, b: Column | str, eps: float = EPS) -> Column:
    """Normalised difference; 0 where both are 0, null where the denominator is."""
    a, b = col(a), col(b)
    return F.try_divide(a - b, a + b + F.lit(eps))


def ndvi(nir="nir", red="red") -> Column:
    return ratio(nir, red)


def ndwi(green="green", nir="nir") -> Column:
    return ratio(green, nir)


def ndbi(swir="swir16", nir="nir") -> Column:
    return ratio(swir, nir)


def bsi(blue="blue", red="red", nir="nir", swir="swir16") -> Column:
    return ratio(col(swir) + col(red), col(nir) + col(blue))


def index_columns() -> dict[str, Column]:
    """The four index bands, in the order in which they follow the six bands."""
    return {"ndvi": ndvi(), "ndwi": ndwi(), "ndbi": ndbi(), "bsi": bsi()}


def add_indices(pixels, bands: tuple[str, ...] = BANDS):
    """Append the index bands to a six-band pixel table; a table with another number of bands stays as it is."""
    return pixels.withColumns(index_columns()) if tuple(bands) == BANDS else pixels


def stretch(x: Column | str, lo: Column | str, hi: Column | str, scale: float = 1.0) -> Column:
    """Linear stretch from ``lo..hi`` to ``0..scale``, clipped; 0 for a flat band. A NaN stays NaN."""
    x, lo, hi = col(x), col(lo), col(hi)
    y = F.try_divide(x - lo, hi - lo)
    clipped = F.when(F.isnan(x), x).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), y)))
    return F.when(hi - lo < EPS, F.lit(0.0)).otherwise(clipped * scale)


def thumbnail_value(x: Column | str, lo: Column | str, hi: Column | str) -> Column:
    """Stretch to 0..255 cut to an integer; a flat band is left as it is."""
    lo, hi = col(lo), col(hi)
    return F.when(hi - lo <= 0, col(x).cast("int")).otherwise(stretch(x, lo, hi, 255.0).cast("int"))


def missing(x: Column | str) -> Column:
    """NaN to null, so that aggregates leave it out."""
    return F.nanvl(col(x), F.lit(None).cast("double"))


def is_clear(scl: Column | str = "scl") -> Column:
    return col(scl).isin(*CLEAR_CLASSES)


def mask_clouds(pixels, bands: tuple[str, ...] = BANDS, scl: str = "scl", fill: float | None = 0.0):
    """All bands get ``fill`` where the class isn't clear; a fill of None gives null, which composites leave out."""
    return pixels.withColumns({b: F.when(is_clear(scl), F.col(b)).otherwise(F.lit(fill).cast("double")) for b in bands})


def at_least(x: Column | str, threshold: float) -> Column:
    """``x >= threshold``, false for NaN and null."""
    x = col(x)
    return F.coalesce((x >= threshold) & ~F.isnan(x), F.lit(False))


def sigmoid(x: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(x)))


def smooth_label(t: Column | str, s: float = 0.05) -> Column:
    return col(t) * (1 - s) + 0.5 * s


def compactness(area: Column | str, perimeter: Column | str) -> Column:
    """Polsby-Popper; 0 for a perimeter of 0."""
    a, p = col(area), col(perimeter)
    return F.when(p == 0, F.lit(0.0)).otherwise(F.lit(4 * math.pi) * a / (p * p))


def area_score(area_km2: Column | str, ideal: float = 2.0) -> Column:
    return F.lit(1.0) - F.least(F.abs(col(area_km2) - ideal) / ideal, F.lit(1.0))


def composite_score(prob, compact, area_km2, weights: tuple[float, float, float] = (0.6, 0.2, 0.2), ideal: float = 2.0) -> Column:
    """Weighted sum of probability, compactness and nearness to the ideal area."""
    return col(prob) * weights[0] + col(compact) * weights[1] + area_score(area_km2, ideal) * weights[2]


def score_evidence(prob, compact, area_km2, ideal: float = 2.0) -> Column:
    """The parts of a composite score, to be kept beside it."""
    return F.struct(col(prob).alias("prob"), col(compact).alias("compactness"), area_score(area_km2, ideal).alias("area_score"))


def piecewise(x: Column | str, stops: list[tuple[float, float]]) -> Column:
    """Linear interpolation between stops, constant outside them."""
    x = col(x)
    out = F.when(x <= stops[0][0], F.lit(float(stops[0][1])))
    for (x0, y0), (x1, y1) in zip(stops, stops[1:], strict=False):
        out = out.when(x <= x1, F.lit(float(y0)) + (x - x0) * ((y1 - y0) / (x1 - x0)))
    return out.otherwise(F.lit(float(stops[-1][1])))


#: Marker radius by score, and colour classes by score (fixed values).
RADIUS_STOPS = [(0.0, 4.0), (0.5, 7.0), (1.0, 12.0)]
COLOUR_STOPS = (0.0, 0.3, 0.6, 0.9)


#: Marker colours at the colour stops, interpolated between them (fixed values).
COLOURS = ("#374151", "#f59e0b", "#ef4444", "#dc2626")


def marker_colour(score: Column | str = "score") -> Column:
    """Colour of a marker as ``#rrggbb``: red, green and blue are interpolated one by one and rounded half up."""

    def part(at: int) -> Column:
        stops = [(x, float(int(c[at : at + 2], 16))) for x, c in zip(COLOUR_STOPS, COLOURS, strict=True)]
        return F.floor(piecewise(score, stops) + 0.5).cast("int")

    return F.format_string("#%02x%02x%02x", part(1), part(3), part(5))


def marker_radius(score: Column | str = "score") -> Column:
    return piecewise(score, RADIUS_STOPS)


def colour_class(score: Column | str = "score") -> Column:
    """Number of the last colour stop at or below the score."""
    return sum(((col(score) >= s).cast("int") for s in COLOUR_STOPS[1:]), F.lit(0))


def tile_count(height: Column | int, width: Column | int, tile: int, overlap: int) -> Column:
    """How many whole tiles fit a raster."""
    step = tile - overlap
    along = lambda n: F.greatest(F.lit(0), F.floor((n - F.lit(tile)) / F.lit(step)) + 1).cast("long")
    h, w = (F.lit(x) if isinstance(x, int) else x for x in (height, width))
    return along(h) * along(w)


def strip_height(width: Column, tile: int, overlap: int, batch: int, max_mb: float, channels: int = 10) -> Column:
    """Rows of a strip whose accumulators and tile batch fit ``max_mb``; one tile at least.

    Two float32 accumulators a pixel and a batch of float32 tiles are counted,
    and the strip ends on the tile grid.
    """
    step = tile - overlap
    room = max_mb * 1024 * 1024 - batch * channels * tile * tile * 4
    if room <= 0:
        return F.lit(tile).cast("long")
    steps = F.floor(F.floor(F.lit(float(room)) / (width * 8.0)) / F.lit(step))
    return F.greatest(F.lit(tile), steps * step + overlap).cast("long")
