"""Robust local regression of one column on another, over all rows.

Lines are fitted at places that hold equal shares of the rows, each to its nearest share of rows with tricube weights, and again
with bisquare weights of the residuals; between places the trend is interpolated. Everything is sums over matrix blocks: the
radius of a window and the median of the residuals are found by counting, with many candidates a pass, so no order of the rows
is kept and nothing but a few numbers per place travels.
"""

from __future__ import annotations

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.ml.blocks import add_up, pack
from tarmac.operators.quantiles import exact_quantiles

#: Candidates of a pass, passes of a search, and values of a block that meet all places at once, few enough for a cache.
_CANDIDATES, _PASSES, _AT_ONCE = 64, 6, 256


def _smallest(rdd: RDD, values, wanted: np.ndarray, top: np.ndarray) -> np.ndarray:
    """For each place the smallest bound (to a part in 64^6 of ``top``) within which at least ``wanted`` values lie.

    ``values(block, bounds)`` counts the values of a block within each of the bounds, an array (place, candidate).
    """
    low, high = np.zeros_like(top), top.astype(float).copy()
    for _ in range(_PASSES):
        bounds = low[:, None] + (high - low)[:, None] * np.arange(1, _CANDIDATES + 1) / _CANDIDATES
        bounds[:, -1] = high
        counts = add_up(rdd, lambda b, t=bounds: values(b, t), lambda p, q: p + q)
        first = (counts >= wanted[:, None]).argmax(axis=1)
        rows = np.arange(len(top))
        low, high = np.where(first > 0, bounds[rows, first - 1], low), bounds[rows, first]
    return high


def _within(block, places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    x = np.sort(block.x[:, 0])
    return np.searchsorted(x, places[:, None] + bounds, "right") - np.searchsorted(x, places[:, None] - bounds, "left")


def _residuals(block, places: np.ndarray, fits: np.ndarray) -> np.ndarray:
    return np.abs(block.y[:, 0] - np.interp(block.x[:, 0], places, fits))


def _sums(block, places: np.ndarray, radius: np.ndarray, shift: float, before: tuple | None) -> np.ndarray:
    """Weighted sums of 1, x, x^2, y and xy at each place; ``before`` holds the last fits and six medians of their residuals."""
    out = np.zeros((5, len(places)))
    robust = np.ones(len(block.x))
    if before is not None:
        fits, scale = before
        u = _residuals(block, places, fits) / scale if scale > 0 else (_residuals(block, places, fits) > 0) * 1.0
        robust = np.maximum(1 - u * u, 0) ** 2
    # rows of one x are equally far from every place, so only their sums meet the places
    values, spot = np.unique(block.x[:, 0], return_inverse=True)
    mass, lift = np.bincount(spot, robust, len(values)), np.bincount(spot, robust * block.y[:, 0], len(values))
    for begin in range(0, len(values), _AT_ONCE):
        x, m, y = (v[begin : begin + _AT_ONCE] for v in (values, mass, lift))
        with np.errstate(divide="ignore", invalid="ignore"):
            u = np.where(radius > 0, np.abs(x[:, None] - places) / radius, (x[:, None] != places) * 1.0)
        rest = np.maximum(1 - u * u * u, 0)
        z = x - shift
        out += np.stack([m, z * m, z * z * m, y, z * y]) @ (rest * rest * rest)
    return out


def lowess(df: DataFrame, x: str, y: str, places: int = 200, share: float = 2 / 3, rounds: int = 3) -> DataFrame:
    """(point, x, trend) at about ``places`` values of x that cut the rows evenly, fewer where values repeat.

    ``rounds`` is the number of robust rounds after the first fit. Rows without x or y are left out; a table without rows, or
    with one value of x, gives its mean y at that value.
    """
    known = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    known = known.where("x is not null and y is not null and not isnan(x) and not isnan(y)")
    probs = [i / max(places - 1, 1) for i in range(places)]
    # a few numbers per place from here on
    at = np.array(sorted({r["q"] for r in exact_quantiles(known, ["x"], probs).collect()}))
    spark, schema = df.sparkSession, "point long, x double, trend double"
    if not len(at):
        return spark.createDataFrame([], schema)
    packed = pack(known, ["x"], ["y"])
    try:
        n, shift = packed.rows, float(at.mean())
        nearest = np.full(len(at), max(1, min(n, int(share * n + 1e-10))))
        reach = np.maximum(at - at[0], at[-1] - at)
        radius = _smallest(packed.rdd, lambda b, t: _within(b, at, t), nearest, reach)
        before = None
        for turn in range(rounds + 1):
            w, wx, wxx, wy, wxy = add_up(packed.rdd, lambda b, last=before: _sums(b, at, radius, shift, last), lambda p, q: p + q)
            with np.errstate(divide="ignore", invalid="ignore"):
                flat = w * wxx - wx * wx
                slope = np.where(flat > 1e-12 * w * wxx, (w * wxy - wx * wy) / flat, 0.0)
                fits = np.where(w > 0, (wy - slope * wx) / w + slope * (at - shift), np.nan)
            if np.isnan(fits).any():
                # no row near this place kept a weight: the last fit stands
                fits = np.where(np.isnan(fits), before[0] if before else 0.0, fits)
            if turn < rounds:
                most = add_up(packed.rdd, lambda b, f=fits: np.array([_residuals(b, at, f).max(initial=0.0)]), np.maximum)
                middle = np.array([(n + 1) // 2, n // 2 + 1])
                halves = _smallest(packed.rdd, lambda b, t, f=fits: np.searchsorted(np.sort(_residuals(b, at, f)), t, "right"), middle, np.repeat(most, 2))
                before = (fits, 6 * float(halves.mean()))
    finally:
        packed.free()
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(at, fits))], schema)
