"""Moving windows over large grids: tiles with halo rows and two-dimensional prefix sums.

A map is cut into tiles, so that one map is the work of many tasks; a cell also goes to
the tiles whose windows reach it. In a tile every sum that the statistics need becomes a table of prefix sums, and a window is four
of its entries, whatever the window's side. Prefix sums are of values less the tile's mean, so that what cancels is small,
and counts say where a window's sum is of nothing at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import TERMS, means, statistics
from .statistics import terms_of

#: Cells along a tile's side.
TILE = 64


def with_tiles(cells: DataFrame, size: int, tile: int, wrap_lon: int | None) -> DataFrame:
    """Cells with each tile (ty, tx) that needs them: the one that holds them, and those whose halo does.

    Around the globe a copy lies one turn on, at a longitude index below 0 or beyond the last.
    """
    half = size // 2
    reach = lambda at: F.sequence(F.floor((at - half) / tile).cast("int"), F.floor((at + half) / tile).cast("int"))
    turns = F.lit(0) if wrap_lon is None else F.explode(F.filter(F.array(F.lit(0), F.lit(-wrap_lon), F.lit(wrap_lon)), lambda t: (F.col("lon_idx") + t).between(-half, wrap_lon - 1 + half)))
    turned = cells.withColumn("__t", turns).withColumn("lon_idx", F.col("lon_idx") + F.col("__t")).drop("__t")
    return turned.withColumn("ty", F.explode(reach(F.col("lat_idx")))).withColumn("tx", F.explode(reach(F.col("lon_idx"))))


def window_sums(lat: np.ndarray, lon: np.ndarray, values: list[np.ndarray], inside: np.ndarray, half: int) -> list[np.ndarray]:
    """Sums of values in the window around each of the cells ``inside``; each cell (lat, lon) occurs once, absent ones add nothing."""
    y0, x0 = lat.min() - half, lon.min() - half
    shape = (lat.max() - y0 + half + 2, lon.max() - x0 + half + 2)
    y, x = lat - y0 + 1, lon - x0 + 1
    a, b, c, d = y[inside] - half - 1, y[inside] + half, x[inside] - half - 1, x[inside] + half
    out = []
    for v in values:
        table = np.zeros(shape, v.dtype)
        table[y, x] = v
        table = table.cumsum(0).cumsum(1)
        out.append(table[b, d] - table[a, d] - table[b, c] + table[a, c])
    return out


def _terms(f: np.ndarray, a: np.ndarray, c: np.ndarray) -> dict[str, np.ndarray]:
    """The terms of the statistics, NaN where missing."""
    d, e, x = f - c, a - c, f - a
    return {
        "f": f, "a": a, "c": c, "d": d, "e": e, "dd": d * d, "ee": e * e, "de": d * e, "d_de": np.where(np.isnan(a), np.nan, d), "e_de": np.where(np.isnan(f), np.nan, e),
        "x": x, "xx": x * x, "ff": f * f, "aa": a * a, "fa": f * a, "f_fa": np.where(np.isnan(a), np.nan, f), "a_fa": np.where(np.isnan(f), np.nan, a),
    }


def tiled(cells: DataFrame, keys: list[str], size: int, wanted: tuple[str, ...] = ("rms", "acorr"), wrap_lon: int | None = None, tile: int = TILE) -> DataFrame:
    """The same as ``pointwise`` (W3-W7) of dense, weighted cells, by tiles; a window counts only if half of it is there.

    Each map is dealt as its tiles; a tile has at most (tile + size)^2 cells.
    """
    terms, half = terms_of(wanted), size // 2
    assert set(terms) <= set(TERMS)
    types = {f.name: f.dataType.simpleString() for f in cells.schema}
    sums = [f"{p}_{t}" for t in terms for p in ("s", "n")]
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "lat_idx int, lon_idx int, f double, a double, c double, enough boolean", *(f"{s} double" for s in sums)])
    names = [*keys, "lat_idx", "lon_idx", "f", "a", "c", "enough", *sums]
    need = int(size * size * 0.5)

    def run(group: pa.Table) -> pa.Table:
        col = lambda n: group.column(n).to_numpy()
        lat, lon = col("lat_idx").astype(np.int64), col("lon_idx").astype(np.int64)
        f, a, c, w = (group.column(n).cast(pa.float64()).fill_null(np.nan).to_numpy() for n in ("f", "a", "c", "grid_weight"))
        inside = np.flatnonzero((lat // tile == col("ty")[0]) & (lon // tile == col("tx")[0]))
        if wrap_lon is not None:
            inside = inside[(lon[inside] >= 0) & (lon[inside] < wrap_lon)]
        all_ = np.concatenate([f, a, c])
        middle = np.nanmean(all_) if (~np.isnan(all_)).any() else 0.0
        found = _terms(f - middle, a - middle, c - middle)
        values = [(~np.isnan(v)).astype(np.int64) for v in (f, a, c)]
        for t in terms:
            there = ~np.isnan(found[t]) & ~np.isnan(w)
            values += [np.where(there, found[t] * w, 0.0), np.where(there, w, 0.0), there.astype(np.int64)]
        got = window_sums(lat, lon, values, inside, half)
        out = [*(group.column(k).take(pa.array(inside)) for k in keys), pa.array(lat[inside], pa.int32()), pa.array(lon[inside], pa.int32())]
        out += [pa.array(v[inside], mask=np.isnan(v[inside])) for v in (f, a, c)]
        out.append(pa.array(np.minimum.reduce(got[:3]) >= need))
        for k in range(len(terms)):
            s, n, count = got[3 + 3 * k : 6 + 3 * k]
            out += [pa.array(s, mask=count == 0), pa.array(n, mask=count == 0)]
        return pa.Table.from_arrays(out, names=names)

    kept = with_tiles(cells.select(*keys, "lat_idx", "lon_idx", "f", "a", "c", "grid_weight"), size, tile, wrap_lon)
    got = kept.groupBy(*keys, "ty", "tx").applyInArrow(run, schema).withColumns(means(terms))
    return got.select(*keys, "lat_idx", "lon_idx", "f", "a", (F.col("f") - F.col("c")).alias("f_c"), *(F.when(F.col("enough"), s).alias(n) for n, s in statistics(wanted).items()))
