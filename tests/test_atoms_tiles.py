"""Region atoms, tiled windows and shifted sums against the plain ways."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skillgrid.functions.grid import grid
from skillgrid.functions.moments import with_shift
from skillgrid.operators import atoms, regions, statistics, tiles

ALL = ("me", "mse", "rms", "acorr", "rms_bar", "rms_amp", "rms_dis", "rms_dsp", "rms_phz", "rms_ran")


def field(spark, n_lat, n_lon, times=2, seed=1, base=0.0, hole=0.15):
    rnd = random.Random(seed)
    rows = []
    for t in range(times):
        for y in range(n_lat):
            for x in range(n_lon):
                v = [None if rnd.random() < hole else base + 10 * math.sin(y + x) + rnd.gauss(0, 3) for _ in range(3)]
                rows.append((t, y, x, *v))
    rows = [r for r in rows if not (r[0] == 1 and r[1] < 3)]  # a part of a map without anything
    cells = spark.createDataFrame(rows, "t int, lat_idx int, lon_idx int, f double, a double, c double")
    return statistics.dense(cells, ["t"], grid(spark, n_lat, n_lon).select("lat_idx", "lon_idx", "grid_weight"), ["f", "a", "c"])


def rows_by(df, keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def same(one, two, tol=1e-9):
    assert one.keys() == two.keys() and one
    for k, a in one.items():
        for name, x in a.items():
            y = two[k][name]
            assert (x is None) == (y is None) and (x is None or x == y or math.isclose(x, y, rel_tol=tol, abs_tol=tol)), (k, name, x, y)


@pytest.mark.parametrize("tile", [3, 5, 64])
@pytest.mark.parametrize("wrap", [False, True])
def test_tiles_equal_window_frames(spark, tile, wrap):
    """Borders of tiles, poles and the date line; windows of nothing; a hole in one map."""
    cells, keys = field(spark, 9, 14), ["t", "lat_idx", "lon_idx"]
    n = 14 if wrap else None
    wanted = ("rms", "acorr", "me", "mse", "rms_bar", "rms_amp")
    same(rows_by(tiles.tiled(cells, ["t"], 5, wanted, n, tile), keys), rows_by(statistics.pointwise(cells, ["t"], 5, wanted, n), keys), 1e-8)


def test_tiles_deal_one_map_to_many_tasks(spark):
    cells = field(spark, 20, 40, 1)
    dealt = tiles.with_tiles(cells, 5, 8, None).groupBy("ty", "tx").count().collect()
    assert len(dealt) >= 15 and max(r["count"] for r in dealt) <= (8 + 4) ** 2


def test_atoms_equal_exploded_regions(spark):
    cells = field(spark, 13, 24)
    names = ("GLO", "NHE", "TRO", "SHE", "NOT")
    boxes = regions.box_cells(grid(spark, 13, 24), names)
    plain = statistics.regional(cells.join(boxes, ["lat_idx", "lon_idx"]), ["t", "region"], ALL)
    same(rows_by(atoms.regional_by_atoms(cells, boxes, ["t"], names, ALL), ["t", "region"]), rows_by(plain, ["t", "region"]))


def test_more_regions_than_a_word_has_bits(spark):
    cells = field(spark, 5, 30, 1)
    names = tuple(f"r{k}" for k in range(140))
    rows = [(n, y, (k + y) % 30) for k, n in enumerate(names) for y in range(5)]
    boxes = spark.createDataFrame(rows, "region string, lat_idx int, lon_idx int")
    plain = statistics.regional(cells.join(boxes, ["lat_idx", "lon_idx"]), ["t", "region"])
    same(rows_by(atoms.regional_by_atoms(cells, boxes, ["t"], names), ["t", "region"]), rows_by(plain, ["t", "region"]))


def test_a_row_a_cell_before_the_shuffle(spark):
    cells, names = field(spark, 13, 24), ("GLO", "NHE", "TRO")
    plan = atoms.regional_by_atoms(cells, regions.box_cells(grid(spark, 13, 24), names), ["t"], names)._jdf.queryExecution().optimizedPlan().toString()
    first = plan.splitlines()
    assert sum("Generate explode" in line for line in first) >= 1
    # the explode into regions stands above the first aggregation of sums
    at = next(k for k, line in enumerate(first) if "Generate explode" in line)
    assert any("Aggregate" in line and "atom" in line for line in first[at:])


def two_pass(cells):
    """Statistics of plain rows in two passes, with exact sums."""
    rows = [(r.f, r.a, r.c, r.grid_weight) for r in cells.collect() if None not in (r.f, r.a, r.c)]
    w = math.fsum(r[3] for r in rows)
    mean = lambda g: math.fsum(g(*r[:3]) * r[3] for r in rows) / w
    mf, ma, mc = mean(lambda f, a, c: f), mean(lambda f, a, c: a), mean(lambda f, a, c: c)
    sf, sa = (math.sqrt(mean(g)) for g in (lambda f, a, c: (f - mf) ** 2, lambda f, a, c: (a - ma) ** 2))
    cov = mean(lambda f, a, c: (f - c - mf + mc) * (a - c - ma + mc))
    acorr = cov / math.sqrt(mean(lambda f, a, c: (f - c - mf + mc) ** 2) * mean(lambda f, a, c: (a - c - ma + mc) ** 2))
    rho = mean(lambda f, a, c: (f - mf) * (a - ma)) / (sf * sa)
    return {"rms_amp": abs(sf - sa), "acorr": acorr, "rms_dsp": 2 * (1 - rho) * sf * sa, "rms_phz": math.sqrt(2 * (1 - rho) * sf * sa)}


@pytest.mark.parametrize("base", [101325.0, 5e6])
def test_shifted_sums_keep_digits(spark, base):
    """Pressures and geopotentials in SI units, whose spread is small against their size."""
    cells = field(spark, 13, 24, 1, base=base, hole=0.0)
    want = two_pass(cells)
    got = statistics.regional(with_shift(cells, ["t"]), ["t"], tuple(want), shift=True).first()
    for k, v in want.items():
        assert math.isclose(got[k], v, rel_tol=1e-9), (k, got[k], v)
    names = ("GLO",)
    folded = atoms.regional_by_atoms(with_shift(cells, []), regions.box_cells(grid(spark, 13, 24), names), ["t"], names, tuple(want), shift=True).first()
    for k in ("rms_amp", "acorr", "rms_dsp"):
        assert math.isfinite(folded[k])
    centred = cells.withColumn("lev", F.lit(None).cast("int"))
    assert with_shift(centred, ["t", "lev"]).count() == cells.count()
