"""Regions as tables of cells: boxes, masks, and intersections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.catalog import BOX_REGIONS, INTERSECTIONS, MASK_REGIONS

CELL = ("lat_idx", "lon_idx")


def in_box(lat: Column, lon: Column, north: Column, south: Column, east: Column, west: Column) -> Column:
    """Whether a point is in a box, bounds included; a box whose west exceeds its east goes over the date line."""
    across = F.when(west <= east, lon.between(west, east)).otherwise((lon >= west) | (lon <= east))
    return lat.between(south, north) & across


def cells_of_regions(grid: DataFrame, masks: dict[str, DataFrame], names: tuple[str, ...]) -> DataFrame:
    """Cells of the named regions, of any kind (M1-M4): components of intersections are made on demand and stay; an unknown name is an error."""
    known = {r[0] for r in BOX_REGIONS + MASK_REGIONS} | set(INTERSECTIONS)
    if unknown := [n for n in names if n not in known]:
        raise ValueError(f"unknown regions: {', '.join(unknown)}")
    wanted = {n for name in names for n in INTERSECTIONS.get(name, (name,))}
    out = box_cells(grid, tuple(b[0] for b in BOX_REGIONS if b[0] in wanted))
    for name, mask in masks.items():
        if name in wanted:
            out = out.unionByName(mask_cells(mask, name))
    return with_intersections(out, tuple(n for n in names if n in INTERSECTIONS))


def box_cells(grid: DataFrame, names: tuple[str, ...] | None = None) -> DataFrame:
    """(region, lat_idx, lon_idx) of the box regions (M1).

    Each cell explodes into the boxes that hold it, so no join is needed.
    """
    boxes = [b for b in BOX_REGIONS if names is None or b[0] in names]
    lat, lon = F.col("lat"), F.col("lon")
    tests = [F.when(in_box(lat, lon, *(F.lit(x) for x in b[2:])), F.lit(b[0])) for b in boxes]
    inside = F.filter(F.array(*tests), lambda r: r.isNotNull())
    return grid.select(F.explode(inside).alias("region"), *CELL)


def mask_cells(mask: DataFrame, region: str) -> DataFrame:
    """(region, lat_idx, lon_idx) where a regridded mask is 1 (M2)."""
    return mask.where("mask = 1").select(F.lit(region).alias("region"), *CELL)


def with_intersections(region_cells: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``region_cells`` with intersections added; their components stay (M3, U8)."""
    out = region_cells
    for name in names:
        one, two = INTERSECTIONS[name]
        both = region_cells.where(F.col("region") == one).select(*CELL).intersect(region_cells.where(F.col("region") == two).select(*CELL))
        out = out.unionByName(both.withColumn("region", F.lit(name)))
    return out


def region_catalog(spark: SparkSession) -> DataFrame:
    """(region, domain_name, north, south, east, west) for scorecards (M5)."""
    return spark.createDataFrame(list(BOX_REGIONS + MASK_REGIONS), "region string, domain_name string, north double, south double, east double, west double")


def coverage(region_cells: DataFrame, grid: DataFrame) -> DataFrame:
    """Cells and covered fraction of every region (K4)."""
    total = grid.count()
    return region_cells.groupBy("region").agg(F.count("*").alias("n_cells"), (F.count("*") / F.lit(total)).alias("fraction"))
