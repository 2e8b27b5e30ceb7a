"""Regional statistics by atoms: sums once for each set of cells that are in the same regions.

A cell gets a bitmap of the regions that hold it. Cells with equal bitmaps are an atom; raw sums
are made for atoms, one row a cell before the shuffle whatever the number of regions, and then
folded: an atom's sums go to each region whose bit it has. There are few atoms, so folding is cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.moments import TERMS, means, raw_sums, shifts, statistics
from .align import small
from .statistics import terms_of

#: Regions of one word of a bitmap.
WORD = 63


def bitmaps(region_cells: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """(lat_idx, lon_idx, atom) of every cell in one of the named regions; ``atom`` is the cell's bitmap in words of ``WORD`` bits."""
    place = F.coalesce(*(F.when(F.col("region") == n, F.lit(k)) for k, n in enumerate(names)))
    bits = region_cells.select("lat_idx", "lon_idx", place.alias("k")).where(F.col("k").isNotNull())
    words = [F.coalesce(F.bit_or(F.when(F.floor(F.col("k") / WORD) == w, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("k", F.lit(WORD)).cast("int")))), F.lit(0).cast("long")) for w in range(-(-len(names) // WORD))]
    return bits.groupBy("lat_idx", "lon_idx").agg(F.array(*words).alias("atom"))


def regions_of(atom: Column, names: tuple[str, ...]) -> Column:
    """The names whose bit an atom has."""
    flags = [F.when(F.getbit(F.get(atom, F.lit(k // WORD)), F.lit(k % WORD)) == 1, F.lit(n)) for k, n in enumerate(names)]
    return F.filter(F.array(*flags), lambda r: r.isNotNull())


def regional_by_atoms(cells: DataFrame, region_cells: DataFrame, keys: list[str], names: tuple[str, ...], wanted: tuple[str, ...] = ("rms", "acorr"), weight: str = "grid_weight", shift: bool = False) -> DataFrame:
    """(keys, region, statistics): the same as statistics of cells joined to their regions.

    Cells in no region and regions without cells give no rows. With ``shift``, cells carry a column ``shift`` that is constant within a
    region's rows of the same keys; sums are then of values less that constant.
    """
    terms = terms_of(wanted)
    f, a, c = shifts(shift)
    placed = cells.join(small(bitmaps(region_cells, names)), ["lat_idx", "lon_idx"])
    atoms = placed.groupBy(*keys, "atom").agg(*raw_sums(f, a, c, F.col(weight), terms, F.sum))
    sums = [f"{p}_{t}" for t in TERMS if t in terms for p in ("s", "n")]
    folded = atoms.withColumn("region", F.explode(regions_of(F.col("atom"), names)))
    got = folded.groupBy(*keys, "region").agg(*(F.sum(s).alias(s) for s in sums)).withColumns(means(terms))
    return got.select(*keys, "region", *(s.alias(n) for n, s in statistics(wanted).items()))
