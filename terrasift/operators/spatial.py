"""Point-in-polygon join on a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.operators.joins import fits_broadcast, salted_join

DEFAULT_CELL = 1.0


def grid_index(v: Column, cell: float) -> Column:
    return F.floor(v / F.lit(cell)).cast("bigint")


def grid_cell(x: Column, y: Column, cell: float) -> Column:
    """K8: cell identifier usable as a partition or sort column."""
    return F.struct(grid_index(x, cell).alias("cx"), grid_index(y, cell).alias("cy"))


def polygon_cells(polygons: DataFrame, geometry: str, cell: float) -> DataFrame:
    """One row per grid cell the bounding box of a polygon touches."""
    b = G.bounds(geometry)
    span = lambda lo, hi: F.sequence(grid_index(b[lo], cell), grid_index(b[hi], cell))
    return polygons.withColumn("_cx", F.explode(span("minx", "maxx"))).withColumn("_cy", F.explode(span("miny", "maxy")))


def spatial_join(
    points: DataFrame,
    lon: str,
    lat: str,
    polygons: DataFrame,
    geometry: str = "geometry",
    cell: float = DEFAULT_CELL,
) -> DataFrame:
    """Every point with every polygon that contains it.

    Points and polygons meet in equal grid cells only; the exact test runs on
    those candidates. Polygon cells measured as small are broadcast, so points
    are not shuffled; otherwise crowded cells are salted.
    """
    cells = polygon_cells(polygons.where(~G.is_unusable(geometry)), geometry, cell)
    placed = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    placed = placed.withColumn("_cx", grid_index(F.col(lon), cell)).withColumn("_cy", grid_index(F.col(lat), cell))
    keys = ["_cx", "_cy"]
    if fits_broadcast(cells):
        candidates = placed.join(F.broadcast(cells), keys)
    else:
        candidates = salted_join(placed, cells, keys)
    return candidates.where(G.contains(geometry, lon, lat)).drop(*keys)
