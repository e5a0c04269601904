"""Points of one Web-Mercator map tile aggregated to grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LATITUDE = 85.0511287798066  # fixed value: edge of the square Web-Mercator world


def tile_x(lon: Column, zoom: int) -> Column:
    return F.least(F.floor((lon + 180) / 360 * (1 << zoom)), F.lit((1 << zoom) - 1))


def tile_y(lat: Column, zoom: int) -> Column:
    phi = F.radians(lat)
    return F.floor((1 - F.log(F.tan(phi) + 1 / F.cos(phi)) / F.pi()) / 2 * (1 << zoom))


def tile_grid(df: DataFrame, lat: Column, lon: Column, zoom: int, x: int, y: int, grid: int = 4) -> DataFrame:
    """Number of points per cell `(cell_x, cell_y)` of tile `zoom/x/y`, cells being tiles `grid` levels deeper.

    The tile's bounds of longitude are a plain range, which reaches the scan where
    `lon` is a stored column.
    """
    tiles = 1 << zoom
    west, east = x / tiles * 360 - 180, (x + 1) / tiles * 360 - 180
    points = df.select(lat.alias("_lat"), lon.alias("_lon")).filter(
        F.col("_lon").between(west, east) & F.col("_lat").between(-MAX_LATITUDE, MAX_LATITUDE)
    )
    inside = points.filter((tile_x(F.col("_lon"), zoom) == x) & (tile_y(F.col("_lat"), zoom) == y))
    cells = inside.select(
        tile_x(F.col("_lon"), zoom + grid).alias("cell_x"), tile_y(F.col("_lat"), zoom + grid).alias("cell_y")
    )
    return cells.groupBy("cell_x", "cell_y").agg(F.count(F.lit(1)).alias("n"))
