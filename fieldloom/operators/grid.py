"""Regular latitude/longitude grids: cells, completion, scatter, crop and pad.

Cells are joined by whole-number indexes, never by equality of floating-point coordinates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldloom.functions.geo import axis_index


@dataclass(frozen=True)
class Grid:
    """A regular grid from (lat0, lon0) in steps of ``step`` (latitudes may descend: ``down``)."""

    lat0: float
    lat1: float
    lon0: float
    lon1: float
    step: float = 0.25
    down: bool = False

    @property
    def rows(self) -> int:
        return round(abs(self.lat1 - self.lat0) / self.step) + 1

    @property
    def columns(self) -> int:
        return round((self.lon1 - self.lon0) / self.step) + 1

    def lat_index(self, lat: Column) -> Column:
        i = axis_index(lat, min(self.lat0, self.lat1), self.step)
        return F.lit(self.rows - 1) - i if self.down else i

    def lon_index(self, lon: Column) -> Column:
        return axis_index(lon, self.lon0, self.step)

    def inside(self, i: Column, j: Column) -> Column:
        return i.between(0, self.rows - 1) & j.between(0, self.columns - 1)

    def spine(self, spark: SparkSession) -> DataFrame:
        """Every cell once: lat_idx, lon_idx, latitude, longitude."""
        n = self.columns
        x = spark.range(self.rows * n).select(F.floor(F.col("id") / n).cast("int").alias("lat_idx"), (F.col("id") % n).cast("int").alias("lon_idx"))
        low = min(self.lat0, self.lat1)
        up = F.lit(self.rows - 1) - F.col("lat_idx") if self.down else F.col("lat_idx")
        return x.select("lat_idx", "lon_idx", (F.lit(float(low)) + up * self.step).alias("latitude"), (F.lit(float(self.lon0)) + F.col("lon_idx") * self.step).alias("longitude"))


#: The three grids in use: daily (latitudes descend), monthly (ascend) and global.
DAILY = Grid(72.0, 34.0, -30.0, 50.0, down=True)
MONTHLY = Grid(32.0, 72.0, -25.0, 45.0)
GLOBAL = Grid(90.0, -90.0, 0.0, 360.0, down=True)


def in_box(df: DataFrame, lat: str, lon: str, lat0: float, lat1: float, lon0: float, lon1: float) -> DataFrame:
    """Rows within the box, edges included; null and NaN coordinates are outside."""
    return df.filter(F.col(lat).between(lat0, lat1) & F.col(lon).between(lon0, lon1))


def scatter(df: DataFrame, grid: Grid, lat: str, lon: str, value: str, order: list[str], keep: str = "last", by: tuple[str, ...] = ()) -> DataFrame:
    """One value a cell (and ``by``): the first or last in ``order``; points off the grid and null values of ``order`` drop out.

    A cell may hold any share of the rows: the choice is an aggregate that is combined before the shuffle.
    """
    x = df.withColumns({"lat_idx": grid.lat_index(F.col(lat)), "lon_idx": grid.lon_index(F.col(lon))}).filter(grid.inside(F.col("lat_idx"), F.col("lon_idx")))
    pick = F.max_by if keep == "last" else F.min_by
    return x.groupBy(*by, "lat_idx", "lon_idx").agg(pick(F.col(value), F.struct(*order)).alias(value))


def complete(df: DataFrame, spine: DataFrame, keys: list[str], fills: dict[str, object]) -> DataFrame:
    """Every row of ``spine`` with the values of ``df``, absent or null ones filled; keys of ``df`` off the spine drop out."""
    return spine.join(df, keys, "left").fillna(fills)


def crop_to_multiple(df: DataFrame, i: str, j: str, rows: int, columns: int, patch: int) -> DataFrame:
    """Cells within the largest part of the grid that is a multiple of ``patch``, from the upper left."""
    return df.filter((F.col(i) < rows // patch * patch) & (F.col(j) < columns // patch * patch))


def pad_to_multiple(df: DataFrame, i: str, j: str, rows: int, columns: int, patch: int, value: str, by: list[str], fill: float = 0.0) -> DataFrame:
    """``df`` with ``fill`` in the cells that make the grid a multiple of ``patch``, at the lower and right edge, for each ``by``."""
    r, c = -(-rows // patch) * patch, -(-columns // patch) * patch
    cells = F.explode(F.filter(F.sequence(F.lit(0), F.lit(r * c - 1)), lambda k: (F.floor(k / c) >= rows) | (k % c >= columns))).alias("__k")
    if r == rows and c == columns:
        return df.select(*by, i, j, value)
    extra = df.select(*by).distinct().select(*by, cells)
    extra = extra.select(*by, F.floor(F.col("__k") / c).cast(df.schema[i].dataType).alias(i), (F.col("__k") % c).cast(df.schema[j].dataType).alias(j), F.lit(fill).cast(df.schema[value].dataType).alias(value))
    return df.select(*by, i, j, value).unionByName(extra)
