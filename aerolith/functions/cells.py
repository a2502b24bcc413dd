"""A planar hexagonal grid as column expressions.

A cell's id is "res:q:r", with axial coordinates over x = lon and y = lat in nautical miles at a reference latitude. A resolution's
cells have the mean area of the hexagons of the usual global grid: each resolution a seventh of the one before. Cell ids of a NULL point
are NULL. Everything is closed-form: no lookup, no Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..units import KM_PER_NM
from .geo import _c, inside

#: Mean area of a cell of resolution 0, km2; a fixed value.
AREA_0_KM2 = 4357449.416
REFERENCE_LAT = 48.0
LON_NM = round(60 * math.cos(math.radians(REFERENCE_LAT)), 6)
LAT_NM = 60.0
_ROOT3 = round(math.sqrt(3), 12)


def side_nm(res: int) -> float:
    """Side of a hexagon, NM, rounded so that every engine works with the same number."""
    area = AREA_0_KM2 / 7**res / KM_PER_NM**2
    return round(math.sqrt(2 * area / (3 * math.sqrt(3))), 12)


def _id(res: int, q: Column, r: Column) -> Column:
    return F.concat_ws(":", F.lit(str(res)), q.cast("long").cast("string"), r.cast("long").cast("string"))


def axial(lat, lon, res: int) -> tuple[Column, Column]:
    """(q, r) of the cell of a point. Three families of strips cross in every hexagon; a point's strips give its cell without a search for the nearest centre."""
    width = round(_ROOT3 * side_nm(res), 12)
    x, y = _c(lon) * (LON_NM / width), _c(lat) * (LAT_NM / width * _ROOT3)
    up = F.floor(x + y + 1)
    r = F.floor((up + F.floor(y - x + 1)) / 3)
    return F.floor((F.floor(2 * x + 1) + up) / 3) - r, r


def cell(lat, lon, res: int) -> Column:
    q, r = axial(lat, lon, res)
    return F.when(_c(lat).isNotNull() & _c(lon).isNotNull(), _id(res, q, r))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parts(of: Column) -> tuple[Column, Column, Column]:
    """(res, q, r) of a cell id."""
    p = F.split(of, ":")
    return F.get(p, F.lit(0)).try_cast("int"), F.get(p, F.lit(1)).try_cast("long"), F.get(p, F.lit(2)).try_cast("long")


def is_cell(of: Column) -> Column:
    return F.coalesce(of.rlike(r"^([0-9]|1[0-5]):-?[0-9]+:-?[0-9]+$"), F.lit(False))


def resolution(of: Column) -> Column:
    return parts(of)[0]


def centre(of: Column, res: int) -> Column:
    """struct(lat, lon) of a cell's centre."""
    _, q, r = parts(of)
    s = side_nm(res)
    return F.when(of.isNotNull(), F.struct((r * (1.5 * s) / LAT_NM).alias("lat"), ((q + r / 2) * (_ROOT3 * s) / LON_NM).alias("lon")))


def grid_distance(a: Column, b: Column) -> Column:
    """Steps between two cells of one resolution; NULL across resolutions."""
    res1, q1, r1 = parts(a)
    res2, q2, r2 = parts(b)
    dq, dr = q1 - q2, r1 - r2
    return F.when(res1 == res2, ((F.abs(dq) + F.abs(dr) + F.abs(dq + dr)) / 2).cast("int"))


def k_ring(of: Column, k: int, res: int) -> Column:
    """All cells within k steps: 1 + 3k(k + 1) of them."""
    _, q, r = parts(of)
    steps = [(dq, dr) for dq in range(-k, k + 1) for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1)]
    return F.array(*[_id(res, q + dq, r + dr) for dq, dr in steps])


def hex_ring(of: Column, k: int, res: int) -> Column:
    """The cells at exactly k steps: 6k of them, or the cell itself."""
    _, q, r = parts(of)
    steps = [(dq, dr) for dq in range(-k, k + 1) for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1) if (abs(dq) + abs(dr) + abs(dq + dr)) // 2 == k]
    return F.array(*[_id(res, q + dq, r + dr) for dq, dr in steps])


def parent(of: Column, res: int) -> Column:
    """The cell of the resolution above that holds a cell's centre; res is the cell's own."""
    return _let(centre(of, res), lambda at: cell(at["lat"], at["lon"], res - 1))


def children(of: Column, res: int) -> Column:
    """The cells of the next resolution whose parent this is; res is the cell's own."""
    middle = _let(centre(of, res), lambda at: cell(at["lat"], at["lon"], res + 1))
    return F.filter(_let(middle, lambda m: k_ring(m, 3, res + 1)), lambda c: parent(c, res + 1) == of)


def compact(cells: DataFrame, column: str, res: int, by: list[str] | None = None) -> DataFrame:
    """(..by, column): every full set of children is replaced by its parent, one resolution up, apart for each value of by."""
    keys = by or []
    own = cells.select(*keys, column).distinct().withColumn("up", parent(F.col(column), res))
    n = own.groupBy(*keys, "up").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == F.size(children(F.col("up"), res - 1)))
    kept = own.join(n.drop("n"), [*keys, "up"], "left_anti").select(*keys, column)
    return kept.unionByName(n.select(*keys, F.col("up").alias(column)))


def uncompact(cells: DataFrame, column: str, res: int) -> DataFrame:
    """Every cell at the given resolution: those one above are replaced by their children."""
    above = resolution(F.col(column)) == res - 1
    return cells.select(F.explode(F.when(above, children(F.col(column), res - 1)).otherwise(F.array(F.col(column)))).alias(column)).distinct()


def box_cells(south: Column, west: Column, north: Column, east: Column, res: int) -> Column:
    """array<struct(q, r)> of all cells whose centre may lie in a box."""
    s = side_nm(res)
    r0, r1 = F.floor(south * LAT_NM / (1.5 * s)), F.ceil(north * LAT_NM / (1.5 * s))
    wide = _ROOT3 * s
    rows = F.sequence(r0.cast("long"), r1.cast("long"))
    return F.flatten(
        F.transform(
            rows,
            lambda r: F.transform(
                F.sequence(F.floor(west * LON_NM / wide - r / 2).cast("long"), F.ceil(east * LON_NM / wide - r / 2).cast("long")),
                lambda q: F.struct(q.alias("q"), r.alias("r")),
            ),
        )
    )


def geojson_ring(text: Column) -> Column:
    """The outer ring, array<struct(lat, lon)>, of a GeoJSON polygon in text form; NULL if it is none."""
    ring = F.get(F.from_json(text, "type string, coordinates array<array<array<double>>>")["coordinates"], F.lit(0))
    return F.transform(ring, lambda p: F.struct(F.get(p, F.lit(1)).alias("lat"), F.get(p, F.lit(0)).alias("lon")))


def polyfill(df: DataFrame, ring: str, res: int, out: str = "cell") -> DataFrame:
    """A row for each cell whose centre lies in the row's ring (array of struct(lat, lon), closed)."""
    lats, lons = F.transform(ring, lambda p: p["lat"]), F.transform(ring, lambda p: p["lon"])
    rows = df.withColumn("_qr", F.explode(box_cells(F.array_min(lats), F.array_min(lons), F.array_max(lats), F.array_max(lons), res)))
    rows = rows.withColumn(out, _id(res, F.col("_qr")["q"], F.col("_qr")["r"])).drop("_qr")
    at = centre(F.col(out), res)
    return rows.filter(inside(F.col(ring), at["lat"], at["lon"]))
