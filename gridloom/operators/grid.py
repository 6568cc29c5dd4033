"""Regular grids: (row, col, value). Resampling uses one-dimensional weights of both axes, so it is an equi-join and an aggregate.

NULL cells are left out and the weights of the others are normalised again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridSpec:
    """Shape, first centre and step of both axes, and the reference system."""

    ny: int
    nx: int
    y0: float
    x0: float
    dy: float
    dx: float
    crs: str | None = "EPSG:4326"

    def checked(self) -> GridSpec:
        if not self.crs:
            raise ValueError("the grid has no reference system")
        return self

    @classmethod
    def of(cls, cells: DataFrame, crs: str | None = "EPSG:4326") -> GridSpec:
        """The grid that the columns row, col, lat, lon of a cube lie on. An axis of one step takes the other's length."""
        m = cells.agg(*(f(c).alias(f"{k}_{c}") for c in ("row", "col") for k, f in (("lo", F.min), ("hi", F.max))), F.min_by("lat", "row").alias("y0"), F.max_by("lat", "row").alias("y1"), F.min_by("lon", "col").alias("x0"), F.max_by("lon", "col").alias("x1")).first()
        step = lambda a, b, n: (b - a) / n if n else 0.0
        ny, nx = (None, None) if m.lo_row is None else (m.hi_row - m.lo_row, m.hi_col - m.lo_col)
        if ny is None:
            raise ValueError("the cube has no cells")
        dy, dx = step(m.y0, m.y1, ny), step(m.x0, m.x1, nx)
        dy, dx = dy or abs(dx) or 1.0, dx or abs(dy) or 1.0
        return cls(m.hi_row + 1, m.hi_col + 1, m.y0 - m.lo_row * dy, m.x0 - m.lo_col * dx, dy, dx, crs).checked()


#: Which method each kind of variable is resampled with; others get the average.
METHODS = {"surface_temperature_fine": "nearest", "radiation": "bilinear", "vapour_pressure": "bilinear", "rain": "bilinear", "temperature_k": "nearest", "temperature_min": "bilinear", "temperature_max": "bilinear"}


def method_for(variable: str, step_km: float = 1.0) -> str:
    method = METHODS.get(variable, "average")
    return "average" if variable in ("radiation", "vapour_pressure") and step_km >= 5 else method


def overlap_weights(src: int, dst: int) -> list[tuple[int, int, float]]:
    """(source, target, overlap) of two axes of equal extent, in source cells."""
    k, out = src / dst, []
    for j in range(dst):
        a, b = j * k, (j + 1) * k
        for i in range(int(math.floor(a)), min(int(math.ceil(b - 1e-12)), src)):
            w = min(b, i + 1) - max(a, i)
            if w > 1e-12:
                out.append((i, j, w))
    return out


def linear_weights(src: int, dst: int) -> list[tuple[int, int, float]]:
    """Two neighbours of each target centre, clamped at the edges."""
    out = []
    for j in range(dst):
        p = min(max((j + 0.5) * src / dst - 0.5, 0.0), src - 1.0)
        i = min(int(p), src - 1)
        f = p - i
        out.append((i, j, 1 - f))
        if f > 0 and i + 1 < src:
            out.append((i + 1, j, f))
    return out


def nearest_weights(src: int, dst: int) -> list[tuple[int, int, float]]:
    return [(min(int(math.floor((j + 0.5) * src / dst)), src - 1), j, 1.0) for j in range(dst)]


def _axis(spark: SparkSession, weights, name: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(i, j, float(w)) for i, j, w in weights], f"{name} int, t{name} int, w{name} double"))  # as long as an axis of a grid


def resample(df: DataFrame, src: tuple[int, int], dst: tuple[int, int], method: str, value: str = "v", by: tuple[str, ...] = ()) -> DataFrame:
    """by, row, col and the value on the target grid: average, bilinear, nearest or mode (ties to the smaller class)."""
    make = {"average": overlap_weights, "mode": overlap_weights, "bilinear": linear_weights, "nearest": nearest_weights}[method]
    spark = df.sparkSession
    j = df.join(_axis(spark, make(src[0], dst[0]), "row"), "row").join(_axis(spark, make(src[1], dst[1]), "col"), "col")
    keys = [*by, F.col("trow").alias("row"), F.col("tcol").alias("col")]
    w, v = F.col("wrow") * F.col("wcol"), F.col(value)
    if method == "mode":
        n = j.filter(v.isNotNull()).groupBy(*keys, value).agg(F.sum(w).alias("__w"))
        return n.groupBy(*by, "row", "col").agg(F.max_by(v, F.struct(F.round("__w", 6), -v)).alias(value))
    total = F.sum(F.when(v.isNotNull(), w))
    return j.groupBy(*keys).agg(F.try_divide(F.sum(v * w), total).alias(value))


def zoom_out(df: DataFrame, k: int, value: str = "v", by: tuple[str, ...] = ()) -> DataFrame:
    """Means of blocks of k x k cells."""
    block = [F.floor(F.col(c) / k).cast("int").alias(c) for c in ("row", "col")]
    return df.groupBy(*by, *block).agg(F.avg(value).alias(value))


def area_total(v: Column, metres: float, months_to_year: bool = False) -> Column:
    """Grams per square metre and month to petagrams per cell."""
    return v * (metres * metres * 1e-15) * (12 if months_to_year else 1)


def round_coords(c: Column, decimals: int = 4) -> Column:
    return F.round(c.cast("float").cast("double"), decimals)


#: Fixed values of the Australian Albers system (EPSG:3577): GRS80 axis and flattening, parallels, origin.
A, FLAT, P1, P2, LAT0, LON0 = 6378137.0, 1 / 298.257222101, -18.0, -36.0, 0.0, 132.0


def _cone() -> tuple[float, float, float, float, float]:
    """First eccentricity, cone constant, its c, radius of the origin, and q of the pole."""
    e2 = FLAT * (2 - FLAT)
    e = math.sqrt(e2)
    q_of = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    m_of = lambda p: math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)
    p1, p2, p0 = (math.radians(p) for p in (P1, P2, LAT0))
    n = (m_of(p1) ** 2 - m_of(p2) ** 2) / (q_of(math.sin(p2)) - q_of(math.sin(p1)))
    c = m_of(p1) ** 2 + n * q_of(math.sin(p1))
    return e, n, c, A * math.sqrt(c - n * q_of(math.sin(p0))) / n, q_of(1.0)


def albers(lat: Column, lon: Column) -> tuple[Column, Column]:
    """x and y in metres (Snyder 1987, ellipsoidal equal-area conic)."""
    e, n, c, rho0, _ = _cone()
    s = F.sin(F.radians(lat))
    q = (1 - e * e) * (s / (1 - e * e * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    rho = A * F.sqrt(c - n * q) / n
    theta = n * F.radians(lon - LON0)
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Latitude and longitude in degrees; the latitude by the series in the authalic one, to about a millimetre. The cone opens to the north here (n < 0)."""
    e, n, c, rho0, pole = _cone()
    e2 = e * e
    sign = -1.0 if n < 0 else 1.0
    rho = F.sqrt(x * x + (rho0 - y) * (rho0 - y))
    theta = F.atan2(sign * x, sign * (rho0 - y))
    q = (c - rho * rho * (n * n / (A * A))) / n
    b = F.asin(q / pole)
    lat = b + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * b) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * b) + (761 * e2**3 / 45360) * F.sin(6 * b)
    return F.degrees(lat), LON0 + F.degrees(theta) / n


def reproject(df: DataFrame, src: GridSpec, dst: GridSpec, method: str = "bilinear", value: str = "v", by: tuple[str, ...] = ()) -> DataFrame:
    """A cube on a grid in degrees as one on a grid in metres of the Albers system: by, row, col, value.

    The centre of each target cell is mapped back and looked up between the four source centres around it (``nearest``: the closest). NULL cells are left out
    and the weights of the others are normalised again; a centre outside of the source's extent has no row. An equi-join and an aggregate.
    """
    if src.checked().crs != "EPSG:4326" or dst.checked().crs != "EPSG:3577":
        raise ValueError("from EPSG:4326 to EPSG:3577 only")
    cells = df.sparkSession.range(dst.ny * dst.nx).select((F.floor(F.col("id") / dst.nx)).cast("int").alias("trow"), (F.col("id") % dst.nx).cast("int").alias("tcol"))
    lat, lon = albers_inverse(dst.x0 + F.col("tcol") * dst.dx, dst.y0 + F.col("trow") * dst.dy)
    at = cells.select("trow", "tcol", ((lat - src.y0) / src.dy).alias("fy"), ((lon - src.x0) / src.dx).alias("fx"))
    at = at.filter(F.col("fy").between(-0.5, src.ny - 0.5) & F.col("fx").between(-0.5, src.nx - 0.5))
    held = lambda c, n: F.greatest(F.lit(0.0), F.least(F.col(c), F.lit(n - 1.0)))
    at = at.withColumns({"fy": held("fy", src.ny), "fx": held("fx", src.nx)})
    if method == "nearest":
        near = at.select("trow", "tcol", F.floor(F.col("fy") + 0.5).cast("int").alias("row"), F.floor(F.col("fx") + 0.5).cast("int").alias("col"), F.lit(1.0).alias("w"))
    else:
        ends = lambda c: F.array(F.struct(F.floor(c).cast("int").alias("i"), (1 - (F.col(c) - F.floor(c))).alias("w")), F.struct((F.floor(c) + 1).cast("int").alias("i"), (F.col(c) - F.floor(c)).alias("w")))
        near = at.withColumn("y", F.explode(ends("fy"))).withColumn("x", F.explode(ends("fx")))
        near = near.select("trow", "tcol", F.col("y.i").alias("row"), F.col("x.i").alias("col"), (F.col("y.w") * F.col("x.w")).alias("w")).filter("w > 0")
    j = df.join(near, ["row", "col"])
    v, w = F.col(value), F.col("w")
    out = j.groupBy(*by, F.col("trow").alias("row"), F.col("tcol").alias("col")).agg(F.try_divide(F.sum(v * w), F.sum(F.when(v.isNotNull(), w))).alias(value))
    return out


#: Whether a point (x, y) lies in rings, by the even-odd rule over all edges, so that a ring within another one is a hole.
INSIDE = """aggregate({rings}, 0, (n, r) -> n + aggregate(sequence(0, size(r) - 1), 0, (c, i) -> c + if(
 (r[i][1] > {y}) <> (r[(i + 1) % size(r)][1] > {y}) and {x} < (r[(i + 1) % size(r)][0] - r[i][0]) * ({y} - r[i][1]) / nullif(r[(i + 1) % size(r)][1] - r[i][1], 0) + r[i][0], 1, 0))) % 2 = 1"""


def regions_table(spark: SparkSession, polygons: list[tuple[int, list]]) -> DataFrame:
    """number and rings (an array of arrays of points) out of (number, ring) or (number, [ring, hole, ...])."""
    rings = lambda p: [[[float(x), float(y)] for x, y in r] for r in (p if p and isinstance(p[0][0], (list, tuple)) else [p])]
    return spark.createDataFrame([(n, rings(p)) for n, p in polygons], "number int, rings array<array<array<double>>>")


def regions_at(points: DataFrame, regions: DataFrame, x: str = "lon", y: str = "lat", name: str = "regions", tile: float = 1.0) -> DataFrame:
    """points with the numbers, ascending, of the regions (number, rings) that hold them; an empty array outside of all.

    Bounding boxes are laid over square tiles, so the join is one of equal tiles, and a row of points stays one row.
    """
    regions = regions.select("number", F.filter("rings", lambda r: F.size(r) > 0).alias("rings"))
    flat = F.flatten("rings")
    xs, ys = F.transform(flat, lambda p: p[0]), F.transform(flat, lambda p: p[1])
    span = lambda a: F.sequence(F.floor(F.array_min(a) / tile).cast("long"), F.floor(F.array_max(a) / tile).cast("long"))
    tiles = regions.filter(F.size(flat) > 0).withColumn("__tx", F.explode(span(xs))).withColumn("__ty", F.explode(span(ys)))
    tiles = tiles.groupBy("__tx", "__ty").agg(F.sort_array(F.collect_list(F.struct("number", "rings"))).alias("__held"))  # at most all regions
    at = points.withColumns({"__tx": F.floor(F.col(x) / tile).cast("long"), "__ty": F.floor(F.col(y) / tile).cast("long")})
    hit = F.expr(f"transform(filter(__held, p -> {INSIDE.format(rings='p.rings', x=f'`{x}`', y=f'`{y}`')}), p -> p.number)")
    return at.join(tiles, ["__tx", "__ty"], "left").withColumn(name, F.coalesce(hit, F.array().cast("array<int>"))).drop("__tx", "__ty", "__held")


def rasterise(cells: DataFrame, regions: DataFrame, x: str = "lon", y: str = "lat", name: str = "region", tile: float = 1.0) -> DataFrame:
    """The first region that holds the centre of each cell; NULL outside of all."""
    return regions_at(cells, regions, x, y, "__in", tile).withColumn(name, F.get("__in", F.lit(0))).drop("__in")


def points_in_regions(points: DataFrame, regions: DataFrame, x: str = "lon", y: str = "lat", fixes: dict[str, int] | None = None, site: str = "site", tile: float = 1.0) -> DataFrame:
    """A left join of points with regions: a row for each region that holds a point, or one with NULL. ``fixes`` gives sites their region whatever their place."""
    held = regions_at(points, regions, x, y, "__in", tile)
    if fixes:
        known = F.create_map(*(F.lit(v) for kv in fixes.items() for v in kv))
        held = held.withColumn("__in", F.when(F.col(site).isin(*fixes), F.array(known[F.col(site)])).otherwise(F.col("__in")))
    return held.select(*points.columns, F.explode_outer("__in").alias("region"))


def zonal_mean(df: DataFrame, zones: DataFrame, value: str = "v", zone: str = "region", by: tuple[str, ...] = ()) -> DataFrame:
    """The mean of each zone; zones: cell and the number of its zone (a rasterised region, or a region layer on the cube's grid)."""
    return df.join(zones.filter(F.col(zone).isNotNull()).select("cell", zone), "cell").groupBy(zone, *by).agg(F.avg(value).alias(value))


def same_cells(a: DataFrame, b: DataFrame) -> bool:
    """Whether two cubes have the same coordinates."""
    ka, kb = a.select("row", "col").distinct(), b.select("row", "col").distinct()
    return ka.exceptAll(kb).limit(1).count() == 0 and kb.exceptAll(ka).limit(1).count() == 0
