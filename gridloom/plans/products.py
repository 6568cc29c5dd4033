"""Queries over products: masks, layers, comparisons of versions, grids in metres, points and zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import align, grid, mask, reduce, temporal as T
from .cube import CUBE, cube, mean_root
from .registry import query, table
from .registry import rounded as r
from .spatial import POINT, _q, _E2

# suppliers on a grid of ten columns; the share of towns and the land class of a cell come from its account
LAND = "land AS (SELECT s_suppkey AS cell, CAST(s_suppkey // 10 AS INTEGER) AS row, CAST(s_suppkey % 10 AS INTEGER) AS col, CASE WHEN s_acctbal >= 0 THEN s_acctbal / 100 END AS urban, CAST(s_nationkey AS INTEGER) AS class FROM supplier)"


def land(spark, d):
    s = F.col("s_suppkey")
    return table(spark, d, "supplier").select(s.alias("cell"), F.expr("int(s_suppkey div 10)").alias("row"), (s % 10).cast("int").alias("col"), F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal") / 100).alias("urban"), F.col("s_nationkey").alias("class"))


@query(f"WITH {LAND} SELECT cell, CASE WHEN urban > 10 THEN 1 ELSE 0 END AS urban, CASE WHEN class = 24 THEN 1 ELSE 0 END AS water, CASE WHEN urban > 10 OR class = 24 THEN 1 ELSE 0 END AS both FROM land")
def urban_water_mask(spark, d):
    u, w = mask.above_class(F.col("urban"), 10.0), mask.is_class(F.col("class"), 24)
    return land(spark, d).select("cell", u.alias("urban"), w.alias("water"), mask.any_flag(u, w).alias("both"))


_W5 = "(VALUES " + ", ".join(f"({i}, {j}, {w!r}::DOUBLE)" for i, j, w in grid.overlap_weights(10, 4)) + ")"


@query(f"WITH {LAND}, k AS (SELECT CAST(y.t AS INTEGER) AS row, CAST(x.t AS INTEGER) AS col, CASE WHEN urban IS NOT NULL THEN 1 ELSE 0 END AS land, sum(y.w * x.w) AS w FROM land JOIN {_W5} y(s, t, w) ON y.s = row JOIN {_W5} x(s, t, w) ON x.s = col GROUP BY 1, 2, 3), o AS (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY round(w, 6) DESC, land) AS k FROM k) SELECT row, col, land FROM o WHERE k = 1")
def land_mask_resampled(spark, d):
    """A mask out of missing values, resampled by the most frequent class."""
    cells = land(spark, d).select("row", "col", mask.has_value(F.col("urban")).alias("land"))
    return grid.resample(cells, (10, 10), (4, 4), "mode", value="land")


@query(f"WITH {LAND} SELECT cell, t, urban FROM land CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2003-01-15', TIMESTAMP '2003-12-15', INTERVAL 1 MONTH)) AS t)")
def static_over_months(spark, d):
    return T.over_months(land(spark, d).select("cell", "urban"), "2003-01-01", "2003-12-31")


@query(f"WITH {CUBE}, a AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i, row_number() OVER (ORDER BY t DESC) AS j FROM (SELECT DISTINCT t FROM cube)) SELECT cell, t, q FROM cube JOIN a USING (t) WHERE i = 12 OR j = 1")
def positional_select(spark, d):
    c = cube(spark, d).select("cell", "t", "q")
    return T.concat_time([T.at_step(c, 12), T.at_step(c, -1)])


@query(f"WITH {CUBE}, a AS (SELECT l_suppkey AS cell, max(l_discount) AS d FROM lineitem WHERE l_quantity > 40 GROUP BY 1) SELECT cell, t, q, d FROM (SELECT cell, t, q FROM cube WHERE t < TIMESTAMP '1996-01-01' UNION ALL SELECT cell, t, q FROM cube WHERE t >= TIMESTAMP '2001-01-01') LEFT JOIN a USING (cell)")
def concat_and_assign(spark, d):
    """Two periods one below the other, and a column of another table by key."""
    c = cube(spark, d).select("cell", "t", "q")
    years = T.concat_time([T.time_slice(c, "1995", "1995"), T.time_slice(c, "2001", "2001")])
    other = table(spark, d, "lineitem").filter("l_quantity > 40").groupBy(F.col("l_suppkey").alias("cell")).agg(F.max("l_discount").alias("w"))
    return align.assigned(years, other, ["cell"], "w", "d")


@query("SELECT key AS latitude, a.n AS n_r, b.n AS n_a FROM (SELECT l_partkey % 500 AS key, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY 1) a FULL JOIN (SELECT l_partkey % 500 AS key, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45 GROUP BY 1) b USING (key)")
def columns_side_by_side(spark, d):
    l = table(spark, d, "lineitem").filter("l_quantity > 45").withColumn("key", F.col("l_partkey") % 500)  # noqa: E741
    parts = [l.filter(F.col("l_returnflag") == f.upper()).groupBy("key").agg(F.count("*").alias(f"n_{f}")) for f in ("r", "a")]
    return align.side_by_side(parts, ["key"]).withColumnsRenamed({"key": "latitude"})


YEARS = f"WITH {CUBE}, y AS (SELECT CAST(year(t) AS INTEGER) AS y, sum(q) AS mid, max(q) AS low, sum(q) + max(q) AS high FROM cube GROUP BY 1)"


def yearly(spark, d):
    q = F.col("q")
    return cube(spark, d).groupBy(F.year("t").alias("y")).agg(F.sum(q).alias("mid"), F.max(q).alias("low"), (F.sum(q) + F.max(q)).alias("high"))


@query(YEARS + " SELECT y, mid, mid - low AS mid_below, high - mid AS mid_above, mid / nullif(CASE WHEN y <> 1997 THEN low END, 0) AS ratio FROM y")
def error_bars_and_ratio(spark, d):
    y = align.error_bars(yearly(spark, d), "mid", "low", "high")
    return y.select("y", "mid", "mid_below", "mid_above", align.ratio(F.col("mid"), F.when(F.col("y") != 1997, F.col("low"))).alias("ratio"))


@query(YEARS + ", l AS (SELECT y, name, v FROM y UNPIVOT (v FOR name IN (mid, low, high))) SELECT name, " + ", ".join(f"CAST(max(CASE WHEN y = {y} THEN v END) AS DOUBLE) AS \"{y}\"" for y in range(1995, 2002)) + " FROM l GROUP BY name")
def transposed_years(spark, d):
    return align.transposed(yearly(spark, d), "y", [str(y) for y in range(1995, 2002)])


@query("WITH y AS (SELECT o_custkey AS site, CAST(year(o_orderdate) AS BIGINT) AS y, avg(sqrt(o_totalprice)) AS v FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2), s AS (SELECT site, unnest(generate_series(min(y), max(y))) AS y FROM y GROUP BY site) SELECT s.site, CAST(make_date(s.y, 12, 31) AS TIMESTAMP) AS t, round(v, 4) AS v FROM s LEFT JOIN y ON y.site = s.site AND y.y = s.y")
def site_year_spine(spark, d):
    o = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("site"), F.col("o_orderdate").alias("t"), "o_totalprice")
    return T.year_spine(o, "site", {"v": mean_root("o_totalprice")}).withColumn("v", r("v"))


# a grid in metres over the suppliers' grid; the inverse of the projection as in Snyder 1987
DST = grid.GridSpec(6, 5, -1_150_000.0, -2_050_000.0, -90_000.0, 95_000.0, "EPSG:3577")


def _inverse_sql() -> str:
    m = lambda p: f"(cos(radians({p})) / sqrt(1 - {_E2} * pow(sin(radians({p})), 2)))"
    series = f"({_E2} / 3 + 31 * pow({_E2}, 2) / 180 + 517 * pow({_E2}, 3) / 5040) * sin(2 * b) + (23 * pow({_E2}, 2) / 360 + 251 * pow({_E2}, 3) / 3780) * sin(4 * b) + 761 * pow({_E2}, 3) / 45360 * sin(6 * b)"
    return f"""n AS (SELECT (pow({m('-18.0')}, 2) - pow({m('-36.0')}, 2)) / ({_q('sin(radians(-36.0))')} - {_q('sin(radians(-18.0))')}) AS n),
c AS (SELECT n, pow({m('-18.0')}, 2) + n * {_q('sin(radians(-18.0))')} AS c, {_q('1.0')} AS pole FROM n),
g AS (SELECT row, col, {DST.x0} + col * {DST.dx} AS x, {DST.y0} + row * ({DST.dy}) AS y FROM (SELECT unnest(range(0, {DST.ny})) AS row), (SELECT unnest(range(0, {DST.nx})) AS col)),
p AS (SELECT row, col, n, c, pole, sqrt(x * x + pow(6378137.0 * sqrt(c) / n - y, 2)) AS rho, atan2(-x, -(6378137.0 * sqrt(c) / n - y)) AS theta FROM g, c),
b AS (SELECT *, asin((c - pow(rho * n / 6378137.0, 2)) / n / pole) AS b FROM p),
back AS (SELECT CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, degrees(b + {series}) AS lat, 132.0 + degrees(theta) / n AS lon FROM b),
f AS (SELECT row, col, (lat + 10.0) / -0.5 AS fy, (lon - 113.0) / 0.5 AS fx FROM back),
h AS (SELECT row, col, greatest(0, least(fy, ny - 1)) AS fy, greatest(0, least(fx, 9.0)) AS fx FROM f, (SELECT max(s_suppkey // 10) + 1 AS ny FROM supplier) WHERE fy BETWEEN -0.5 AND ny - 0.5 AND fx BETWEEN -0.5 AND 9.5)"""


@query(f"WITH {LAND}, {_inverse_sql()}, w AS (SELECT h.row, h.col, floor(fy) + i AS sy, floor(fx) + j AS sx, CASE i WHEN 0 THEN 1 - (fy - floor(fy)) ELSE fy - floor(fy) END * CASE j WHEN 0 THEN 1 - (fx - floor(fx)) ELSE fx - floor(fx) END AS w FROM h, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)) SELECT w.row, w.col, round(sum(urban * w) / nullif(sum(CASE WHEN urban IS NOT NULL THEN w END), 0), 4) AS v FROM w JOIN land ON land.row = sy AND land.col = sx WHERE w > 0 GROUP BY 1, 2")
def reproject_bilinear(spark, d):
    cells = land(spark, d).select("row", "col", (-10.0 - 0.5 * F.col("row")).alias("lat"), (113.0 + 0.5 * F.col("col")).alias("lon"), F.col("urban").alias("v"))
    return grid.reproject(cells, grid.GridSpec.of(cells), DST).withColumn("v", r("v"))


# two regions; the first has a hole
RINGS = [(1, [[(112.93, -10.12), (115.32, -10.12), (115.32, -14.93), (112.93, -14.93)], [(113.42, -11.13), (114.13, -11.13), (114.13, -12.62), (113.42, -12.62)]]), (2, [(114.92, -9.12), (118.77, -12.42), (114.92, -30.12)])]
IN1 = "(lat < -10.12 AND lat > -14.93 AND lon > 112.93 AND lon < 115.32 AND NOT (lat < -11.13 AND lat > -12.62 AND lon > 113.42 AND lon < 114.13))"
IN2 = "(lon > 114.92 AND lon < CASE WHEN lat > -12.42 THEN 114.92 + (lat + 9.12) / (-12.42 + 9.12) * 3.85 ELSE 118.77 - (lat + 12.42) / (-30.12 + 12.42) * 3.85 END AND lat < -9.12 AND lat > -30.12)"


@query(f"WITH p AS (SELECT {POINT}), i AS (SELECT site, CASE WHEN site IN (50, 100) THEN [7] ELSE list_filter([CASE WHEN {IN1} THEN 1 END, CASE WHEN {IN2} THEN 2 END], lambda x: x IS NOT NULL) END AS a FROM p) SELECT site, CAST(unnest(CASE WHEN len(a) = 0 THEN [NULL] ELSE a END) AS INTEGER) AS region FROM i")
def points_in_regions(spark, d):
    k = F.col("c_custkey")
    p = table(spark, d, "customer").select(k.alias("site"), (-10.2 - (k % 97) * 0.05).alias("lat"), (113.1 + (k % 89) * 0.05).alias("lon"), k.cast("string").alias("name"))
    return grid.points_in_regions(p, grid.regions_table(spark, RINGS), fixes={"50": 7, "100": 7}, site="name").select("site", "region")


@query(f"WITH {CUBE}, z AS (SELECT s_suppkey AS cell, CASE WHEN {IN1} THEN 1 WHEN {IN2} THEN 2 END AS region FROM (SELECT s_suppkey, -10 - 0.5 * (s_suppkey // 10) AS lat, 113 + 0.5 * (s_suppkey % 10) AS lon FROM supplier)) SELECT CAST(region AS INTEGER) AS region, t, round(avg(v), 4) AS v FROM cube JOIN z USING (cell) WHERE region IS NOT NULL GROUP BY 1, 2")
def region_series(spark, d):
    """The mean of each region: polygons to cells, cells to zones."""
    k = F.col("s_suppkey")
    cells = table(spark, d, "supplier").select(k.alias("cell"), (F.lit(-10) - 0.5 * F.floor(k / 10)).alias("lat"), (F.lit(113) + 0.5 * (k % 10)).alias("lon"))
    zones = grid.rasterise(cells, grid.regions_table(spark, RINGS))
    return grid.zonal_mean(cube(spark, d), zones, by=("t",)).withColumn("v", r("v"))


PAIRS = f"WITH {CUBE}, o AS (SELECT cell, t, v AS observed FROM cube WHERE cell % 3 = 0), " + ", ".join(f"{n} AS (SELECT l_suppkey AS cell, date_trunc('month', l_shipdate) + INTERVAL 14 DAY AS t, avg(sqrt(l_extendedprice)) AS v FROM lineitem WHERE l_returnflag = '{f}' GROUP BY 1, 2)" for n, f in (("ra", "R"), ("aa", "A")))


@query(PAIRS + ", j AS (SELECT 'first' AS product, observed, ra.v * 30 AS p FROM o LEFT JOIN ra USING (cell, t) UNION ALL SELECT 'second', observed, aa.v FROM o LEFT JOIN aa USING (cell, t)) SELECT product, count(p) AS n, round(regr_r2(p, observed), 4) AS r2, round(avg(abs(observed - p)), 4) AS mae FROM j GROUP BY product")
def product_intercomparison(spark, d):
    """Two products with their units put right, in the cells of the towers and at the nearest time, against what the towers observed."""
    towers = cube(spark, d).filter("cell % 3 = 0").select("cell", "t", F.col("v").alias("observed"))
    one = lambda f: T.resample_month(table(spark, d, "lineitem").filter(F.col("l_returnflag") == f), "l_suppkey", "l_shipdate", {"v": mean_root("l_extendedprice")})
    wide = align.compare_products(towers, {"first": (one("R"), 30.0), "second": (one("A"), 1.0)})
    long = wide.unpivot(["cell", "t", "observed"], ["first", "second"], "product", "p")
    return reduce.skill(long, "observed", "p", ["product"]).select("product", "n", r("r2").alias("r2"), r("mae").alias("mae"))


@query("SELECT p_partkey, CASE p_size WHEN 1 THEN 'nearest' WHEN 2 THEN 'bilinear' WHEN 3 THEN 'mode' ELSE 'average' END AS method, round(CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE), 1) AS coord FROM part")
def looked_up_method(spark, d):
    """A fixed map from keys to methods; coordinates as single precision, rounded."""
    p = table(spark, d, "part")
    return p.select("p_partkey", S.looked_up(F.col("p_size"), {1: "nearest", 2: "bilinear", 3: "mode"}, "average").alias("method"), grid.round_coords(F.col("p_retailprice"), 1).alias("coord"))
