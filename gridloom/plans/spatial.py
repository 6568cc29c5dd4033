"""Queries over grids (the 8 x 8 tile of an embedding, or suppliers on a grid), ensembles, points and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import align, grid, mask, reduce
from ..sources import io
from .registry import query, table
from .registry import rounded as r

TILE = "tile AS (SELECT vec_id AS tile, label, CAST((i - 1) // 8 AS INTEGER) AS row, CAST((i - 1) % 8 AS INTEGER) AS col, CASE WHEN (vec_id + i) % 11 = 0 THEN NULL ELSE CAST(embedding[i] AS DOUBLE) END AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS i) n)"


def tiles(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("tile"), "label", F.posexplode("embedding").alias("p", "x"))
    v = F.when((F.col("tile") + F.col("p") + 1) % 11 == 0, F.lit(None)).otherwise(F.col("x").cast("double"))
    return e.select("tile", "label", F.expr("int(p div 8)").alias("row"), (F.col("p") % 8).alias("col"), v.alias("v"))


def _values(weights) -> str:
    return "(VALUES " + ", ".join(f"({i}, {j}, {w!r}::DOUBLE)" for i, j, w in weights) + ")"


def _resample_sql(make, dst: int, value: str = "round(sum(v * y.w * x.w) / nullif(sum(CASE WHEN v IS NOT NULL THEN y.w * x.w END), 0), 4) AS v") -> str:
    w = _values(make(8, dst))
    return f"WITH {TILE} SELECT tile, CAST(y.t AS INTEGER) AS row, CAST(x.t AS INTEGER) AS col, {value} FROM tile JOIN {w} y(s, t, w) ON y.s = row JOIN {w} x(s, t, w) ON x.s = col GROUP BY 1, 2, 3"


def _resampled(spark, d, method, dst):
    return grid.resample(tiles(spark, d), (8, 8), (dst, dst), method, by=("tile",)).select("tile", "row", "col", r("v").alias("v"))


@query(_resample_sql(grid.overlap_weights, 3))
def grid_resample_average(spark, d):
    return _resampled(spark, d, "average", 3)


@query(_resample_sql(grid.linear_weights, 5))
def grid_resample_bilinear(spark, d):
    return _resampled(spark, d, "bilinear", 5)


@query(_resample_sql(grid.nearest_weights, 5))
def grid_resample_nearest(spark, d):
    return _resampled(spark, d, "nearest", 5)


_W3 = _values(grid.overlap_weights(8, 3))


@query(f"WITH {TILE}, k AS (SELECT tile, CAST(y.t AS INTEGER) AS row, CAST(x.t AS INTEGER) AS col, CASE WHEN v < -0.05 THEN 0 WHEN v > 0.05 THEN 2 WHEN v IS NOT NULL THEN 1 END AS class, sum(y.w * x.w) AS w FROM tile JOIN {_W3} y(s, t, w) ON y.s = row JOIN {_W3} x(s, t, w) ON x.s = col GROUP BY 1, 2, 3, 4), o AS (SELECT *, row_number() OVER (PARTITION BY tile, row, col ORDER BY round(w, 6) DESC, class) AS k FROM k WHERE class IS NOT NULL) SELECT tile, row, col, class FROM o WHERE k = 1")
def grid_resample_mode(spark, d):
    c = F.when(F.col("v") < -0.05, 0).when(F.col("v") > 0.05, 2).when(F.col("v").isNotNull(), 1)
    t = tiles(spark, d).withColumn("class", c)
    j = grid.resample(t, (8, 8), (3, 3), "mode", value="class", by=("tile",))
    return j


@query(f"WITH {TILE} SELECT tile, row // 2 AS row, col // 2 AS col, round(avg(v), 4) AS v FROM tile GROUP BY 1, 2, 3")
def grid_zoom_out_average(spark, d):
    return grid.zoom_out(tiles(spark, d), 2, by=("tile",)).select("tile", "row", "col", r("v").alias("v"))


@query(f"WITH {TILE} SELECT tile, round(sum(v * (5000.0 * 5000.0 * 1e-15) * 12) * 1e9, 4) AS total FROM tile GROUP BY tile")
def area_scaled_total(spark, d):
    return tiles(spark, d).groupBy("tile").agg(r(F.sum(grid.area_total(F.col("v"), 5000.0, True)) * 1e9).alias("total"))


_QN = "CASE WHEN len(a) >= 3 THEN a[CAST(round_even({p} * (len(a) - 1), 0) AS INTEGER) + 1] END"


@query("WITH m AS (SELECT vec_id, list_sort(list_transform(embedding[1:CAST(1 + vec_id % 33 AS INTEGER)], lambda x: CAST(x AS DOUBLE))) AS a FROM embeddings) SELECT vec_id, " + ", ".join(f"{_QN.format(p=p)} AS flux_{k}" for k, p in (("25th_percentile", 0.25), ("median", 0.5), ("75th_percentile", 0.75))) + " FROM m")
def ensemble_quantiles(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.slice(F.col("embedding").cast("array<double>"), F.lit(1), (F.col("vec_id") % 33 + 1).cast("int")).alias("m"))
    return reduce.combine_members(e, "m", "flux")


@query("SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n FROM embeddings")
def ensemble_valid_count(spark, d):
    keep = F.transform("embedding", lambda x: F.when(x > 0, x))
    return table(spark, d, "embeddings").select("vec_id", reduce.member_count(keep).alias("n"))


@query("SELECT vec_id, name, v FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(label AS DOUBLE) AS c FROM embeddings) UNPIVOT (v FOR name IN (a, b, c))")
def unpivot_variables(spark, d):
    e = F.col("embedding")
    wide = table(spark, d, "embeddings").select("vec_id", e[0].cast("double").alias("a"), e[1].cast("double").alias("b"), F.col("label").cast("double").alias("c"))
    return wide.unpivot("vec_id", ["a", "b", "c"], "name", "v")


@query("WITH m AS (SELECT vec_id, list_sort(list_transform(embedding[1:CAST(1 + vec_id % 33 AS INTEGER)], lambda x: CAST(x AS DOUBLE))) AS a FROM embeddings) SELECT vec_id, " + ", ".join(f"{_QN.format(p=p)} AS pc_{int(p * 100)}" for p in (0.25, 0.5, 0.75)) + " FROM m")
def pivot_quantiles(spark, d):
    """Quantiles as rows, by the rule of nearest rank, then as columns."""
    ps = {"pc_25": 0.25, "pc_50": 0.5, "pc_75": 0.75}
    e = table(spark, d, "embeddings").select("vec_id", F.slice(F.col("embedding").cast("array<double>"), F.lit(1), (F.col("vec_id") % 33 + 1).cast("int")).alias("m"))
    long = e.select("vec_id", F.explode(F.array(*(F.struct(F.lit(k).alias("quantile"), reduce.member_quantile(F.col("m"), p).alias("v")) for k, p in ps.items()))).alias("x")).select("vec_id", "x.*")
    return long.groupBy("vec_id").pivot("quantile", list(ps)).agg(F.first("v"))


@query("SELECT l_orderkey, l_linenumber, (l_quantity + l_discount + l_tax) / 3 AS mean FROM lineitem")
def row_mean_across_columns(spark, d):
    l = table(spark, d, "lineitem")  # noqa: E741
    return l.select("l_orderkey", "l_linenumber", reduce.row_mean("l_quantity", "l_discount", "l_tax").alias("mean"))


POINT = "c_custkey AS site, -10.2 - (c_custkey % 97) * 0.05 AS lat, 113.1 + (c_custkey % 89) * 0.05 AS lon FROM customer"


@query(f"WITH p AS (SELECT {POINT}), i AS (SELECT site, floor((lat + 10.0) / -0.5 + 0.5) AS y, floor((lon - 113.0) / 0.5 + 0.5) AS x FROM p) SELECT site, CAST(least(greatest(y, 0), 9) * 10 + least(greatest(x, 0), 9) AS BIGINT) AS cell, s_acctbal AS v FROM i LEFT JOIN supplier ON s_suppkey = least(greatest(y, 0), 9) * 10 + least(greatest(x, 0), 9)")
def nearest_cell_extract(spark, d):
    p = table(spark, d, "customer").select(F.col("c_custkey").alias("site"), (-10.2 - (F.col("c_custkey") % 97) * 0.05).alias("lat"), (113.1 + (F.col("c_custkey") % 89) * 0.05).alias("lon"))
    cell = align.nearest_index(F.col("lat"), -10.0, -0.5, 10) * 10 + align.nearest_index(F.col("lon"), 113.0, 0.5, 10)
    at = p.select("site", cell.alias("cell"))
    return at.join(table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell"), F.col("s_acctbal").alias("v")), "cell", "left").select("site", "cell", "v")


@query("""WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts AS rt, value FROM events WHERE event_type = 'view'),
j AS (SELECT l.event_id, l.user_id, l.ts, v.value, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(epoch_us(v.rt) - epoch_us(l.ts)), v.rt, CASE WHEN v.rt <= l.ts THEN -v.value ELSE v.value END) AS k, abs(epoch_us(v.rt) - epoch_us(l.ts)) <= 86400000000 AS near FROM l LEFT JOIN v USING (user_id))
SELECT event_id, user_id, ts, CASE WHEN near THEN value END AS value FROM j WHERE k = 1""")
def asof_nearest_tolerance(spark, d):
    e = table(spark, d, "events")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return align.asof_nearest(left, e.filter("event_type = 'view'").select("user_id", "ts", "value"), "user_id", "ts", "value", "1 day")


@query("""WITH a AS (SELECT l_suppkey AS cell, avg(sqrt(l_tax)) AS v FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49 GROUP BY 1), b AS (SELECT l_suppkey AS cell, avg(sqrt(l_tax)) AS v, max(l_discount) AS w FROM lineitem WHERE l_quantity < 2 GROUP BY 1)
SELECT cell, round(coalesce(a.v, b.v), 4) AS v, b.w FROM a FULL JOIN b USING (cell)""")
def merge_outer_override(spark, d):
    l = table(spark, d, "lineitem").withColumn("cell", F.col("l_suppkey"))  # noqa: E741
    a = l.filter("l_returnflag = 'R' and l_quantity > 49").groupBy("cell").agg(F.avg(F.sqrt("l_tax")).alias("v"))
    b = l.filter("l_quantity < 2").groupBy("cell").agg(F.avg(F.sqrt("l_tax")).alias("v"), F.max("l_discount").alias("w"))
    return align.merge_override([a, b], ["cell"]).select("cell", r("v").alias("v"), "w")


@query("""WITH ec AS (SELECT user_id, CAST(ts AS DATE) AS t, round(sum(value), 4) AS GPP_EC FROM events WHERE event_type = 'view' GROUP BY 1, 2), rs AS (SELECT user_id, CAST(ts AS DATE) AS t, count(*) AS LAI_RS FROM events WHERE event_type = 'click' GROUP BY 1, 2)
SELECT user_id, t, GPP_EC, LAI_RS FROM ec LEFT JOIN rs USING (user_id, t)""")
def suffix_join(spark, d):
    e = table(spark, d, "events").withColumn("t", F.col("ts").cast("date"))
    ec = align.suffixed(e.filter("event_type = 'view'").groupBy("user_id", "t").agg(r(F.sum("value")).alias("GPP")), "_EC", ("user_id", "t"))
    rs = align.suffixed(e.filter("event_type = 'click'").groupBy("user_id", "t").agg(F.count("*").alias("LAI")), "_RS", ("user_id", "t"))
    return align.left_all([ec, rs], ["user_id", "t"])


SITE = "SELECT c_custkey, c_nationkey AS site, CASE WHEN c_nationkey % 3 = 0 THEN NULL WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS h_ec, c_acctbal / 2 AS h_rs FROM customer"


@query(f"WITH s AS ({SITE}) SELECT c_custkey, site, CASE WHEN count(h_ec) OVER (PARTITION BY site) = 0 THEN h_rs ELSE h_ec END AS h FROM s")
def site_fallback_column(spark, d):
    s = sites(spark, d)
    return s.select("c_custkey", "site", align.fallback_column("h_ec", "h_rs", "site").alias("h"))


def sites(spark, d):
    h = F.when((F.col("c_nationkey") % 3 == 0) | (F.col("c_acctbal") < 0), F.lit(None)).otherwise(F.col("c_acctbal"))
    return table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("site"), h.alias("h_ec"), (F.col("c_acctbal") / 2).alias("h_rs"), "c_name")


@query(f"WITH s AS ({SITE}) SELECT * FROM s WHERE h_ec IS NOT NULL AND h_rs IS NOT NULL")
def drop_any_null(spark, d):
    return sites(spark, d).drop("c_name").na.drop("any")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT (contains(c_name, '12') OR contains(c_name, '7'))")
def substring_exclusion(spark, d):
    return table(spark, d, "customer").filter(mask.not_named(F.col("c_name"), ["12", "7"])).select("c_custkey", "c_name")


@query("""SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages""")
def link_crawl(spark, d):
    return io.links(table(spark, d, "pages"))


@query("""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages) SELECT page_id, link, regexp_extract(link, '([^/]*)$', 1) AS name, replace(link, '/', '/dods/') AS url FROM l WHERE suffix(link, 'e') OR suffix(link, 'is')""")
def link_filter_rewrite(spark, d):
    return io.data_links(table(spark, d, "pages"), ["e", "is"], "/", "/dods/")


@query("SELECT site, c_custkey, h FROM (SELECT c_nationkey AS site, c_custkey, c_acctbal AS h, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer) WHERE k = 1")
def first_row_per_site(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("site"))
    return c.agg(F.min("c_custkey").alias("c_custkey"), F.min_by("c_acctbal", "c_custkey").alias("h"))


@query("SELECT c_custkey, round((c_acctbal * 9301 + 49297) % 233280, 2) AS k FROM customer ORDER BY k, c_custkey LIMIT 400")
def deterministic_sample(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.round((F.col("c_acctbal") * 9301 + 49297) % 233280, 2).alias("k")).orderBy("k", "c_custkey").limit(400)


@query("SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderdate < TIMESTAMP '1998-01-01')")
def idempotent_antijoin(spark, d):
    done = table(spark, d, "orders").filter("o_orderdate < timestamp_ntz'1998-01-01'").select(F.col("o_orderkey").alias("l_orderkey"))
    return io.missing(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), done, ["l_orderkey"])


@query("SELECT s_suppkey AS cell, CAST(CASE WHEN lat BETWEEN -14.9 AND -10.1 AND lon > 112.9 AND lon < 115.2 THEN 1 WHEN lat < -10.1 AND lat > -30.1 AND lon > 115.2 AND lon < 118 THEN 2 END AS INTEGER) AS region FROM (SELECT s_suppkey, -10 - 0.5 * (s_suppkey // 10) AS lat, 113 + 0.5 * (s_suppkey % 10) AS lon FROM supplier)")
def rasterize_polygons(spark, d):
    k = F.col("s_suppkey")
    cells = table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell"), (F.lit(-10) - 0.5 * F.floor(k / 10)).alias("lat"), (F.lit(113) + 0.5 * (k % 10)).alias("lon"))
    box = lambda x0, x1, y0, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    regions = grid.regions_table(spark, [(1, box(112.9, 115.2, -14.9, -10.1)), (2, box(115.2, 118.0, -30.1, -10.1))])
    return grid.rasterise(cells, regions).select("cell", "region")


_E2 = "0.006694380022903416"
_E = "0.08181919104283185"


def _q(s: str) -> str:
    return f"((1 - {_E2}) * ({s} / (1 - {_E2} * {s} * {s}) - ln((1 - {_E} * {s}) / (1 + {_E} * {s})) / (2 * {_E})))"


def _m(p: str) -> str:
    return f"(cos(radians({p})) / sqrt(1 - {_E2} * pow(sin(radians({p})), 2)))"


@query(f"""WITH k AS (SELECT (pow({_m('-18.0')}, 2) - pow({_m('-36.0')}, 2)) / ({_q('sin(radians(-36.0))')} - {_q('sin(radians(-18.0))')}) AS n),
c AS (SELECT n, pow({_m('-18.0')}, 2) + n * {_q('sin(radians(-18.0))')} AS c FROM k),
p AS (SELECT s_suppkey AS cell, -10 - 0.5 * (s_suppkey // 10) AS lat, 113 + 0.5 * (s_suppkey % 10) AS lon FROM supplier),
rho AS (SELECT cell, n, c, 6378137.0 * sqrt(c - n * {_q('sin(radians(lat))')}) / n AS rho, n * radians(lon - 132.0) AS theta FROM p, c)
SELECT cell, round(rho * sin(theta), 1) AS x, round(6378137.0 * sqrt(c) / n - rho * cos(theta), 1) AS y FROM rho""")
def albers_project(spark, d):
    k = F.col("s_suppkey")
    x, y = grid.albers(F.lit(-10) - 0.5 * F.floor(k / 10), F.lit(113) + 0.5 * (k % 10))
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell"), F.round(x, 1).alias("x"), F.round(y, 1).alias("y"))


@query("SELECT c_custkey, CAST(substr(c_name, 1, length(c_name) - 2) AS VARCHAR) AS short, c_name[-5:-2] AS middle, TRY_CAST(substr(unit, 1, length(unit) - 1) AS DOUBLE) AS metres, regexp_replace(c_mktsegment, '(ING|URE|Y)$', '') AS segment, c_name || '.nc' AS file FROM (SELECT *, CASE WHEN c_custkey % 4 = 0 THEN 'unknown' ELSE CAST(c_nationkey AS VARCHAR) || '.5m' END AS unit FROM customer)")
def string_templates(spark, d):
    n = F.col("c_name")
    unit = F.when(F.col("c_custkey") % 4 == 0, "unknown").otherwise(F.concat(F.col("c_nationkey").cast("string"), F.lit(".5m")))
    return table(spark, d, "customer").select("c_custkey", S.without_end(n, 2).alias("short"), S.from_end(n, 5, 1).alias("middle"), S.number_with_unit(unit).alias("metres"), S.strip_suffix(F.col("c_mktsegment"), "ING", "URE", "Y").alias("segment"), F.format_string("%s.nc", n).alias("file"))
