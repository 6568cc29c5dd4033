"""Queries over monthly cubes made of lineitem: the supplier is the cell, the month of shipping the time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import align, features, mask, reduce, temporal as T
from .registry import query, table
from .registry import rounded as r

# The variables are means of square roots of amounts: a mean of amounts in cents often lies exactly between two values of the fourth place, where the
# last bit of a sum would decide; a mean of roots does not.
CUBE = "cube AS (SELECT l_suppkey AS cell, date_trunc('month', l_shipdate) + INTERVAL 14 DAY AS t, avg(sqrt(l_extendedprice)) AS v, sum(l_quantity) AS q, avg(sqrt(l_discount)) AS d, avg(sqrt(l_tax)) AS x FROM lineitem GROUP BY 1, 2)"
GAPPY = """g0 AS (SELECT l_suppkey AS cell, date_trunc('month', l_shipdate) + INTERVAL 14 DAY AS t, avg(sqrt(l_extendedprice)) AS v, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1, 2),
gap AS (SELECT c.cell, m.t, g0.v, g0.q FROM (SELECT DISTINCT cell FROM g0) c CROSS JOIN (SELECT unnest(generate_series((SELECT min(t) FROM g0), (SELECT max(t) FROM g0), INTERVAL 1 MONTH)) AS t) m LEFT JOIN g0 ON g0.cell = c.cell AND g0.t = m.t)"""
CELLM = "PARTITION BY cell, month(t)"


def mean_root(c):
    return F.avg(F.sqrt(c))


def cube(spark, d):
    """cell, t, v, q, d, x; quantities are added as decimals, so that the sum is exact."""
    aggs = {"v": mean_root("l_extendedprice"), "q": F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double"), "d": mean_root("l_discount"), "x": mean_root("l_tax")}
    return T.resample_month(table(spark, d, "lineitem"), "l_suppkey", "l_shipdate", aggs)


def gappy(spark, d):
    rows = table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_linestatus = 'F'")
    bounds = rows.select(T.month_label(F.min("l_shipdate")), T.month_label(F.max("l_shipdate"))).first()  # reads the dates only
    return T.month_spine(T.resample_month(rows, "l_suppkey", "l_shipdate", {"v": mean_root("l_extendedprice"), "q": F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")}), bounds=bounds)


@query(f"WITH {GAPPY}, f AS (SELECT *, v / nullif(avg(CASE WHEN year(t) <= 1999 THEN v END) OVER ({CELLM}), 0) AS frac FROM gap) SELECT cell, t, round(frac, 4) AS frac, CASE WHEN count(q) OVER w = 3 THEN sum(q) OVER w END AS q3 FROM f WINDOW w AS (PARTITION BY cell ORDER BY t ROWS 2 PRECEDING)")
def cube_anomaly_rolling(spark, d):
    g = gappy(spark, d)
    return g.select("cell", "t", r(T.fraction_of_normal(F.col("v"), first=1995, last=1999)).alias("frac"), T.rolling("sum", F.col("q"), 3).alias("q3"))


@query(f"WITH {CUBE} SELECT cell, t, round(v, 4) AS v, round(d, 4) AS d, round(x, 4) AS x FROM cube")
def cube_monthly_mean(spark, d):
    return cube(spark, d).select("cell", "t", r("v").alias("v"), r("d").alias("d"), r("x").alias("x"))


@query(f"WITH {GAPPY} SELECT cell, t, coalesce(q, 0) AS q FROM gap")
def cube_monthly_sum_zero(spark, d):
    return gappy(spark, d).select("cell", "t", F.coalesce("q", F.lit(0.0)).alias("q"))


ANNUAL = "SELECT cell, CAST(make_date(CAST(year(t) AS BIGINT), 12, 31) AS TIMESTAMP) AS t, {0} AS v FROM gap GROUP BY cell, year(t)"


@query(f"WITH {GAPPY} " + ANNUAL.format("round(max(v), 4)"))
def cube_annual_max(spark, d):
    return T.resample_year(gappy(spark, d), {"v": r(F.max("v"))})


@query(f"WITH {GAPPY} " + ANNUAL.format("round(avg(v), 4)"))
def cube_annual_mean(spark, d):
    return T.resample_year(gappy(spark, d), {"v": r(F.avg("v"))})


@query(f"WITH {GAPPY} " + ANNUAL.format("coalesce(sum(q), 0)"))
def cube_annual_sum(spark, d):
    return T.resample_year(gappy(spark, d), {"v": reduce.zero_sum(F.col("q"))})


@query(f"WITH {GAPPY} " + ANNUAL.format("CASE WHEN avg(q) IS NOT NULL THEN sum(q) END"))
def annual_sum_masked(spark, d):
    return T.resample_year(gappy(spark, d), {"v": reduce.masked_sum(F.col("q"))})


@query(f"WITH {CUBE} SELECT cell, t, CAST(date_diff('day', DATE '1970-01-01', CAST(t AS DATE)) AS INTEGER) AS days, CAST(day(last_day(CAST(t AS DATE))) AS INTEGER) AS month_days FROM cube")
def days_since_label(spark, d):
    return cube(spark, d).select("cell", "t", S.days_since(F.col("t")).alias("days"), S.days_in_month(F.col("t")).alias("month_days"))


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1997")
def time_slice_inclusive(spark, d):
    return T.time_slice(table(spark, d, "lineitem"), "1996", "1997", "l_shipdate").select("l_orderkey", "l_linenumber", "l_shipdate")


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-03-01' AND l_shipdate < TIMESTAMP '1997-10-16'")
def time_slice_partial(spark, d):
    return T.time_slice(table(spark, d, "lineitem"), "1996-03", "1997-10-15", "l_shipdate").select("l_orderkey", "l_linenumber", "l_shipdate")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN year(l_shipdate) IN (2000, 2001) OR l_linenumber IN (0, 5, 17, 21, 64, 65, 81) THEN l_quantity END AS v FROM lineitem")
def qc_allowlist_mask(spark, d):
    l = table(spark, d, "lineitem")  # noqa: E741
    return l.select("l_orderkey", "l_linenumber", mask.quality_mask(F.col("l_quantity"), F.col("l_linenumber"), F.col("l_shipdate"), (2000, 2001)).alias("v"))


@query(f"WITH {GAPPY}, y AS (SELECT *, lag(v) OVER (PARTITION BY cell ORDER BY t) AS v1 FROM gap) SELECT cell, t, CASE WHEN v IS NOT NULL AND v1 IS NOT NULL AND q IS NOT NULL THEN round(v, 4) END AS v FROM y")
def any_null_mask(spark, d):
    from pyspark.sql import Window

    g = gappy(spark, d).withColumn("v1", F.lag("v").over(Window.partitionBy("cell").orderBy("t")))
    return g.select("cell", "t", mask.where(r("v"), mask.all_present("v", "v1", "q")).alias("v"))


LAYER = "SELECT s_suppkey AS cell, CASE WHEN s_nationkey % 5 = 0 THEN 1 WHEN s_acctbal < 0 THEN NULL ELSE 0 END AS urban FROM supplier"


def layer(spark, d):
    urban = F.when(F.col("s_nationkey") % 5 == 0, 1).when(F.col("s_acctbal") < 0, F.lit(None)).otherwise(0)
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell"), urban.alias("urban"), "s_acctbal")


@query(f"WITH {CUBE}, l AS ({LAYER}) SELECT cube.cell, t, CASE WHEN urban IS DISTINCT FROM 1 THEN round(v, 4) END AS v FROM cube LEFT JOIN l USING (cell)")
def static_mask_join(spark, d):
    return mask.static_mask(cube(spark, d).select("cell", "t", r("v").alias("v")), layer(spark, d), "urban", ["v"])


@query("SELECT c_custkey, CASE WHEN c_acctbal / 5000 < 0 THEN 0 WHEN c_acctbal / 5000 > 1 THEN 1 ELSE c_acctbal / 5000 END AS v FROM customer")
def clip_unit_interval(spark, d):
    return table(spark, d, "customer").select("c_custkey", S.clip(F.col("c_acctbal") / 5000, 0.0, 1.0).alias("v"))


@query(f"WITH {CUBE} SELECT cell, t, round((d - x) / nullif(d + x, 0), 4) + 0 AS nd, round(tanh(pow((d - x) / nullif(d + x, 0), 2)), 4) AS k FROM cube")
def knorm_diff_tanh(spark, d):
    a, b = F.col("d"), F.col("x")
    return cube(spark, d).select("cell", "t", r(S.normalised_difference(a, b)).alias("nd"), r(S.kernel_ndvi(a, b)).alias("k"))


ES = "6.11 * exp((2500000.0 / 461) * (1.0 / 273 - 1.0 / (273 + d * 100)))"


@query(f"WITH {CUBE} SELECT cell, t, round((100 - x * 1000) / 100 * {ES}, 4) AS vpd FROM cube")
def vpd_from_rh(spark, d):
    return cube(spark, d).select("cell", "t", r(S.vpd_from_humidity(F.col("x") * 1000, F.col("d") * 100)).alias("vpd"))


@query(f"WITH {CUBE} SELECT cell, t, round({ES} - x * 100, 4) AS vpd FROM cube")
def vpd_from_vp(spark, d):
    return cube(spark, d).select("cell", "t", r(S.vpd_from_pressure(F.col("x") * 100, F.col("d") * 100)).alias("vpd"))


@query(f"WITH {CUBE} SELECT cell, t, round(x * 100 + d * (d * 100 - x * 100), 4) AS tavg, round(d * 100 - 273.15, 4) AS celsius FROM cube")
def tavg_blend(spark, d):
    return cube(spark, d).select("cell", "t", r(S.blended_temperature(F.col("x") * 100, F.col("d") * 100, F.col("d"))).alias("tavg"), r(S.kelvin_to_celsius(F.col("d") * 100)).alias("celsius"))


@query(f"WITH {CUBE}, {GAPPY} SELECT cube.cell, cube.t, round(cube.v - g0.v, 4) AS delta FROM cube JOIN g0 USING (cell, t)")
def delta_join(spark, d):
    a = cube(spark, d).select("cell", "t", "v")
    b = T.resample_month(table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_linestatus = 'F'"), "l_suppkey", "l_shipdate", {"w": mean_root("l_extendedprice")})
    return align.aligned(a, b, ["cell", "t"], r(F.col("v") - F.col("w")), "delta")


@query(f"WITH {GAPPY} SELECT DISTINCT cell, CAST(month(t) AS INTEGER) AS month, round(avg(CASE WHEN year(t) BETWEEN 1995 AND 1999 THEN v END) OVER ({CELLM}), 4) AS clim FROM gap")
def climatology_baseline(spark, d):
    g = gappy(spark, d)
    return g.groupBy("cell", F.month("t").alias("month")).agg(r(F.avg(F.when(F.year("t").between(1995, 1999), F.col("v")))).alias("clim"))


@query(f"WITH {GAPPY} SELECT cell, t, round(v - avg(CASE WHEN year(t) BETWEEN 1995 AND 1999 THEN v END) OVER ({CELLM}), 4) AS a FROM gap")
def anomaly_diff(spark, d):
    return gappy(spark, d).select("cell", "t", r(T.anomaly(F.col("v"), first=1995, last=1999)).alias("a"))


@query(f"WITH {GAPPY} SELECT cell, t, round(v / nullif(avg(CASE WHEN year(t) BETWEEN 1995 AND 1999 THEN v END) OVER ({CELLM}), 0), 4) AS a FROM gap")
def anomaly_fraction(spark, d):
    return gappy(spark, d).select("cell", "t", r(T.fraction_of_normal(F.col("v"), first=1995, last=1999)).alias("a"))


@query(f"WITH {GAPPY}, s AS (SELECT cell, t, v - avg(v) OVER ({CELLM}) AS a, stddev_pop(v) OVER ({CELLM}) AS sd FROM gap) SELECT cell, t, CASE WHEN sd > 1e-6 THEN round(a / sd, 4) END AS z FROM s")
def anomaly_zscore(spark, d):
    v = F.col("v")
    sd = F.stddev_pop(v).over(T.by_month())
    return gappy(spark, d).select("cell", "t", F.when(sd > 1e-6, r(T.standardised(v))).alias("z"))


def _roll(agg: str, frame: str, need: int, col: str = "v") -> str:
    return f"WITH {GAPPY} SELECT cell, t, CASE WHEN count({col}) OVER w >= {need} THEN round({agg}({col}) OVER w, 4) END AS m FROM gap WINDOW w AS (PARTITION BY cell ORDER BY t ROWS {frame})"


def _rolled(spark, d, kind, n, need=None, centred=False, col="v"):
    return gappy(spark, d).select("cell", "t", r(T.rolling(kind, F.col(col), n, need, centred)).alias("m"))


@query(_roll("min", "6 PRECEDING", 1))
def rolling_min7(spark, d):
    return _rolled(spark, d, "min", 7, 1)


@query(_roll("avg", "8 PRECEDING", 1))
def rolling_mean9(spark, d):
    return _rolled(spark, d, "mean", 9, 1)


@query(_roll("sum", "2 PRECEDING", 3, "q"))
def rolling_sum3_full(spark, d):
    return _rolled(spark, d, "sum", 3, col="q")


@query(_roll("sum", "5 PRECEDING", 6, "q"))
def rolling_sum6_full(spark, d):
    return _rolled(spark, d, "sum", 6, col="q")


@query(_roll("sum", "11 PRECEDING", 12, "q"))
def rolling_sum12_full(spark, d):
    return _rolled(spark, d, "sum", 12, col="q")


@query(_roll("avg", "11 PRECEDING", 12))
def rolling_mean12_full(spark, d):
    return _rolled(spark, d, "mean", 12)


@query(_roll("avg", "BETWEEN 1 PRECEDING AND 1 FOLLOWING", 3))
def rolling_center3(spark, d):
    return _rolled(spark, d, "mean", 3, centred=True)


def _interp(source: str, v: str) -> str:
    return f"""SELECT cell, t, {v}, v0, v1, t0, t1, run, CASE WHEN {v} IS NOT NULL THEN {v} WHEN run <= 2 AND v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * (epoch(t) - t0) / (t1 - t0) END AS i FROM (
SELECT *, last_value({v} IGNORE NULLS) OVER p AS v0, first_value({v} IGNORE NULLS) OVER n AS v1,
 last_value(CASE WHEN {v} IS NOT NULL THEN epoch(t) END IGNORE NULLS) OVER p AS t0, first_value(CASE WHEN {v} IS NOT NULL THEN epoch(t) END IGNORE NULLS) OVER n AS t1,
 sum(CASE WHEN {v} IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY cell ORDER BY t ROWS 2 PRECEDING) AS run
FROM {source} WINDOW p AS (PARTITION BY cell ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY cell ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(f"WITH {GAPPY}, i AS ({_interp('gap', 'v')}) SELECT cell, t, round(i, 4) AS v FROM i")
def gapfill_interp_limit2(spark, d):
    return gappy(spark, d).select("cell", "t", r(T.interpolate(F.col("v"))).alias("v"))


@query(f"WITH {GAPPY} SELECT cell, t, round(coalesce(v, avg(v) OVER ({CELLM})), 4) AS v FROM gap")
def gapfill_climatology(spark, d):
    return T.fill_with_climatology(gappy(spark, d), "v", "f").select("cell", "t", r("f").alias("v"))


@query(f"WITH {GAPPY}, c AS (SELECT cell, t, v, avg(v) OVER ({CELLM}) AS clim FROM gap), a AS (SELECT cell, t, clim, v - clim AS a FROM c), i AS ({_interp('a', 'a')}) SELECT i.cell, i.t, round(coalesce(i.i + c.clim, c.clim), 4) AS v FROM i JOIN c USING (cell, t)")
def gapfill_pipeline(spark, d):
    return T.gap_fill(gappy(spark, d), "v", "f").select("cell", "t", r("f").alias("v"))


VEG = f"""WITH {CUBE}, f AS (SELECT cell, t, CASE WHEN (d * 3 - x) / (0.91 - x) < 0 THEN 0 WHEN (d * 3 - x) / (0.91 - x) > 1 THEN 1 ELSE (d * 3 - x) / (0.91 - x) END AS f FROM cube),
l AS (SELECT *, min(f) OVER (PARTITION BY cell ORDER BY t ROWS 6 PRECEDING) AS low FROM f),
p AS (SELECT *, avg(low) OVER (PARTITION BY cell ORDER BY t ROWS 8 PRECEDING) AS p FROM l),
e AS (SELECT cell, t, f, CASE WHEN p - CASE WHEN f - p < 0 THEN abs(f - p) ELSE 0 END < 0 THEN 0 ELSE p - CASE WHEN f - p < 0 THEN abs(f - p) ELSE 0 END END AS persistent FROM p),
v AS (SELECT cell, t, persistent, CASE WHEN f - persistent < 0 THEN 0 ELSE f - persistent END AS recurrent FROM e)"""


def _veg(spark, d):
    return features.vegetation_fractions(cube(spark, d).select("cell", "t", (F.col("d") * 3).alias("ndvi"), F.col("x").alias("bare")))


@query(VEG + " SELECT cell, t, round(persistent, 4) AS persistent, round(recurrent, 4) AS recurrent FROM v")
def veg_fractions(spark, d):
    return _veg(spark, d).select("cell", "t", r("persistent").alias("persistent"), r("recurrent").alias("recurrent"))


YEARLY = VEG + ", y AS (SELECT cell, CAST(year(t) AS BIGINT) AS y, max(persistent) AS trees, max(recurrent) AS grass FROM v GROUP BY 1, 2)"


@query(YEARLY + " SELECT cell, make_timestamp(y, m, 1, 0, 0, 0) + INTERVAL 14 DAY AS t, round(trees, 4) AS trees, round(grass, 4) AS grass, round(1 - (trees + grass), 4) AS bare FROM y CROSS JOIN (SELECT unnest(range(1, 13)) AS m)")
def annual_to_monthly_expand(spark, d):
    y = features.annual_fractions(_veg(spark, d))
    return T.expand_year(y).select("cell", "t", r("trees").alias("trees"), r("grass").alias("grass"), r("bare").alias("bare"))


@query(YEARLY + " SELECT y.cell, CAST(make_date(y, 12, 31) AS TIMESTAMP) AS t, round(grass * CASE WHEN s_acctbal >= 0 THEN s_acctbal / 100 END, 4) AS c4_grass FROM y JOIN supplier ON s_suppkey = y.cell")
def c4_grass_fraction(spark, d):
    y = features.annual_fractions(_veg(spark, d))
    return features.c4_grass(y, layer(spark, d), percent="s_acctbal").select("cell", "t", r("c4_grass").alias("c4_grass"))


@query(f"WITH {GAPPY} SELECT cell, t, " + ", ".join(f"CASE WHEN count(q) OVER w{n} = {n} THEN sum(q) OVER w{n} END AS rain_{n}" for n in (3, 6, 12)) + " FROM gap WINDOW " + ", ".join(f"w{n} AS (PARTITION BY cell ORDER BY t ROWS {n - 1} PRECEDING)" for n in (3, 6, 12)))
def cumulative_rain(spark, d):
    return features.cumulative_rain(gappy(spark, d), "q").select("cell", "t", "rain_3", "rain_6", "rain_12")


@query(f"WITH {GAPPY}, m AS (SELECT cell, month(t) AS month, max(v) AS v FROM gap GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY v DESC NULLS LAST, month) AS k FROM m) SELECT cell, CAST(CASE WHEN v IS NOT NULL THEN month END AS INTEGER) AS argmax FROM k WHERE k = 1")
def argmax_month(spark, d):
    g = gappy(spark, d).groupBy("cell", F.month("t").alias("month")).agg(F.max("v").alias("v"))
    return reduce.arg_extreme(g, "v", "month", "max")


@query(f"WITH {GAPPY}, m AS (SELECT cell, month(t) AS month, min(v) AS v FROM gap GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY v NULLS LAST, month) AS k FROM m) SELECT cell, CAST(CASE WHEN v IS NOT NULL THEN month END AS INTEGER) AS argmin FROM k WHERE k = 1")
def argmin_month(spark, d):
    g = gappy(spark, d).groupBy("cell", F.month("t").alias("month")).agg(F.min("v").alias("v"))
    return reduce.arg_extreme(g, "v", "month", "min")


YV = f"WITH {CUBE}, y AS (SELECT cell, CAST(year(t) AS INTEGER) AS y, avg(v) AS v, sum(q) AS q, avg(d) AS d FROM cube GROUP BY 1, 2) "


def yearly(spark, d):
    return cube(spark, d).groupBy("cell", F.year("t").alias("y")).agg(F.avg("v").alias("v"), F.sum("q").alias("q"), F.avg("d").alias("d"))


@query(YV + "SELECT cell, round(regr_slope(v, y), 4) AS slope, round(regr_intercept(v, y), 2) AS intercept FROM y GROUP BY cell")
def cell_trend(spark, d):
    return reduce.trend(yearly(spark, d), "v", "y").select("cell", r("slope").alias("slope"), r("intercept", 2).alias("intercept"))


@query(f"WITH {CUBE} SELECT cell, round(corr(v, q), 4) AS r FROM cube GROUP BY cell")
def cell_corr(spark, d):
    return cube(spark, d).groupBy("cell").agg(r(F.corr("v", "q")).alias("r"))


@query(f"WITH {CUBE} SELECT cell, round(sqrt(avg(pow(v - q * 100, 2))), 4) AS rmse FROM cube GROUP BY cell")
def cell_rmse(spark, d):
    c = cube(spark, d).withColumn("p", F.col("q") * 100)
    return reduce.skill(c, "v", "p", ["cell"]).select("cell", r("rmse").alias("rmse"))


@query(f"WITH {CUBE} SELECT cell, round(stddev_pop(v) / nullif(avg(v), 0), 4) AS cv, round(max(v), 4) AS highest FROM cube GROUP BY cell")
def cell_cv(spark, d):
    return cube(spark, d).groupBy("cell").agg(r(reduce.variation(F.col("v"))).alias("cv"), r(F.max("v")).alias("highest"))


@query(f"WITH {CUBE} SELECT t, round(avg(v), 4) AS v FROM cube GROUP BY t")
def spatial_mean_series(spark, d):
    return cube(spark, d).groupBy("t").agg(r(F.avg("v")).alias("v"))


@query(f"WITH {GAPPY} SELECT t, coalesce(sum(q), 0) AS q FROM gap GROUP BY t")
def spatial_sum_series(spark, d):
    return gappy(spark, d).groupBy("t").agg(reduce.zero_sum(F.col("q")).alias("q"))


@query(YV + "SELECT y, round(avg(q), 4) AS q FROM y GROUP BY y")
def annual_sum_then_mean(spark, d):
    return yearly(spark, d).groupBy("y").agg(r(F.avg("q")).alias("q"))


@query(f"WITH {CUBE} SELECT r_name AS region, CAST(month(t) AS INTEGER) AS month, round(avg(v), 4) AS v FROM cube JOIN supplier ON s_suppkey = cell JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2")
def zonal_climatology(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    zones = s.select(F.col("s_suppkey").alias("cell"), F.col("r_name").alias("region"))
    return cube(spark, d).join(zones, "cell").groupBy("region", F.month("t").alias("month")).agg(r(F.avg("v")).alias("v"))


@query(f"WITH {CUBE}, c AS (SELECT cell, month(t) AS m, avg(q) AS q FROM cube GROUP BY 1, 2), s AS (SELECT m, sum(q) AS q FROM c GROUP BY m) SELECT round(max(q) - min(q), 4) AS seasonal_range FROM s")
def seasonal_range(spark, d):
    s = cube(spark, d).groupBy("cell", F.month("t").alias("m")).agg(F.avg("q").alias("q")).groupBy("m").agg(F.sum("q").alias("q"))
    return s.agg(r(F.max("q") - F.min("q")).alias("seasonal_range"))


@query(YV + ", s AS (SELECT y, sum(q) / 12 AS q FROM y GROUP BY y) SELECT round(stddev_pop(q), 4) AS iav, round(avg(q), 4) AS mean, round(quantile_cont(q, 0.25), 4) AS q1, round(quantile_cont(q, 0.5), 4) AS median, round(quantile_cont(q, 0.75), 4) AS q3 FROM s")
def iav_std(spark, d):
    s = yearly(spark, d).groupBy("y").agg((F.sum("q") / 12).alias("q"))
    out = s.agg(F.stddev_pop("q").alias("iav"), *reduce.box_summary(F.col("q")))
    return out.select(*(r(c).alias(c) for c in out.columns))


@query(f"WITH {GAPPY} SELECT cell, t, CASE WHEN v IS NULL OR CAST(q AS BIGINT) % 5 = 0 OR CAST(q AS BIGINT) % 7 = 0 THEN 0 ELSE round(v, 4) END AS clean, CASE WHEN CAST(q AS BIGINT) % 5 = 0 OR CAST(q AS BIGINT) % 7 = 0 THEN NULL ELSE round(v, 4) END AS finite, round(v * 9 * 1e-3 * 12, 4) AS area FROM gap")
def finite_and_area(spark, d):
    """Infinities where the quantity is divisible by 5, NaN where it is by 7."""
    from ..operators.grid import area_total

    v, q = F.col("v"), F.col("q").cast("long")
    bad = F.when(q % 5 == 0, F.lit(float("-inf"))).when(q % 7 == 0, F.lit(float("nan"))).otherwise(r("v"))
    return gappy(spark, d).select("cell", "t", S.finite_or(bad, 0.0).alias("clean"), S.finite_or(bad, None).alias("finite"), r(area_total(v * 1e12, 3.0, True)).alias("area"))


@query(f"WITH {CUBE}, p AS (SELECT CASE WHEN t < TIMESTAMP '1998-01-01' THEN 'early' ELSE 'late' END AS period, cell, q - avg(q) OVER ({CELLM}) AS a FROM cube) SELECT period, round(sum(a), 2) AS total FROM p GROUP BY period")
def period_total_anomaly(spark, d):
    c = cube(spark, d).select("t", T.anomaly(F.col("q")).alias("a"))
    late = F.col("t") < F.lit("1998-01-01").cast("timestamp_ntz")
    return c.groupBy(F.when(late, "early").otherwise("late").alias("period")).agg(r(F.sum("a"), 2).alias("total"))


@query(f"WITH {CUBE} SELECT cube.cell, t, round(v, 4) AS v FROM cube WHERE cell NOT IN (SELECT cell FROM cube WHERE t <= TIMESTAMP '1996-06-30' GROUP BY cell HAVING max(CASE WHEN cell % 7 = 3 THEN 0 ELSE q END) = 0)")
def zero_pixel_mask(spark, d):
    c = cube(spark, d).withColumn("z", F.when(F.col("cell") % 7 == 3, 0.0).otherwise(F.col("q")))
    return mask.never_zero(c, "z", "1996-06-30").select("cell", "t", r("v").alias("v"))


@query("WITH e AS (SELECT user_id AS cell, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events) SELECT cell, event_id, TIMESTAMP '2003-01-01' + to_days(CAST(n AS INTEGER)) AS t FROM e")
def time_axis_repair(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("cell"), "event_id")
    return T.daily_axis(e, "event_id", "2003-01-01").select("cell", "event_id", "t")
