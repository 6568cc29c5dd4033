"""Queries over training tables and models; the supplier's nation is the site."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import model, reduce
from .registry import query, table
from .registry import rounded as r

FEATURES = ["quantity", "discount", "tax", "retail", "size"]
PAIR = "pr AS (SELECT s_nationkey AS site, CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS o, CASE WHEN p_size <> 7 THEN p_retailprice * l_quantity * 0.9 + 100 END AS p FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey)"
SKILL = "count(CASE WHEN o IS NOT NULL AND p IS NOT NULL THEN 1 END) AS n, round(regr_slope(p, o), 4) AS slope, round(regr_r2(p, o), 4) AS r2, round(avg(abs(o - p)), 2) AS mae, round(sqrt(avg(pow(o - p, 2))), 2) AS rmse"


def training(spark, d):
    l, s, p = (table(spark, d, n) for n in ("lineitem", "supplier", "part"))  # noqa: E741
    j = l.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(F.col("s_nationkey").alias("site"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), F.col("p_retailprice").alias("retail"), F.col("p_size").cast("double").alias("size"), F.col("l_extendedprice").alias("label"))


def pairs(spark, d):
    """Observed and predicted prices; some of either are missing."""
    o, p = F.when(F.col("l_linenumber") != 3, F.col("label")), F.when(F.col("size") != 7, F.col("retail") * F.col("quantity") * 0.9 + 100)
    return training(spark, d).select("site", o.alias("o"), p.alias("p"))


def _skill(df):
    return df.select(*(c for c in df.columns if c == "site"), "n", r("slope").alias("slope"), r("r2").alias("r2"), r("mae", 2).alias("mae"), r("rmse", 2).alias("rmse"))


@query(f"WITH {PAIR} SELECT {SKILL} FROM pr")
def mae_r2_pooled(spark, d):
    return _skill(reduce.skill(pairs(spark, d), "o", "p"))


@query(f"WITH {PAIR} SELECT site, {SKILL} FROM pr GROUP BY site")
def mae_r2_by_group(spark, d):
    return _skill(reduce.skill(pairs(spark, d), "o", "p", ["site"]))


@query("SELECT s_nationkey AS site, l_orderkey, l_linenumber FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey NOT IN (3, 17)")
def leave_two_out_antijoin(spark, d):
    return model.leave_out(training(spark, d), "site", [3, 17]).select("site", "l_orderkey", "l_linenumber")


@query("""WITH t AS (SELECT s_nationkey AS site, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY s_nationkey ORDER BY l_orderkey, l_linenumber) - 1 AS row_index, count(*) OVER (PARTITION BY s_nationkey) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
SELECT site, l_orderkey, l_linenumber, row_index, CAST(CASE WHEN n // 6 > 0 AND row_index >= n - 5 * (n // 6) THEN (row_index - (n - 5 * (n // 6))) // (n // 6) END AS INTEGER) AS block FROM t""")
def blocked_cv_split(spark, d):
    return model.cv_blocks(training(spark, d), "site", ["l_orderkey", "l_linenumber"]).select("site", "l_orderkey", "l_linenumber", "row_index", "block")


@query("SELECT name, round(avg(abs(v)), 4) AS mean FROM (SELECT l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_extendedprice AS price, CAST(l_linenumber AS DOUBLE) AS line, CAST(l_suppkey AS DOUBLE) AS supp FROM lineitem) UNPIVOT (v FOR name IN (quantity, discount, tax, price, line, supp)) GROUP BY name ORDER BY mean DESC LIMIT 5")
def top5_importance(spark, d):
    l = table(spark, d, "lineitem")  # noqa: E741
    cols = {"quantity": "l_quantity", "discount": "l_discount", "tax": "l_tax", "price": "l_extendedprice", "line": "l_linenumber", "supp": "l_suppkey"}
    means = l.agg(*(r(F.avg(F.abs(c))).alias(k) for k, c in cols.items()))  # one row
    return means.unpivot([], list(cols), "name", "mean").orderBy(F.desc("mean")).limit(5)


@query("SELECT s_nationkey AS site, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1")
def site_list(spark, d):
    return training(spark, d).groupBy("site").agg(F.count("*").alias("n"))


def _predict(spark, d, kind, **params):
    rows = training(spark, d)
    models = model.fit_ensemble(rows, "site", FEATURES, "label", kinds=(kind,), params={kind: params})
    return model.predict_median(rows, models, FEATURES, ["quantity"], ["site", "l_orderkey", "l_linenumber"])


@query()
def rf_ensemble_predict(spark, d):
    return _predict(spark, d, "forest", numTrees=10, maxDepth=5)


@query()
def gbt_ensemble_predict(spark, d):
    return _predict(spark, d, "boosted", maxIter=8, maxDepth=4)


@query()
def feature_importance(spark, d):
    """Mean absolute Shapley values of the boosted models, over all rows."""
    rows = training(spark, d)
    models = model.fit_ensemble(rows, "site", FEATURES, "label", kinds=("boosted",), params={"boosted": {"maxIter": 8, "maxDepth": 4}})
    return model.shap_importance(models, rows, FEATURES)


@query("""WITH p AS (SELECT l_extendedprice AS x, p_retailprice * l_quantity * 0.9 + 100 AS y FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <> 3 AND p_size <> 7 ORDER BY md5(l_orderkey || ':' || l_linenumber), x, y LIMIT 4000),
m AS (SELECT count(*) AS n, var_samp(x) AS xx, var_samp(y) AS yy, covar_samp(x, y) AS xy FROM p),
k AS (SELECT n, xx, yy, xy, pow(n, -1.0 / 3) AS f, (xx * yy - xy * xy) * pow(n, -2.0 / 3) AS det FROM m)
SELECT a.x, a.y, round(1e9 * sum(exp(-0.5 * (pow(b.x - a.x, 2) * yy - 2 * (b.x - a.x) * (b.y - a.y) * xy + pow(b.y - a.y, 2) * xx) * f / det)) / any_value(n * 2 * pi() * sqrt(det)), 4) AS density FROM (SELECT *, row_number() OVER () AS i FROM p) a, p b, k GROUP BY a.i, a.x, a.y""")
def kde_density(spark, d):
    key = F.md5(F.concat_ws(":", "l_orderkey", "l_linenumber").cast("binary"))
    rows = training(spark, d).filter("l_linenumber <> 3 and size <> 7").withColumn("predicted", F.col("retail") * F.col("quantity") * 0.9 + 100)
    return reduce.kde(rows, "label", "predicted", order=key).select("x", "y", r(F.col("density") * 1e9).alias("density"))


@query("""WITH s AS (SELECT c_mktsegment AS site, c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' OR c_acctbal < 0 THEN NULL ELSE c_acctbal END AS VegH_EC, c_acctbal / 2 AS VegH_RS, c_acctbal + 1 AS NEE_SOLO_EC, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal + 2 END AS GPP_SOLO_EC, c_acctbal + 3 AS ER_SOLO_EC, c_acctbal + 4 AS ET_EC, CAST(c_nationkey AS DOUBLE) AS LAI_RS FROM customer WHERE NOT contains(c_mktsegment, 'BUILD')),
f AS (SELECT *, CASE WHEN count(VegH_EC) OVER (PARTITION BY site) = 0 THEN VegH_RS ELSE VegH_EC END AS h FROM s)
SELECT site, CAST(c_custkey AS DOUBLE) AS key, h AS VegH_EC, LAI_RS, GPP_SOLO_EC AS label FROM f WHERE h IS NOT NULL AND VegH_RS IS NOT NULL AND NEE_SOLO_EC IS NOT NULL AND GPP_SOLO_EC IS NOT NULL AND ER_SOLO_EC IS NOT NULL AND ET_EC IS NOT NULL AND LAI_RS IS NOT NULL""")
def training_assembly(spark, d):
    a = F.col("c_acctbal")
    height = F.when((F.col("c_mktsegment") == "MACHINERY") | (a < 0), F.lit(None)).otherwise(a)
    c = table(spark, d, "customer").select(F.col("c_mktsegment").alias("site"), F.col("c_custkey").cast("double").alias("key"), height.alias("VegH_EC"), (a / 2).alias("VegH_RS"), (a + 1).alias("NEE_SOLO_EC"), F.when(F.col("c_custkey") % 9 != 0, a + 2).alias("GPP_SOLO_EC"), (a + 3).alias("ER_SOLO_EC"), (a + 4).alias("ET_EC"), F.col("c_nationkey").cast("double").alias("LAI_RS"))
    return model.training_table(c, ["key", "VegH_EC", "VegH_RS", "LAI_RS"], "GPP", ["BUILD"])


@query("SELECT c_custkey, c_name AS site, CASE WHEN contains(c_name, '77') THEN -23.5232::DOUBLE ELSE -10.0 END AS lat, CASE WHEN contains(c_name, '77') THEN 144.3104::DOUBLE ELSE 120.0 END AS lon, o_orderdate AS t FROM customer JOIN orders ON o_custkey = c_custkey WHERE NOT contains(c_name, '13') OR year(o_orderdate) BETWEEN 1996 AND 1998")
def site_patches(spark, d):
    o = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select("c_custkey", F.col("c_name").alias("site"), F.lit(-10.0).alias("lat"), F.lit(120.0).alias("lon"), F.col("o_orderdate").alias("t"))
    return model.patched(o, "site", {"77": model.PLACES["Longr"]}, {"13": (1996, 1998)})
