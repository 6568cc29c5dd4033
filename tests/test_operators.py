"""Operators beside the registered queries: sources and sinks, models, explanations, edge cases."""

import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from gridloom.functions import scalar
from gridloom.operators import align, grid, mask, model, reduce, temporal
from gridloom.sources import io
from gridloom.streaming import incremental

SF = "/root/testdata/sf0.001"


def at(df, column="t"):
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


# time


def test_month_spine_fills_every_month(spark):
    df = at(spark.createDataFrame([(1, "2001-03-15", 1.0), (1, "2001-06-15", 2.0), (2, "2001-05-15", None), (3, "2001-04-15", 4.0), (3, "2001-04-15", 5.0)], "cell int, t string, v double"))
    rows = [(r.cell, r.t.month, r.v) for r in temporal.month_spine(df).collect()]
    want = [(1, 3, 1.0), (1, 4, None), (1, 5, None), (1, 6, 2.0), *((2, m, None) for m in range(3, 7)), (3, 3, None), (3, 4, 4.0), (3, 4, 5.0), (3, 5, None), (3, 6, None)]
    assert sorted(rows, key=str) == sorted(want, key=str)
    zero = temporal.month_spine(df, ("v",), bounds=("2001-02-15 00:00:00", "2001-07-15 00:00:00"))
    assert zero.filter("v is null").count() == 0 and zero.filter("cell = 1").count() == 6
    assert temporal.month_spine(df.limit(0)).count() == 0


def test_month_spine_needs_no_join(spark):
    df = at(spark.createDataFrame([(1, "2001-03-15", 1.0)], "cell int, t string, v double"))
    plan = temporal.month_spine(df, bounds=("2001-03-15", "2001-08-15"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") <= 1


def test_year_spine(spark):
    df = at(spark.createDataFrame([("a", "2001-02-01", 1.0), ("a", "2001-08-01", 3.0), ("a", "2004-01-01", 5.0), ("b", "2003-01-01", None)], "site string, t string, v double"))
    rows = sorted((r.site, r.t.year, r.v) for r in temporal.year_spine(df, "site", {"v": F.avg("v")}).collect() if r.site == "a")
    assert rows == [("a", 2001, 2.0), ("a", 2002, None), ("a", 2003, None), ("a", 2004, 5.0)]
    assert temporal.year_spine(df.limit(0), "site", {"v": F.avg("v")}).count() == 0


def test_slices_and_steps(spark):
    df = at(spark.createDataFrame([(i, f"200{y}-{m:02d}-15") for i, (y, m) in enumerate(itertools.product(range(1, 4), range(1, 13)))], "i int, t string"))
    n = lambda a, b: temporal.time_slice(df, a, b).count()
    assert (n("2001", "2002"), n("2002", "2002"), n("2001-11", "2002-02"), n("2001-11-16", "2002-02-14")) == (24, 12, 4, 2)
    assert [temporal.at_step(df, i).first().i for i in (0, 5, -1, -36)] == [0, 5, 35, 0]
    assert temporal.at_step(df, 36).count() == 0 == temporal.at_step(df, -37).count()


# joins


def test_nearest_index_at_the_edges(spark):
    df = spark.createDataFrame([(-9.0,), (-10.2,), (-10.3,), (-14.6,), (-90.0,), (None,)], "lat double")
    got = lambda **k: [r[0] for r in df.select(align.nearest_index(F.col("lat"), -10.0, -0.5, 10, **k)).collect()]
    assert got() == [0, 0, 1, 9, 9, None]
    assert got(outside="null") == [None, 0, 1, 9, None, None]


@pytest.mark.parametrize("skip", [False, True])
@pytest.mark.parametrize("stretch", [1, 3, 32])
def test_asof_against_brute_force(spark, skip, stretch):
    rng = random.Random(stretch)
    stamp = lambda s: f"2001-01-01 00:00:00.{0:06d}" if s == 0 else None
    left = [(i, rng.randrange(3), rng.randrange(0, 40 * 86400)) for i in range(150)]
    right = [(rng.randrange(3), s, rng.choice([None, float(k)])) for k, s in enumerate(rng.sample(range(0, 40 * 86400), 90))]
    assert stamp(0)
    time = lambda c: (F.lit("2001-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col(c).cast("decimal(18,6)"))).alias("t")
    l = spark.createDataFrame(left, "i int, k int, s long").select("i", "k", time("s"), "s")  # noqa: E741
    r = spark.createDataFrame(right, "k int, s long, v double").select("k", time("s"), "v")
    got = {x.i: x.v for x in align.asof_nearest(l, r, "k", "t", "v", "1 day", skip, stretch).collect()}
    for i, k, s in left:
        near = sorted((abs(u - s), u, v) for j, u, v in right if j == k and not (skip and v is None))
        want = near[0][2] if near and near[0][0] <= 86400 else None
        assert got[i] == want


def test_masks(spark):
    df = spark.createDataFrame([(1, 1.0, 5), (2, None, 24), (3, 30.0, None)], "cell int, v double, flag int")
    rows = df.select(mask.above_class(F.col("v"), 10).alias("a"), mask.is_class(F.col("flag"), 24).alias("b"), mask.any_flag(mask.above_class(F.col("v"), 10), mask.is_class(F.col("flag"), 24)).alias("c"), mask.has_value(F.col("v")).alias("d")).collect()
    assert [tuple(r) for r in rows] == [(0, 0, 0, 1), (0, 1, 1, 0), (1, 0, 1, 1)]
    layer = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0)], "cell int, flag int")
    out = mask.static_mask(df, layer, "flag", ["v"])
    assert out.columns == df.columns and {(r.cell, r.v, r.flag) for r in out.collect()} == {(1, None, 5), (2, None, 24), (3, 30.0, None)}


def test_transposed_and_constants(spark):
    df = spark.createDataFrame([("a", 1, 2.5), ("b", 3, None)], "m string, x int, y double")
    assert {tuple(r) for r in align.transposed(df, "m", ["a", "b"]).collect()} == {("x", 1.0, 3.0), ("y", 2.5, None)}
    one = spark.range(1)
    r = model.with_site_facts(one, "Tumbarumba", "40.5m", -35.6, 148.1).first()
    assert (r.site, r.VegH_EC, r.x_coord, r.y_coord) == ("Tumbarumba", 40.5, 148.1, -35.6)
    assert model.with_site_facts(one, "x", "unknown").first().VegH_EC is None and model.with_site_facts(one, "x").first().VegH_EC is None
    ends = one.select(scalar.from_end(F.lit("abcdef"), 4, 1).alias("a"), scalar.without_end(F.lit("ab"), 5).alias("b"), scalar.looked_up(F.lit("z"), {"y": 1}, 9).alias("c")).first()
    assert tuple(ends) == ("abcdef"[-4:-1], "", 9)


# grids


def test_albers_round_trip(spark):
    pts = [(lat, lon) for lat in (-9.5, -25.0, -36.0, -44.0) for lon in (112.0, 132.0, 154.0)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    x, y = grid.albers(F.col("lat"), F.col("lon"))
    df = df.withColumns({"x": x, "y": y})
    lat, lon = grid.albers_inverse(F.col("x"), F.col("y"))
    for r in df.select("lat", "lon", lat.alias("a"), lon.alias("b")).collect():
        assert abs(r.lat - r.a) < 1e-7 and abs(r.lon - r.b) < 1e-9


def test_reproject_keeps_a_plane(spark):
    cells = spark.range(400).select((F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col"))
    cells = cells.withColumns({"lat": -20.0 - 0.25 * F.col("row"), "lon": 130.0 + 0.25 * F.col("col")})
    src = grid.GridSpec.of(cells)
    assert (src.ny, src.nx, src.y0, src.x0, src.dy, src.dx) == (20, 20, -20.0, 130.0, -0.25, 0.25)
    dst = grid.GridSpec(8, 8, -2_250_000.0, -150_000.0, -50_000.0, 60_000.0, "EPSG:3577")
    got = grid.reproject(cells.withColumn("v", F.col("lat")), src, dst).collect()
    y = spark.createDataFrame([(r.row, r.col, r.v) for r in got], "row int, col int, v double")
    lat, _ = grid.albers_inverse(dst.x0 + F.col("col") * dst.dx, dst.y0 + F.col("row") * dst.dy)
    assert got and all(abs(r.v - r.lat) < 1e-9 for r in y.withColumn("lat", lat).filter("lat between -24.75 and -20").collect())
    near = grid.reproject(cells.withColumn("v", F.lit(1.0)), src, dst, "nearest")
    assert {r.v for r in near.collect()} == {1.0}
    with pytest.raises(ValueError):
        grid.reproject(cells, src, src)
    with pytest.raises(ValueError):
        grid.GridSpec.of(cells.limit(0))


def test_regions_with_holes(spark):
    rng = random.Random(4)
    star = [(5 + (4 if i % 2 else 1.7) * math.cos(i * math.pi / 7), 5 + (4 if i % 2 else 1.7) * math.sin(i * math.pi / 7)) for i in range(14)]
    hole = [(4.5, 4.5), (5.5, 4.5), (5.5, 5.5), (4.5, 5.5), (4.5, 4.5)]
    regions = grid.regions_table(spark, [(2, [star, hole]), (1, [(8.0, 8.0), (12.0, 8.0), (12.0, 12.0)])])
    pts = [(i, rng.uniform(-1, 13), rng.uniform(-1, 13)) for i in range(800)]
    got = {r.i: r.regions for r in grid.regions_at(spark.createDataFrame(pts, "i int, lon double, lat double"), regions).collect()}

    def inside(x, y, rings):
        n = 0
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
                n += (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
        return n % 2 == 1

    for i, x, y in pts:
        assert got[i] == [k for k, rings in ((1, [[(8, 8), (12, 8), (12, 12)]]), (2, [star, hole])) if inside(x, y, rings)]
    assert any(got.values())
    p = spark.createDataFrame([("in", 10.0, 9.0), ("out", 50.0, 50.0), ("CowBay", 60.0, 0.0)], "site string, lon double, lat double")
    assert {(r.site, r.region) for r in grid.points_in_regions(p, regions, fixes={"CowBay": 1}).collect()} == {("in", 1), ("out", None), ("CowBay", 1)}
    assert grid.rasterise(p, regions.limit(0)).filter("region is not null").count() == 0


def test_methods_and_coordinates(spark):
    assert grid.method_for("radiation") == "bilinear" and grid.method_for("radiation", 5.0) == "average" and grid.method_for("x") == "average" and grid.method_for("temperature_k") == "nearest"
    assert spark.range(1).select(grid.round_coords(F.lit(113.12345678), 4)).first()[0] == 113.1235


def test_zonal_mean(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 9.0)], "cell int, v double")
    zones = spark.createDataFrame([(1, 7), (2, 7), (3, None)], "cell int, region int")
    assert [tuple(r) for r in grid.zonal_mean(df, zones).collect()] == [(7, 2.0)]


# sources and sinks


def test_sources(spark, tmp_path):
    (tmp_path / "totals.csv").write_text("Value,Year\n1.5,2001\n2.5,2002\n")
    df = io.read_named_csv(spark, f"{tmp_path}/totals.csv", "Year", {"Value": "national"})
    assert df.columns == ["Year", "national"] and df.count() == 2
    rings = [[[0, 0], [4, 0], [4, 4], [0, 4]], [[1, 1], [2, 1], [2, 2]]]
    features = [{"type": "Feature", "properties": {"name": "a", "n": 1.0}, "geometry": {"type": "Polygon", "coordinates": rings}}, {"type": "Feature", "properties": {"name": "b", "n": None}, "geometry": {"type": "MultiPolygon", "coordinates": [[rings[0]], [[[9, 9], [10, 9], [10, 10]]]]}}]
    (tmp_path / "r.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    got = {r.name: r.rings for r in io.read_regions(spark, f"{tmp_path}/r.json").collect()}
    assert got["a"] == [[[float(v) for v in p] for p in r] for r in rings] and len(got["b"]) == 2 and got["b"][1][2] == [10.0, 10.0]
    spark.range(3).write.parquet(f"{tmp_path}/here.parquet")
    found, skipped = io.read_existing(spark, {"x": f"{tmp_path}/here.parquet", "y": f"{tmp_path}/gone.parquet"}, spark.read.parquet)
    assert list(found) == ["x"] and found["x"].count() == 3 and skipped == ["y"]
    spark.conf.set("gridloom.batch.model_var", "GPP")
    spark.conf.set("gridloom.batch.n_workers", "4")
    assert io.batch_parameters(spark, {"model_var": str, "n_workers": int}) == {"model_var": "GPP", "n_workers": 4}
    with pytest.raises(ValueError, match="gridloom.batch.year_end"):
        io.batch_parameters(spark, {"model_var": str, "year_end": int})
    spark.range(2).coalesce(1).write.parquet(f"{tmp_path}/many/2001")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/many/2002")
    assert io.read_folder(spark, f"{tmp_path}/many").count() == 5


def test_sinks(spark, tmp_path):
    df = at(spark.createDataFrame([(1, "2003-01-15", 1.0, 2.0), (1, "2004-01-15", 3.0, None), (2, "2005-01-15", 5.0, 6.0)], "cell int, t string, GPP_median double, GPP_25th_percentile double"))
    path = io.write_product(df, f"{tmp_path}", "flux", "GPP", "1km", "v1.2", 2003, 2004, {"units": "gC"})
    assert path.endswith("flux_GPP_1km_quantiles_v1.2") and spark.read.parquet(path).count() == 2
    io.write_product(df.filter("year(t) = 2004").withColumn("GPP_median", F.lit(9.0)), f"{tmp_path}", "flux", "GPP", "1km", "v1.2", 2003, 2005)
    assert {(r.year, r.GPP_median) for r in spark.read.parquet(path).collect()} == {(2003, 1.0), (2004, 9.0)}  # the other year stays
    io.write_product(df, f"{tmp_path}", "flux", "GPP", "1km", "v1.3", 2003, 2005)
    assert spark.read.parquet(path).count() == 2 and spark.read.parquet(path.replace("v1.2", "v1.3")).schema["GPP_median"].metadata == {"version": "v1.3"}
    io.write_variables(df, f"{tmp_path}/stacked")
    assert io.read_variable(spark, f"{tmp_path}/stacked", "GPP_median").columns == ["cell", "t", "GPP_median"]
    raw = io.with_attributes(df, "GPP_median", {"_NCProperties": "x", "units": "gC"})
    io.write_raw(raw, f"{tmp_path}/raw")
    assert spark.read.parquet(f"{tmp_path}/raw").schema["GPP_median"].metadata == {"units": "gC"}
    io.write_feature_list(spark, f"{tmp_path}/features", ["LAI_RS", "Ta_EC", "site"])
    assert io.read_header(spark, f"{tmp_path}/features") == ["LAI", "Ta"]
    sites = spark.createDataFrame([("b",), ("a",), ("a",)], "site string")
    io.write_site_list(sites, f"{tmp_path}/sites")
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/sites", header=True).collect()] == [("a", "2"), ("b", "1")]
    pred = spark.createDataFrame([(0, 1.0, 1.5), (0, 1.0, 1.5), (1, 2.0, None)], "split int, Test double, Pred double")
    assert [io.append_predictions(pred, f"{tmp_path}/cv", "GPP", "boosted", m) for m in (0, 0, 1)] == [3, 0, 3]
    twice = df.unionByName(df)
    assert io.append_table(twice, f"{tmp_path}/app", ["cell", "t"]) == 3
    io.write_cube(df.limit(1), f"{tmp_path}/whole")
    io.write_cube(df, f"{tmp_path}/whole")
    assert spark.read.parquet(f"{tmp_path}/whole").count() == 3


def test_daily_counts_of_a_stream(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_type", "value").withColumn("ts", F.col("ts").cast("timestamp"))
    events.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = incremental.daily_counts(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in"))
    q = stream.writeStream.format("memory").queryName("daily").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    q.awaitTermination()
    assert spark.table("daily").agg(F.sum("n")).first()[0] == events.count()


# models


def table(spark, n=240, seed=2):
    rng = random.Random(seed)
    return spark.createDataFrame([(f"s{i % 4}", i, x := rng.random(), z := rng.random(), rng.random(), 3 * x - 2 * x * z) for i in range(n)], "site string, cell int, a_RS double, b_EC double, c_RS double, y double")


FEATURES = ["a_RS", "b_EC", "c_RS"]


def test_models_are_saved_and_masked(spark, tmp_path):
    df = table(spark)
    models = model.fit_ensemble(df, "site", FEATURES, "y", members=1, params={"forest": {"numTrees": 4}, "boosted": {"maxIter": 3}})
    model.save_models(models, f"{tmp_path}/m", ["forest_0", "boosted_0"], FEATURES)
    loaded, features = model.load_models(spark, f"{tmp_path}/m")
    assert list(loaded) == ["forest_0", "boosted_0"] and features == FEATURES
    layer = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(100)], "cell int, urban_water_mask int")
    cube = df.withColumn("b_EC", F.when(F.col("cell") % 5 > 0, F.col("b_EC")))
    args = (FEATURES, ["b_EC"], ["cell"])
    a, b = ({r.cell: r.members for r in model.predict_ensemble(cube, m, *args, layer=layer).collect()} for m in (models, list(loaded.values())))
    assert a == b and len(a) == 240
    assert all((x is None) == (c % 5 == 0 or (c < 100 and c % 7 == 0)) for c, m in a.items() for x in m)
    one = model.predict(cube, models[0], FEATURES, return_input=True, keys=("cell",))
    assert one.columns == ["cell", "Predictions", *FEATURES] and one.filter("Predictions is null").count() == 0


def test_class_probability(spark):
    df = table(spark).withColumn("k", (F.col("a_RS") > 0.5).cast("double"))
    fitted = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), RandomForestClassifier(labelCol="k", numTrees=5, seed=1)]).fit(df)
    rows = model.predict(df, fitted, FEATURES, proba=True, keys=("cell",)).collect()
    assert all(50 <= r.Probabilities <= 100 for r in rows) and len(rows) == 240


def shapley(paths, x, n):
    """By all subsets: an absent feature lets each leaf count by the shares of the training rows."""

    def value(known):
        total = 0.0
        for weight, v, splits in paths:
            p = 1.0
            for f, lo, hi, share in splits:
                p *= float(lo < x[f] <= hi) if f in known else share
            total += weight * v * p
        return total

    phi = [0.0] * n
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for k in range(n):
            for s in itertools.combinations(others, k):
                phi[i] += math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n) * (value({*s, i}) - value(set(s)))
    return phi


def test_shapley_values(spark):
    df = table(spark)
    models = model.fit_ensemble(df, "site", FEATURES, "y", members=2, params={"forest": {"numTrees": 3}, "boosted": {"maxIter": 4, "maxDepth": 3}})
    x = np.array(df.select(*FEATURES).limit(12).collect())
    for m in models:
        paths = model._paths(m)
        got = model.shap_values(x, paths, 3)
        assert np.allclose(got, [shapley(paths, row, 3) for row in x], atol=1e-9)
        mean = sum(w * v * math.prod(s[3] for s in splits) for w, v, splits in paths)
        pred = [r.prediction for r in m.transform(df).select("prediction").limit(12).collect()]
        assert np.allclose(got.sum(1) + mean, pred, atol=1e-6)  # values add up to the prediction
    every = np.array(df.select(*FEATURES).collect())
    boosted = [m for m in models if hasattr(m.stages[-1], "treeWeights") and type(m.stages[-1]).__name__.startswith("GBT")]
    want = np.mean([np.abs(model.shap_values(every, model._paths(m), 3)).mean(0) for m in boosted], axis=0)
    got = {r.feature: r.importance for r in model.shap_importance(models, df, FEATURES).collect()}
    assert np.allclose([got[f] for f in ("a", "b", "c")], want) and max(got, key=got.get) == "a"


def test_training_names(spark):
    assert (model.target_name("ET"), model.target_name("GPP")) == ("ET_EC", "GPP_SOLO_EC")
    df = at(spark.createDataFrame([("Longreach", "2001-01-01", 0.0, 0.0), ("Tumbarumba", "2021-01-01", 1.0, 1.0), ("Tumbarumba", "2019-06-01", 1.0, 1.0), (None, "2021-01-01", 2.0, 2.0)], "site string, t string, lat double, lon double"))
    rows = {(r.site, r.t.year, r.lat, r.lon) for r in model.patched(df).collect()}
    assert rows == {("Longreach", 2001, *model.PLACES["Longr"]), ("Tumbarumba", 2019, 1.0, 1.0), (None, 2021, 2.0, 2.0)}


def test_skill_leaves_pairs_out(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (4.0, None), (3.0, 3.0)], "o double, p double")
    r = reduce.skill(df, "o", "p").first()
    assert r.n == 2 and r.mae == 0.5
