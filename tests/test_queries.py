"""Every query against its SQL on a second engine, and invariants of the operators."""

import importlib
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gridloom.operators import align, grid, mask, model, reduce, temporal
from gridloom.plans.registry import ORACLE_SQL, QUERIES
from gridloom.sources import io
from gridloom.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    got, want = (sorted((tuple(r) for r in rows), key=str) for rows in (df.select(*cols).collect(), rel.select(*cols).fetchall()))
    assert got == want


def test_entry_imports():
    entry = importlib.import_module("__spark_entry__")
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_quantile_is_nearest_rank(spark):
    rng = random.Random(0)
    rows = [(i, [rng.choice([None, float("nan"), rng.random()]) if rng.random() < 0.3 else rng.random() for _ in range(n)]) for i, n in enumerate(list(range(0, 33)) * 2)]
    df = spark.createDataFrame(rows, "i int, m array<double>")
    for p in (0.05, 0.25, 0.5, 0.75, 0.95):
        got = {r.i: r.q for r in df.select("i", reduce.member_quantile(F.col("m"), p).alias("q")).collect()}
        for i, m in rows:
            a = sorted(x for x in m if x is not None and not math.isnan(x))
            assert got[i] == (a[round(p * (len(a) - 1))] if len(a) >= 3 else None)


def test_interpolation_limit(spark):
    v = [None, 1.0, None, None, None, 5.0, None, 7.0, None]
    rows = [(1, f"2001-{i + 1:02d}-15", x) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "cell int, d string, v double").withColumn("t", F.to_timestamp_ntz("d"))
    got = [r.x for r in df.select("t", temporal.interpolate(F.col("v")).alias("x")).orderBy("t").collect()]
    assert got[0] is None and got[8] is None and got[4] is None
    assert 1 < got[2] < got[3] < 5 and 5 < got[6] < 7


def test_resampling_metamorphic(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(r, c, rng.random()) for r in range(12) for c in range(12)], "row int, col int, v double")
    once = grid.resample(df, (12, 12), (2, 2), "average")
    twice = grid.resample(grid.resample(df, (12, 12), (6, 6), "average"), (6, 6), (2, 2), "average")
    a, b = ({(r.row, r.col): r.v for r in x.collect()} for x in (once, twice))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)
    assert grid.same_cells(df, df) and not grid.same_cells(df, df.filter("row > 0"))
    flat = grid.resample(df.withColumn("v", F.lit(3.0)), (12, 12), (5, 7), "bilinear").select(F.min("v"), F.max("v")).first()
    assert abs(flat[0] - 3) < 1e-12 and abs(flat[1] - 3) < 1e-12
    with pytest.raises(ValueError):
        grid.GridSpec(1, 1, 0, 0, 1, 1, None).checked()


def test_vegetation_fractions_add_up(spark):
    rows = QUERIES["annual_to_monthly_expand"](spark, SF).collect()
    assert all(abs(r.trees + r.grass + r.bare - 1) < 1e-3 for r in rows)


def test_blocks_are_disjoint(spark):
    df = spark.createDataFrame([(s, i) for s in range(3) for i in range(10 + 7 * s)], "site int, i int")
    rows = model.cv_blocks(df, "site", ["i"]).collect()
    for s in range(3):
        n = 10 + 7 * s
        sizes = [sum(r.site == s and r.block == b for r in rows) for b in range(5)]
        assert sizes == [n // 6] * 5
    assert model.left_out_sites(list("abcd"), 1) == model.left_out_sites(list("dcba"), 1)


def test_nested_cv_and_prediction(spark):
    rng = random.Random(2)
    rows = [(f"s{i % 4}", i, x := rng.random(), rng.random(), 3 * x) for i in range(240)]
    df = spark.createDataFrame(rows, "site string, i int, a_RS double, b_EC double, y double")
    blocked = model.cv_blocks(df, "site", ["i"])
    pred = model.nested_predictions(blocked, ["a_RS", "b_EC"], "y", "forest", numTrees=10)
    assert pred.count() == 200
    assert reduce.skill(pred, "Test", "Pred").first().r2 > 0.8
    models = model.fit_ensemble(df, "site", ["a_RS", "b_EC"], "y", members=2, params={"forest": {"numTrees": 5}, "boosted": {"maxIter": 5}})
    cube = df.withColumn("a_RS", F.when(F.col("i") % 5 > 0, F.col("a_RS")))
    out = model.ensemble_median(model.predict_ensemble(cube, models, ["a_RS", "b_EC"], ["a_RS"], ["i"])).collect()
    assert all((r.median is None) == (r.i % 5 == 0) and len(r.members) == 4 for r in out)
    assert model.importance(models, ["a_RS", "b_EC"], spark).first().feature == "a"
    with pytest.raises(ValueError):
        model.predict_ensemble(cube, models, ["nope"], [], ["i"])
    best = model.search(df, ["a_RS", "b_EC"], "y", "forest", {"maxDepth": [2, 3], "numTrees": [3]}, n_iter=2, folds=2)
    assert best.bestModel.transform(df).count() == 240


def test_registered_ensembles_learn_from_all_rows(spark, monkeypatch):
    fit, seen = model.fit_ensemble, []

    def watched(df, *args, **kw):
        seen.append((df.count(), kw.get("members", 15)))
        return fit(df, *args, **(kw | {"members": 3}))  # three suffice for a median

    monkeypatch.setattr(model, "fit_ensemble", watched)
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    for name in ("rf_ensemble_predict", "gbt_ensemble_predict"):
        out = QUERIES[name](spark, SF).agg(F.count("*"), F.count("median")).first()
        assert tuple(out) == (n, n)
    assert QUERIES["feature_importance"](spark, SF).count() == 5
    assert seen == [(n, 15)] * 3


def test_merge_takes_the_first(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None)], "cell int, v double")
    b = spark.createDataFrame([(2, 5.0, 7.0), (3, 6.0, 8.0)], "cell int, v double, w double")
    got = sorted(map(tuple, align.merge_override([a, b], ["cell"]).select("cell", "v", "w").collect()))
    assert got == [(1, 1.0, None), (2, 5.0, 7.0), (3, 6.0, 8.0)]


def test_static_mask_keeps_unknown(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "cell int, v double")
    layer = spark.createDataFrame([(1, 1), (2, None)], "cell int, urban int")
    assert {r.cell: r.v for r in mask.static_mask(df, layer, "urban", ["v"]).collect()} == {1: None, 2: 2.0, 3: 3.0}


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "2003-01-15", 1.5), (1, "2003-02-15", None), (2, "2003-01-15", float("nan"))], "cell int, d string, v double").withColumn("t", F.to_timestamp_ntz("d")).drop("d")
    clean = io.nan_to_null(df)
    assert clean.filter("v is null").count() == 2
    io.write_cube(clean.withColumn("year", F.year("t")), f"{tmp_path}/cube", ["year"])
    cube = io.read_cube(spark, f"{tmp_path}/cube", ["v"])
    assert cube.count() == 3 and dict(cube.dtypes)["v"] == "float"
    with pytest.raises(ValueError):
        io.read_cube(spark, f"{tmp_path}/cube", ["w"])
    assert io.append_table(clean, f"{tmp_path}/app", ["cell", "t"]) == 3 and io.append_table(clean, f"{tmp_path}/app", ["cell", "t"]) == 0
    io.write_site_csv(clean.withColumnRenamed("cell", "site"), f"{tmp_path}/csv")
    assert io.read_projection_csv(spark, f"{tmp_path}/csv", ["v"]).count() == 3
    (tmp_path / "AliceSprings.csv").write_text("time,GPP_EC\n2003-01-15 00:00:00,1.0\n")
    r = io.read_series_csv(spark, f"{tmp_path}/AliceSprings.csv", "time string, GPP_EC double").first()
    assert r.site == "AliceSprings" and r.time.year == 2003
    (tmp_path / "soi.txt").write_text("200301,0.5\n200302,-1\n")
    assert [x.t.month for x in io.read_index_csv(spark, f"{tmp_path}/soi.txt").orderBy("t").collect()] == [1, 2]
    (tmp_path / "variables.txt").write_text("LAI_RS,Tair_EC,site,")
    assert io.read_header(spark, f"{tmp_path}/variables.txt") == ["LAI", "Tair"]
    io.publish(clean.withColumn("m", F.col("v")), f"{tmp_path}/pub", "m", ["m"])
    assert spark.read.parquet(f"{tmp_path}/pub/AnnualSum").count() == 2
    assert io.with_attributes(clean, "v", {"units": "gC"}).schema["v"].metadata == {"units": "gC"}


def test_incremental_run_is_idempotent(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    e = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts", "value")
    e.filter("user_id % 2 = 0").write.parquet(f"{src}/a")
    for _ in range(2):
        incremental.update_monthly(spark, f"{src}/*", "user_id long, ts timestamp_ntz, value double", out, f"{tmp_path}/cp", "user_id", "ts", "value")
    e.filter("user_id % 2 = 1").write.parquet(f"{src}/b")
    incremental.update_monthly(spark, f"{src}/*", "user_id long, ts timestamp_ntz, value double", out, f"{tmp_path}/cp", "user_id", "ts", "value")
    got = {(r.cell, r.t): r.v for r in incremental.monthly_means(spark, out).collect()}
    want = {(r.cell, r.t): r.v for r in temporal.resample_month(e, "user_id", "ts", {"v": F.avg("value")}).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
