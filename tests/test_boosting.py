"""Boosted trees learnt together against Spark's learner, and their tables against Spark's models."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from gridloom.operators import boosting, model

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    rows = [(f"s{i % 6}", i, rng.randrange(12) / 4, float(rng.randrange(20)), float(rng.randrange(5)), rng.random()) for i in range(1500)]
    rows = [(s, i, a, b, c, 3 * a + (b > 9) * (c + 2) + (b % 3) * a + e) for s, i, a, b, c, e in rows]
    return spark.createDataFrame(rows, "site string, i int, a double, b double, c double, y double").repartition(3).cache()


def test_together_as_alone(spark, table):
    """Few values, so that Spark's sample of thresholds has all of them: trees must be those that Spark grows for each member alone."""
    params = {"maxIter": 4, "maxDepth": 3, "minInstancesPerNode": 5}
    models = model.fit_ensemble(table, "site", FEATURES, "y", members=3, kinds=("boosted",), params={"boosted": params})
    for m, got in enumerate(models):
        part = model.leave_out(table, "site", model.left_out_sites([f"s{i}" for i in range(6)], m))
        alone = model.pipeline(FEATURES, "y", "boosted", m, **params).fit(part)
        a, b = ({r.i: r.v for r in model.predict(table, x, FEATURES, "v", keys=("i",)).collect()} for x in (got, alone))
        assert max(abs(a[i] - b[i]) for i in b) < 1e-9
        plain = PipelineModel(got.stages)  # without the paths that came with it
        for x, y in zip(model._trees(plain), got.paths, strict=True):
            assert all(np.allclose(a[2], b[2]) for a, b in zip(x, y, strict=True)) and np.allclose([leaf[:2] for leaf in x], [leaf[:2] for leaf in y])
        assert np.allclose(got.stages[-1].featureImportances.toArray(), alone.stages[-1].featureImportances.toArray())


def test_tables_as_models(spark, table, monkeypatch):
    models = model.fit_ensemble(table, "site", FEATURES, "y", members=3, kinds=("boosted",), params={"boosted": {"maxIter": 3, "maxDepth": 5}})
    cube = table.withColumns({"a": F.when(F.col("i") % 5 > 0, F.col("a") * 1.1), "b": F.when(F.col("i") % 7 == 0, float("nan")).otherwise(F.col("b"))})
    args = (cube, models, FEATURES, ["a"], ["i"])
    fast, median = ({r.i: r[1] for r in f(*args).collect()} for f in (model.predict_ensemble, model.predict_median))
    assert model.predict_ensemble(*args).schema["members"].dataType.simpleString() == "array<float>"
    monkeypatch.setattr(model, "_for_tables", lambda models: None)
    slow, other = ({r.i: r[1] for r in f(*args).collect()} for f in (model.predict_ensemble, model.predict_median))
    assert fast.keys() == slow.keys() and len(fast) == 1500
    for i in slow:
        assert (median[i] is None) == (other[i] is None) == (i % 5 == 0)
        assert fast[i] == [None] * 3 if i % 5 == 0 else np.allclose(fast[i], slow[i], rtol=1e-6) and abs(median[i] - other[i]) < 1e-5


def test_missing_values_are_errors(spark, table):
    for bad in (table.withColumn("b", F.when(F.col("i") > 3, F.col("b"))), table.withColumn("y", F.when(F.col("i") > 3, F.col("y")))):
        with pytest.raises(Exception, match="missing or infinite"):
            model.fit_ensemble(bad, "site", FEATURES, "y", members=2, kinds=("boosted",))
    with pytest.raises(ValueError):
        model.fit_ensemble(table.filter("false"), "site", FEATURES, "y", members=2, kinds=("boosted",))


def test_cut_points():
    assert boosting.cut_points(np.array([1.0, 2, 4]), np.array([5, 1, 1]), 32).tolist() == [1.5, 3.0]
    cuts = boosting.cut_points(np.arange(1000.0), np.ones(1000), 32)
    assert len(cuts) == 31 and max(abs(np.diff(cuts) - 1000 / 32)) <= 1
    v, n = boosting._added(np.arange(100_000.0), np.ones(100_000))  # many values: few points, all rows counted
    assert len(v) <= boosting.POINTS and n.sum() == 100_000


def test_shapley_values_by_tables(spark, table):
    """Copies of rows are explained once and counted; tables hold what each row would give."""
    models = model.fit_ensemble(table, "site", FEATURES, "y", members=2, kinds=("boosted",), params={"boosted": {"maxIter": 3, "maxDepth": 4}})
    every = [m.paths for m in models]
    cuts = boosting.path_cuts(every, 3)
    x = np.array([[r.a, r.b, r.c] for r in table.collect()])
    x[:5] = [[cuts[0][0], cuts[1][0], 0.5], [np.nan, 3, 0.1], [np.inf, -3.0, 0.2], [9, 9, cuts[2][-1]], [0, 0, 0]]
    bins = [len(c) + 1 for c in cuts]
    codes = boosting.group_codes([boosting.binned(x[:, f], c) for f, c in enumerate(cuts)], bins)
    for tree in every[0]:
        at, values = model.shap_table(tree, cuts)
        got, want = values[sum(t[c] for t, c in zip(at, codes, strict=True))], model.shap_values(x, tree, 3)
        assert np.allclose(np.delete(got, 1, 0), np.delete(want, 1, 0), atol=1e-12)
    once, often = ({r.feature: r.importance for r in model.shap_importance(models, t, FEATURES).collect()} for t in (table, table.crossJoin(spark.range(30))))
    plain = np.array([[r.a, r.b, r.c] for r in table.collect()])
    want = np.mean([np.abs(model.shap_values(plain, model._paths(m), 3)).mean(0) for m in models], axis=0)
    assert all(abs(once[f] - w) < 1e-9 and abs(often[f] - w) < 1e-9 for f, w in zip(FEATURES, want, strict=True))
