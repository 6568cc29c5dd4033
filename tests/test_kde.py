"""The registered density against brute force."""

from collections import Counter

import numpy as np
import pytest

from gridloom.operators import reduce
from gridloom.plans import modelling

SF = "/root/testdata/sf0.001"


def brute(xy):
    cov = np.cov(xy.T) * len(xy) ** (-1 / 3)
    diff = xy[:, None, :] - xy[None, :, :]
    quad = np.einsum("abi,ij,abj->ab", diff, np.linalg.inv(cov), diff)
    return np.exp(-0.5 * quad).mean(axis=1) / (2 * np.pi * np.linalg.det(cov) ** 0.5)


def test_default_sample(spark):
    rows = modelling.pairs(spark, SF).na.drop("any")
    got = reduce.kde(rows, "o", "p").collect()
    every = Counter((r.o, r.p) for r in rows.collect())
    assert len(got) == 4000 < sum(every.values())
    assert not Counter((r.x, r.y) for r in got) - every
    xy = np.array([(r.x, r.y) for r in got])
    assert np.allclose([r.density for r in got], brute(xy), rtol=1e-8)


def test_no_spread(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "o double, p double")
    for few in (df, df.limit(1), df.limit(0)):
        assert all(r.density is None for r in reduce.kde(few, "o", "p").collect())


@pytest.mark.parametrize("n", [3, 40])
def test_kde_of_few_rows(spark, n):
    xy = np.random.default_rng(n).normal(size=(n, 2))
    got = reduce.kde(spark.createDataFrame(xy.tolist(), "o double, p double"), "o", "p").collect()
    xy = np.array([(r.x, r.y) for r in got])
    assert len(got) == n and np.allclose([r.density for r in got], brute(xy), rtol=1e-8)
