"""A query's own row must not take the place of its k-th neighbour."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import topk


@pytest.mark.parametrize("n", [5, 6, 7, 40, 250])
def test_one_shard_gives_k(spark, n):
    rng = np.random.default_rng(n)
    v = rng.integers(-900, 900, (n, 8))
    df = spark.createDataFrame([(i, [float(x) / 256 for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, k=5).collect()))
    score = v @ v.T
    want = [(q, k + 1, i, int(score[q, i])) for q in range(0, n, 50) for k, i in enumerate(sorted((i for i in range(n) if i != q), key=lambda i: (-score[q, i], i))[:5])]
    assert got == want
