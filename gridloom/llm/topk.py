"""Exact top-k search by tiled matrix products.

Queries and candidates are dealt into tiles by a hash of their ids. A task multiplies one query tile by one shard,
keeps the k best of each query by partial selection, and the lists of each query are then merged in a tree of fixed fan-in, so
that no task gathers the lists of all shards. Memory of a task is bounded by ``query_rows`` and ``shard_rows``; the number
of tiles grows with the tables. Scores are integers, computed exactly: in float64 products where a bound on the sums
proves that every partial sum is below 2^53, else in int64.

Defined cases: a vector that is null or holds a null, NaN or infinite component takes no part, as query or candidate, and
neither does a row with a null id. A shorter vector counts as padded with zeros. Ties go to the smaller id; rows repeated
with the same id count once (the lexicographically smallest vector). A query with fewer candidates than k gets all of them,
one with none gets no row. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OUT = "query_id long, vec_id long, score long, lane long"


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    d = F.col(vector_col)
    valid = d.isNotNull() & F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = df.filter(F.col(id_col).isNotNull() & valid)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(d, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out, at = np.zeros((len(sizes), width), np.int64), 0
    for i, n in enumerate(sizes):
        out[i, :n] = flat[at : at + n]
        at += n
    return out


def _tile(k: int):
    def best(key, queries: pa.Table, shard: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "lane": pa.array([], pa.int64())})
        if not queries.num_rows or not shard.num_rows:
            return empty
        width = max(int(np.diff(np.asarray(c.combine_chunks().offsets)).max(initial=0)) for c in (queries["q"], shard["v"]))
        q, s = _matrix(queries["q"], width), _matrix(shard["v"], width)
        qid, sid = np.asarray(queries["query_id"]), np.asarray(shard["vec_id"])
        order = np.argsort(sid, kind="stable")  # a smaller column is a smaller id
        s, sid = s[order], sid[order]
        bound = float(np.abs(q).max(initial=0)) * float(np.abs(s).max(initial=0)) * max(width, 1)
        st = s.T.astype(np.float64) if bound < 2**53 else s.T
        rows, cols, vals = [], [], []
        for a in range(0, len(q), 256):  # 256 x shard scores at a time
            block = q[a : a + 256]
            score = (block.astype(np.float64) @ st).astype(np.int64) if bound < 2**53 else block @ st
            ids = qid[a : a + 256]
            at = np.minimum(np.searchsorted(sid, ids), len(sid) - 1)
            own = sid[at] == ids
            low = np.iinfo(np.int64).min
            score[np.flatnonzero(own), at[own]] = low
            n = min(k, score.shape[1])
            kth = np.partition(score, -n, axis=1)[:, -n] if n < score.shape[1] else score.min(axis=1)  # -low would overflow
            for i in range(len(ids)):
                found = np.flatnonzero(score[i] >= kth[i])  # ties at the k-th score come along, in order of their ids
                found = found[score[i, found] > low]
                found = found[np.lexsort((found, -score[i, found]))][:k]
                rows.append(np.full(len(found), ids[i]))
                cols.append(sid[found])
                vals.append(score[i, found])
        if not rows:
            return empty
        out = np.concatenate(rows)
        return pa.table({"query_id": out, "vec_id": np.concatenate(cols), "score": np.concatenate(vals), "lane": np.full(len(out), key[1].as_py())})

    return best


def top_k(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, query_rows: int = 4096, shard_rows: int = 8192, fan_in: int = 32) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each row for which the column ``is_query`` holds."""
    kept = quantised(df, id_col, vector_col, scale)
    counts = df.select(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.count(F.col(id_col)).alias("ids"), F.count_distinct(F.col(id_col)).alias("d")).first()
    if counts.ids != counts.d:  # only then a shuffle by id
        kept = kept.groupBy("vec_id").agg(F.min("v").alias("v"))
    shards = max(-(-counts.n // shard_rows), min(48, -(-counts.n // 256)), 1)
    tiles = max(-(-counts.q // query_rows), 1)
    queries = quantised(df.filter(is_query), id_col, vector_col, scale)
    if counts.ids != counts.d:
        queries = kept.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    left = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), deal("vec_id", tiles).alias("q_tile"))
    left = left.withColumn("q_lane", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))
    right = kept.withColumn("lane", deal("vec_id", shards)).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)).cast("array<long>")))
    lists = left.groupBy("q_tile", "q_lane").cogroup(right.groupBy("tile", "lane")).applyInArrow(_tile(k), OUT)
    order = [F.col("score").desc(), F.col("vec_id")]
    while True:  # each level merges the lists of fan_in lanes
        shards = -(-shards // fan_in)
        lists = lists.withColumn("lane", F.pmod(F.col("lane"), F.lit(shards)))
        ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "lane").orderBy(*order)))
        lists = ranked.filter(F.col("rank") <= k)
        if shards == 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")

