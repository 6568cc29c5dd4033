"""The registered queries: each name has a function (spark, sf_dir) and, where SQL can express it, DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def rounded(c, n: int = 4):
    """For comparison with another engine, whose sums may differ in the last bits."""
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


for _m in ("cube", "spatial", "modelling", "products"):
    import_module(f"gridloom.plans.{_m}")
