"""Reductions over members, time, space and regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def member_quantile(members: Column, p: float, least: int = 3) -> Column:
    """Nearest rank, half to even, of the non-null members of an array; NULL with fewer than ``least``."""
    a = F.sort_array(F.filter(members, lambda x: x.isNotNull() & ~F.isnan(x)))
    n = F.size(a)
    return F.when(n >= least, F.get(a, F.rint(F.lit(p) * (n - 1)).cast("int")))


def member_count(members: Column) -> Column:
    return F.size(F.filter(members, lambda x: x.isNotNull() & ~F.isnan(x)))


def combine_members(df: DataFrame, members: str, name: str) -> DataFrame:
    """25th percentile, median and 75th percentile columns; no shuffle."""
    ps = {f"{name}_25th_percentile": 0.25, f"{name}_median": 0.5, f"{name}_75th_percentile": 0.75}
    return df.withColumns({k: member_quantile(F.col(members), p) for k, p in ps.items()}).drop(members)


def arg_extreme(df: DataFrame, value: str, coord: str, kind: str = "max") -> DataFrame:
    """The first coordinate with the extreme value of each cell; cells without a value stay, with NULL."""
    v, c = F.col(value), F.col(coord)
    best = F.max_by(c, F.struct(v, -c)) if kind == "max" else F.min_by(c, F.struct(v, c))
    found = df.filter(v.isNotNull()).groupBy("cell").agg(best.alias(f"arg{kind}"))
    return df.select("cell").distinct().join(found, "cell", "left")


def trend(df: DataFrame, y: str, x: str, by: str = "cell") -> DataFrame:
    return df.groupBy(by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def skill(df: DataFrame, observed: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """n, slope and intercept of predicted on observed, r2, mae and rmse over the rows that have both."""
    o, p = F.col(observed), F.col(predicted)
    both = df.filter(o.isNotNull() & p.isNotNull())
    return both.groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        F.regr_slope(p, o).alias("slope"),
        F.regr_intercept(p, o).alias("intercept"),
        F.regr_r2(p, o).alias("r2"),
        F.avg(F.abs(o - p)).alias("mae"),
        F.sqrt(F.avg(F.pow(o - p, 2))).alias("rmse"),
    )


def masked_sum(v: Column) -> Column:
    """NULL without any value (a plain SQL sum)."""
    return F.sum(v)


def zero_sum(v: Column) -> Column:
    """0 without any value."""
    return F.coalesce(F.sum(v), F.lit(0.0))


def variation(v: Column) -> Column:
    return F.try_divide(F.stddev_pop(v), F.avg(v))


def row_mean(*columns: str) -> Column:
    """Mean across columns, NULLs left out."""
    a = F.filter(F.array(*columns), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.size(a))


def box_summary(v: Column) -> list[Column]:
    q = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return [F.avg(v).alias("mean"), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")]


def kde(df: DataFrame, x: str, y: str, points: int = 4000, order: Column | None = None) -> DataFrame:
    """Gaussian density (Scott's bandwidth) of a deterministic sample of at most ``points`` rows, the first by ``order`` (default: a hash of the values), at these rows.

    NULL without any spread (fewer than two rows, or all on a line)."""
    s = df.select(F.col(x).alias("x"), F.col(y).alias("y"), (F.xxhash64(x, y) if order is None else order).alias("h")).orderBy("h", "x", "y").limit(points)
    m = s.select(F.count("*").alias("n"), F.var_samp("x").alias("xx"), F.var_samp("y").alias("yy"), F.covar_samp("x", "y").alias("xy")).first()
    if not m.n or m.xx is None or m.xx * m.yy - m.xy**2 <= 0:
        return s.select("x", "y", F.lit(None).cast("double").alias("density"))
    f = m.n ** (-1 / 3)  # the square of the bandwidth
    det = (m.xx * m.yy - m.xy**2) * f * f
    pts = s.agg(F.collect_list(F.struct("x", "y")).alias("pts"))  # at most ``points`` structs
    quad = lambda p: ((p.x - F.col("x")) ** 2 * m.yy - 2 * (p.x - F.col("x")) * (p.y - F.col("y")) * m.xy + (p.y - F.col("y")) ** 2 * m.xx) * f / det
    total = F.aggregate("pts", F.lit(0.0), lambda a, p: a + F.exp(-0.5 * quad(p)))
    dealt = s.repartition(df.sparkSession.sparkContext.defaultParallelism)  # points squared terms, else in one task
    return dealt.join(F.broadcast(pts)).select("x", "y", (total / (m.n * 2 * 3.141592653589793 * det**0.5)).alias("density"))
