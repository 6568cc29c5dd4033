"""Time-series operators on long cubes: (cell, t, value), t the 15th of the month.

All windows are partitioned by the cell and share one exchange; a climatology adds a sort on (cell, month), not an exchange.
Frames count rows, so a cube with missing months goes through ``month_spine`` first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def month_label(t: Column) -> Column:
    """Month start + 14 days, without time zone."""
    return F.date_trunc("month", t).cast("timestamp_ntz") + F.expr("INTERVAL 14 DAYS")


def resample_month(df: DataFrame, cell: str, t: str, aggs: dict[str, Column]) -> DataFrame:
    return df.groupBy(F.col(cell).alias("cell"), month_label(F.col(t)).alias("t")).agg(*(c.alias(k) for k, c in aggs.items()))


def month_spine(cube: DataFrame, zero: tuple[str, ...] = (), bounds: tuple | None = None) -> DataFrame:
    """A row for every cell and month of the cube's range; missing values are NULL, or 0 for the columns in ``zero`` (sums).

    Each row is followed by the months up to the next one of its cell, so one window does it, without a join. ``bounds`` are the first and last label of
    the range; without them a job over ``cube`` finds them. A (cell, month) with several rows keeps them. An empty cube stays empty.
    """
    lo, hi = (F.lit(None if x is None else str(x)).cast("timestamp_ntz") for x in bounds or cube.select(F.min("t"), F.max("t")).first())
    w, month = Window.partitionBy("cell").orderBy("t"), F.expr("INTERVAL 1 MONTH")
    first = F.when(F.lag("t").over(w).isNull(), F.least(lo, "t")).otherwise(F.col("t"))
    last = F.greatest(F.coalesce(F.lead("t").over(w) - month, hi), F.col("t"))
    d = cube.withColumns({"__a": first, "__b": last}).withColumn("__m", F.explode(F.sequence("__a", "__b", month)))
    value = {c: F.when(F.col("__m") == F.col("t"), F.col(c)) for c in cube.columns if c not in ("cell", "t")}
    return d.select("cell", F.col("__m").alias("t"), *((F.coalesce(v, F.lit(0.0)) if c in zero else v).alias(c) for c, v in value.items()))


def year_spine(df: DataFrame, by: str, aggs: dict[str, Column]) -> DataFrame:
    """Yearly values of each group, labelled 31 December, with a row of NULLs for every year between its first and its last that has none."""
    y = df.groupBy(by, F.year("t").alias("__y")).agg(*(c.alias(k) for k, c in aggs.items()))
    following = F.lead("__y").over(Window.partitionBy(by).orderBy("__y"))
    d = y.withColumn("__last", F.coalesce(following - 1, F.col("__y"))).withColumn("__n", F.explode(F.sequence("__y", "__last")))
    own = F.col("__n") == F.col("__y")
    return d.select(by, F.make_date("__n", F.lit(12), F.lit(31)).cast("timestamp_ntz").alias("t"), *(F.when(own, F.col(k)).alias(k) for k in aggs))


def resample_year(df: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    """By cell and calendar year, labelled 31 December."""
    by = df.groupBy("cell", F.year("t").alias("y")).agg(*(c.alias(k) for k, c in aggs.items()))
    return by.select("cell", F.make_date("y", F.lit(12), F.lit(31)).cast("timestamp_ntz").alias("t"), *aggs)


def _period(label: str) -> tuple[str, str]:
    """First day of a year, month or day, and the interval it lasts."""
    year, month, day = (*map(int, label.split("-")), None, None)[:3]
    return f"{year:04d}-{month or 1:02d}-{day or 1:02d}", "1 DAY" if day else "1 MONTH" if month else "1 YEAR"


def time_slice(df: DataFrame, first: str, last: str, t: str = "t") -> DataFrame:
    """Inclusive at both ends, which are a year, a month or a day ('1996', '1996-03', '1996-03-15'); a range predicate that reaches the scan."""
    (lo, _), (hi, lasts) = _period(first), _period(last)
    return df.filter((F.col(t) >= F.lit(lo).cast("timestamp_ntz")) & (F.col(t) < F.lit(hi).cast("timestamp_ntz") + F.expr(f"INTERVAL {lasts}")))


def at_step(df: DataFrame, i: int, t: str = "t") -> DataFrame:
    """The i-th step of the time axis that all rows share, from 0; from the end if negative. No rows beyond the axis."""
    axis = df.select(F.col(t).alias("__t")).filter("__t is not null").distinct()
    one = axis.orderBy("__t" if i >= 0 else F.desc("__t")).offset(i if i >= 0 else -i - 1).limit(1)
    return df.join(F.broadcast(one), F.col(t) == F.col("__t"), "left_semi")


def over_months(layer: DataFrame, first: str, last: str) -> DataFrame:
    """A static layer repeated at the mid-month labels from the month of ``first`` to that of ``last``; no join."""
    lo, hi = (month_label(F.lit(x).cast("timestamp_ntz")) for x in (first, last))
    return layer.withColumn("t", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))))


def concat_time(frames: list[DataFrame]) -> DataFrame:
    """Cubes of other times, one below the other; a variable that a cube lacks is NULL there. Order is the sink's matter."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def by_month() -> Window:
    return Window.partitionBy("cell", F.month("t"))


def trailing(n: int, ahead: int = 0) -> Window:
    return Window.partitionBy("cell").orderBy("t").rowsBetween(-(n - 1), ahead)


def climatology(v: Column, first: int | None = None, last: int | None = None) -> Column:
    """The cell's mean of the calendar month over the baseline years; later years do not change it."""
    if first is not None:
        v = F.when(F.year("t").between(first, last), v)
    return F.avg(v).over(by_month())


def anomaly(v: Column, **baseline) -> Column:
    return v - climatology(v, **baseline)


def fraction_of_normal(v: Column, **baseline) -> Column:
    return F.try_divide(v, climatology(v, **baseline))


def standardised(v: Column) -> Column:
    """Population standard deviation."""
    return F.try_divide(v - F.avg(v).over(by_month()), F.stddev_pop(v).over(by_month()))


def rolling(kind: str, v: Column, n: int, need: int | None = None, centred: bool = False) -> Column:
    """min, mean or sum of n rows, trailing or centred; NULL with fewer than ``need`` values (default: all of them)."""
    w = Window.partitionBy("cell").orderBy("t").rowsBetween(-(n // 2), n // 2) if centred else trailing(n)
    f = {"min": F.min, "mean": F.avg, "sum": F.sum, "max": F.max}[kind]
    return F.when(F.count(v).over(w) >= (n if need is None else need), f(v).over(w))


def interpolate(v: Column, limit: int = 2) -> Column:
    """Linear in time, at most the first ``limit`` rows of a gap, not beyond the ends."""
    past = Window.partitionBy("cell").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("cell").orderBy("t").rowsBetween(0, Window.unboundedFollowing)
    sec = F.unix_seconds(F.col("t").cast("timestamp"))
    at = F.when(v.isNotNull(), sec)
    v0, v1 = F.last(v, True).over(past), F.first(v, True).over(ahead)
    t0, t1 = F.last(at, True).over(past), F.first(at, True).over(ahead)
    near = F.sum(F.when(v.isNull(), 1).otherwise(0)).over(trailing(limit + 1)) <= limit
    return F.when(v.isNotNull(), v).when(near & v0.isNotNull() & v1.isNotNull(), v0 + (v1 - v0) * (sec - t0) / (t1 - t0))


def fill_with_climatology(df: DataFrame, v: str, out: str, **baseline) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(v), climatology(F.col(v), **baseline)))


def gap_fill(df: DataFrame, v: str, out: str, limit: int = 2, **baseline) -> DataFrame:
    """Anomalies from the climatology are interpolated over short gaps and added back; the rest gets the climatology."""
    d = df.withColumn("__c", climatology(F.col(v), **baseline)).withColumn("__a", F.col(v) - F.col("__c"))
    d = d.withColumn("__i", interpolate(F.col("__a"), limit))
    return d.withColumn(out, F.coalesce(F.col("__i") + F.col("__c"), F.col("__c"))).drop("__c", "__a", "__i")


def expand_year(df: DataFrame) -> DataFrame:
    """A yearly value repeated at its twelve mid-month labels."""
    start = F.date_trunc("year", F.col("t")).cast("timestamp_ntz")
    months = F.explode(F.sequence(start, start + F.expr("INTERVAL 11 MONTHS"), F.expr("INTERVAL 1 MONTH")))
    return df.withColumn("__m", months).withColumn("t", F.col("__m") + F.expr("INTERVAL 14 DAYS")).drop("__m")


def daily_axis(df: DataFrame, order: str, first: str) -> DataFrame:
    """Replace a broken time axis: the n-th row of each cell gets the n-th day from ``first``."""
    n = F.row_number().over(Window.partitionBy("cell").orderBy(order)) - 1
    return df.withColumn("t", F.lit(first).cast("timestamp_ntz") + F.make_dt_interval(n))
