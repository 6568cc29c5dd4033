"""Joins by coordinates: aligned arithmetic, merges, nearest cells, as-of extraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def aligned(a: DataFrame, b: DataFrame, keys: list[str], result: Column, name: str) -> DataFrame:
    """An expression over two cubes on their common coordinates."""
    return a.join(b, keys, "inner").select(*keys, result.alias(name))


def merge_override(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """All coordinates of all cubes; for a variable that several have, the first that has a value. One shuffle for any number of cubes."""
    marked = [f.withColumn("__n", F.lit(i)) for i, f in enumerate(frames)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    names = [c for c in union.columns if c not in (*keys, "__n")]
    pick = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("__n"))).alias(c) for c in names]
    return union.groupBy(*keys).agg(*pick)


def left_all(frames: list[DataFrame], key: str | list[str]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "left"), frames)


def suffixed(df: DataFrame, suffix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").alias(c if c in keep else c + suffix) for c in df.columns))


def nearest_index(x: Column, origin: float, step: float, n: int, outside: str = "edge") -> Column:
    """The index of the nearest centre of a regular axis. Beyond the axis it is the edge, or NULL by more than half a step with ``outside='null'``."""
    i = F.floor((x - origin) / step + 0.5).cast("long")
    return F.when(i.isNotNull(), F.greatest(F.lit(0), F.least(i, F.lit(n - 1)))) if outside == "edge" else F.when((i >= 0) & (i < n), i)


def asof_nearest(left: DataFrame, right: DataFrame, by: str, t: str, value: str, tolerance: str, skip_null: bool = False, stretch: int = 32) -> DataFrame:
    """left with the value of the row of right that is nearest in time within the tolerance; the earlier one on a tie.

    The nearest row counts even if its value is NULL, unless ``skip_null``. One exchange: both sides are united and looked at through windows, so there is no
    range join. Time is cut into stretches of ``stretch`` tolerances, and a row of right stands in every stretch that it can serve (one or two), so that a key with
    very many rows is many tasks.
    """
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    limit = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00' + interval {tolerance}) - unix_micros(timestamp'1970-01-01 00:00:00')")
    part = lambda c: F.floor(c / (limit * stretch)).cast("long")
    l = left.select("*", F.lit(None).cast(right.schema[value].dataType).alias("__v"), F.lit(None).cast("timestamp_ntz").alias("__t"), F.lit(0).alias("__side"), part(micros(F.col(t))).alias("__part"))  # noqa: E741
    r = right.filter(F.col(value).isNotNull()) if skip_null else right
    r = r.filter(F.col(t).isNotNull()).select(F.col(by), F.col(t), F.col(value).alias("__v"), F.col(t).alias("__t"), F.lit(1).alias("__side"), F.explode(F.sequence(part(micros(F.col(t)) - limit), part(micros(F.col(t)) + limit))).alias("__part"))
    u = l.unionByName(r, allowMissingColumns=True)
    past = Window.partitionBy(by, "__part").orderBy(F.col(t), F.col("__side").desc(), F.col("__v")).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(by, "__part").orderBy(F.col(t).desc(), F.col("__side").desc(), F.col("__v").desc()).rowsBetween(Window.unboundedPreceding, 0)
    pair = F.when(F.col("__side") == 1, F.struct("__t", "__v"))
    u = u.withColumns({"__p": F.last(pair, True).over(past), "__n": F.last(pair, True).over(ahead)}).filter("__side = 0")
    dp, dn = micros(F.col(t)) - micros(F.col("__p.__t")), micros(F.col("__n.__t")) - micros(F.col(t))
    earlier = dp.isNotNull() & (dn.isNull() | (dp <= dn))
    return u.withColumn(value, F.when(earlier & (dp <= limit), F.col("__p.__v")).when(~earlier & (dn <= limit), F.col("__n.__v"))).select(*left.columns, value)


def assigned(df: DataFrame, other: DataFrame, keys: list[str], column: str, name: str | None = None) -> DataFrame:
    """A column of another table by key; rows that it lacks get NULL. ``other`` has one row for each key."""
    return df.join(other.select(*keys, F.col(column).alias(name or column)), keys, "left")


def side_by_side(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """All columns of tables with other columns, on the union of their keys."""
    return reduce(lambda a, b: a.join(b, keys, "full"), frames)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def error_bars(df: DataFrame, mid: str, lower: str, upper: str) -> DataFrame:
    """Distances of the middle from both bounds."""
    return df.withColumns({f"{mid}_below": F.col(mid) - F.col(lower), f"{mid}_above": F.col(upper) - F.col(mid)})


def transposed(df: DataFrame, key: str, keys: list[str], name: str = "name") -> DataFrame:
    """Columns as rows and the values ``keys`` of the key column as columns; values are doubles."""
    values = [c for c in df.columns if c != key]
    long = df.select(F.col(key).cast("string").alias("__k"), *(F.col(c).cast("double") for c in values)).unpivot("__k", values, name, "__v")
    return long.groupBy(name).pivot("__k", keys).agg(F.first("__v", True))


def compare_products(towers: DataFrame, products: dict[str, tuple[DataFrame, float]], tolerance: str = "1 day") -> DataFrame:
    """site, t, the observed value and a column for each product: its value, times a factor of units, in the cell of the site and at the nearest time.

    towers: site, cell, t, observed; a product: cell, t, v.
    """
    out = towers
    for name, (cube, factor) in products.items():
        out = asof_nearest(out, cube.select("cell", "t", (F.col("v") * factor).alias(name)), "cell", "t", name, tolerance)
    return out


def fallback_column(first: str, second: str, group: str) -> Column:
    """The second column for groups in which the first has no value at all."""
    return F.when(F.count(F.col(first)).over(Window.partitionBy(group)) == 0, F.col(second)).otherwise(F.col(first))
