"""Masks and conditional replacement. A mask turns values into NULL; rows stay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Quality codes that are kept.
GOOD_CODES = (0, 5, 17, 21, 64, 65, 81)


def where(v: Column, keep: Column) -> Column:
    return F.when(keep, v)


def quality_mask(v: Column, code: Column, t: Column, skip_years: tuple[int, ...] = (2022, 2023), codes: tuple[int, ...] = GOOD_CODES) -> Column:
    """Values whose code is not allowed become NULL, but for the years that have no codes."""
    return F.when(F.year(t).isin(*skip_years) | code.isin(*codes), v)


def all_present(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def static_mask(df: DataFrame, layer: DataFrame, flag: str, columns: list[str], excluded: int = 1) -> DataFrame:
    """NULL where the layer's flag is ``excluded``; cells that the layer lacks keep their values. A cell that the layer has several times is excluded if one of its rows is."""
    out = layer.filter(F.col(flag) == excluded).select(F.col("cell").alias("__cell")).distinct().withColumn("__out", F.lit(True))
    j = df.join(out, F.col("cell") == F.col("__cell"), "left")
    return j.withColumns({c: F.when(F.col("__out").isNull(), F.col(c)) for c in columns}).drop("__cell", "__out")


def above_class(v: Column, limit: float) -> Column:
    """1 above a limit, else 0, also for a missing value."""
    return F.coalesce((v > limit).cast("int"), F.lit(0))


def is_class(v: Column, code: int) -> Column:
    return F.coalesce((v == code).cast("int"), F.lit(0))


def any_flag(*flags: Column) -> Column:
    """The union of masks of 0 and 1."""
    return reduce(lambda a, b: a.bitwiseOR(b), flags)


def has_value(v: Column) -> Column:
    """1 where there is a value: a mask of land out of a variable that exists on land only."""
    return v.isNotNull().cast("int")


def never_zero(df: DataFrame, v: str, until: str) -> DataFrame:
    """Cells whose highest value up to a date is not 0."""
    peak = df.filter(F.col("t") <= F.lit(until).cast("timestamp_ntz")).groupBy("cell").agg(F.max(v).alias("peak"))
    return df.join(peak.filter("peak = 0").select("cell"), "cell", "left_anti")


def not_named(c: Column, parts: list[str]) -> Column:
    """Rows whose name holds none of the parts."""
    return ~reduce(lambda a, b: a | b, (F.contains(c, F.lit(p)) for p in parts)) if parts else F.lit(True)
