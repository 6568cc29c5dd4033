"""Composite features: vegetation fractions, grass with the C4 pathway, cumulative rain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip
from .temporal import resample_year, rolling, trailing


def vegetation_fractions(df: DataFrame, ndvi: str = "ndvi", bare: str = "bare", ndvi_max: float = 0.91) -> DataFrame:
    """Persistent, recurrent and bare fractions of each month (after Donohue 2009).

    The total follows from the index between bare soil and its maximum. Persistent cover is a nine-month mean of a seven-month
    minimum; what exceeds it recurs. Where persistent cover exceeds the total, the excess is taken off.
    """
    total = clip(F.try_divide(F.col(ndvi) - F.col(bare), ndvi_max - F.col(bare)), 0.0, 1.0)
    d = df.withColumn("__f", total).withColumn("__low", F.min("__f").over(trailing(7)))
    d = d.withColumn("__p", F.avg("__low").over(trailing(9))).withColumn("__r", F.col("__f") - F.col("__p"))
    excess = F.when(F.col("__r") < 0, F.abs("__r")).otherwise(F.lit(0.0))
    persistent = clip(F.col("__p") - excess, 0.0)
    d = d.withColumns({"persistent": persistent, "recurrent": clip(F.col("__f") - persistent, 0.0)})
    return d.select("cell", "t", "persistent", "recurrent")


def annual_fractions(monthly: DataFrame) -> DataFrame:
    """Yearly maxima, and what they leave bare."""
    y = resample_year(monthly, {"trees": F.max("persistent"), "grass": F.max("recurrent")})
    return y.withColumn("bare", 1 - (F.col("trees") + F.col("grass")))


def c4_grass(df: DataFrame, layer: DataFrame, grass: str = "grass", percent: str = "percent") -> DataFrame:
    """Grass times the share of the C4 pathway; negative percentages are missing. The layer has one row for each cell."""
    valid = layer.select("cell", F.when(F.col(percent) >= 0, F.col(percent) / 100).alias("__share"))
    return df.join(valid, "cell").withColumn("c4_grass", F.col(grass) * F.col("__share")).drop("__share")


def cumulative_rain(df: DataFrame, rain: str = "rain") -> DataFrame:
    return df.withColumns({f"rain_{n}": rolling("sum", F.col(rain), n) for n in (3, 6, 12)})
