"""Sources and sinks. Cubes live in Parquet; formats whose libraries are absent are read through optional imports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_cube(spark: SparkSession, path: str, variables: list[str] | None = None) -> DataFrame:
    """A cube, or some of its variables; the columns of the keys always come along. A variable that is missing is an error."""
    df = spark.read.parquet(path)
    if variables is None:
        return df
    if lost := [v for v in variables if v not in df.columns]:
        raise ValueError(f"the cube has no {', '.join(lost)}")
    keys = [c for c in df.columns if c in ("cell", "row", "col", "lat", "lon", "t", "year", "member")]
    return df.select(*keys, *variables)


def read_folder(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """All files of a folder that match, one below the other, with the name of the file."""
    df = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").parquet(path)
    return df.withColumn("file", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]*$", 1))


def read_series_csv(spark: SparkSession, path: str, schema: str, time: str = "time", pattern: str | None = None) -> DataFrame:
    """CSV files with a time column; the name of the file is the site."""
    names = [f.name for f in T._parse_datatype_string(schema)]
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=False).withColumn("site", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv", 1))
    return df.withColumn(time, F.to_timestamp_ntz(F.col(time).cast("string"), F.lit(pattern)) if pattern else F.col(time).cast("timestamp_ntz")) if time in names else df


def read_projection_csv(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """Some columns of every CSV of a folder."""
    return spark.read.csv(folder, header=True, inferSchema=True).select(*columns)


def read_index_csv(spark: SparkSession, path: str) -> DataFrame:
    """A climate index without header: yyyyMM, value."""
    df = spark.read.csv(path, schema="month string, value double")
    return df.select(F.to_date("month", "yyyyMM").cast("timestamp_ntz").alias("t"), "value")


def read_named_csv(spark: SparkSession, path: str, index: str, names: dict[str, str] | None = None) -> DataFrame:
    """A CSV with a header whose index column is named (national totals by year), some columns renamed."""
    df = spark.read.csv(path, header=True, inferSchema=True).withColumnsRenamed(names or {})
    return df.select(index, *(c for c in df.columns if c != index))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON features: properties and the rings, holes among them, of a Polygon or of all parts of a MultiPolygon."""
    known = spark.read.json(path, multiLine=True).select(F.explode("features").alias("f")).select("f.properties").schema["properties"].dataType
    schema = f"features array<struct<geometry: struct<type: string, coordinates: string>, properties: {known.simpleString()}>>"
    g = spark.read.schema(schema).json(path, multiLine=True)
    g = g.select(F.explode("features").alias("f"))
    text, ring = F.col("f.geometry.coordinates"), "array<array<array<double>>>"
    rings = F.when(F.col("f.geometry.type") == "MultiPolygon", F.flatten(F.from_json(text, f"array<{ring}>"))).otherwise(F.from_json(text, ring))
    return g.select("f.properties.*", rings.alias("rings"))


def read_existing(spark: SparkSession, paths: dict[str, str], read) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables of the sites whose path exists, by ``read(path)``, and the names of those that are skipped."""
    found, skipped = {}, []
    for site, path in paths.items():
        if _exists(spark, path):
            found[site] = read(path)
        else:
            skipped.append(site)
    return found, skipped


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def batch_parameters(spark: SparkSession, names: dict[str, type], prefix: str = "gridloom.batch.") -> dict:
    """Parameters of a batch job from the session's settings (``--conf gridloom.batch.model_var=GPP``), each of its type; a missing one is an error."""
    got = {n: spark.conf.get(prefix + n, None) for n in names}
    if lost := [n for n, v in got.items() if v is None]:
        raise ValueError(f"no setting for {', '.join(prefix + n for n in lost)}")
    return {n: kind(got[n]) for n, kind in names.items()}


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The names in the first line of a list of features: blank ends, the site and suffixes of three characters are left out."""
    line = spark.read.text(path).first().value
    return [n[:-3] if n[-3:] in ("_RS", "_EC") else n for n in (x.strip() for x in line.split(",")) if n and n != "site"]


def read_netcdf(spark: SparkSession, paths: list[str], variable: str) -> DataFrame:
    """NetCDF variables as (t, lat, lon, value), a task for each file; needs the netCDF4 package on the executors."""

    def load(batches):
        import netCDF4
        import numpy as np
        import pandas as pd

        for batch in batches:
            for path in batch["path"]:
                with netCDF4.Dataset(path) as ds:
                    v = ds[variable]
                    axes = [np.asarray(ds[d][:]) for d in v.dimensions]
                    t = netCDF4.num2date(axes[0], ds[v.dimensions[0]].units, only_use_cftime_datetimes=False)
                    for i, when in enumerate(t):  # one step of time at a time
                        lat, lon = np.meshgrid(axes[1], axes[2], indexing="ij")
                        yield pd.DataFrame({"t": pd.Timestamp(when), "lat": lat.ravel(), "lon": lon.ravel(), "value": np.ma.filled(v[i].astype(float), np.nan).ravel()})

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(len(paths), 1))
    return files.mapInPandas(load, "t timestamp_ntz, lat double, lon double, value double").withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def read_geotiff(spark: SparkSession, path: str) -> DataFrame:
    """The first band as (row, col, value); needs the rasterio package on the executors."""

    def load(batches):
        import numpy as np
        import pandas as pd
        from rasterio.io import MemoryFile

        for batch in batches:
            for content in batch["content"]:
                with MemoryFile(content) as f, f.open() as src:
                    a = src.read(1, masked=True).astype(float).filled(np.nan)
                    row, col = np.indices(a.shape)
                    yield pd.DataFrame({"row": row.ravel(), "col": col.ravel(), "value": a.ravel()})

    raw = spark.read.format("binaryFile").load(path).select("content")
    return raw.mapInPandas(load, "row int, col int, value double").withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN as NULL in all floating columns; done once, when data comes in."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, k in df.dtypes if k in ("double", "float")})


def links(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))


def data_links(pages: DataFrame, endings: list[str], old: str, new: str) -> DataFrame:
    """Links with one of the endings, their last part, and the address of the data behind them."""
    from functools import reduce

    keep = reduce(lambda a, b: a | b, (F.endswith(F.col("link"), F.lit(e)) for e in endings))
    return links(pages).filter(keep).select("page_id", "link", F.regexp_extract("link", "([^/]*)$", 1).alias("name"), F.replace("link", F.lit(old), F.lit(new)).alias("url"))


def missing(new: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new`` whose keys are not there yet."""
    return new.join(done.select(*keys), keys, "left_anti")


def write_cube(df: DataFrame, path: str, partitions: list[str] | None = None, narrow: bool = True) -> None:
    """Doubles become floats. With ``partitions`` only those that df has are replaced, else the whole cube is."""
    if narrow:
        df = df.select(*(F.col(f"`{f.name}`").cast("float").alias(f.name, metadata=f.metadata) if f.dataType == T.DoubleType() else F.col(f"`{f.name}`") for f in df.schema.fields))
    w = df.write.mode("overwrite")
    (w.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions) if partitions else w).parquet(path)


def write_variables(df: DataFrame, path: str, keys: tuple[str, ...] = ("cell", "t")) -> None:
    """A stacked cube, a folder for each variable, in one pass."""
    names = [c for c in df.columns if c not in keys]
    long = df.select(*keys, *(F.col(c).cast("float") for c in names)).unpivot(list(keys), names, "variable", "value")
    write_cube(long, path, ["variable"])


def read_variable(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """One variable of a stacked cube; the other folders are not read."""
    return spark.read.parquet(path).filter(F.col("variable") == variable).withColumnRenamed("value", variable).drop("variable")


def product_path(root: str, product: str, variable: str, grid: str, version: str) -> str:
    return f"{root.rstrip('/')}/{product}_{variable}_{grid}_quantiles_{version}"


def write_product(df: DataFrame, root: str, product: str, variable: str, grid: str, version: str, first: int, last: int, attributes: dict | None = None) -> str:
    """The final product of some years, one partition for each; another version is another folder. Years that are written again are replaced. Returns the path."""
    path = product_path(root, product, variable, grid, version)
    out = df.withColumn("year", F.year("t")).filter(F.col("year").between(first, last))
    for c in (c for c in df.columns if c.startswith(variable)):
        out = with_attributes(out, c, (attributes or {}) | {"version": version})
    write_cube(out, path, ["year"])
    return path


def write_raw(df: DataFrame, path: str, reserved: tuple[str, ...] = ("_NCProperties",)) -> None:
    """A copy of the source as it is, but for reserved attributes."""
    for f in df.schema.fields:
        if any(k in f.metadata for k in reserved):
            df = with_attributes(df, f.name, {k: v for k, v in f.metadata.items() if k not in reserved})
    df.write.mode("overwrite").parquet(path)


def write_site_csv(df: DataFrame, path: str, site: str = "site") -> None:
    df.write.mode("overwrite").partitionBy(site).csv(path, header=True)


def write_site_list(df: DataFrame, path: str, site: str = "site") -> None:
    """The sites of a training table with their numbers of rows, as one CSV."""
    df.groupBy(site).agg(F.count("*").alias("n")).orderBy(site).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_feature_list(spark: SparkSession, path: str, features: list[str]) -> None:
    """Names separated by commas, with one at the end, as ``read_header`` reads them."""
    spark.createDataFrame([("".join(f"{x}," for x in features),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def append_table(df: DataFrame, path: str, keys: list[str]) -> int:
    """Append the rows whose keys the table lacks, one for each key; running it again adds nothing. Returns the number of new rows."""
    spark = df.sparkSession
    fresh = df.dropDuplicates(keys)
    if _exists(spark, path):
        fresh = missing(fresh, spark.read.parquet(path), keys)
    fresh = fresh.persist()  # counted and written
    try:
        n = fresh.count()
        if n:
            fresh.write.mode("append").parquet(path)
        return n
    finally:
        fresh.unpersist()


def append_predictions(predictions: DataFrame, path: str, variable: str, model: str, member: int) -> int:
    """Observed and predicted values of a cross-validation (split, Test, Pred), keyed by variable, model, member, split and place in the split."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("split").orderBy("Test", "Pred")) - 1
    marked = predictions.select(F.lit(variable).alias("variable"), F.lit(model).alias("model"), F.lit(member).alias("member"), "split", place.alias("place"), "Test", "Pred")
    return append_table(marked, path, ["variable", "model", "member", "split", "place"])


def with_attributes(df: DataFrame, column: str, attributes: dict) -> DataFrame:
    """Replace the metadata of a column."""
    return df.withMetadata(column, attributes)


def publish(monthly: DataFrame, path: str, median: str, columns: list[str]) -> None:
    """Monthly values, annual means and annual sums; a sum is NULL where the annual mean of the median is."""
    write_cube(monthly.withColumn("year", F.year("t")), f"{path}/Monthly", ["year"])
    by = monthly.groupBy("cell", F.year("t").alias("year"))
    write_cube(by.agg(*(F.avg(c).alias(c) for c in columns)), f"{path}/AnnualMean", ["year"])
    has = F.avg(median).isNotNull()
    write_cube(by.agg(*(F.when(has, F.coalesce(F.sum(c), F.lit(0.0))).alias(c) for c in columns)), f"{path}/AnnualSum", ["year"])
