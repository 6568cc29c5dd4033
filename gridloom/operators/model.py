"""Training tables, blocked cross-validation, tree ensembles, prediction over cubes."""

from __future__ import annotations

import gc
import math
import random

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from ..functions.scalar import number_with_unit
from . import boosting
from .align import fallback_column
from .mask import all_present, not_named, static_mask
from .reduce import member_quantile

#: Ranges of the random search. Trees grow by levels up to a depth of 30, leaf-wise growth and dropout do not exist here.
FOREST = {"maxDepth": range(5, 31), "featureSubsetStrategy": ["log2", "all", "sqrt"], "numTrees": [300, 400, 500]}
BOOSTED = {"maxDepth": range(3, 13), "minInstancesPerNode": range(10, 31), "maxIter": [300, 400, 500], "stepSize": [0.05, 0.1]}
#: Rows of a training table that a task holds at most.
TASK_ROWS = 250_000


def target_name(variable: str) -> str:
    return "ET_EC" if variable == "ET" else f"{variable}_SOLO_EC"


#: Towers whose coordinates are wrong in the source (latitude, longitude), and years to keep of towers that stopped.
PLACES = {"Longr": (-23.5232, 144.3104)}
YEARS = {"Tumba": (2000, 2019)}


def patched(df: DataFrame, site: str = "site", places: dict = PLACES, years: dict = YEARS) -> DataFrame:
    """Coordinates (lat, lon) put right and years cut off for sites whose name holds a key."""
    for part, (lat, lon) in places.items():
        hit = F.contains(F.col(site), F.lit(part))
        df = df.withColumns({"lat": F.when(hit, lat).otherwise(F.col("lat")), "lon": F.when(hit, lon).otherwise(F.col("lon"))})
    for part, (first, last) in years.items():
        df = df.filter(F.coalesce(~F.contains(F.col(site), F.lit(part)), F.lit(True)) | F.year("t").between(first, last))
    return df


def with_site_facts(df: DataFrame, site: str, height: str | None = None, lat: float | None = None, lon: float | None = None) -> DataFrame:
    """Constant columns of a tower: its name, its canopy height out of an attribute such as '12.5m' (NULL if that is no number), its place."""
    return df.withColumns({"site": F.lit(site), "VegH_EC": number_with_unit(F.lit(height).cast("string")), "x_coord": F.lit(lon).cast("double"), "y_coord": F.lit(lat).cast("double")})


def training_table(sites: DataFrame, features: list[str], variable: str, exclusions: list[str], fluxes: tuple[str, ...] = ("NEE_SOLO_EC", "GPP_SOLO_EC", "ER_SOLO_EC", "ET_EC"), height: str = "VegH") -> DataFrame:
    """site, the features and ``label`` of all sites that are not excluded by name, complete rows only.

    The tower's canopy height is used where the site has one at all, else the remote one, which is then no feature. Rows that lack one of the fluxes, whichever is modelled, go.
    """
    kept = sites.filter(not_named(F.col("site"), exclusions))
    kept = kept.withColumn(f"{height}_EC", fallback_column(f"{height}_EC", f"{height}_RS", "site"))
    rows = kept.select("site", *dict.fromkeys([*fluxes, *features])).na.drop("any")
    return rows.select("site", *(f for f in features if f != f"{height}_RS"), F.col(target_name(variable)).alias("label"))


def cv_blocks(df: DataFrame, site: str, order: list[str], blocks: int = 5) -> DataFrame:
    """row_index in the site, and the block that tests the row; the first n - blocks * (n div (blocks + 1)) rows are never tested.

    A block is trained on all other rows of its site (blocked, not temporal, cross-validation), and the blocks are distinct.
    """
    w = Window.partitionBy(site)
    n = F.count("*").over(w)
    size = F.floor(n / (blocks + 1))
    i = F.row_number().over(w.orderBy(*order)) - 1
    d = df.withColumns({"row_index": i.cast("long"), "__n": n, "__s": size})
    b = F.floor((F.col("row_index") - (F.col("__n") - blocks * F.col("__s"))) / F.col("__s"))
    return d.withColumn("block", F.when((F.col("__s") > 0) & (F.col("row_index") >= F.col("__n") - blocks * F.col("__s")), b.cast("int"))).drop("__n", "__s")


def left_out_sites(sites: list, member: int, n: int = 2, seed: int = 0) -> list:
    """n distinct sites that a member of the ensemble does not see."""
    return random.Random(seed * 1009 + member).sample(sorted(sites), min(n, len(sites)))


def leave_out(df: DataFrame, site: str, left: list) -> DataFrame:
    return df.filter(~F.col(site).isin(left))


def pipeline(features: list[str], label: str, kind: str = "forest", seed: int = 0, **params) -> Pipeline:
    make = RandomForestRegressor if kind == "forest" else GBTRegressor
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error"), make(labelCol=label, featuresCol="features", seed=seed, **params)])


def random_params(space: dict, n: int, seed: int) -> list[dict]:
    rng = random.Random(seed)
    return [{k: rng.choice(list(v)) for k, v in space.items()} for _ in range(n)]


def search(df: DataFrame, features: list[str], label: str, kind: str, space: dict, n_iter: int = 20, folds: int = 3, parallelism: int = 4, seed: int = 0):
    """The best of n_iter random settings by shuffled inner cross-validation."""
    p = pipeline(features, label, kind, seed)
    tree = p.getStages()[-1]
    grid = [{tree.getParam(k): v for k, v in s.items()} for s in random_params(space, n_iter, seed)]
    cv = CrossValidator(estimator=p, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol=label, metricName="r2"), numFolds=folds, seed=seed, parallelism=parallelism)
    return cv.fit(df)


def nested_predictions(df: DataFrame, features: list[str], label: str, kind: str, blocks: int = 5, **params) -> DataFrame:
    """Observed and predicted values of each block's test rows; df has the column ``block``."""
    out = []
    for b in range(blocks):
        test = F.col("block").eqNullSafe(F.lit(b))
        fitted = pipeline(features, label, kind, **params).fit(df.filter(~test))
        out.append(fitted.transform(df.filter(test)).select(F.lit(b).alias("split"), F.col(label).alias("Test"), F.col("prediction").alias("Pred")))
    first, *rest = out
    for r in rest:
        first = first.unionByName(r)
    return first


def fit_ensemble(df: DataFrame, site: str, features: list[str], label: str, members: int = 15, kinds: tuple[str, ...] = ("forest", "boosted"), seed: int = 0, params: dict | None = None) -> list[PipelineModel]:
    """The models of all members, each learnt from every row of the sites that it does not leave out. Boosted models of all members are learnt together, if
    ``boosting`` has their parameters."""
    found = {}
    if "boosted" in kinds and boosting.fits((params or {}).get("boosted", {})):
        found["boosted"] = boosted_ensemble(df, site, features, label, members, seed, (params or {}).get("boosted", {}))
    if rest := [k for k in kinds if k not in found]:
        counts = {r[0]: r[1] for r in df.groupBy(site).count().collect()}
        tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-sum(counts.values()) // TASK_ROWS))
        rows = df.repartition(tasks).cache()  # read and joined once for all members
        parts = [leave_out(rows, site, left_out_sites(list(counts), m, seed=seed)) for m in range(members)]
        found |= {k: [pipeline(features, label, k, seed + m, **(params or {}).get(k, {})).fit(part) for m, part in enumerate(parts)] for k in rest}
        rows.unpersist()
    return [found[k][m] for m in range(members) for k in kinds]


def boosted_ensemble(df: DataFrame, site: str, features: list[str], label: str, members: int, seed: int, params: dict) -> list[PipelineModel]:
    """Boosted models only, learnt together."""
    trees, cuts, p = boosting.learn(df, site, features, label, lambda sites, m: left_out_sites(sites, m, seed=seed), members, params)
    gc.collect()  # shuffle files of the training table go before the models are used
    df.sparkSession.sparkContext._jvm.System.gc()
    models = []
    for m, own in enumerate(trees):

        def make(m=m, own=own):
            assembler, tree = pipeline(features, label, "boosted", seed + m, **params).getStages()
            return [assembler, boosting.spark_model(df.sparkSession, tree, own, cuts, p["stepSize"])]

        models.append(boosting.Learnt(make, boosting.paths(own, cuts, p["stepSize"])))
    return models


def save_models(models: list[PipelineModel], path: str, names: list[str], features: list[str]) -> None:
    """Every model in a folder of its name, and a table of names and features. Models of these names are replaced, others stay."""
    for name, m in zip(names, models, strict=True):
        m.write().overwrite().save(f"{path}/models/{name}")
    rows = [(n, i, list(features)) for i, n in enumerate(names)]
    SparkSession.getActiveSession().createDataFrame(rows, "name string, place int, features array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}/list")


def load_models(spark: SparkSession, path: str) -> tuple[dict[str, PipelineModel], list[str]]:
    """The models of ``save_models`` by name, in their order, and their features."""
    rows = spark.read.parquet(f"{path}/list").orderBy("place").collect()  # a row for each model
    return {r.name: PipelineModel.load(f"{path}/models/{r.name}") for r in rows}, list(rows[0].features) if rows else []


def _inputs(df: DataFrame, features: list[str], clean: bool) -> DataFrame:
    if lost := [f for f in features if f not in df.columns]:
        raise ValueError(f"the cube has no {', '.join(lost)}")
    bad = lambda f: F.col(f).isNull() | F.isnan(f) | (F.abs(f) == float("inf"))
    d = df.withColumns({f"__f_{f}": F.when(bad(f), 0.0).otherwise(F.col(f).cast("double")) if clean else F.col(f).cast("double") for f in features})
    return VectorAssembler(inputCols=[f"__f_{f}" for f in features], outputCol="__features", handleInvalid="keep").transform(d)


def predict(df: DataFrame, model: PipelineModel, features: list[str], name: str = "Predictions", proba: bool = False, clean: bool = True, return_input: bool = False, keys: tuple[str, ...] = ("cell", "t")) -> DataFrame:
    """The prediction of one model for every row, no shuffle. ``clean``: missing and infinite inputs count as 0. ``proba``: of a classifier, also the highest class
    probability in per cent. ``return_input``: the inputs come along."""
    stage = model.stages[-1].copy().setFeaturesCol("__features").setPredictionCol("__prediction")
    if proba:
        stage = stage.setProbabilityCol("__proba").setRawPredictionCol("__raw")
    d = stage.transform(_inputs(df, features, clean))
    out = [F.col("__prediction").alias(name)] + ([best_probability("__proba").alias("Probabilities")] if proba else [])
    return d.select(*keys, *out, *(f for f in features if return_input and f not in keys))


def predict_ensemble(df: DataFrame, models: list[PipelineModel], features: list[str], masking: list[str], keys: list[str], layer: DataFrame | None = None, flag: str = "urban_water_mask") -> DataFrame:
    """keys and an array of the members' predictions: missing inputs count as 0, rows with a missing masking variable get NULLs, and so do cells that the layer
    (cell, flag) excludes. Without a layer no shuffle."""
    d = _masked_inputs(df, features, masking, keys, layer, flag)
    if every := _for_tables(models):
        return _predict_by_tables(d, every, keys, features)
    for i, m in enumerate(models):
        d = m.stages[-1].copy().setFeaturesCol("__features").setPredictionCol(f"__p{i}").transform(d)
    members = F.array(*(F.when(F.col("__ok"), F.col(f"__p{i}").cast("float")) for i in range(len(models))))
    return d.select(*keys, members.alias("members"))


def predict_median(df: DataFrame, models: list[PipelineModel], features: list[str], masking: list[str], keys: list[str]) -> DataFrame:
    """keys and the median of the members as ``ensemble_median`` has it; of boosted models without arrays of members."""
    if every := _for_tables(models):
        return _predict_by_tables(_masked_inputs(df, features, masking, keys), every, keys, features, median=True)
    return ensemble_median(predict_ensemble(df, models, features, masking, keys)).drop("members")


def _for_tables(models: list[PipelineModel]) -> list | None:
    """The trees of boosted models whose leaves fit a mask."""
    if not models or not all(map(_boosted, models)):
        return None
    every = [_trees(m) for m in models]
    return every if max(len(t) for trees in every for t in trees) <= 1 << boosting.DEEPEST else None


def _masked_inputs(df: DataFrame, features: list[str], masking: list[str], keys: list[str], layer: DataFrame | None = None, flag: str = "urban_water_mask") -> DataFrame:
    if lost := [f for f in features if f not in df.columns]:
        raise ValueError(f"the cube has no {', '.join(lost)}")
    needed = list(dict.fromkeys([*keys, *features, *masking, *(["cell"] if layer is not None else [])]))
    d = df.select(*needed).withColumn("__ok", all_present(*masking) if masking else F.lit(True))
    if layer is not None:
        d = static_mask(d, layer, flag, ["__ok"]).withColumn("__ok", F.coalesce("__ok", F.lit(False)))
    return _inputs(d, features, True)


def _predict_by_tables(d: DataFrame, models: list, keys: list[str], features: list[str], median: bool = False) -> DataFrame:
    """keys and members, or their median: the leaf of each tree out of tables over the bins that all thresholds make."""
    d, n, count = d.select(*keys, "__ok", *(f"__f_{f}" for f in features)), len(keys), len(models)
    cuts = boosting.path_cuts(models, len(features))
    sizes = [len(c) + 1 for c in cuts]
    tables = [[(boosting.leaf_masks(boosting.path_boxes(t, cuts), sizes), np.array([w * v for w, v, _ in t])) for t in trees] for trees in models]
    shared = d.sparkSession.sparkContext.broadcast(tables)
    rank = round(0.5 * (count - 1))  # half to even
    kind = StructField("median", FloatType()) if median else StructField("members", ArrayType(FloatType()))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ok = b.column(n).to_numpy(zero_copy_only=False).astype(bool)
            codes = boosting.group_codes([boosting.binned(b.column(n + 1 + f).to_numpy(zero_copy_only=False), c) for f, c in enumerate(cuts)], sizes)
            out = np.empty((count, b.num_rows), np.float32)
            for i, trees in enumerate(shared.value):
                out[i] = sum(values[boosting.leaves(masks, codes)] for masks, values in trees)
            if median:
                made = pa.array(np.sort(out.T, axis=1)[:, rank], pa.float32(), mask=~ok | (count < 3))
            else:
                values = pa.array(out.T.ravel(), pa.float32(), mask=np.repeat(~ok, count))
                made = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * count), values)
            yield pa.RecordBatch.from_arrays([*b.columns[:n], made], [*b.schema.names[:n], kind.name])

    return d.mapInArrow(run, StructType([*d.schema.fields[:n], kind]))


def ensemble_median(df: DataFrame) -> DataFrame:
    return df.withColumn("median", member_quantile(F.col("members"), 0.5))


def best_probability(probability: str):
    """The highest class probability, in per cent."""
    return F.array_max(vector_to_array(F.col(probability))) * 100


def importance(models: list[PipelineModel], features: list[str], spark) -> DataFrame:
    """Mean impurity importance of each feature over the models, the highest first; suffixes are stripped."""
    rows = [(plain_name(f), float(m.stages[-1].featureImportances[i])) for m in models for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, importance double").groupBy("feature").agg(F.avg("importance").alias("importance")).orderBy(F.desc("importance"), "feature")


def plain_name(feature: str) -> str:
    return feature[:-3] if feature[-3:] in ("_RS", "_EC") else feature


def _boosted(model: PipelineModel) -> bool:
    return isinstance(model, boosting.Learnt) or isinstance(model.stages[-1], GBTRegressionModel)


def _paths(model: PipelineModel) -> list[tuple[float, float, list]]:
    return [leaf for tree in _trees(model) for leaf in tree]


def _trees(model: PipelineModel) -> list[list[tuple[float, float, list]]]:
    """(weight of the tree, value, splits) of every leaf, for each tree; a split is (feature, least, below, share): what the feature must be on the whole path (at least
    ``least`` exclusive and up to ``below``), and the product of the shares of training rows that went this way at its splits."""
    if isinstance(model, boosting.Learnt):
        return model.paths
    stage = model.stages[-1]
    weights = list(stage.treeWeights) if hasattr(stage, "treeWeights") else [1.0]
    if not isinstance(stage, GBTRegressionModel):
        weights = [w / len(weights) for w in weights]
    out = []

    def walk(node, weight, held):
        if node.numDescendants() == 0:
            out[-1].append((weight, float(node.prediction()), [(f, *v) for f, v in sorted(held.items())]))
            return
        split, here = node.split(), float(node.impurityStats().count())
        f, at = split.featureIndex(), float(split.threshold())
        lo, hi, share = held.get(f, (float("-inf"), float("inf"), 1.0))
        for child, (a, b) in ((node.leftChild(), (lo, min(hi, at))), (node.rightChild(), (max(lo, at), hi))):
            walk(child, weight, held | {f: (a, b, share * float(child.impurityStats().count()) / here)})

    for weight, tree in zip(weights, stage.trees, strict=True):
        out.append([])
        walk(tree._call_java("rootNode"), float(weight), {})
    return out


def shap_values(x, paths: list, n_features: int):
    """Exact Shapley values of sums of trees [rows x features], absent features averaged over the training rows that go each way (path-dependent).

    A leaf's value counts if every feature of its path lies in its range; an absent one lets it count by its share. For each leaf the value of a feature is a sum over
    subsets of the other features on the path, by size, which a polynomial holds: its coefficients are products of (share + inside * z).
    """
    phi = np.zeros((len(x), n_features))
    for weight, value, splits in paths:
        m = len(splits)
        if not m or not value:
            continue
        inside = np.stack([(x[:, f] > lo) & (x[:, f] <= hi) for f, lo, hi, _ in splits], 1).astype(float)
        shares = np.array([s[3] for s in splits])
        by_size = np.array([math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)])
        for i, (f, *_) in enumerate(splits):
            poly = np.zeros((len(x), m))
            poly[:, 0] = 1.0
            for j in range(m):
                if j != i:
                    poly[:, 1:] = poly[:, 1:] * shares[j] + poly[:, :-1] * inside[:, j : j + 1]
                    poly[:, 0] *= shares[j]
            phi[:, f] += weight * value * (poly @ by_size) * (inside[:, i] - shares[i])
    return phi


def shap_table(tree: list, cuts: list):
    """The Shapley values of one tree for each combination of the ranges between its own thresholds, and for each group of features the tables that say which combination
    bins belong to (their numbers add up)."""
    own = boosting.path_cuts([[tree]], len(cuts))
    inside = [np.append(o, np.inf) for o in own]  # one value of each range
    sizes = [len(c) + 1 for c in cuts]
    parts, step = [], 1
    for o, c in zip(own, cuts, strict=True):
        parts.append(np.searchsorted(o, np.append(c, np.inf), "left") * step)
        step *= len(o) + 1
    # the first feature changes fastest, as its step is the smallest
    grid = np.stack([g.ravel(order="F") for g in np.meshgrid(*inside, indexing="ij")], 1)
    return boosting.group_table(parts, sizes, np.add), shap_values(grid, tree, len(cuts))


def shap_importance(models: list[PipelineModel], df: DataFrame, features: list[str]) -> DataFrame:
    """feature and importance: the mean absolute Shapley value over all rows, averaged over the models; the highest first, suffixes stripped.

    Only boosted models count, as explaining forests takes long, unless there are no others. Rows in the same bins of all thresholds have the same values, so they are
    counted first; each task then explains its share of the distinct combinations, and gives one row of sums for each model and feature.
    """
    boosted = [m for m in models if _boosted(m)] or models
    every, n = [_trees(m) for m in boosted], len(features)
    cuts = boosting.path_cuts(every, n)
    bins = [len(c) + 1 for c in cuts]
    sizes = [math.prod(bins[f] for f in g) for g in boosting.grouped(bins)]
    shared = df.sparkSession.sparkContext.broadcast(every)
    parts = max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def count(batches):
        coded = ((boosting.group_codes([boosting.binned(t.column(f).to_numpy(), c) for f, c in enumerate(cuts)], bins), np.zeros(len(t), int), [np.ones(len(t))]) for t in boosting._chunks(batches))
        yield from boosting.collapsed(coded, sizes, 1, parts)

    def explain(batches):
        import pyarrow as pa

        if (m := boosting.merged(boosting._payloads(batches), sizes)) is None:
            return
        codes, _, cell, (rows,) = m  # a cell for each pair, in order
        sums = np.zeros((len(shared.value), n))
        tables = [[shap_table(t, cuts) for t in trees] for trees in shared.value]
        for a in range(0, len(rows), 1 << 14):
            part, weight = [c[a : a + (1 << 14)] for c in codes], rows[a : a + (1 << 14)]
            for i, trees in enumerate(tables):
                phi = np.zeros((len(weight), n))
                for at, values in trees:
                    phi += values[sum(t[c] for t, c in zip(at, part, strict=True))]
                sums[i] += weight @ np.abs(phi)
        yield pa.RecordBatch.from_pydict({"feature": pa.array([i for _ in sums for i in range(n)], pa.int32()), "total": pa.array(sums.ravel()), "n": pa.array([rows.sum()] * sums.size, pa.float64())})

    inputs = df.select(*(F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"f{i}") for i, f in enumerate(features)))
    rows = inputs.mapInArrow(count, "part int, data binary").repartitionById(parts, F.col("part")).mapInArrow(explain, "feature int, total double, n double")
    mean = rows.groupBy("feature").agg(F.try_divide(F.sum("total"), F.sum("n")).alias("importance"))
    name = F.create_map(*(x for i, f in enumerate(features) for x in (F.lit(i), F.lit(plain_name(f)))))[F.col("feature")]
    return mean.select(name.alias("feature"), "importance").orderBy(F.desc("importance"), "feature")
