"""Boosted regression trees of many members at once, and tables that score and explain trees.

Trees see a feature through its bin only. Rows of the same bins and site are therefore added up once (number, sum and sum of squares of the labels: nothing is lost that
squared error uses), and each level of a tree reads these cells instead of rows, for all members together. A member leaves out sites by taking their part off each cell.
"""

from __future__ import annotations

import itertools
import json
import math
import pickle

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a task encodes at a time, and cells in a block.
CHUNK, BLOCK = 250_000, 131_072
#: Rows of the table for each task that holds cells.
CELL_ROWS = 1_500_000
#: Distinct values of a feature up to which quantiles are exact; beyond, a task keeps so many points of equal weight.
POINTS = 4096
#: Features are looked up in groups of at most so many combinations of bins.
GROUP = 4096
#: Parameters that this learner has, and Spark's default values.
PARAMS = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "maxBins": 32, "minInstancesPerNode": 1, "minInfoGain": 0.0}
#: Masks have a bit for each leaf, and every level adds up the trees before: deeper trees and longer series are for Spark's learner.
DEEPEST, LONGEST = 6, 32
ONE_HOT = np.zeros(1 << 16, np.intp)
ONE_HOT[1 << np.arange(16)] = np.arange(16)


def fits(params: dict) -> bool:
    p = PARAMS | params
    return p.keys() == PARAMS.keys() and p["maxDepth"] <= DEEPEST and p["maxIter"] <= LONGEST


# tables over bins


def grouped(sizes: list[int]) -> list[list[int]]:
    """Features in groups whose combinations of bins fit a table."""
    out: list[list[int]] = []
    for f, n in enumerate(sizes):
        if out and math.prod(sizes[i] for i in out[-1]) * n <= GROUP:
            out[-1].append(f)
        else:
            out.append([f])
    return out


def group_codes(bins: list[np.ndarray], sizes: list[int]) -> list[np.ndarray]:
    out = []
    for g in grouped(sizes):
        code = bins[g[0]].astype(np.intp)
        for f in g[1:]:
            code = code * sizes[f] + bins[f]
        out.append(code)
    return out


def binned(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The number of thresholds below each value: values up to a threshold lie left of it, NaN lies right of all."""
    return np.searchsorted(cuts, x, "left")


def group_table(parts: list[np.ndarray], sizes: list[int], join) -> list[np.ndarray]:
    """Of one array for each feature [bins], one for each group [combinations], by the ufunc join."""
    out = []
    for g in grouped(sizes):
        t = parts[g[0]]
        for f in g[1:]:
            t = join.outer(t, parts[f]).ravel()
        out.append(t)
    return out


def leaf_masks(boxes: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Tables of bits: those of the leaves whose box [leaf, feature, (first bin, last bin)] has the bin. And-ed over the features one bit stays."""
    kind = np.uint16 if len(boxes) <= 16 else np.uint64
    bit = kind(1) << np.arange(len(boxes)).astype(kind)
    parts = []
    for f, n in enumerate(sizes):
        c = np.arange(n)[:, None]
        parts.append(np.bitwise_or.reduce(np.where((c >= boxes[:, f, 0]) & (c <= boxes[:, f, 1]), bit, kind(0)), axis=1))
    return group_table(parts, sizes, np.bitwise_and)


def leaves(masks: list[np.ndarray], codes: list[np.ndarray]) -> np.ndarray:
    m = masks[0][codes[0]]
    for t, c in zip(masks[1:], codes[1:], strict=True):
        m &= t[c]
    return ONE_HOT[m] if m.dtype == np.uint16 else np.frexp(m.astype(float))[1].astype(np.intp) - 1


def path_cuts(models: list, n_features: int) -> list[np.ndarray]:
    """The thresholds of each feature in models, which are lists of trees, which are lists of leaves (weight, value, splits)."""
    found: list[set] = [set() for _ in range(n_features)]
    for tree in (t for m in models for t in m):
        for *_, splits in tree:
            for f, lo, hi, _ in splits:
                found[f] |= {v for v in (lo, hi) if math.isfinite(v)}
    return [np.array(sorted(v), float) for v in found]


def path_boxes(tree: list, cuts: list[np.ndarray]) -> np.ndarray:
    boxes = np.array([[[0, len(c)] for c in cuts]] * len(tree))
    for k, (*_, splits) in enumerate(tree):
        for f, lo, hi, _ in splits:
            boxes[k, f] = (np.searchsorted(cuts[f], lo) + 1 if math.isfinite(lo) else 0, np.searchsorted(cuts[f], hi) if math.isfinite(hi) else len(cuts[f]))
    return boxes


# payloads


def _chunks(batches, rows: int = CHUNK):
    import pyarrow as pa

    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _batch(payloads: list, parts: list | None = None):
    import pyarrow as pa

    data = pa.array([pickle.dumps(p, 5) for p in payloads], pa.binary())
    return pa.RecordBatch.from_pydict(({"part": pa.array(parts, pa.int32())} if parts is not None else {}) | {"data": data})


def _payloads(batches):
    for b in batches:
        for v in b.column(b.schema.get_field_index("data")):
            yield pickle.loads(v.as_buffer())


def _small(x: np.ndarray, n: int) -> np.ndarray:
    return x.astype(np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.int32)


def _distinct(cols: list[np.ndarray], sizes: list[int]):
    """The first row of each combination, and every row's combination."""
    if math.prod(sizes) < 1 << 62:
        key = cols[0].astype(np.int64)
        for c, n in zip(cols[1:], sizes[1:], strict=True):
            key = key * n + c
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
    else:
        _, first, which = np.unique(np.stack(cols, 1), axis=0, return_index=True, return_inverse=True)
    return first, which.ravel()


def _dealt(codes: list[np.ndarray], parts: int) -> np.ndarray:
    h = np.zeros(len(codes[0]), np.uint64)
    for c in codes:
        h = (h + c.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h >> np.uint64(11)) % np.uint64(parts)).astype(np.int32)


def collapsed(coded, sizes: list[int], extra: int, parts: int):
    """Out of (group codes, number of another key, columns of sums), which is added up by codes and key: batches (part, data) by a hash of the codes."""
    for codes, key, sums in coded:
        first, which = _distinct([*codes, key], [*sizes, extra])
        sums = [np.bincount(which, s, len(first)) for s in sums]
        codes, key = [c[first] for c in codes], key[first]
        part = _dealt(codes, parts)
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(parts + 1))
        found = [(p, order[a:b]) for p, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if b > a]
        yield _batch([([_small(c[i], n) for c, n in zip(codes, sizes, strict=True)], _small(key[i], extra), [s[i] for s in sums]) for _, i in found], [p for p, _ in found])


def merged(payloads, sizes: list[int]):
    """Of the payloads of a part: codes of its distinct cells, and for each pair of key and cell, ordered by key, the key, the cell and the sums."""
    held = list(payloads)
    if not held:
        return None
    codes = [np.concatenate([h[0][g] for h in held]).astype(np.intp) for g in range(len(sizes))]
    key = np.concatenate([h[1] for h in held]).astype(np.int64)
    sums = [np.concatenate([h[2][i] for h in held]) for i in range(len(held[0][2]))]
    del held
    first, cell = _distinct(codes, sizes)
    pair, which = np.unique(key * len(first) + cell, return_inverse=True)
    return [c[first] for c in codes], pair // len(first), pair % len(first), [np.bincount(which, s, len(pair)) for s in sums]


# learning


def _encode(n_features: int):
    """Rows (features, site, label) as blocks with a dictionary for each feature and for the site."""

    def run(batches):
        for t in _chunks(batches):
            cols = []
            for i in range(n_features):
                d = t.column(i).combine_chunks().dictionary_encode()
                values = d.dictionary.to_numpy(zero_copy_only=False)
                if d.null_count or not np.isfinite(values).all():
                    raise ValueError("a feature of the training table is missing or infinite")
                cols.append((values, _small(d.indices.to_numpy(), len(values))))
            site, y = t.column(n_features).combine_chunks().dictionary_encode(), t.column(n_features + 1)
            if y.null_count or not np.isfinite(y := y.to_numpy()).all():
                raise ValueError("a label of the training table is missing or infinite")
            yield _batch([(cols, site.dictionary.to_pylist(), _small(site.indices.to_numpy(), len(site.dictionary)), y)])

    return run


def _added(values: np.ndarray, counts: np.ndarray):
    """Distinct values and their counts; of more than POINTS, so many points of about equal weight."""
    values, which = np.unique(values, return_inverse=True)
    counts = np.bincount(which.ravel(), counts, len(values))
    if len(values) > POINTS:
        ends = np.cumsum(counts)
        at = np.unique(np.searchsorted(ends, ends[-1] * (np.arange(POINTS) + 1) / POINTS).clip(0, len(values) - 1))
        values, counts = values[at], np.diff(ends[at], prepend=0)
    return values, counts


def _summary(found):
    """(value, count) of each feature and rows of each site, of several added up."""
    total, sites = None, {}
    for values, rows in found:
        total = [_added(*v) if total is None else _added(*map(np.concatenate, zip(total[f], v, strict=True))) for f, v in enumerate(values)]
        for k, n in rows.items():
            sites[k] = sites.get(k, 0) + n
    return total, sites


def _summaries(batches):
    counted = (([(v, np.bincount(c, minlength=len(v))) for v, c in cols], dict(zip(sites, np.bincount(s, minlength=len(sites)).tolist(), strict=True))) for cols, sites, s, _ in _payloads(batches))
    total, sites = _summary(counted)
    if total is not None:
        yield _batch([(total, sites)])


def _summaries_of_tasks(batches):
    total, sites = _summary(_payloads(batches))
    if total is not None:
        yield _batch([(total, sites)])


def cut_points(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Spark's rule: halfway between all neighbours, or between those nearest to equal weights if there are more than bins values."""
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    stride, out = counts.sum() / bins, []
    target, ends = stride, np.cumsum(counts)
    for i in range(1, len(values)):
        if abs(ends[i - 1] - target) < abs(ends[i] - target):
            out.append((values[i - 1] + values[i]) / 2)
            target += stride
    return np.array(out[: bins - 1])


def _cells(cuts, sites: dict, sizes: list[int], parts: int):
    def run(batches):
        def coded():
            for cols, names, site, y in _payloads(batches):
                bins = [binned(v, k)[c] for (v, c), k in zip(cols, cuts, strict=True)]
                yield group_codes(bins, [len(k) + 1 for k in cuts]), np.array([sites[s] for s in names])[site], [np.ones(len(y)), y, y * y]

        yield from collapsed(coded(), sizes, len(sites), parts)

    return run


def _blocks(sizes: list[int], n_sites: int):
    """The cells of a task in blocks: group codes, first pair of each site, cells of the pairs, sums of the pairs."""

    def run(batches):
        if (m := merged(_payloads(batches), sizes)) is None:
            return
        codes, site, cell, sums = m
        for a in range(0, len(codes[0]), BLOCK):
            here = (cell >= a) & (cell < a + BLOCK)
            yield _batch([([_small(c[a : a + BLOCK], n) for c, n in zip(codes, sizes, strict=True)], np.searchsorted(site[here], np.arange(n_sites + 1)), (cell[here] - a).astype(np.int32), [s[here] for s in sums])])

    return run


def _histograms(members: list, bins: list[int]):
    """For each member that still grows a tree, of every open leaf and bin of a feature: number, sum and sum of squares of what is to be learnt [3, leaf, bin].

    members: sites left out, trees so far (masks, values with weight), masks and number of the open leaf for each leaf of the tree that grows, how many are open."""
    groups = grouped(bins)
    at = np.cumsum([0, *bins])

    def run(batches):
        total = {}
        for codes, first, cell, sums in _payloads(batches):
            codes, n = [c.astype(np.intp) for c in codes], len(codes[0])
            every = [np.bincount(cell, s, n) for s in sums]
            for m, (left, trees, masks, place, k) in enumerate(members):
                if not k:
                    continue
                w, s, q = (e.copy() for e in every)
                for x in left:
                    own = slice(first[x], first[x + 1])
                    for have, part in zip((w, s, q), sums, strict=True):
                        have[cell[own]] -= part[own]
                if trees:  # twice the residual
                    p = sum(values[leaves(t, codes)] for t, values in trees)
                    q = 4 * (q - p * (2 * s - p * w))
                    s = 2 * (s - p * w)
                leaf = place[leaves(masks, codes)]
                out = total.setdefault(m, np.zeros((3, k, at[-1])))
                for g, code in zip(groups, codes, strict=True):
                    dims = [bins[f] for f in g]
                    i = leaf * math.prod(dims) + code
                    for j, v in enumerate((w, s, q)):
                        h = np.bincount(i, v, (k + 1) * math.prod(dims))[: k * math.prod(dims)].reshape(k, *dims)
                        for d, f in enumerate(g):
                            out[j, :, at[f] : at[f + 1]] += h.sum(tuple(x + 1 for x in range(len(g)) if x != d))
        if total:
            yield _batch([total])

    return run


def _sum(found) -> dict:
    total: dict = {}
    for x in found:
        for m, h in x.items():
            total[m] = total[m] + h if m in total else h
    return total


def _sums(batches):
    if total := _sum(_payloads(batches)):
        yield _batch([total])


def _leaf(box, stats) -> dict:
    return {"box": box, "stats": stats, "split": None}


def _best(h: np.ndarray, at: np.ndarray, least: int, gain_least: float):
    """Of one leaf's histogram [3, bin]: (gain, feature, bin, sums left, sums right) of the best split, or None."""
    total = h[:, at[0] : at[1]].sum(1)
    best = None
    for f in range(len(at) - 1):
        low = np.cumsum(h[:, at[f] : at[f + 1]], axis=1)[:, :-1]
        high = total[:, None] - low
        ok = (low[0] >= least) & (high[0] >= least)
        if ok.any():
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, (low[1] ** 2 / low[0] + high[1] ** 2 / high[0] - total[1] ** 2 / total[0]) / total[0], -np.inf)
            b = int(gain.argmax())
            if best is None or gain[b] > best[0]:
                best = (float(gain[b]), f, b, low[:, b], high[:, b])
    tiny = 1e-12 * total[2] / total[0] if total[0] else 0.0  # no gain but rounding
    return best if best is not None and best[0] > tiny and best[0] >= gain_least else None


def _open(node: dict) -> list[dict]:
    if node["split"] is None:
        return [node]
    return _open(node["children"][0]) + _open(node["children"][1])


def learn(df: DataFrame, site: str, features: list[str], label: str, left_out, members: int, params: dict) -> tuple[list[list[dict]], list[np.ndarray], dict]:
    """For each member its trees (roots of nodes), the thresholds of all features, and all parameters. left_out(sites, member) are the sites that it does not see.

    Spark's boosting with squared error: trees grow by levels, the first learns the labels, each further one twice the residual and counts with stepSize. The thresholds to
    choose from come from the features of all rows and are the same for all members.
    """
    p, sc = PARAMS | params, df.sparkSession.sparkContext
    rows = df.filter(F.col(site).isNotNull()).select(*(F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)), F.col(site).alias("site"), F.col(label).cast("double").alias("label"))
    encoded = rows.mapInArrow(_encode(len(features)), "data binary").cache()  # read and joined once
    found = [pickle.loads(r.data) for r in encoded.mapInArrow(_summaries, "data binary").repartition(8).mapInArrow(_summaries_of_tasks, "data binary").collect()]
    total, counts = _summary(found)
    if total is None:
        raise ValueError("the training table is empty")
    cuts = [cut_points(*v, p["maxBins"]) for v in total]
    bins, place = [len(c) + 1 for c in cuts], {s: i for i, s in enumerate(sorted(counts))}
    sizes = [math.prod(bins[f] for f in g) for g in grouped(bins)]
    parts = max(sc.defaultParallelism, -(-sum(counts.values()) // CELL_ROWS))
    cells = encoded.mapInArrow(_cells(cuts, place, sizes, parts), "part int, data binary").repartitionById(parts, F.col("part")).mapInArrow(_blocks(sizes, len(place)), "data binary").cache()
    cells.count()
    encoded.unpersist()
    left = [[place[s] for s in left_out(list(counts), m)] for m in range(members)]
    if any(len(set(x)) == len(place) for x in left):
        raise ValueError("a member has no site to learn from")
    box = np.array([[0, b - 1] for b in bins])
    at = np.cumsum([0, *bins])
    done: list[list] = [[] for _ in left]  # masks and values
    trees: list[list[dict]] = [[] for _ in left]
    for t in range(p["maxIter"]):
        weight = p["stepSize"] if t else 1.0
        roots = [_leaf(box, None) for _ in left]
        active = [[r] for r in roots]
        for depth in range(max(p["maxDepth"], 1)):
            task = []
            for m, root in enumerate(roots):
                ends = _open(root)
                number = {id(x): i for i, x in enumerate(active[m])}
                spot = np.array([number.get(id(x), len(active[m])) for x in ends], np.intp)
                task.append((left[m], done[m], leaf_masks(np.array([x["box"] for x in ends]), bins), spot, len(active[m])))
            shared = sc.broadcast(task)
            d = cells.mapInArrow(lambda batches, s=shared: _histograms(s.value, bins)(batches), "data binary")
            if parts > 64:
                d = d.repartition(math.isqrt(parts)).mapInArrow(_sums, "data binary")
            sums = _sum(pickle.loads(r.data) for r in d.collect())
            shared.destroy()
            for m, nodes in enumerate(active):
                active[m] = []
                for i, node in enumerate(nodes):
                    h = sums[m][:, i]
                    node["stats"] = h[:, at[0] : at[1]].sum(1)
                    if p["maxDepth"] < 1 or (best := _best(h, at, p["minInstancesPerNode"], p["minInfoGain"])) is None:
                        continue
                    gain, f, b, low, high = best
                    boxes = node["box"].copy(), node["box"].copy()
                    boxes[0][f, 1], boxes[1][f, 0] = b, b + 1
                    node |= {"split": (f, b), "gain": gain, "children": [_leaf(x, s) for x, s in zip(boxes, (low, high), strict=True)]}
                    active[m] += node["children"]
            if not any(active):
                break
        for m, root in enumerate(roots):
            trees[m].append(root)
            ends = _open(root)
            done[m].append((leaf_masks(np.array([x["box"] for x in ends]), bins), np.array([weight * x["stats"][1] / x["stats"][0] for x in ends])))
    cells.unpersist()
    return trees, cuts, p


def spark_model(spark, estimator, trees: list[dict], cuts: list[np.ndarray], step: float):
    """The trees as the model of Spark that the estimator would give."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    ml = jvm.org.apache.spark.ml
    end, inner, split, calculator, part = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, jvm.java.util.Arrays.copyOfRange

    def doubles(v):
        return jvm.org.apache.spark.mllib.linalg.Vectors.fromJson(json.dumps({"type": 1, "values": [float(x) for x in v]})).toArray()

    def listed(x):
        return [x["stats"]] + ([] if x["split"] is None else [s for c in x["children"] for s in listed(c)])

    sums, at = doubles([v for root in trees for s in listed(root) for v in s]), itertools.count(0, 3)

    def node(x):  # in the order of listed()
        i = next(at)
        n, s, q = x["stats"]
        stats = calculator(part(sums, i, i + 3), int(round(n)))
        mean, impurity = float(s / n), max(float(q / n - (s / n) ** 2), 0.0)
        if x["split"] is None:
            return end(mean, impurity, stats)
        f, b = x["split"]
        return inner(mean, impurity, x["gain"], *map(node, x["children"]), split(f, float(cuts[f][b])), stats)

    made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    for i, root in enumerate(trees):
        made[i] = ml.regression.DecisionTreeRegressionModel(f"{estimator.uid}_{i}", node(root), len(cuts))
    model = estimator._create_model(ml.regression.GBTRegressionModel(estimator.uid, made, doubles([1.0] + [step] * (len(trees) - 1)), len(cuts)))
    return estimator._copyValues(model)


class Learnt(PipelineModel):
    """A model of trees that were learnt here; Spark's stages are made when they are asked for, node by node."""

    def __init__(self, make, paths: list):
        self._make, self._made, self.paths = make, None, paths
        super().__init__([])

    @property
    def stages(self) -> list:
        if self._made is None:
            self._made = self._make()
        return self._made

    @stages.setter
    def stages(self, stages: list) -> None:
        self._made = stages or None


def paths(trees: list[dict], cuts: list[np.ndarray], step: float) -> list[list]:
    """(weight, value, splits) of every leaf of each tree; a split is (feature, least, below, share) as in ``model``."""

    def walk(x, weight, held):
        if x["split"] is None:
            return [(weight, float(x["stats"][1] / x["stats"][0]), [(f, *v) for f, v in sorted(held.items())])]
        f, b = x["split"]
        lo, hi, share = held.get(f, (-math.inf, math.inf, 1.0))
        cut, out = float(cuts[f][b]), []
        for child, ends in zip(x["children"], ((lo, min(hi, cut)), (max(lo, cut), hi)), strict=True):
            out += walk(child, weight, held | {f: (*ends, share * float(child["stats"][0] / x["stats"][0]))})
        return out

    return [walk(root, step if t else 1.0, {}) for t, root in enumerate(trees)]
