"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade > j) = logistic(w . x - t_j) with one weight vector w over hashed text features and ordered thresholds t_0 <= t_1 <= ....
The features are hashed character trigrams (of letters, spaces and punctuation alike), as square roots of their shares in the text. The fit is a
full-batch gradient descent (Adam) on the ordinal likelihood with an L2 penalty; the thresholds are kept in order by learning their
gaps as exponentials. A result is the expected grade and the tail probability P(grade >= ``tail_grade``), by which rows are selected.

What is learnt comes from a bounded sample: about ``max_rows`` rated rows, chosen by a hash of the id. Every text is scored whole,
and very long texts are hashed in blocks.

Defined cases: a null or empty text has no features and is scored by the thresholds alone. A null rating is not learnt from; a rating repeated for
an id counts once, the highest. With fewer than two grades every row gets that grade (0 if there is none) and tail probability 1. Repeated rows are
scored alike. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import mapped, unit_hash

BITS = 14
BLOCK = 1_000_000


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of the text and the square roots of their shares."""
    c = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(c) < 1:
        return np.zeros(0, np.int64), np.zeros(0)
    c = np.concatenate(([np.uint32(32)], c, [np.uint32(32)])).astype(np.uint64)
    total = np.zeros(1 << BITS, np.int64)
    for a in range(0, len(c) - 2, BLOCK):
        p = c[a : a + BLOCK + 2]
        h = (p[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (p[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (p[2:] * np.uint64(0x165667B19E3779F9))
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        total += np.bincount((h >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    at = np.flatnonzero(total)
    return at, np.sqrt(total[at] / (len(c) - 2))


class Ordinal:
    """Shared weights and ordered thresholds."""

    def __init__(self, grades, w, thresholds):
        self.grades, self.w, self.t = list(grades), w, np.asarray(thresholds, float)

    def above(self, texts) -> np.ndarray:
        """[texts x thresholds]: P(grade > j-th grade)."""
        s = np.zeros(len(texts))
        for i, x in enumerate(texts):
            at, v = features(x)
            s[i] = float((self.w[at] * v).sum())
        return 1 / (1 + np.exp(-np.clip(s[:, None] - self.t[None, :], -40, 40)))

    def predict(self, texts, tail_grade: int):
        above = self.above(texts)
        g = np.asarray(self.grades, float)
        expected = g[0] + (above * np.diff(g)[None, :]).sum(axis=1) if len(g) > 1 else np.full(len(texts), g[0] if len(g) else 0.0)
        j = int(np.searchsorted(g, tail_grade)) - 1
        tail = np.ones(len(texts)) if j < 0 or len(g) < 2 else above[:, j] if j < above.shape[1] else np.zeros(len(texts))
        return expected, tail


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray, int]], steps: int = 150, rate: float = 0.15, penalty: float = 2e-4) -> Ordinal:
    """rows: (buckets, values, grade)."""
    grades = sorted({r[2] for r in rows})
    d = 1 << BITS
    if len(grades) < 2:
        return Ordinal(grades, np.zeros(d), np.zeros(0))
    y = np.searchsorted(grades, [r[2] for r in rows])
    sizes = np.array([len(r[0]) for r in rows])
    at = np.concatenate([r[0] for r in rows])
    val = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    k, n = len(grades) - 1, len(rows)
    share = np.array([(y > j).mean() for j in range(k)]).clip(1e-3, 1 - 1e-3)
    t0 = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(t0), 1e-3))
    p = np.concatenate([np.zeros(d), t0[:1], gaps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        t = np.concatenate([p[d : d + 1], p[d] + np.cumsum(np.exp(p[d + 1 :]))])
        s = np.bincount(row, weights=p[at] * val, minlength=n)
        edges = np.concatenate([np.full((n, 1), 1.0), 1 / (1 + np.exp(-np.clip(s[:, None] - t[None, :], -40, 40))), np.zeros((n, 1))], axis=1)
        hi, lo = edges[np.arange(n), y], edges[np.arange(n), y + 1]
        mass = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi), lo * (1 - lo)
        gs = -(dhi - dlo) / mass / n
        gt = np.zeros(k)
        np.add.at(gt, np.maximum(y - 1, 0), np.where(y > 0, dhi / mass / n, 0))
        np.add.at(gt, np.minimum(y, k - 1), np.where(y < k, -dlo / mass / n, 0))
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([np.bincount(at, weights=val * gs[row], minlength=d) + penalty * p[:d], tail[:1], tail[1:] * np.exp(p[d + 1 :])])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Ordinal(grades, p[:d].copy(), np.concatenate([p[d : d + 1], p[d] + np.cumsum(np.exp(p[d + 1 :]))]))


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "quality", max_rows: int = 4000, seed: int = 31) -> Ordinal:
    """The model of about ``max_rows`` rated rows. ``ratings`` holds the rows to learn from only."""
    known = ratings.filter(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.max(F.col(grade_col).cast("int")).alias("__g"))
    n = max(known.count(), 1)
    chosen = F.broadcast(known.filter(unit_hash("__id", seed) < min(1.0, max_rows / n)))  # about max_rows ids: a proven bound
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text")).join(chosen, "__id")

    def hashed(batches):
        for b in batches:
            f = [features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"g": b.column(2), "at": pa.array([x[0].astype(np.int32) for x in f], pa.list_(pa.int32())), "v": pa.array([x[1].astype(np.float32) for x in f], pa.list_(pa.float32()))})

    table = mapped(rows.select("__id", "text", "__g"), hashed, "g int, at array<int>, v array<float>").toArrow()
    ats, vs = table.column("at").combine_chunks(), table.column("v").combine_chunks()
    return fit_ordinal([(np.asarray(ats[i].values, dtype=np.int64), np.asarray(vs[i].values, dtype=float), g) for i, g in enumerate(table.column("g").to_pylist())])


def rate(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text", tail_grade: int = 1, select_at: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_prob and selected (tail_prob >= ``select_at``) for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            expected, tail = shared.value.predict(b.column(1).to_pylist(), tail_grade)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "expected_grade": pa.array(expected, pa.float64()), "tail_prob": pa.array(tail, pa.float64()), "selected": pa.array(tail >= select_at, pa.bool_())})

    return mapped(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run, "doc_id long, expected_grade double, tail_prob double, selected boolean")
