"""Toxicity by the nearest labelled examples.

Examples and texts are TF-IDF vectors over words and the beginnings of words (``STEMS`` code points long); the k examples with the highest exact
cosine vote with their similarity as weight (k is a twentieth of the examples, 15 at least), and a logistic curve turns the vote into a probability. It is fitted on the examples' own votes,
each without the example itself, so no row votes on its own label. The ids of the nearest voters are the evidence.

The labels play no part in the vectors: a term counts if at least ``min_df`` examples hold it and no more than ``max_df`` of them do (what most
texts hold tells them apart least, and has the longest postings). Weights are (1 + ln count) * idf, scaled to norm 1.

The search goes over a block-max inverted index: the postings of each term are cut into blocks of ``BLOCK`` examples, with the highest weight
of each. Postings of the terms that over ``DENSE`` of the examples hold are kept with their gaps, as arrays over all examples, and added up at
once; the k-th highest of these parts is a lower bound of the k-th similarity, as no weight is negative. A query bounds the cosine of every block by the
maxima, and only blocks whose bound reaches that value are read, and scored exactly. Examples are ordered by their most telling terms before they
are cut into blocks, so that like examples stand together.

What is learnt comes from a bounded sample: about ``max_examples`` labelled rows, chosen by a hash of the id, in the ratio that the labels
have. The index is bounded by the texts of that sample and goes to every task as a broadcast.

Defined cases: a null or empty text, or one with none of the terms, has no neighbours and gets the smoothed share of positive
examples among those without neighbours. A null label, or one without a text, is not learnt from; with no labelled rows every score is 0. Ties between
examples go to the smaller id. Rows repeated are scored alike; a label repeated for an id counts once, the highest. Very long texts are cut
into words in one pass. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import logistic, mapped, trim, unit_hash

WORD = re.compile(r"\w+")
STEMS = (4, 5, 7)
BLOCK = 256
#: Terms that over this share of the examples hold have postings without gaps.
DENSE = 0.05
#: Words whose terms are kept.
CACHE = 300_000
#: What an index makes again in each worker.
DERIVED = ("dense", "whole", "starts", "words", "numbers")


def terms_of(word: str) -> list[str]:
    """The word itself and its beginnings; the latter carry a mark, so that they differ from words."""
    return [word, *(word[:n] + "~" for n in STEMS if len(word) >= n)]


def term_counts(text: str) -> Counter:
    out: Counter = Counter()
    for word, c in Counter(WORD.findall(text.lower())).items():
        for t in terms_of(word):
            out[t] += c
    return out


class Index:
    """Block-max inverted index of the examples."""

    def __init__(self, ids, docs: Iterable[Counter], labels, k: int = 200, min_df: int = 3, max_df: float = 0.5):
        """``docs`` is read once, one bag of terms at a time: only numbers of terms are kept of it."""
        self.k = k
        seen: dict[str, int] = {}
        bags = []
        for d in docs:
            bags.append((np.fromiter((seen.setdefault(t, len(seen)) for t in d), np.int32, len(d)), np.fromiter(d.values(), np.int32, len(d))))
        n, names = len(bags), list(seen)
        df = np.bincount(np.concatenate([b[0] for b in bags] or [np.zeros(0, np.int32)]), minlength=len(names))
        numbers = np.flatnonzero((df >= min_df) & (df <= max(max_df * n, min_df))).tolist()
        numbers.sort(key=lambda i: (df[i] <= DENSE * n, names[i]))  # the common ones first
        self.terms = {names[i]: j for j, i in enumerate(numbers)}
        share = df[numbers]
        self.common = int((share > DENSE * n).sum())
        self.idf = np.log((n + 1) / (share + 0.5))
        place = np.full(len(names), -1, np.int32)
        place[numbers] = np.arange(len(numbers), dtype=np.int32)
        del seen, names
        vectors = [self._vector(place[c], x) for c, x in bags]
        del bags
        # like examples stand together: by their heaviest common terms
        signs = [tuple(at[np.argsort(-share[at], kind="stable")[:3]].tolist()) for at, _ in vectors]
        order = sorted(range(n), key=lambda i: (signs[i], ids[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.y = np.array([labels[i] for i in order], float)
        self.vectors = [vectors[i] for i in order]
        blocks = -(-n // BLOCK)
        at = np.concatenate([v[0] for v in self.vectors] or [np.zeros(0, np.int64)])
        who = np.repeat(np.arange(n), [len(v[0]) for v in self.vectors])
        w = np.concatenate([v[1] for v in self.vectors] or [np.zeros(0, np.float32)])
        by = np.lexsort((who, at))
        self.who, self.weight = who[by].astype(np.int32), w[by]
        cell = at[by] * blocks + self.who // BLOCK
        self.blocks = blocks
        self.start = np.searchsorted(cell, np.arange(len(share) * blocks + 1)).astype(np.int32)
        self.peak = np.zeros(len(share) * blocks, np.float32)
        np.maximum.at(self.peak, cell, self.weight)
        self.peak = self.peak.reshape(len(share), blocks)
        self.alone = 0.0
        self.cal = (1.0, 0.0)
        self._derive()

    def _derive(self) -> None:
        """What follows from the postings and the terms; it is made again in each worker, not sent."""
        self.dense = np.zeros((self.common, self.blocks * BLOCK), np.float32)
        plain = int(self.start[self.common * self.blocks])
        row = np.repeat(np.arange(self.common), np.diff(self.start[: self.common * self.blocks + 1 : self.blocks]))
        self.dense[row, self.who[:plain]] = self.weight[:plain]
        self.whole = {t: i for t, i in self.terms.items() if not t.endswith("~")}
        self.starts = [(n, {t[:-1]: i for t, i in self.terms.items() if t.endswith("~") and len(t) == n + 1}) for n in STEMS]
        self.words: dict[str, int] = {}
        self.numbers = np.zeros((0, 1 + len(STEMS)), np.int32)

    def release(self) -> None:
        """Drop what searches need, here only: an index that is sent to a task makes it again there."""
        for name in DERIVED:
            self.__dict__.pop(name, None)
        self.vectors = []
        trim()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in DERIVED}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._derive()

    def _weigh(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.zeros(0, np.float32)
        w = (1 + np.log(count)) * self.idf[at]
        norm = math.sqrt(float((w * w).sum()))
        return (w / norm if norm else w).astype(np.float32)

    def _vector(self, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers, ascending, and weights of norm 1; a number below 0 is no term."""
        by = np.argsort(at, kind="stable")[int((at < 0).sum()) :]
        at = at[by].astype(np.int64)
        return at, self._weigh(at, count[by])

    def _learn(self, words: list[str]) -> None:
        """Give words a row of the numbers of their terms; the rows are dropped when there are too many."""
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = set(words)
        first = len(self.words)
        if first + len(new) > len(self.numbers):
            more = np.zeros((max(first + len(new), 2 * first, 1024), 1 + len(STEMS)), np.int32)
            more[:first] = self.numbers[:first]
            self.numbers = more
        whole, starts = self.whole, self.starts
        rows = [[whole.get(word, -1), *(known.get(word[:n], -1) if len(word) >= n else -1 for n, known in starts)] for word in new]
        if rows:
            self.numbers[first : first + len(rows)] = rows
        self.words.update(zip(new, range(first, first + len(rows)), strict=True))

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The same of a text; the terms of a word are looked up once."""
        words = WORD.findall(text.lower())
        try:
            at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        except KeyError:
            self._learn(words)
            at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        at, count = np.unique(at, return_counts=True)
        numbers = self.numbers[at]
        held = numbers >= 0
        if not held.any():
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        terms, place = np.unique(numbers[held], return_inverse=True)
        terms = terms.astype(np.int64)
        return terms, self._weigh(terms, np.bincount(place, np.repeat(count, held.sum(axis=1))))

    def nearest(self, at: np.ndarray, w: np.ndarray, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples, similarity above 0, ties to the smaller id."""
        if not len(at) or not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        bound = np.einsum("i,ij->j", w, self.peak[at])  # not by BLAS, whose threads would take other tasks' cores
        rare = int(np.searchsorted(at, self.common))
        score = np.einsum("i,ij->j", w[:rare], self.dense[at[:rare]]).astype(np.float64)
        if leave >= 0:
            score[leave] = 0.0
        at, w, open_ = at[rare:], w[rare:], bound > 0
        if self.k < len(score):  # what the common terms give is a part of the cosine, so its k-th highest value bounds the k-th similarity from below
            open_ &= bound >= np.partition(score, len(score) - self.k)[len(score) - self.k] - 1e-5
        edge = np.flatnonzero(np.diff(open_, prepend=False, append=False))  # open blocks that stand together are read at once
        cells = at[:, None] * self.blocks + edge[None, :]
        first, last = self.start[cells[:, ::2]].ravel(), self.start[cells[:, 1::2]].ravel()
        size = last - first
        place = np.repeat(last - np.cumsum(size, dtype=np.int32), size)
        place += np.arange(len(place), dtype=np.int32)
        score += np.bincount(self.who[place], self.weight[place] * np.repeat(np.repeat(w, len(edge) // 2), size), len(score))
        if leave >= 0:
            score[leave] = 0.0
        score[np.repeat(~open_, BLOCK)] = 0.0
        least = float(np.partition(score, len(score) - self.k)[len(score) - self.k]) if self.k < len(score) else 0.0
        found = np.flatnonzero(score > max(least - 1e-7, 1e-6))
        s = np.round(score[found], 7)  # sums in another order differ in later places
        top = np.lexsort((self.ids[found], -s))[: self.k]
        return found[top], s[top].astype(np.float32)

    def vote(self, at, w, leave: int = -1) -> tuple[float | None, np.ndarray]:
        i, s = self.nearest(at, w, leave)
        total = float(s.sum())
        return (float((s * self.y[i]).sum()) / total if total else None, i)

    def calibrate(self) -> None:
        votes, truth, none = [], [], []
        for n, (at, w) in enumerate(self.vectors):
            v, _ = self.vote(at, w, n)
            (none if v is None else truth).append(self.y[n])
            if v is not None:
                votes.append(v)
        if votes:
            self.cal = logistic(votes, np.array(truth) > 0.5)
        rate = float(self.y.mean()) if len(self.y) else 0.0
        self.alone = float((sum(none) + rate) / (len(none) + 1))

    def score(self, text: str | None) -> tuple[float, np.ndarray]:
        at, w = self.vector(text or "")
        v, who = self.vote(at, w)
        if v is None:
            return self.alone, self.ids[:0]
        x = self.cal[0] * v + self.cal[1]
        return float(1 / (1 + math.exp(-min(max(x, -40.0), 40.0)))), self.ids[who]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_examples: int = 4000, k: int = 200, seed: int = 23) -> Index | None:
    """The index of about ``max_examples`` labelled rows; ``k`` neighbours at most vote. ``labels`` holds the rows to learn from only."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__y"))
    known = known.withColumn("__y", (F.col("__y") > 0).cast("int"))
    size = known.count()
    if not size:
        return None
    chosen = F.broadcast(known.filter(unit_hash("__id", seed) < min(1.0, max_examples / size)))  # about max_examples ids: a proven bound
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text")).join(chosen, "__id").filter(F.col("text").isNotNull())

    def count(batches):
        for b in batches:
            out = [term_counts(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": b.column(0), "y": b.column(2), "terms": pa.array([list(c) for c in out], pa.list_(pa.string())), "n": pa.array([list(c.values()) for c in out], pa.list_(pa.int32()))})

    table = mapped(rows.select("__id", "text", "__y"), count, "id long, y int, terms array<string>, n array<int>").toArrow()
    ids, labels, at = table.column("id").to_pylist(), table.column("y").to_pylist(), {}

    def bag(i: int) -> Counter:
        return Counter(dict(zip(table.column("terms")[i].as_py(), table.column("n")[i].as_py(), strict=True)))

    for i, key in enumerate(ids):
        if key not in at or sorted(bag(i).items()) < sorted(bag(at[key]).items()):  # an id with several texts: the same one whatever the partitions
            at[key] = i
    if not at:
        return None
    order = [at[key] for key in sorted(at)]
    index = Index(sorted(at), map(bag, order), [labels[i] for i in order], min(k, max(15, len(at) // 20)))
    del table
    index.calibrate()
    index.release()
    return index


def score(docs: DataFrame, index: Index | None, id_col: str = "doc_id", text_col: str = "text", evidence: int = 15) -> DataFrame:
    """doc_id, score, predicted and evidence (ids of the nearest labelled examples, the nearest first) for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        model = shared.value
        for b in batches:
            got = [model.score(t) if model else (0.0, []) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "score": pa.array([g[0] for g in got], pa.float64()), "predicted": pa.array([int(g[0] >= 0.5) for g in got], pa.int32()), "evidence": pa.array([g[1][:evidence] for g in got], pa.list_(pa.int64()))})

    return mapped(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run, "doc_id long, score double, predicted int, evidence array<long>")
