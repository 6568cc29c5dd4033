"""Toxicity: the search against whole TF-IDF vectors, held-out accuracy, defined cases."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridloom.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


def brute(texts, query, k, min_df, max_df):
    """(place, cosine) of the k nearest texts, by dictionaries over every term."""

    def terms(text):
        out = Counter()
        for w in re.findall(r"\w+", text.lower()):
            out.update([w] + [w[:n] + "~" for n in (4, 5, 7) if len(w) >= n])
        return out

    bags = [terms(t) for t in texts]
    df = Counter(t for b in bags for t in b)
    known = {t for t, c in df.items() if min_df <= c <= max(max_df * len(texts), min_df)}

    def vector(bag):
        v = {t: (1 + math.log(c)) * math.log((len(texts) + 1) / (df[t] + 0.5)) for t, c in bag.items() if t in known}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    q = vector(terms(query))
    sims = [(sum(x * v.get(t, 0.0) for t, x in q.items()), i) for i, v in enumerate(map(vector, bags))]
    return sorted(((round(s, 5), i) for s, i in sims if s > 1e-6), key=lambda x: (-x[0], x[1]))[:k]


@pytest.mark.parametrize("k", [3, 15, 1000])
def test_search_equals_whole_vectors(k, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 16)  # many blocks, so that bounds rule some out
    monkeypatch.setattr(toxicity, "CACHE", 100)  # fewer than the words there are
    rng = random.Random(k)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(150)]
    texts = [" ".join(rng.choice(vocab[g * 50 : g * 50 + 70]) for _ in range(rng.randrange(1, 40))) for g in (0, 1, 2) for _ in range(90)]
    texts += texts[:8]  # ties
    index = toxicity.Index(list(range(len(texts))), [toxicity.term_counts(t) for t in texts], [0] * len(texts), k, 3, 0.3)
    for query in texts[::23] + [" ".join(vocab[:20]), "no such words", ""]:
        want = brute(texts, query, k, 3, 0.3)
        i, s = index.nearest(*index.vector(query))
        got = [(float(x), int(index.ids[j])) for j, x in zip(i, s, strict=True)]
        assert len(got) == len(want)
        assert all(abs(a[0] - b[0]) < 2e-5 for a, b in zip(got, want, strict=True))
        last = want[-1][0] if want else 0
        assert {j for x, j in got if x > last + 2e-5} == {j for x, j in want if x > last + 2e-5}


def test_leaving_a_row_out(monkeypatch):
    texts = ["one two three four"] * 3 + ["five six seven eight"] * 3
    index = toxicity.Index(list(range(6)), [toxicity.term_counts(t) for t in texts], [1, 0, 0, 1, 1, 1], 15, 1, 1.0)
    for n, (at, w) in enumerate(index.vectors):
        i, _ = index.nearest(at, w, n)
        assert n not in i and len(i) == 2


def test_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = queries.op4_toxicity(spark, SF).join(labels, "doc_id").join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.93 * len(held)
    assert sum(len(r.evidence) > 0 for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 and len(r.evidence) <= 15 for r in got)


def test_cases(spark):
    rows = [(i, ("stupid moron idiot " if i % 2 else "lovely fine day ") * 3 + f"word{i % 7}") for i in range(60)]
    rows += [(60, None), (61, ""), (62, "?!"), (None, "stupid moron"), (1, rows[1][1]), (63, "stupid " * 60_000)]
    docs = spark.createDataFrame([(i, t, 0, 1.0) for i, t in rows], "doc_id long, text string, __id long, score double")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(1, 0, 0), (60, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, toxic int, __y int")
    index = toxicity.fit(docs, labels)
    assert len(index.ids) == 60  # a repeated label counts once, null texts and ids do not
    out = toxicity.score(docs, index).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add((r.score, r.predicted))
    assert by[1] == by[3] or all(p == 1 for _, p in by[1] | by[3])
    assert len(by[1]) == 1 and by[60] == by[61] == by[62]
    assert {p for _, p in by[None]} == {1} and {p for _, p in by[63]} == {1} and {p for _, p in by[2]} == {0}
    assert toxicity.score(docs.limit(0), index).count() == 0
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.fit(docs.filter("text is null"), labels) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs, index).filter(F.col("score").isNull()).count() == 0
