"""The pipeline, stage by stage and as a whole, against brute force; odd rows, empty tables and clashing columns."""

import os
import random
import re
import sys

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from gridloom.llm import byte_bpe, queries, secrets  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __gone long, __dropped string, __norm string, row int, before long, h string"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """The documents of the smallest fixture, with planted copies, repeated and null ids, nulls in every column and clashing names."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rng = random.Random(8)
    good = [r for r in docs if len(r[1].split()) > 60][:6]
    extra = [(9000 + i, r[1].replace(" ", "  "), r[2], r[3], r[4]) for i, r in enumerate(good)]  # exact copies, longer
    for i, r in enumerate(good):
        w = r[1].split(" ")
        w[rng.randrange(len(w))] = "changed"
        extra.append((9100 + i, " ".join(w), None, None, None))
    extra += [(good[0][0], None, None, None, None), (good[0][0], good[1][1], "en", "s", 3), (None, good[2][1] + " more", "en", "s", 1), (None, None, None, None, None), (None, good[2][1] + " more", None, None, None)]
    extra += [(9200, "", "en", "s", 0), (9201, "12345 %%", "en", "s", 8), (9202, "我们今天去公园散步然后回家吃饭看电视" * 20, "zh", "s", 1), (9203, " ".join(rng.sample(good[3][1].split(), 50)) + "\npassword: 'hunter2hunter2'", "en", "s", 1)]
    rows = [(*r, 1, "x", None, i, None, "h") for i, r in enumerate(docs + extra)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    return path


def key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def found(df):
    return sorted((key((r.doc_id, r.text, r.lang, r.source, r.n_chars)) for r in df.collect()))


def plain(rows):
    return sorted(key(r) for r in rows)


def by_language(spark, docs, rows):
    m = queries.language_models(docs)
    lang, _, _, ok = m.predict([r[1] or "" for r in rows])
    return [r for r, g, k in zip(rows, lang, ok, strict=True) if k and g != "und"]


def by_text(rows):
    best = {}
    for r in rows:
        k = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        rank = (-len(r[1] or ""), r[0] is None, r[0] or 0)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, r)
    return {k: v[1] for k, v in best.items()}


def near(rows, size=5, percent=80):
    from test_ops import brute_components

    comp = brute_components([(r[0], r[1]) for r in rows if r[0] is not None], size, percent)
    return [r for r in rows if r[0] is None or comp[r[0]][1] == r[0]]


def mask(text):
    enc = byte_bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    out, at = "", 0
    for a, b, _ in secrets.spans_of(text, enc, 2.0)[1]:
        out += text[at:a] + ("[SECRET]" if a >= at else "")
        at = max(at, b)
    return out + text[at:]


def test_stages_and_whole(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    stage = dict(corpus_pipeline.STAGES)

    kept = stage["language_id"](spark, docs, table)
    assert kept.columns == docs.columns
    rows = by_language(spark, docs, rows)
    assert found(kept) == plain(rows)
    assert sum(r[0] is None for r in rows) == 2 and not {9200, 9201, 9202} & {r[0] for r in rows}

    kept = spark.createDataFrame(kept.collect(), docs.schema)
    single = stage["exact_dedup"](spark, kept, table)
    assert single.columns == docs.columns
    want = by_text(rows)
    got = [tuple(r) for r in single.select("doc_id", "text").collect()]
    assert sorted(map(key, got)) == sorted(key(r[:2]) for r in want.values())

    single = spark.createDataFrame(single.collect(), docs.schema)
    rows = [tuple(r) for r in single.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert len({r[0] for r in rows}) == len(rows)  # so that brute force may go by the id
    apart = stage["minhash_near_dedup"](spark, single, table)
    rows = near(rows)
    assert apart.columns == docs.columns and found(apart) == plain(rows)

    apart = spark.createDataFrame(apart.collect(), docs.schema)
    clean = stage["secret_scan"](spark, apart, table)
    rows = [(r[0], t := mask(r[1]), r[2], r[3], len(t)) for r in rows]
    assert clean.columns == docs.columns and found(clean) == plain(rows)
    assert any("[SECRET]" in r[1] for r in rows)

    def tokens(pieces):
        out = {}
        for r in sorted(pieces, key=lambda r: r.start):
            out[r.doc_id] = out.get(r.doc_id, b"") + bytes(r.ids)
        return out

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {r[0]: np.array([*tok.encode(r[1], add_special_tokens=False).ids, 1], "<u4").tobytes() for r in rows}
    assert tokens(stage["packing"](spark, spark.createDataFrame(clean.collect(), docs.schema), table).collect()) == want
    assert tokens(corpus_pipeline.run(spark, table).collect()) == want


def test_stages_on_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, empty, str(tmp_path)).count() == 0
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_good_rows_with_shared_ids_stay(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, table)
    shared = docs.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    both = kept.join(shared, kept.doc_id.eqNullSafe(shared.doc_id), "left_semi").filter(F.length("text") > 60)
    assert both.count() == 4  # two of the repeated id, two without an id; their null texts went
