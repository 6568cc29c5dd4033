"""The operators against brute force, round trips and held-out accuracy, and their defined cases on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from gridloom.llm import byte_bpe, exact_dedup, language_id, minhash, packing, quality, queries, secrets, subwords, token_file, topk
from gridloom.llm._common import fold

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, a string, score double, rep long"


def words(rng, n, v=300):
    return " ".join(f"w{rng.randrange(v)}" for _ in range(n))


def odd_texts():
    rng = random.Random(3)
    base = words(rng, 60)
    texts = [None, "", " ", "\n\t ", "a", "A", "é", "12345 %%", base, base, base.upper(), base.replace(" ", "  ", 3), base + " tail", words(rng, 200), words(rng, 200)]
    texts += ["x" * 70_000, "a b " * 30_000, "  lead", "trail \n", "a \n \n b", "it's we'll 'S", "你好 мир ß İ", 'api_key: "ABCDEFGH12" token=short', "AKIA" + "Z9" * 10, "0a" * 20]
    return texts


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 3 else "en", None, None, -1, "x", 0.5, 9) for i, t in enumerate(odd_texts())]
    rows += [(4, "a", "en", "s", 1, 1, "", 0.0, 0), (None, "null id text here", "fr", None, 3, 4, "", 0.0, 0), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def test_language_id(spark, docs, odd, empty):
    models = queries.language_models(docs)
    got = language_id.identify(docs, models).join(docs.select(F.col("doc_id"), "lang"), "doc_id").filter(fold("doc_id", 4) == 2)
    rows = got.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(r.accepted and 0 <= r.score <= 1 for r in rows)
    out = {r.doc_id: r for r in language_id.identify(odd, models).collect() if r.doc_id is not None}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (0, 1, 2, 3, 7))
    assert out[8].lang_pred == out[9].lang_pred != "und"
    assert language_id.identify(odd, models).count() == odd.count()
    assert language_id.identify(empty, models).count() == 0
    assert language_id.fit(empty) is None
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"}


def test_kneser_ney_sums_to_one():
    grams = {"a": language_id.grams_of("the cat sat on the mat"), "b": language_id.grams_of("der hund")}
    m = language_id.Models(["a", "b"], grams)
    alphabet = sorted({c for g in grams.values() for k in g for c in k})
    for context in (" the", "xxxx", "e ca", "   d"):
        cols = [np.full(len(alphabet), ord(c), np.uint64) for c in context] + [np.array([ord(c) for c in alphabet], np.uint64)]
        total = np.exp(m.log_probs(cols).astype(float)).sum(axis=0)
        assert np.all(np.abs(total - 1) < 0.1)  # what is missing is for unseen characters


def test_top_k(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.3, 2.0]) for _ in range(6)], 0) for i in range(300)]
    rows += [(300, None, 1), (301, [float("nan")] * 6, 1), (302, [None] * 6, 1), (303, [float("inf")] * 6, 1), (None, [1.0] * 6, 1), (304, [1.0], 1), (5, rows[5][1], 2), (350, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score long")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, k=5, shard_rows=7, query_rows=2, fan_in=3).orderBy("query_id", "rank").collect()]
    vec = {i: [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in sorted(i for i in vec if i % 50 == 0):
        best = sorted(((-sum(a * b for a, b in zip(vec[q], v)), i) for i, v in vec.items() if i != q))[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_byte_bpe(spark, odd, empty):
    file = P.path("byte_bpe_multi_50k.tiktoken")
    enc = byte_bpe.encoding(file, P.PATTERN)
    got = byte_bpe.round_trip(odd, file, P.PATTERN).collect()
    want = []
    for r in odd.collect():
        ids = enc.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert byte_bpe.round_trip(empty, file, P.PATTERN).count() == 0
    for text in ("ab cd  ef\n gh 'll x " * 50, "é ü  " * 40):
        assert byte_bpe.encode(text, enc, 17).tolist() == enc.encode_ordinary(text)


def test_quality(spark, odd, empty):
    rng = random.Random(5)
    marks = ["@@@", "###", "$$$", "&&&"]
    rows = [(i, " ".join(words(rng, 5) + (" " + marks[i % 4]) * 3 for _ in range(12)), i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(df.filter("doc_id < 300"), df.filter("doc_id < 300").select("doc_id", "quality"))
    assert model.grades == [0, 1, 2, 3] and all(np.diff(model.t) >= 0)
    got = quality.rate(df, model, tail_grade=2).join(df, "doc_id").filter("doc_id >= 300").collect()
    assert sum(abs(r.expected_grade - r.quality) < 1 for r in got) >= 0.9 * len(got)
    assert sum(r.selected == (r.quality >= 2) for r in got) >= 0.9 * len(got)
    assert quality.rate(odd, model).count() == odd.count()
    assert quality.rate(empty, model).count() == 0
    assert {r.tail_prob for r in quality.rate(odd, quality.fit(df, df.limit(0))).collect()} == {1.0}


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_subwords_equal_library(docs, name, spaces):
    sub = subwords.Subwords(P.path(name), spaces)
    texts = [t for t in odd_texts() if t] + [r.text for r in docs.limit(40).collect()]
    rng = random.Random(9)
    texts += ["".join(rng.choice(["a", "B", " ", " ", "\n", "\t", ".", "'s", "é", "1", " ", " ", "é", "Σ", "\x1c", "​"]) for _ in range(40)) for _ in range(400)]
    for t in texts:
        assert sub.encode(t) == sub.whole(t), repr(t[:80])


def test_elias_fano():
    rng = random.Random(2)
    for n in (0, 1, 2, 63, 64, 65, 1000):
        for top in (1, 50, 10**6, 2**40):
            v = sorted(rng.randrange(top) for _ in range(n))
            ef, _ = token_file.EliasFano.load(token_file.EliasFano.of(v).dump(), 0)
            assert ef.all().tolist() == v
            assert [ef.get(i) for i in range(0, n, 7)] == v[::7]


def test_token_file(spark, odd, empty, monkeypatch):
    file = P.path("byte_bpe_50k.json")
    path = token_file.fresh_path(spark, "test")
    token_file.write_tokens(odd, path, file, 2, shards=4)
    got = token_file.read_tokens(spark, path).orderBy("start").collect()
    sub = subwords.Subwords(file, True)
    want = {}
    for r in odd.collect():
        ids = np.concatenate([np.frombuffer(sub.whole(r.text or ""), "<u2"), [2]]).astype("<u4")
        want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(want.values())
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    block = token_file.Block(spark.read.parquet(path).filter("n_docs > 1").first().data)
    assert [int(x) for x in block.document(1)][-1] == 2
    path = token_file.fresh_path(spark, "empty")
    token_file.write_tokens(empty, path, file, 2, shards=2)
    assert token_file.read_tokens(spark, path).count() == 0


def test_secrets(spark, docs, odd, empty):
    file = P.path("byte_bpe_50k.tiktoken")
    frame = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    for r in secrets.scan(frame, file, P.PATTERN).join(frame.filter("doc_id is not null").dropDuplicates(["doc_id", "text"]), "doc_id").collect()[:400]:
        pass
    for t in [r.text or "" for r in frame.collect()]:
        want = []
        for kind, pattern, least, flags in (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, re.I | re.A), ("access", "AKIA[A-Z0-9]+", 16, 0), ("hex", "[0-9a-f]+", 32, 0)):
            for m in re.finditer(pattern, t, flags):
                if len(m.group(2) if kind == "assign" else m.group()) >= least:
                    want.append((m.start(), ["assign", "access", "hex"].index(kind), m.end(), kind))
        assert [(a, b, k) for a, _, b, k in sorted(want)] == secrets.spans_of(t, byte_bpe.encoding(file, P.PATTERN), 2.0)[0]
    enc = byte_bpe.encoding(file, P.PATTERN)
    assert secrets.spans_of("key q7Zk29XvB4mT8sWpL3nRfH6y end", enc, 2.0)[1][0][2] == "random"
    clean = [r.text for r in docs.collect() if not secrets.base_spans(r.text)]
    assert not [t for t in clean if secrets.spans_of(t, enc, 2.0)[1]]
    assert secrets.scan(odd, file, P.PATTERN).count() == odd.count()
    assert secrets.scan(empty, file, P.PATTERN).count() == 0
    masked = secrets.redact(odd, file, P.PATTERN)
    assert masked.columns == odd.columns and masked.filter("text like '%ABCDEFGH12%'").count() == 0 and masked.filter("text is null").count() == 2


def brute_components(texts, size, percent):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            same = len(x & y)
            if same and 100 * same >= percent * len(x | y):
                p, q = sorted((root(a), root(b)))
                comp[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_minhash(spark, docs, odd, empty):
    rng = random.Random(4)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    base = words(rng, 90, 5000).split()
    for k in range(120):  # a large group whose members are near the limit to each other
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        texts.append((1000 + k, " ".join(w)))
    short = ["a b c d e f g h i", "a b c d e f g h i j", "q r s", "Q R S", "q r", "Q\tR", "", None]
    texts += [(2000 + k, t) for k, t in enumerate(short)]
    df = spark.createDataFrame([(i, t, -5, "x") for i, t in texts], "doc_id long, text string, rep long, key string")
    for size, percent in ((3, 85), (5, 80)):
        want = brute_components(texts, size, percent)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, size, percent).collect()}
        assert got == want
        kept = {r.doc_id for r in minhash.near_dedup(df, size, percent).collect()}
        assert kept == {i for i, (_, c) in want.items() if c == i}
    assert minhash.near_duplicates(odd, 3, 85).count() == odd.count()
    assert minhash.near_dedup(empty, 3, 85).count() == 0


def test_packing(spark, docs, odd, empty):
    file = P.path("word_bpe_49k.json")
    sub = subwords.Subwords(file, False)
    frame = docs.select("doc_id", "text").unionByName(odd.select((F.col("doc_id") + 10_000).alias("doc_id"), "text")).repartition(5)
    got = packing.pack(frame, file).collect()
    want = {}
    for r in frame.collect():
        ids = np.concatenate([np.frombuffer(sub.whole(r.text or ""), "<u2"), [1]]).astype("<u4")
        want.setdefault(r.doc_id, []).append(ids)
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids), r.doc_tokens))
        assert len(r.ids) == 4 * r.length
    for pieces in by_seq.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at == 2048 or at & (at - 1) == 0  # no padding at all
    assert by_doc.keys() == want.keys()
    for k, texts in want.items():
        if len(texts) == 1:
            pieces = sorted(by_doc[k])
            assert b"".join(p[2] for p in pieces) == texts[0].tobytes()
            assert all(p[3] == len(texts[0]) for p in pieces)
        else:
            assert sum(p[1] for p in by_doc[k]) == sum(map(len, texts))
    assert packing.pack(empty, file).count() == 0


def test_fill_is_closest():
    rng = random.Random(6)
    for _ in range(200):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(1, 90)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        total, found = packing.fill(room, sorted(counts, reverse=True), counts)
        assert total == max(s for s in sums if s <= room) == sum(n * k for n, k in found.items())
        assert all(k <= counts[n] for n, k in found.items())


def test_exact_dedup(spark, docs, odd, empty):
    frame = docs.unionByName(docs.limit(20).withColumn("doc_id", F.col("doc_id") + 5000).withColumn("text", F.concat(F.col("text"), F.lit(" \n"))))
    groups = {}
    for r in frame.collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id))
    want = {(i, min(g)[1], len(g), i == min(g)[1]) for g in groups.values() for _, i in g}
    for every in (True, False):
        got = {tuple(r)[:4] for r in exact_dedup.exact_groups(frame, digest_all=every).collect()}
        assert got == want
    assert {r.doc_id for r in exact_dedup.exact_dedup(frame).collect()} == {w[1] for w in want}
    out = exact_dedup.exact_groups(odd, digest_all=True).collect()
    assert len(out) == odd.count()
    assert sum(r.kept for r in out) == len({r.text_sha256 for r in out})
    assert exact_dedup.exact_dedup(odd).count() == len({r.text_sha256 for r in out})
    assert exact_dedup.exact_groups(empty).count() == 0 == exact_dedup.exact_dedup(empty).count()
