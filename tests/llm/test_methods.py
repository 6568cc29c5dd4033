"""The methods behind the operators against plain versions: language models, digests, added tokens, packing plans, secrets."""

import hashlib
import math
import random
import re
import uuid
import zlib
from base64 import b64encode
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm import byte_bpe, exact_dedup, language_id, minhash, packing, queries, secrets, subwords, token_file

SF = "/root/testdata/sf0.001"


# language models


def plain_kneser_ney(texts, order=5):
    """ln p(last character | the ones before) of interpolated Kneser-Ney, by dictionaries."""
    counts = {order: Counter()}
    for t in texts:
        s = " " * (order - 1) + re.sub(r"[^a-z]+", " ", t.lower()).strip() + " "
        counts[order].update(s[i : i + order] for i in range(len(s) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    vocab = len(counts[1]) + 1
    total, kinds, discount = defaultdict(int), defaultdict(int), {}
    for k, c in counts.items():
        one, two = (sum(v == n for v in c.values()) for n in (1, 2))
        discount[k] = min(max(one / max(one + 2 * two, 1), 0.1), 0.95)
        for g, v in c.items():
            total[k, g[:-1]] += v
            kinds[k, g[:-1]] += 1

    def p(g):
        k = len(g)
        if not k:
            return 1 / vocab
        t = total[k, g[:-1]]
        if not t:
            return p(g[1:])
        return max(counts[k][g] - discount[k], 0) / t + discount[k] * kinds[k, g[:-1]] / t * p(g[1:])

    return lambda g: math.log(p(g))


def test_language_model_equals_plain_one():
    texts = {"a": ["the cat sat on the mat", "a cat and a hat sat"], "b": ["der hund und die katze", "das ist der hund"]}
    grams = {g: sum((language_id.grams_of(t) for t in ts), Counter()) for g, ts in texts.items()}
    m = language_id.Models(["a", "b"], grams)
    alphabet = sorted({c for g in grams.values() for k in g for c in k})
    rng = random.Random(3)
    seen = [k for g in grams.values() for k in g]
    for j, g in enumerate("ab"):
        plain = plain_kneser_ney(texts[g])
        for _ in range(300):
            w = rng.choice(seen) if rng.random() < 0.5 else "".join(rng.choice(alphabet) for _ in range(5))
            own = set().union(*(set(k) for k in grams[g]))
            if not set(w) <= own:
                continue
            got = m.log_probs([np.array([ord(c)], np.uint64) for c in w])[0, j]
            if grams[g]:
                # the shared vocabulary of both languages stands in the last back-off only
                assert abs(math.exp(got) - math.exp(plain(w))) < 0.02


def test_language_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = queries.language_models(docs)
    strange = ["我们今天去公园散步" * 30, "Мы сегодня пошли гулять в парк " * 10, "xq zvk qqj wxz kkv jjq zzx " * 20]
    assert not m.predict(strange)[3].any()
    rows = [r.text for r in docs.filter("lang is not null").limit(100).collect()]
    assert m.predict(rows)[3].mean() >= 0.97


def test_language_blocks(monkeypatch):
    grams = {"a": language_id.grams_of("the cat sat on the mat"), "b": language_id.grams_of("der hund")}
    m = language_id.Models(["a", "b"], grams)
    text = "the dog and der katze sat " * 200
    whole, n = m.entropies([text, "the", text])
    monkeypatch.setattr(language_id, "BLOCK", 97)
    parts, k = m.entropies([text, "the", text])
    assert np.allclose(whole, parts, rtol=1e-5) and (n == k).all()


# exact dedup


def test_repeated_ids_and_clashing_columns(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["a b", "ab", "a  b", "c", "c ", None, "", " ", "long " * 50] + [f"t{i} x" for i in range(6)]
    rows = [(rng.choice([None, *range(12)]), rng.choice(texts), i, "x", i) for i in range(400)]
    rows += [(7, "a  b", i, None, None) for i in range(300)]  # a large group that shares its id
    df = spark.createDataFrame(rows, "doc_id long, text string, __gone long, __twice string, row int")
    best = {}
    for i, t, *_ in rows:
        k = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        rank = (-len(t or ""), i is None, i or 0)
        best[k] = min(best.get(k, rank), rank)
    want = sorted((k, r[0], r[2] if not r[1] else None) for k, r in best.items())
    key = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for few in (exact_dedup.FEW, 0):  # 0: every broadcast becomes a shuffle
        monkeypatch.setattr(exact_dedup, "FEW", few)
        got = exact_dedup.exact_dedup(df)
        assert got.columns == df.columns
        assert sorted((key(r.text), -len(r.text or ""), r.doc_id) for r in got.collect()) == want
        for every in (True, False):
            out = exact_dedup.exact_groups(df, digest_all=every).collect()
            assert len(out) == len(rows) and sum(r.kept for r in out) == len(best)
            assert not every or {r.text_sha256 for r in out} == {hashlib.sha256(k.encode()).hexdigest() for k in best}


def test_the_query_refines(spark):
    plan = exact_dedup._keys(spark.createDataFrame([(1, "a"), (2, "b c"), (3, "bc")], "doc_id long, text string"), "doc_id", "text", True)
    got = {r.doc_id: (r.survives, r.text_sha256 is not None) for r in plan.collect()}
    assert got == {1: (False, True), 2: (True, True), 3: (True, True)}
    only = exact_dedup._keys(spark.createDataFrame([(1, "a"), (2, "b c"), (3, "bc")], "doc_id long, text string"), "doc_id", "text", False)
    assert {r.doc_id for r in only.collect() if r.text_sha256} == {2, 3}


def test_least_id(spark):
    least = -(1 << 63)
    df = spark.createDataFrame([(0, "a"), (least, "a"), (None, "a")], "doc_id long, text string")
    assert {r.keep_id for r in exact_dedup.exact_groups(df).collect()} == {least}


# near dedup


def test_components_of_hubs_and_chains(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HUB", 16)  # so that there are hubs
    rng = random.Random(2)
    links = [(5000, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000 + rng.randrange(90), 2000 + rng.randrange(90)) for _ in range(60)]
    links = [(a, b) for a, b in links if a != b]
    comp = {}
    for a, b in links:
        comp.setdefault(a, a), comp.setdefault(b, b)
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(comp[a], comp[b])
            moved |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    got = {r.node: r.comp for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == comp


@pytest.mark.parametrize("few", [0, 10**6])
def test_near_duplicates_by_shuffles(spark, monkeypatch, few):
    from test_ops import brute_components, words

    monkeypatch.setattr(minhash, "FEW", few)
    rng = random.Random(11)
    base, rows = words(rng, 60, 4000).split(), []
    for k in range(60):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, words(rng, 30, 4000)) for k in range(30)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, __gone int, salt string")
    want = brute_components(rows, 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, 3, 85).collect()} == want
    kept = minhash.near_dedup(df, 3, 85)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if c == i}


# tokens

MARKED = ["hello <|endoftext|> world", "<|startoftext|>a", "x<|endoftext|>", "<|endoftext|>" * 3, "<|ENDOFTEXT|> b", "a < | endoftext|>", "no mark <|", "tab\t<|endoftext|>\n\nword"]


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_added_tokens_are_the_librarys(name, spaces):
    fresh, sub, literal = Tokenizer.from_file(P.path(name)), subwords.Subwords(P.path(name), spaces), subwords.Subwords(P.path(name), spaces, True)
    for t in MARKED:
        assert np.frombuffer(sub.encode(t), sub.dtype).tolist() == fresh.encode(t, add_special_tokens=False).ids, t
    fresh.encode_special_tokens = True
    for t in MARKED:
        assert np.frombuffer(literal.encode(t), literal.dtype).tolist() == fresh.encode(t, add_special_tokens=False).ids, t


def test_token_file_blocks_and_lookup(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma,", "delta\n"]) for _ in range(rng.randrange(400))) for _ in range(150)] + MARKED
    rows = [(i * 3 - 100, t) for i, t in enumerate(texts)] + [(None, "null id"), (-100, "again"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path, file = token_file.fresh_path(spark, "blocks"), P.path("byte_bpe_50k.json")
    token_file.write_tokens(df, path, file, 2, shards=3)
    fresh = Tokenizer.from_file(file)
    ids = lambda t: np.array([*fresh.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
    got = token_file.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    at, seen = 0, []
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
        at += r.n_tokens
        seen.append((str(r.doc_id), bytes(r.ids)))
    assert sorted(seen) == sorted((str(i), ids(t)) for i, t in rows)
    want = [-100, 8, 50, 51, 10**12, -101]
    found = sorted((r.doc_id, bytes(r.ids)) for r in token_file.lookup(spark, path, want).collect())
    assert found == sorted((i, ids(t)) for i, t in rows if i in want)
    assert token_file.lookup(spark, path, []).count() == 0


def test_very_long_documents(spark):
    """Texts beyond a block of ids, and beyond the parts that other operators cut texts into."""
    rng = random.Random(6)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(500)]
    text = " ".join(rng.choice(vocab) for _ in range(650_000))
    df = spark.createDataFrame([(1, "short one"), (2, text), (3, "another")], "doc_id long, text string")
    file = P.path("byte_bpe_50k.json")
    path = token_file.fresh_path(spark, "long")
    token_file.write_tokens(df, path, file, 2, shards=1)
    assert spark.read.parquet(path).count() == 2  # the long one closes its block
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_file.read_tokens(spark, path).collect()}
    fresh, at = Tokenizer.from_file(file), 0
    for r in df.orderBy("doc_id").collect():
        ids = [*fresh.encode(r.text, add_special_tokens=False).ids, 2]
        assert got[r.doc_id] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    rank = P.path("byte_bpe_multi_50k.tiktoken")
    enc = byte_bpe.encoding(rank, P.PATTERN)
    r = byte_bpe.round_trip(df.filter("doc_id = 2"), rank, P.PATTERN).first()
    assert r.n_tokens == len(enc.encode_ordinary(text)) and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


# packing


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_every_id_once(seed):
    rng = random.Random(seed)
    window = rng.choice([32, 64, 100])
    spread = rng.choice([3, window // 3, window - 1])
    counts = {rng.randrange(window // 2 if seed % 3 == 0 else 1, window): rng.randrange(1, 40) for _ in range(spread)}
    plan = packing.Plan(dict(counts), 5, window)
    held = defaultdict(list)
    for n, c in counts.items():
        for rank in range(c):
            parts = plan.place(n, rank)
            at = 0
            for a, size, seq, offset in parts:
                assert a == at and size > 0
                at += size
                held[seq].append((offset, size))
            assert at == n
    assert sorted(held) == list(range(5, 5 + len(held)))
    for pieces in held.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at == window or at & (at - 1) == 0
    assert sum(size for p in held.values() for _, size in p) == sum(n * c for n, c in counts.items())


def test_closest_multiset_is_used():
    plan = packing.Plan({7: 10, 6: 1}, 0, 16)  # two of 7 leave room for 2, which no other multiset fills
    whole = sum(len(plan.place(7, i)) == 1 for i in range(10))
    assert whole >= 7


# secrets

ENC = lambda: byte_bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
ALNUM = BASE64[:62]


def test_query_equals_plain_scan(spark, tmp_path):
    rng = random.Random(1)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(9000, None), (9001, ""), (None, "token: abcdefgh1234"), (9002, "API_KEY = 'aaaa' AKIA" + "Q" * 30 + " " + "0f" * 16 + "é" + "0f" * 20 + "x")]
    docs += [(9100 + i, f"see {''.join(rng.choice(ALNUM) for _ in range(32))} for it, passwd=\"{'ab1' * 4}\"") for i in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op7_secret_scan(spark, str(tmp_path)).collect()}
    assert len(got) == len(docs)
    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 8), ("access", r"AKIA[A-Z0-9]+", 0, 0, 16), ("hex", r"[0-9a-f]+", 0, 0, 32)]
    for i, t in docs:
        base = [(m.start(), n, m.end(), k) for n, (k, p, flags, g, least) in enumerate(kinds) for m in re.finditer(p, t or "", flags) if len(m.group(g)) >= least]
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(base))
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b[3] == k[0] for b in base) for k in kinds)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("random")] == [s for s in text.split(",") if s]
        assert len(spans) == len(base) + r.n_random
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
        if i and i >= 9100:
            assert r.n_random == 1 and "random:4:36" in r.spans


def planted(make, n=300, seed=7):
    """The share of random strings, each within a sentence, that are found by their place."""
    rng, enc, hit = random.Random(seed), ENC(), 0
    for _ in range(n):
        s = make(rng)
        text = f"the value was {s} at that time"
        hit += any(k == "random" and a <= 14 and b >= 14 + len(s) for a, b, k in secrets.spans_of(text, enc, 2.0)[1])
    return hit / n


def test_recall_on_planted_secrets():
    of = lambda letters, n: lambda rng: "".join(rng.choice(letters) for _ in range(n))
    figures = {("alnum", 20): planted(of(ALNUM, 20)), ("alnum", 32): planted(of(ALNUM, 32)), ("alnum", 64): planted(of(ALNUM, 64)), ("lower", 24): planted(of(ALNUM[26:], 24)), ("base64", 40): planted(of(BASE64, 40)), ("url", 43): planted(of(ALNUM + "-_", 43))}
    print(figures)
    assert min(figures.values()) >= 0.97


def test_known_identifiers_are_no_secrets():
    rng, enc = random.Random(9), ENC()
    for i in range(60):
        u = str(uuid.UUID(int=rng.getrandbits(128)))
        raw = bytes(rng.randrange(256) for _ in range(64))
        for t in (f"id={u}", f"user-{u}-x", u.upper(), f"sha256-{b64encode(raw[:32]).decode()}", f"sha384-{b64encode(raw[:48]).decode()}", f"sha512-{b64encode(raw).decode()}", f"SHA1={raw[:20].hex().upper()}", "backup-2024-05-17T101500Z-2024-05-18", "1234567890123456789012345", "the-quick-brown-fox-jumps-over-the-lazy-dog", "/usr/local/share/applications/Default2"):
            assert not [s for s in secrets.spans_of(f"see {t} there", enc, 2.0)[1] if s[2] == "random"], t
