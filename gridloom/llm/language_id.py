"""Language identification with one interpolated Kneser-Ney character model per language.

The models of all languages share, for each order, one sorted array of n-gram hashes and a matrix with a column of log
probabilities for each language, so that one lookup serves all of them. A lookup goes by the top bits of the hash to a place
in the sorted array and probes from there. The prediction is the language with the lowest cross-entropy per
character; its score is the probability of being right, a logistic function of the lead over the second language, fitted on
labelled rows that the models have not seen. A text is rejected (``accepted`` false) if its cross-entropy is far outside of what those rows
show for texts of its length.

What is learnt comes from a bounded sample: at most about ``max_docs`` whole texts of each language for the models, and
``cal_docs`` for the calibration, chosen by a hash of the id; counting is distributed, and the counts that reach the driver are
bounded by the characters of that sample. Every text is scored whole, in blocks of bounded size.

Defined cases: a null text, or one without any letter, is ``und`` with score 0. Letters are lower-cased, and every run of other
characters counts as one space. A null language is never learnt. With no labelled row at all everything is ``und`` with score 0; with
one language that one is predicted with score 1. Ties go to the alphabetically first language. Repeated rows are scored alike. An
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, logistic, mapped, resident, small_batches, unit_hash

ORDER = 5
MUL = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
BLOCK = 400_000


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class _Table:
    """Is built once in each process that needs it."""

    is_letter: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.is_letter is None:
            cls.is_letter = _letters()
        return cls.is_letter


def normalise(text: str) -> np.ndarray:
    """Code points: lower case, every run of characters that are no letters as one space, a space at each end."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(_Table.get()[c], c, np.uint32(32))
    c = np.concatenate(([32], c, [32])).astype(np.uint64)
    return c[~((c == 32) & np.concatenate(([False], c[:-1] == 32)))]


def _hash(columns) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h + c.astype(np.uint64) + np.uint64(1)) * MUL
        h ^= h >> np.uint64(29)
    h *= MIX
    return h ^ (h >> np.uint64(32))


class HashArray:
    """Sorted hashes with an index on their top bits."""

    def __init__(self, hashes: np.ndarray):
        self.h = hashes
        self.shift = np.uint64(64 - max(int(np.ceil(np.log2(len(hashes) + 1))) + 2, 1))
        top = np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.float64)
        edges = np.minimum(top * 2.0 ** float(self.shift), 2.0**64 - 4096).astype(np.uint64)
        self.start = np.searchsorted(hashes, edges).astype(np.int64)
        self.start[-1] = len(hashes)

    def find(self, q: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        out = np.full(len(q), -1, np.int64)
        if not len(self.h):
            return out
        top = (q >> self.shift).astype(np.int64)
        at, end = self.start[top], self.start[top + 1]
        left = np.flatnonzero(at < end)
        while len(left):
            hit = self.h[at[left]] == q[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


class Models:
    """The models of all languages: log probabilities of the n-grams of each order, and log back-off weights of the contexts."""

    def __init__(self, langs: list[str], grams: dict[str, Counter]):
        self.langs, n = langs, len(langs)
        keys = sorted(set().union(*grams.values())) if grams else []
        codes = np.array([[ord(x) for x in k] for k in keys], np.uint64).reshape(len(keys), ORDER)
        counts = np.array([[grams[g].get(k, 0) for g in langs] for k in keys], np.float64).reshape(len(keys), n)
        levels = {ORDER: (codes, counts)}
        for k in range(ORDER - 1, 0, -1):  # continuation counts: in how many longer n-grams this one is the end
            codes, counts = levels[k + 1]
            _, first, place = np.unique(_hash(list(codes[:, 1:].T)), return_index=True, return_inverse=True)
            seen = np.zeros((len(first), n))
            np.add.at(seen, place, counts > 0)
            levels[k] = (codes[first][:, 1:], seen)
        self.vocab = max(len(levels[1][0]), 1) + 1
        self.index, self.logp, self.ctx, self.back = {}, {}, {}, {}
        lower = None
        for k in range(1, ORDER + 1):
            codes, a = levels[k]
            h = _hash(list(codes.T)) if len(codes) else np.zeros(0, np.uint64)
            order = np.argsort(h)
            h, codes, a = h[order], codes[order], a[order]
            if k == 1:
                ch, place = np.zeros(1, np.uint64), np.zeros(len(codes), np.int64)
            else:
                ch, place = np.unique(_hash(list(codes[:, :-1].T)), return_inverse=True) if len(codes) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            one, two = (a == 1).sum(0), (a == 2).sum(0)
            d = np.clip(one / np.maximum(one + 2.0 * two, 1), 0.1, 0.95)
            total, kinds = np.zeros((len(ch), n)), np.zeros((len(ch), n))
            np.add.at(total, place, a)
            np.add.at(kinds, place, a > 0)
            gamma = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
            below = np.full((len(codes), n), 1.0 / self.vocab) if k == 1 else np.exp(self.logp[k - 1][self.index[k - 1].find(_hash(list(codes[:, 1:].T)))]) if len(codes) else np.zeros((0, n))
            t = total[place]
            p = np.where(t > 0, np.maximum(a - d, 0) / np.maximum(t, 1), 0) + gamma[place] * below
            self.index[k], self.logp[k] = HashArray(h), np.log(np.maximum(p, 1e-12))
            self.ctx[k], self.back[k] = HashArray(ch), np.log(gamma).reshape(len(ch), n)
        for k in self.logp:
            self.logp[k] = self.logp[k].astype(np.float32)
        self.cal = (1.0, 0.0)
        self.reject = (np.inf, 0.0)

    def log_probs(self, windows: list[np.ndarray]) -> np.ndarray:
        """[positions x languages]: log probability of the last character of each window of ORDER characters."""
        out = np.zeros((len(windows[0]), len(self.langs)), np.float32)
        left = np.arange(len(windows[0]))
        for k in range(ORDER, 0, -1):
            cols = [w[left] for w in windows[ORDER - k :]]
            at = self.index[k].find(_hash(cols))
            hit = at >= 0
            out[left[hit]] += self.logp[k][at[hit]]
            left = left[~hit]
            if not len(left):
                return out
            if k > 1:
                c = self.ctx[k].find(_hash([w[left] for w in windows[ORDER - k : -1]]))
                known = c >= 0
                out[left[known]] += self.back[k][c[known]].astype(np.float32)
            else:
                out[left] += (self.back[1][0] - np.log(self.vocab)).astype(np.float32)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """[texts x languages] nats a character, and the number of characters of each text (0: no letter)."""
        n = np.zeros(len(texts), np.int64)
        sums = np.zeros((len(texts), len(self.langs)))
        held: list[np.ndarray] = []
        owner: list[int] = []
        size = 0
        pad = np.full(ORDER - 1, 32, np.uint64)

        def flush():
            nonlocal held, owner, size
            if not held:
                return
            c = np.concatenate(held)
            windows = [c[i : len(c) - ORDER + 1 + i] for i in range(ORDER)]
            lp = self.log_probs(windows)
            at = 0
            for part, who in zip(held, owner, strict=True):  # windows that end inside of this part
                sums[who] += lp[at : at + len(part) - ORDER + 1].sum(0, dtype=np.float64)
                at += len(part)
            held, owner, size = [], [], 0

        for i, text in enumerate(texts):
            if not text:
                continue
            c = normalise(text)
            if len(c) < 3 and not (c != 32).any():
                continue
            n[i] = len(c) - 1
            c = np.concatenate((pad[1:], c))
            for a in range(0, max(len(c) - ORDER + 1, 1), BLOCK):
                part = c[a : a + BLOCK + ORDER - 1]
                held.append(part)
                owner.append(i)
                size += len(part)
                if size >= BLOCK:
                    flush()
        flush()
        return -sums / np.maximum(n, 1)[:, None], n

    def features(self, texts: list[str]):
        """Best language, its nats a character, the lead over the second, and the characters, of each text."""
        e, n = self.entropies(texts)
        best = np.argmin(e, axis=1)
        low = e[np.arange(len(e)), best]
        second = np.partition(e, 1, axis=1)[:, 1] if e.shape[1] > 1 else low
        return best, low, np.minimum((second - low) * np.sqrt(np.maximum(n, 1)), 50.0), n

    def calibrate(self, texts: list[str], langs: list[str]) -> None:
        """Fit the probability of being right and the limit of rejection."""
        if not texts:
            return
        best, low, lead, n = self.features(texts)
        ok = n > 0
        right = np.array([self.langs[b] == g for b, g in zip(best, langs, strict=True)])
        slope, at = logistic(lead[ok], right[ok])
        self.cal = (max(slope, 1e-3), at)
        mid = float(np.median(low[ok]))
        spread = float(np.max((low[ok] - mid) * np.sqrt(np.minimum(n[ok], 400)), initial=0.0))
        self.reject = (mid, 1.5 * spread + 1.0)

    def predict(self, texts: list[str]):
        best, low, lead, n = self.features(texts)
        a, b = self.cal
        score = np.ones(len(lead)) if len(self.langs) == 1 else 1 / (1 + np.exp(-(a * lead + b)))
        mid, wide = self.reject
        accepted = (n > 0) & ((low - mid) * np.sqrt(np.minimum(np.maximum(n, 1), 400)) <= wide)
        lang = [self.langs[i] if k else "und" for i, k in zip(best, n, strict=True)]
        return lang, np.where(n > 0, np.clip(score, 0, 1), 0.0), np.where(n > 0, low / np.log(2), np.nan), accepted


def grams_of(text: str) -> Counter:
    s = "".join(map(chr, normalise(text).tolist()))
    s = " " * (ORDER - 2) + s
    return Counter(s[i : i + ORDER] for i in range(len(s) - ORDER + 1))


def fit(learn: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 600, cal_docs: int = 250, seed: int = 11) -> Models:
    """Models from a sample of the rows of ``learn``: about ``max_docs`` texts for the counts and ``cal_docs`` for the calibration, by language."""
    rows = learn.filter(F.col(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # reads no texts
    langs = sorted(sizes)
    if not langs:
        return None
    share = F.create_map(*[x for g in langs for x in (F.lit(g), F.lit(min(1.0, (max_docs + cal_docs) / sizes[g])))])[F.col(lang_col)]
    u = unit_hash(id_col, seed) / share
    sample = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), (u < max_docs / (max_docs + cal_docs)).alias("for_counts"), (u < 1).alias("chosen")).filter("chosen and text is not null")
    sample = cut(sample.select("lang", "text", "for_counts"))  # bounded; the table is read once for counts and calibration

    def count(batches):
        resident("language_id", object)  # frees what another operator has left in this worker
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(grams_of(text))
            rows = [(g, k, v) for g, c in found.items() for k, v in c.items()]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([r[0] for r in rows], pa.string()), "gram": pa.array([r[1] for r in rows], pa.string()), "n": pa.array([r[2] for r in rows], pa.int64())})

    counted = mapped(sample.filter("for_counts").select("lang", "text"), count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    grams: dict[str, Counter] = {g: Counter() for g in langs}
    table = counted.toArrow()
    for lang, gram, n in zip(*(table.column(i).to_pylist() for i in range(3)), strict=True):
        grams[lang][gram] = n
    models = Models(langs, grams)
    held = sample.filter("not for_counts").select("lang", "text").toArrow()
    models.calibrate(held.column(1).to_pylist(), held.column(0).to_pylist())
    return models


def identify(docs: DataFrame, models: Models | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, bits_per_char, accepted for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        resident("language_id", object)
        m = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if m is None:
                lang, score, bits, ok = ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan), np.zeros(len(texts), bool)
            else:
                lang, score, bits, ok = m.predict(texts)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64()), "bits_per_char": pa.array(bits, pa.float64(), from_pandas=True), "accepted": pa.array(ok, pa.bool_())})

    return mapped(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run, "doc_id long, lang_pred string, score double, bits_per_char double, accepted boolean")


def keep_known(docs: DataFrame, models: Models | None, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text is accepted and not 'und'; each row by its own text, whatever its id."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def known(texts):
        resident("language_id", object)
        m = shared.value
        for batch in texts:
            if m is None:
                yield pa.array([False] * len(batch), pa.bool_())
                continue
            lang, _, _, ok = m.predict(batch.to_pylist())
            yield pa.array([bool(k) and g != "und" for g, k in zip(lang, ok, strict=True)], pa.bool_())

    from collections.abc import Iterator

    known.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    small_batches(docs.sparkSession)
    return docs.filter(F.arrow_udf(known, "boolean")(F.col(text_col)))

