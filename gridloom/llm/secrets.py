"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

The base kinds are assignments of credentials, access keys and long hexadecimal strings, by pattern. The test adds spans of
kind ``random``: runs of ``MIN_RUN`` or more characters of the alphabet of keys whose characters per token, under a tiktoken
vocabulary, stay below ``max_ratio``. Words of a language, even invented ones, need fewer tokens for their length. Runs that
mix at most one class of lower case, upper case and digits are not random. Known digests and identifiers are cut out of a run wherever they stand in it: UUIDs, hexadecimal
strings of 32 or more characters, digests of subresource integrity (``sha256-...``), dates and times. So is what a base span covers; the rest is tested. Words around a random string raise
the mean of the whole run, so in a run that is not random itself neighbouring segments (between ``/``, ``-``, ``_`` and ``=``) that stay below
``max_ratio`` each are tested as runs of their own. A random string that a word touches without such a separator can still be missed.

Defined cases: a null text is empty and has no span. Offsets count code points, the end is exclusive. Very long texts are scanned in one pass by
linear patterns, and a run goes to the vocabulary in parts of 64 characters. Repeated rows are scanned alike. Other columns are not looked at.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import mapped, resident, small_batches
from .byte_bpe import encoding

#: Fixed patterns of the base kinds: kind, pattern, the group whose length counts, its least length.
BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
]
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "random"]
MIN_RUN = 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: A run is more than one word or key where one of / - _ = stands in it.
SEGMENT = re.compile(r"[A-Za-z0-9+]+")
#: Known digests and identifiers.
KNOWN = re.compile(
    r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9a-fA-F]{32,}|[0-9]{4}-[0-9]{2}-[0-9]{2}(?:T[0-9]+Z?)?)(?![0-9A-Za-z])"
    r"|sha256-[A-Za-z0-9+/]{43}=|sha384-[A-Za-z0-9+/]{64}|sha512-[A-Za-z0-9+/]{86}=="
)
DIGEST = re.compile(r"[0-9a-fA-F]+")
#: Every assignment holds one of these, in lower case.
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out, low = [], text.lower()
    for kind, pattern, group, least in BASE:
        if kind == "assign" and not any(h in low for h in HINTS) or kind == "access" and "AKIA" not in text:
            continue
        found = LONG_HEX.finditer(text) if kind == "hex" else pattern.finditer(text)
        out += [(m.start(), m.end(), kind) for m in found if m.end(group) - m.start(group) >= least]
    return out


def _free(at: int, end: int, taken):
    """The parts of a run, of MIN_RUN or more characters, that the spans (sorted, apart from each other) leave over."""
    for s, e in taken:
        if s >= end:
            break
        if s - at >= MIN_RUN:
            yield at, s
        at = max(at, e)
    if end - at >= MIN_RUN:
        yield at, end


def _dense(run: str, enc, max_ratio: float) -> bool:
    return len(run) < max_ratio * sum(len(enc.encode_ordinary(run[i : i + 64])) for i in range(0, len(run), 64))


def _mixed(run: str) -> bool:
    """No digest, and of two classes at least."""
    if DIGEST.fullmatch(run):
        return False
    return any(c.isdigit() for c in run) + any(c.islower() for c in run) + any(c.isupper() for c in run) >= 2


def _chains(run: str, enc, max_ratio: float):
    """Neighbouring segments of a run, between separators, that are dense each; together MIN_RUN or more characters."""
    first = last = None
    for m in SEGMENT.finditer(run):
        a, b = m.span()
        if b - a >= MIN_RUN and DIGEST.fullmatch(m.group()) or not _dense(m.group(), enc, max_ratio):
            if first is not None:
                yield first, last
            first = None
        else:
            first, last = a if first is None else first, b
    if first is not None:
        yield first, last


def random_spans(text: str, enc, taken: list[tuple[int, int, str]], max_ratio: float) -> list[tuple[int, int, str]]:
    out, apart = [], []
    for s, e, _ in sorted(taken):
        if apart and s <= apart[-1][1]:
            apart[-1] = (apart[-1][0], max(e, apart[-1][1]))
        else:
            apart.append((s, e))
    for m in RUN.finditer(text):
        begin, end = m.span()
        held = apart[bisect.bisect_right(apart, begin, key=lambda x: x[1]) :]
        for a, b in (part for x in _free(begin, end, held) for part in _free(*x, [k.span() for k in KNOWN.finditer(text, *x)])):
            run = text[a:b]
            if not _mixed(run):
                continue
            if _dense(run, enc, max_ratio):
                out.append((a, b, "random"))
            else:
                out += [(a + s, a + e, "random") for s, e in _chains(run, enc, max_ratio) if e - s >= MIN_RUN and _mixed(run[s:e])]
    return out


def spans_of(text: str, enc, max_ratio: float):
    """Base spans and all spans, by start, then kind as listed."""
    key = lambda s: (s[0], KINDS.index(s[2]))
    base = sorted(base_spans(text), key=key)
    return base, sorted(base + random_spans(text, enc, base, max_ratio), key=key)


def joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", max_ratio: float = 2.0) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans for each row of docs."""

    def run(batches):
        enc = resident(("secrets", rank_file, pattern), lambda: encoding(rank_file, pattern))
        for batch in batches:
            rows = [spans_of(t or "", enc, max_ratio) for t in batch.column(1).to_pylist()]
            n = {f"n_{k}": pa.array([sum(s[2] == k for s in every) for _, every in rows], pa.int64()) for k in KINDS}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0)} | n | {"base_sha256": pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in rows]), "spans": pa.array([joined(e) for _, e in rows], pa.string())})

    return mapped(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run, "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")


def redact(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", mask: str = "[SECRET]", max_ratio: float = 2.0) -> DataFrame:
    """docs with every span of their texts replaced by ``mask``; all other columns and null texts stay as they are."""

    def hide(texts):
        enc = resident(("secrets", rank_file, pattern), lambda: encoding(rank_file, pattern))
        for series in texts:
            out = []
            for t in series.to_pylist():
                _, spans = spans_of(t or "", enc, max_ratio)
                if spans:
                    parts, at = [], 0
                    for a, b, _ in spans:
                        if a >= at:
                            parts += [t[at:a], mask]
                        at = max(at, b)
                    t = "".join([*parts, t[at:]])
                out.append(t)
            yield pa.array(out, pa.string())

    from collections.abc import Iterator

    hide.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    small_batches(docs.sparkSession)
    return docs.withColumn(text_col, F.arrow_udf(hide, "string")(F.col(text_col)))
