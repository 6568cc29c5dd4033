"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A long text is cut before encoding at safe boundaries: before a single space that stands between two characters which are
not white space, where the split pattern always starts a new match. The ids of the parts then are the ids of
the whole, and no call of the library sees more than about ``part`` characters unless the text has no such place (such a part goes to the library
whole). Special tokens are never produced. Decoding joins the raw bytes of the ids.

Defined cases: a null text is an empty text with no ids. Ids repeat if rows repeat. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from ._common import mapped, resident

SAFE = re.compile(r"(?<=\S) (?=\S)")
PART = 200_000


def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART):
    """Pieces of the text, cut only where the ids of the pieces are those of the whole."""
    at = 0
    while len(text) - at > size:
        found = SAFE.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def encode(text: str, enc: tiktoken.Encoding, size: int = PART):
    """The ids as an array of little-endian unsigned 32-bit integers."""
    if len(text) <= size:
        return enc.encode_to_numpy(text, disallowed_special=())
    import numpy as np

    return np.concatenate([enc.encode_to_numpy(p, disallowed_special=()) for p in parts(text, size)])


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids as binary."""

    def run(batches):
        enc = resident(("byte_bpe", rank_file, pattern), lambda: encoding(rank_file, pattern))
        for batch in batches:
            n, a, b, raw = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = encode(text or "", enc)
                blob = ids.astype("<u4").tobytes()
                n.append(len(ids))
                a.append(hashlib.sha256(blob).hexdigest())
                b.append(hashlib.sha256(enc.decode_bytes(ids.tolist())).hexdigest())
                raw.append(blob)
            out = {"doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())}
            yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(raw, pa.binary())} if with_ids else {}))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return mapped(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run, schema)
