"""Token files: concatenated ids with Elias-Fano coded document boundaries.

A file set is a Parquet data set of blocks (so that any store Spark can write holds it). A block has the ids of consecutive
documents as one array of 16- or 32-bit integers, and two Elias-Fano sequences: the ends of the documents in the array, and their
ids. Such a sequence of n values below u takes about 2 + log2(u / n) bits a value; samples of every 64th set bit give the
offset of any document without decoding the rest, and no table of 64-bit offsets exists. A block is closed at ``BLOCK_IDS`` ids, so
that its size is bounded by that or by its longest document.

Documents are dealt into shards by ranges of their id (ties by a hash of the text, so that an id which many rows share is split) and
sorted within. A block holds its place within the shard; the place of a shard follows from the totals of the shards, one row each.

Defined cases: a null text is empty and has the end id alone. Null ids come first. Rows with equal ids stay separate documents, in the order of a
hash of their texts. An empty table gives a file set without blocks. Other columns are not looked at.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import checkpoint_dir, mapped
from .subwords import subwords

BLOCK_IDS = 1 << 20
SAMPLE = 64
MAGIC = b"EFT1"


class EliasFano:
    """A non-decreasing sequence of unsigned integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        bits = ((v[:, None] >> np.arange(low_bits, dtype=np.uint64)[None, :]) & np.uint64(1)).astype(np.uint8) if low_bits else np.zeros((n, 0), np.uint8)
        at = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1, np.uint8)
        high[at] = 1
        return cls(n, low_bits, np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), at[::SAMPLE].astype(np.uint32))

    def _low(self, a: int, b: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(b - a, np.uint64)
        first, last = a * self.low_bits, b * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : -(-last // 8)], bitorder="little")[first % 8 :][: last - first]
        return (bits.reshape(b - a, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def get(self, i: int) -> int:
        """The i-th value: the sample before it, then the set bits from there."""
        at = int(self.samples[i // SAMPLE])
        need, byte = i % SAMPLE, at // 8
        skip = at % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64], bitorder="little")[skip:])
            if need < len(ones):
                place = byte * 8 + skip + int(ones[need])
                return ((place - i) << self.low_bits) | int(self._low(i, i + 1)[0])
            need, byte, skip = need - len(ones), byte + 64, 0

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.n)

    def dump(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()]
        return struct.pack("<QBIII", self.n, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def load(cls, blob, at: int) -> tuple[EliasFano, int]:
        n, low_bits, a, b, c = struct.unpack_from("<QBIII", blob, at)
        at += struct.calcsize("<QBIII")
        low, high = np.frombuffer(blob, np.uint8, a, at), np.frombuffer(blob, np.uint8, b, at + a)
        return cls(n, low_bits, low, high, np.frombuffer(blob, "<u4", c // 4, at + a + b)), at + a + b + c


def pack_block(doc_ids: list, ids: list[bytes], width: int) -> bytes:
    """doc_ids ascending, nulls first."""
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    ends = np.cumsum([len(b) // width for b in ids], dtype=np.uint64)
    keys = np.array([d - least for d in known], np.uint64)
    return MAGIC + struct.pack("<BQq", width, len(doc_ids) - len(known), least) + EliasFano.of(ends).dump() + EliasFano.of(keys).dump() + b"".join(ids)


class Block:
    """A block read back; ``document(i)`` finds its ids by two selects."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a token block")
        self.width, self.nulls, self.least = struct.unpack_from("<BQq", blob, 4)
        at = 4 + struct.calcsize("<BQq")
        self.ends, at = EliasFano.load(blob, at)
        self.keys, at = EliasFano.load(blob, at)
        self.ids = np.frombuffer(blob, f"<u{self.width}", -1, at)

    def __len__(self) -> int:
        return self.ends.n

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.get(i - 1) if i else 0 : self.ends.get(i)]

    def find(self, doc_id: int) -> range:
        """The places of the documents with an id, by binary search with selects."""
        want, n = doc_id - self.least, self.keys.n

        def below(x: int) -> int:
            lo, hi = 0, n
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if self.keys.get(mid) < x else (lo, mid)
            return lo

        return range(self.nulls + below(want), self.nulls + below(want + 1)) if want >= 0 else range(0)

    def doc_ids(self) -> list:
        return [None] * self.nulls + [int(k) + self.least for k in self.keys.all()]


def write_tokens(docs: DataFrame, path: str, file: str, end_id: int, keeps_space: bool = True, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None, literal: bool = False) -> None:
    """Encode the texts of docs, each followed by ``end_id``, and write the blocks to ``path``. ``literal``: added tokens in a text are ordinary text."""

    def run(batches):
        sub = subwords(file, keeps_space, literal)
        tail = np.array([end_id], sub.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        keys, ids, size, base, number = [], [], 0, 0, 0

        def block():
            nonlocal keys, ids, size, base, number
            known = [k for k in keys if k is not None] or [None]
            row = pa.RecordBatch.from_pydict({"first_id": pa.array(known[:1], pa.int64()), "last_id": pa.array(known[-1:], pa.int64()), "shard": pa.array([shard], pa.int32()), "block": pa.array([number], pa.int32()), "base": pa.array([base], pa.int64()), "n_docs": pa.array([len(keys)], pa.int64()), "n_ids": pa.array([size], pa.int64()), "data": pa.array([pack_block(keys, ids, sub.width)], pa.binary())})
            keys, ids, size, base, number = [], [], 0, base + size, number + 1
            return row

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (sub.encode(text.as_py()) if text.is_valid else b"") + tail
                keys.append(key)
                ids.append(raw)
                size += len(raw) // sub.width
                if size >= BLOCK_IDS:
                    yield block()
        if keys:
            yield block()

    rows = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange(shards, "doc_id", "h") if shards else rows.repartitionByRange("doc_id", "h")
    ordered = dealt.sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    mapped(ordered, run, "first_id long, last_id long, shard int, block int, base long, n_docs long, n_ids long, data binary").write.mode("errorifexists").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, the ids (unsigned 32-bit, little-endian) of each document of a file set."""
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("shard"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))  # one row for each shard

    def run(batches):
        for batch in batches:
            for before, base, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                b = Block(blob)
                ends = b.ends.all().astype(np.int64)
                begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
                raw = [b.ids[s:e].astype("<u4").tobytes() for s, e in zip(begins, ends, strict=True)]
                out = {"doc_id": pa.array(b.doc_ids(), pa.int64()), "start": pa.array(begins + before + base), "n_tokens": pa.array(ends - begins), "ids_crc32": pa.array([zlib.crc32(r) for r in raw], pa.int64())}
                yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(raw, pa.binary())} if with_ids else {}))

    rows = blocks.select("shard", "base", "data").join(F.broadcast(starts), "shard").select("before", "base", "data")
    return mapped(rows, run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids (unsigned 32-bit, little-endian) of the documents with some ids, a row for each document. Only blocks whose range of ids holds one of
    them are opened (a filter that reaches the scan), and in a block each document is found by selects, without decoding the others."""
    wanted = sorted(set(doc_ids))
    if not wanted:
        return spark.createDataFrame([], "doc_id long, ids binary")

    def run(batches):
        for batch in batches:
            for blob in batch.column(0):
                b = Block(blob.as_py())
                found = [(d, b.document(i).astype("<u4").tobytes()) for d in wanted for i in b.find(d)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([f[0] for f in found], pa.int64()), "ids": pa.array([f[1] for f in found], pa.binary())})

    blocks = spark.read.parquet(path).filter((F.col("last_id") >= wanted[0]) & (F.col("first_id") <= wanted[-1]))
    return mapped(blocks.select("data"), run, "doc_id long, ids binary")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
