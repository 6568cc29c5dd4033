"""Packing of documents into sequences by minimum bin slack.

A document is cut into full windows and a remainder shorter than a window. Only the numbers of remainders of each length (at
most ``window`` - 1 of them, whatever the corpus) reach the driver, which plans the windows: the longest remaining length is
placed, and a subset-sum programme over bitsets, with the remaining lengths and their numbers, finds the multiset that comes
closest to the free room; backtracking over the bitsets gives the number of each length. The pattern is repeated as often as the numbers allow. Where
the closest multiset leaves some room, the gap is filled afterwards: of the last such windows as many are taken apart as the gaps of the others need, and
their pieces, as one stream, are cut to fill them. What is left of that stream fills windows of its own; the last partial one is cut into powers of two,
which need no padding.

A piece finds its place by its rank among the pieces of its length: ranks within a task are counted while encoding, and the
offsets of tasks are prefix sums over one row for each (task, length), so no length is gathered anywhere. They come back as one row a task. The plan that goes to
the tasks has a few intervals of ranks for each length. Encoded documents are written once, to the shared checkpoint folder.

Defined cases: a null text is empty and has the end id alone. Rows with equal or null ids are separate documents. An empty table gives an empty result. Other
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import broadcast_below, cut, mapped
from .subwords import subwords

#: Tasks whose offsets are broadcast at most (at most ``window`` numbers each, of 12 bytes); beyond that they are joined by a shuffle.
TASKS = 8_000


def fill(room: int, lengths: list[int], counts: dict[int, int]) -> tuple[int, dict[int, int]]:
    """The multiset of the given lengths (each at most counts[length] times) whose sum comes closest to ``room`` from below.

    reach[i] has bit s set if a sum of s can be made of the first i lengths. Backtracking takes each length as seldom as possible.
    """
    mask = (1 << (room + 1)) - 1
    reach, used = [1], []
    for n in lengths:
        if reach[-1] >> room & 1:
            break
        if n > room:
            continue
        most, now, step = min(counts[n], room // n), reach[-1], 1
        while most > 0:  # binary splitting of the multiplicity
            take = min(step, most)
            now |= now << (n * take) & mask
            most, step = most - take, step * 2
        if now != reach[-1]:
            reach.append(now)
            used.append(n)
    total = left = reach[-1].bit_length() - 1
    found: dict[int, int] = {}
    for i in range(len(used) - 1, -1, -1):
        n, k = used[i], 0
        while not reach[i] >> (left - k * n) & 1:
            k += 1
        if k:
            found[n] = k
            left -= k * n
    return total, found


class Plan:
    """Where the pieces of each length go, by rank."""

    def __init__(self, counts: dict[int, int], full: int, window: int = 2048):
        self.window = window
        rest = {n: c for n, c in counts.items() if c > 0}
        used = dict.fromkeys(rest, 0)
        rows = []  # pattern with the first rank of each length, times, room left
        lengths = sorted(rest, reverse=True)
        while lengths:
            seed = lengths[0]
            rest[seed] -= 1
            total, found = fill(window - seed, [n for n in lengths if rest[n] > 0], rest)
            rest[seed] += 1
            found[seed] = found.get(seed, 0) + 1
            times = min(rest[n] // k for n, k in found.items())
            rows.append(([(n, k, used[n]) for n, k in sorted(found.items(), reverse=True)], times, window - seed - total))
            for n, k in found.items():
                used[n] += times * k
                rest[n] -= times * k
            lengths = [n for n in lengths if rest[n] > 0]
        room = sum(times * gap for _, times, gap in rows)
        apart, stream = [0] * len(rows), 0  # windows of each row that are taken apart, and their ids
        for i in range(len(rows) - 1, -1, -1):
            _, times, gap = rows[i]
            if gap and stream < room:
                apart[i] = min(times, -(-(room - stream) // window))
                room -= apart[i] * gap
                stream += apart[i] * (window - gap)
        intervals, gaps, seq, at = [], [], full, 0
        self.room, self.stream_len = room, stream
        for (pattern, times, gap), x in zip(rows, apart, strict=True):
            offset, keep = 0, times - x
            for n, k, first in pattern:
                if keep:
                    intervals.append((n, first, seq, k, offset))
                offset += n * k
                if x:
                    intervals.append((n, first + keep * k, -1, 0, at))
                    at += x * k * n
            if gap and keep:
                gaps.append((gap, keep, seq))
            seq += keep
        self.gaps = gaps
        self.gap_from = np.concatenate(([0], np.cumsum([g * t for g, t, _ in gaps], dtype=np.int64))).astype(np.int64)
        self.stream_seq = seq
        edges, left = [], stream - room
        s, end = seq + left // window, left // window * window
        while end < left:  # powers of two, from the largest
            size = 1 << ((left - end).bit_length() - 1)
            edges.append((end, s, size))
            end, s = end + size, s + 1
        self.edges = edges
        intervals.sort()
        self.key = np.array([n << 44 | lo for n, lo, *_ in intervals], np.int64)
        self.table = np.array(intervals, np.int64).reshape(len(intervals), 5)

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start within the piece, length, sequence, offset) of the parts of the rank-th piece of this length."""
        i = int(np.searchsorted(self.key, length << 44 | rank, side="right")) - 1
        _, first, seq, k, at = self.table[i].tolist()
        if seq >= 0:
            return [(0, length, seq + (rank - first) // k, at + (rank - first) % k * length)]
        out, start = [], at + (rank - first) * length
        p, end = start, start + length
        while p < end:
            s, offset, size = self._stretch(p)
            n = min(end - p, size)
            out.append((p - start, n, s, offset))
            p += n
        return out

    def _stretch(self, p: int) -> tuple[int, int, int]:
        """Sequence and offset of a place in the stream, and how far it is the same stretch."""
        w = self.window
        if p < self.room:
            j = int(np.searchsorted(self.gap_from, p, side="right")) - 1
            gap, _, seq = self.gaps[j]
            p -= int(self.gap_from[j])
            return seq + p // gap, w - gap + p % gap, gap - p % gap
        p -= self.room
        if p < (self.stream_len - self.room) // w * w:
            return self.stream_seq + p // w, p % w, w - p % w
        begin, s, size = next(e for e in self.edges if e[0] <= p < e[0] + e[2])
        return s, p - begin, begin + size - p


def encoded(docs: DataFrame, file: str, end_id: int, window: int, keeps_space: bool, id_col: str, text_col: str, literal: bool) -> DataFrame:
    """A row for each document: its ids, and its places within the task among the full windows and the remainders of its length."""

    def run(batches):
        sub = subwords(file, keeps_space, literal)
        tail = np.array([end_id], sub.dtype).tobytes()
        task, full, seen = TaskContext.get().partitionId(), 0, np.zeros(window, np.int64)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                raw = (sub.encode(text.as_py()) if text.is_valid else b"") + tail
                n = len(raw) // sub.width
                rows.append((n, raw, full, int(seen[n % window])))
                full += n // window
                seen[n % window] += 1
            n, raw, f, r = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "task": pa.array([task] * len(n), pa.int32()), "n": pa.array(n, pa.int64()), "rest": pa.array([x % window for x in n], pa.int32()), "full_at": pa.array(f, pa.int64()), "rest_at": pa.array(r, pa.int64()), "width": pa.array([sub.width] * len(n), pa.int32()), "ids": pa.array(raw, pa.binary())})

    rows = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    return mapped(rows, run, "doc_id long, task int, n long, rest int, full_at long, rest_at long, width int, ids binary")


def pack(docs: DataFrame, file: str, end_id: int = 1, window: int = 2048, keeps_space: bool = False, id_col: str = "doc_id", text_col: str = "text", literal: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset. ``literal``: added
    tokens in a text are ordinary text."""
    rows = cut(encoded(docs, file, end_id, window, keeps_space, id_col, text_col, literal))
    counts = rows.filter("rest > 0").groupBy("task", "rest").agg(F.count("*").alias("c"))
    fulls = rows.groupBy("task").agg(F.sum(F.expr(f"n div {window}")).alias("c")).select("task", F.lit(window).alias("rest"), "c")
    by = cut(counts.unionByName(fulls))
    before = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by.select("task", "rest", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    of_task = cut(offsets.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("rest", "before"))).alias("before")))  # at most ``window`` numbers a task
    totals = {r[0]: r[1] for r in by.groupBy("rest").agg(F.sum("c")).collect()}  # at most ``window`` rows
    full = totals.pop(window, 0)
    plan = docs.sparkSession.sparkContext.broadcast(Plan(totals, full, window))
    placed = rows.join(broadcast_below(of_task, TASKS), "task")

    def run(batches):
        p = plan.value
        for b in batches:
            out = []
            for key, n, full_rank, rest_rank, width, raw in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                for i in range(n // window):
                    out.append((key, i * window, window, ids[i * window : (i + 1) * window].tobytes(), n, full_rank + i, 0))
                if n % window:
                    at = n - n % window
                    for a, size, seq, offset in p.place(n % window, rest_rank):
                        out.append((key, at + a, size, ids[at + a : at + a + size].tobytes(), n, seq, offset))
            cols = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in zip(("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"), cols, strict=True)})

    first = lambda key: F.coalesce(F.col("before")[key], F.lit(0))
    narrow = placed.select("doc_id", "n", (first(F.lit(window)) + F.col("full_at")).alias("f"), (first(F.col("rest")) + F.col("rest_at")).alias("r"), "width", "ids")
    return mapped(narrow, run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
