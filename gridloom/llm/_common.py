"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as in ``[\x20\x09-\x0D]``.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the session's ``spark.checkpoint.dir``, else (only where all runs on this machine, as in tests) a new
    temporary folder. On a cluster without that setting it is an error: a folder of the driver's would not be seen by executors."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        known = current.get() if current.isDefined() else None
        if not known:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir names no shared folder")
            known = "file://" + tempfile.mkdtemp(prefix="gridloom-")
            spark.sparkContext.setCheckpointDir(known)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(known)
    return known


#: Bounds of the Arrow batches between executor and Python worker, which both hold several of; a session's own settings go first.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` on batches of bounded size."""
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    for key, value in BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def trim() -> None:
    """Give freed memory of this worker back to the system, where the C library can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


_RESIDENT: dict = {}


def resident(key, make):
    """A large helper of an operator (a tokenizer, a cache), kept in the worker process for its next tasks. Only one is
    kept: a worker that goes on to another operator frees the last one's memory."""
    if key not in _RESIDENT:
        if _RESIDENT:
            _RESIDENT.clear()
            trim()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder; a lost executor cannot lose it, and no later step repeats the work above it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written to the shared store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def broadcast_below(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if a count proves it has at most ``max_rows`` rows (rows here are a few words wide)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def fold(column: str, modulus: int):
    """crc32 of the id as text, modulo: the split of learning and held-out rows. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def unit_hash(column: str, seed: int):
    """A uniform number in [0, 1) that depends on the id alone, so that a sample is the same whatever the partitions."""
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def logistic(x, right, ridge: float = 1e-2):
    """Slope and intercept of a logistic curve through 0/1 outcomes, with smoothed targets and a line search."""
    import numpy as np

    x, right = np.asarray(x, float), np.asarray(right, bool)
    n, k = len(x), int(right.sum())
    target = np.where(right, (k + 1) / (k + 2), 1 / (n - k + 2))
    mean, sd = (float(x.mean()), float(x.std()) or 1.0) if n else (0.0, 1.0)
    z = np.column_stack([(x - mean) / sd, np.ones(n)])
    w = np.array([0.0, np.log((k + 1) / (n - k + 1))])

    def loss(w):
        s = z @ w
        return float((np.logaddexp(0, s) - target * s).sum() + ridge * w[0] ** 2)

    now = loss(w)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        g = z.T @ (p - target) + np.array([2 * ridge * w[0], 0])
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag([2 * ridge, 1e-6]), g)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if now - loss(w) < 1e-9:
            break
        now = loss(w)
    return float(w[0] / sd), float(w[1] - w[0] * mean / sd)
