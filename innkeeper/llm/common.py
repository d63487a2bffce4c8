"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import inspect
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: maximal run without space, tab, LF, VT, FF, CR. ``bytes.split()`` cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(taken: list[str], name: str) -> str:
    """``name``, led by as many underscores as make it differ from all names taken (in any case)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered up to ``most`` words (then forgotten all at once)."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


WORD_HASHES = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def appended(batch: pa.RecordBatch, more: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with further columns at its end."""
    return pa.RecordBatch.from_arrays([*batch.columns, *more.values()], [*batch.schema.names, *more])


# Rows that a Python worker is handed at a time: whole texts may be long.
BATCH_ROWS = 2000
# Freed memory goes back to the system instead of staying with idle workers.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2",
                 "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20)}


def python_ready(spark: SparkSession) -> None:
    """Sets the session up for operators with Python workers.

    They import this package from the driver's folder, where they share it (a cluster whose
    machines do not gets the package as usual: an installed wheel, --py-files), keep little
    freed memory, and get batches of at most ``BATCH_ROWS`` rows.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))
    for name, value in WORKER_MEMORY.items():
        known.setdefault(name, value)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def give_back() -> None:
    """Freed memory goes back to the system."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def trimmed(fn):
    """fn for the groups of applyInArrow; what it freed goes back to the system, so a worker that waits holds little."""

    def run(*tables):
        out = fn(*tables)
        give_back()
        return out

    run.__signature__ = inspect.signature(fn)  # Spark looks at the number of parameters and their types
    return run


def relieved(fn):
    """fn for mapInArrow; what a task freed goes back to the system when it ends."""

    def run(batches):
        yield from fn(batches)
        give_back()

    return run


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_size(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one aggregate over one column, to size blocks and buckets by."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n - 1) modulo 2^64; the longest asked for is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, 1), base, U64)
        factors[0] = 1
        have = _powers[base] = np.cumprod(factors, dtype=U64)
    return have[:n]
