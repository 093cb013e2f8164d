"""Shared helpers: the scratch folder, word splitting, batched hashing."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsline.session import checkpoint_dir

#: A word is a run of characters other than these six (fixed by the contracts).
WHITE = "\\x20\\x09-\\x0D"
WORD = f"[^{WHITE}]+"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """This process's free memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """``run`` over a task's batches, then the worker's free memory goes back to
    the system: Spark keeps workers between tasks, and an idle one would hold
    its largest task's memory."""
    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket(n: int, *cols) -> Column:
    """An even bucket number 0..n-1 from the columns' hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


SEGMENT = 1 << 20  # bytes hashed at once; longer buffers are cut at white space


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, _BASE, np.uint64), dtype=np.uint64)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        down = np.cumprod(np.full(n, inverse, np.uint64), dtype=np.uint64)
    return up, down


_POWERS: list = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def lowered(text: bytes) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return _LOWER[np.frombuffer(text, np.uint8)]


def segments(white: np.ndarray, size: int = SEGMENT):
    """(start, end) of stretches of about ``size`` bytes that end at white space."""
    a, n = 0, len(white)
    while a < n:
        b = min(n, a + size)
        if b < n:
            later = np.flatnonzero(white[b : b + 4096])
            b = b + int(later[0]) if len(later) else b + int(np.argmax(white[b:])) if white[b:].any() else n
        yield a, b
        a = b


def spans(white: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs that are not white."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).astype(np.int8)))
    return edge[0::2], edge[1::2]


def running(raw: np.ndarray) -> np.ndarray:
    """Running sums of a buffer's polynomial hash."""
    if len(_POWERS[0]) < len(raw):
        _POWERS[:] = _powers(max(len(raw), 1 << 16))
    run = np.zeros(len(raw) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _POWERS[0][: len(raw)], out=run[1:])
    return run


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, run: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of ``raw[start:end]``: a polynomial hash from the running
    sums over the whole buffer, a few array passes however many spans."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    run = running(raw) if run is None else run
    with np.errstate(over="ignore"):
        value = (run[ends] - run[starts]) * _POWERS[1][starts]
        return mix(value + mix((ends - starts).astype(np.uint64)))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased, in order."""
    raw = lowered(text)
    white = _IS_WHITE[raw]
    parts = []
    for a, b in segments(white):
        parts.append(span_hashes(raw[a:b], *spans(white[a:b])))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``k``-word shingles.

    With fewer than ``k`` words the whole sequence is one shingle; without
    words the set is empty.
    """
    w = word_hashes(text.encode("utf-8")) if text else np.zeros(0, np.uint64)
    n = len(w)
    if not n:
        return w
    size = min(k, n)
    with np.errstate(over="ignore"):
        h = np.full(n - size + 1, np.uint64(size), np.uint64)
        for j in range(size):
            h = h * np.uint64(0xD6E8FEB86659FD93) + w[j : n - size + 1 + j]
    h = np.sort(mix(h))
    return h[np.concatenate(([True], h[1:] != h[:-1]))]
