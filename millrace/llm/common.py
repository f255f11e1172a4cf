"""What several operators share: words, hashes, stored intermediate tables, worker caches."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from millrace.session import work_path

# What separates words (space, tab, line feed, vertical tab, form feed, carriage return).
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def text_bytes(text: str) -> Column:
    """The column ``text`` as UTF-8 bytes, NULL as no bytes.

    ``bytes.split()`` and ``bytes.lower()`` know just the separators of WORD and the
    letters A-Z, so words need no regular expression and no decoding.
    """
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


#: Bytes of a batch that travels between the JVM and Python, about.
BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold at most BATCH_BYTES (and one row more), so that a
    worker's memory follows this bound and not ten thousand texts of any length."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) != str(BATCH_BYTES):
        conf.set(key, str(BATCH_BYTES))
    return df


def store(df: DataFrame, label: str, folder: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: the plan above starts from files
    that outlive any executor, and readers prune columns.

    The shuffle files of the write go at its end, not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = folder or work_path(spark, label)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.mode("overwrite").options(**(options or {})).parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """An object that lives as long as the Python worker, so that its tasks share one copy."""
    kept = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def release() -> None:
    """Hand freed memory back to the system: workers live on between stages, and what they keep counts."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (finaliser of SplitMix64); a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for each run of ``width`` consecutive hashes, in order."""
    n = len(hashes) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return out


class WordScan:
    """Where the words of many texts are and a 64-bit hash of each, without a loop over words.

    A word's hash is a polynomial in an odd base over a table of 256 fixed random values,
    modulo 2**64, taken as a difference of running sums; ``mix`` finishes it with the length.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.separator = np.zeros(256, bool)
        self.separator[[32, *range(9, 14)]] = True
        self.values = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 1 << 16)
            back = pow(self.BASE, -1, 1 << 64)
            for name, base in (("up", self.BASE), ("down", back)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def words(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words in an array of bytes."""
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = ~self.separator[raw]
        edges = np.diff(inside)
        return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)

    def hashes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each slice of the bytes."""
        self._powers(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.values[raw] * self.up[: len(raw)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.down[starts]
        return mix(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def chunks(texts: list[bytes], most: int = 1 << 20):
    """Runs of texts of about ``most`` bytes; a longer text is a run of its own, whole."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            yield texts[start:k]
            start, size = k, 0
        size += len(text) + 1
    if start < len(texts):
        yield texts[start:]


def joined(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts with a line feed behind each, and where each begins (and the last one ends)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return b"\n".join([*texts, b""]), np.concatenate([[0], np.cumsum(sizes)])


def pack(values: np.ndarray, width: int = 8) -> bytes:
    """The ``width`` low bytes of 64-bit values, all lowest bytes first: small numbers and sorted differences
    compress well."""
    return np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(raw: bytes, width: int = 8) -> np.ndarray:
    low = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((low.shape[1], 8), np.uint8)
    out[:, :width] = low.T
    return out.view(np.uint64).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64)


def shape(fields: dict[str, DataType | str]) -> StructType:
    """A schema from names and types, whatever characters the names have."""
    return StructType([
        StructField(name, kind if isinstance(kind, DataType) else DataType.fromDDL(kind)) for name, kind in fields.items()])
