"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import importable, release, scratch_path, table, written

__all__ = [
    "Shared",
    "WHITE",
    "fold",
    "labelled_sample",
    "lean",
    "mix64",
    "pieces_of",
    "release",
    "scratch_path",
    "table",
    "token_hashes",
    "white_runs",
    "words_of",
    "written",
]

#: The white-space bytes of the contracts, [\x20\x09-\x0D].
WHITE = b" \t\n\x0b\x0c\r"
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[list(WHITE)] = True
#: Bytes of text hashed at once.
WINDOW = 1 << 17
#: A-Z to a-z, other bytes as they are.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: One random 64-bit value a byte, from a fixed seed: every worker derives the same.
_BYTE_KEYS = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def give_back() -> None:
    """Return what this process has freed to the machine: Spark keeps Python workers for later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own house
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that gives its memory back when its task ends."""
    active = SparkSession.getActiveSession()
    if active is not None:  # on the driver
        importable(active)

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id counts as empty text (0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out, dtype=np.uint64)


_POWERS: dict[str, np.ndarray] = {"up": _powers(_BASE, 1 << 16), "down": _powers(_BASE_INVERSE, 1 << 16)}


def _table(kind: str, n: int) -> np.ndarray:
    if len(_POWERS[kind]) < n:
        _POWERS[kind] = _powers(_BASE if kind == "up" else _BASE_INVERSE, max(n, 2 * len(_POWERS[kind])))
    return _POWERS[kind]


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the runs of non-white bytes."""
    solid = np.zeros(len(data) + 2, dtype=np.int8)
    solid[1:-1] = ~_IS_WHITE[data]
    step = np.diff(solid)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def white_runs(text: bytes) -> bytes:
    """``text`` with every run of white-space bytes replaced by one space."""
    out = b" ".join(text.split())
    if text[:1] and text[0] in WHITE:
        out = b" " + out
    if out != b" " and text[-1:] and text[-1] in WHITE:
        out += b" "
    return out


def token_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit fingerprints of all words of a few texts, A-Z lower-cased if ``lower``, without a Python loop over words.

    Returns (hashes, word counts a text, the joined bytes, word starts, word ends). A word's fingerprint is a polynomial
    over random byte values, so it depends on the word alone, whatever text it stands in.
    """
    joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8) if texts else np.zeros(0, np.uint8)
    data = _LOWER[joined] if lower else joined
    starts, ends = words_of(data)
    bounds = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64)) if texts else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
    hashes = np.zeros(len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(data), WINDOW):  # windows bound the 8-byte temporaries and the tables of powers
            lo, hi = np.searchsorted(starts, [at, at + WINDOW])
            if lo == hi:
                continue
            a, b = int(starts[lo]), int(ends[hi - 1])
            sums = np.zeros(b - a + 1, dtype=np.uint64)
            np.cumsum(_BYTE_KEYS[data[a:b]] * _table("up", b - a)[: b - a], out=sums[1:])
            s, e = starts[lo:hi] - a, ends[lo:hi] - a
            hashes[lo:hi] = (sums[e] - sums[s]) * _table("down", b - a)[s]
    return mix64(hashes), counts, data, starts, ends


def pieces_of(batch: pa.RecordBatch, column: str, limit: int = 4 << 20, beside: str | None = None) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of an Arrow batch of about ``limit`` bytes of text (one row at least), with the texts as UTF-8 bytes; the texts
    of the column ``beside`` count for the limit too.

    Null texts come as empty ones. A text is never cut.
    """
    texts = batch.column(column).cast(pa.large_binary())
    length = lambda c: np.asarray(pa.compute.fill_null(pa.compute.binary_length(c), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    part = np.cumsum(length(texts) + (length(batch.column(beside)) if beside else 0)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a), [t or b"" for t in texts.slice(a, b - a).to_pylist()]


def renamed(df: DataFrame, taken: set[str], prefix: str = "in_") -> DataFrame:
    """``df`` with columns whose names an operator needs for itself renamed ``prefix + name``."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c in taken})


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, modulus: int = 3, held: int = 1, parts: int = 24) -> DataFrame:
    """(doc_id, text, label): whole texts of at most ``per_class`` labelled rows of each class, chosen by a hash of the id,
    from the rows outside the held-out fold alone. Of rows with one id the text of the smallest hash is taken, so the bound
    holds for rows and makes them fit to be collected. They are dealt over ``parts`` tasks."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), modulus) != held))
    usable = usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    order = F.xxhash64(F.lit("sample"), "doc_id")
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("label") == value).orderBy(order, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # 2 * per_class rows at most
    one = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    return one.select("doc_id", F.col("first.text").alias("text"), "label").repartition(parts, "doc_id")


class Shared:
    """A broadcast value (of bounded size) with a number of its own, so that workers can keep what they derive from it."""

    def __init__(self, spark, value):
        self.cast, self.id = spark.sparkContext.broadcast(value), uuid.uuid4().hex

    @property
    def value(self):
        return self.cast.value
