"""Vectorised words of whole Arrow text columns: byte spans and 64-bit hashes.

A text is read as its UTF-8 bytes. Which bytes belong to words, and which are
lower-cased, is a table of 256 entries, so a batch of texts is cut into words
by a handful of numpy passes and no Python object is made per word. Null texts
count as empty. Words never cross rows.

Hashes are polynomial over the bytes (modulo 2**64, a random odd base) and then
mixed; a sequence of words is hashed the same way over the word hashes, so the
hash of any run of words is one subtraction of prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Bytes of text worked on at once: bounds the temporary arrays of a task (about 60 bytes a byte).
# One byte short of a power of two, so that the tables of powers (one entry more) are one.
SLICE_BYTES = (512 << 10) - 1
# Spark's batches hold 10,000 rows or 64 MB, once in the JVM and once in Python; whole texts need fewer.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULT = "67108864b"
BATCH_BYTES = "2m"

U = np.uint64
_BASES = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93))


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch (one row at least), unless the session has a bound of its own."""
    if spark.conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _byte_codes(lower: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += U(32)
    return mix(b + U(0x1F123BB5)) | U(1)


def _space_words() -> np.ndarray:
    ok = np.ones(256, dtype=bool)
    ok[[0x20, *range(0x09, 0x0E)]] = False
    return ok


def _alnum_words() -> np.ndarray:
    ok = np.zeros(256, dtype=bool)
    for lo, hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        ok[lo:hi] = True
    return ok


@dataclass(frozen=True)
class Rule:
    """Which bytes are word bytes, and whether A-Z are lower-cased."""

    word: np.ndarray
    codes: np.ndarray


SPACED = Rule(_space_words(), _byte_codes(False))  # [^\x20\x09-\x0D]+, unchanged
SPACED_LOWER = Rule(_space_words(), _byte_codes(True))
ALNUM_LOWER = Rule(_alnum_words(), _byte_codes(True))  # lower-cased [^\x00-\x2F\x3A-\x60\x7B-\x7F]+

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of a base and of its inverse modulo 2**64."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        base = int(_BASES[which]) | 1
        inverse = pow(base, -1, 1 << 64)

        def run(b: int) -> np.ndarray:
            x = np.full(size, b, dtype=np.uint64)
            x[0] = 1
            return np.multiply.accumulate(x, out=x)

        have = _POWERS[which] = (run(base), run(inverse))
    return have[0][:n], have[1][:n]


def prefix_sums(values: np.ndarray, which: int) -> np.ndarray:
    up, _ = powers(len(values) + 1, which)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hash of values ``[start, end)``; equal runs hash equally wherever they stand."""
    _, down = powers(len(sums), which)
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of ``len(ptr) - 1`` texts: word ``i`` of row ``r`` is at ``ptr[r] + i``."""

    data: np.ndarray  # bytes of the slice
    start: np.ndarray
    end: np.ndarray
    ptr: np.ndarray
    hash: np.ndarray
    row_start: np.ndarray  # byte offset of each row, and the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts)

    def windows(self, width: int, which: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word index) and hashes of all ``width``-word windows inside one row."""
        n = self.counts
        starts = ragged(self.ptr[:-1], np.maximum(n - width + 1, 0))
        sums = prefix_sums(self.hash, which)
        return starts, span_hash(sums, starts, starts + width, which)


def ragged(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` (``length[i]`` values) for every ``i``, joined."""
    length = np.asarray(length, dtype=np.int64)
    total = int(length.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(length)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(first, dtype=np.int64) - (ends - length), length)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string or binary column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    col = texts.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    n = len(col)
    if not n:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + n + 1]
    body = col.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text each (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lo, total = 0, 0
    for i, s in enumerate(sizes.tolist()):
        if i > lo and total + s > most:
            yield lo, i
            lo, total = i, 0
        total += s
    if lo < len(sizes):
        yield lo, len(sizes)


def cut(texts: pa.Array, rule: Rule) -> Words:
    """The words of every row of ``texts``."""
    data, rows = raw_bytes(texts)
    n = len(data)
    inside = rule.word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = rows[:-1][rows[:-1] < n]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = rows[1:][rows[1:] > 0] - 1
    last[tails] = inside[tails]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    ptr = np.searchsorted(start, rows)
    sums = prefix_sums(rule.codes[data], 0)
    return Words(data, start, end, ptr, span_hash(sums, start, end, 0), rows)


def cut_batches(batches: Iterator[pa.RecordBatch], rule: Rule, text: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """``(rows, words)`` for bounded slices of a stream of batches."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        for lo, hi in slices(col, most):
            part = batch.slice(lo, hi - lo)
            yield part, cut(part.column(part.schema.get_field_index(text)), rule)


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64), pa.int64())


def list_of(values: np.ndarray, ptr: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow list column from flat values and row offsets."""
    body = longs(values) if kind == pa.int64() else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), body)
