"""Vectorised text helpers for code that runs inside Spark tasks.

Everything here works on one Arrow batch (or a bounded slice of it) with numpy:
no per-word Python loop, and memory in proportion to the slice, not the input.
Null texts read as empty ones.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of text that one vectorised pass takes; a longer document gets a pass of its own.
SLICE_BYTES = 2_000_000
#: Bytes in one Arrow batch between the JVM and a Python worker.
BATCH_BYTES = 8_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of alphanumeric words: ASCII signs that are neither digit nor letter.
SIGNS = np.zeros(256, bool)
SIGNS[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_powers: dict[str, np.ndarray] = {}


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application, and bound the
    Arrow batches of the session by rows and bytes, so that long texts can't fill a worker."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        place = Path(os.path.realpath(tempfile.mkdtemp(prefix="contrail-py-"))) / "contrail_tasks.zip"
        with zipfile.ZipFile(place, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(place))
        _shipped.add(app)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _power(which: str, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (``which`` 'up') or of its inverse ('down'), kept per worker."""
    have = _powers.get(which)
    if have is None or len(have) < n:
        step = np.full(max(n, SLICE_BYTES), _BASE if which == "up" else _BASE_INV, np.uint64)
        step[0] = 1
        have = _powers[which] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that any of their bits can be used."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``units[s:e]`` for each span (end exclusive); equal spans get equal hashes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * _power("up", len(units)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power("down", len(units))[starts] + (ends - starts).astype(np.uint64))


def text_slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes, offsets) for runs of whole texts of about SLICE_BYTES; offsets has a row more."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(off, off[row] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, data[off[row] : off[last]], off[row : last + 1] - off[row]
        row = last


class Words:
    """The words (maximal runs without a separator byte, by default ASCII white space) of some texts.

    ``starts`` and ``ends`` are byte places, ``doc`` the text of each word,
    ``bytes`` the texts' bytes (A-Z lower-cased if ``lower``).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True, separators=_SPACE):
        self.bytes, self.n_docs = (_LOWER[data] if lower else data), len(offsets) - 1
        inside = ~separators[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edge = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < len(data))]
        first[edge] |= inside[edge]
        last[edge - 1] |= inside[edge - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs)
        self.first_word = np.concatenate(([0], np.cumsum(self.counts)))

    def hashes(self) -> np.ndarray:
        return span_hashes(self.bytes, self.starts, self.ends)


def doc_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i+1]] for each i (0 for an empty range), in double precision."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
