"""Words, chunks and keys of whole texts, shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SPACE_CHAR = r"[\x20\x09-\x0D]"


def words_of(text: str | Column) -> Column:
    """The words of a text as an array; a null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often (or inside which lambda) the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def text_key(text: str | Column) -> Column:
    """16 bytes that stand for a text: the head of its SHA-256."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores in front of it while the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def pieces(batches: Iterable[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` bytes of ``column``; a longer text stands alone."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each span, all at once."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=sums[1:])
    back = powers(_INVERSE, len(values) + 1)
    return mix((sums[ends] - sums[starts]) * back[starts])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start+1, ...`` for each start, one after the other."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)
