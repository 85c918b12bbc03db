"""Words, hashes and shingles of many texts at once, straight from Arrow buffers.

A batch is cut into pieces of a few megabytes of whole texts, so memory follows the
piece (or the single longest text), not the batch. Hashes are 64 bits wide; a word's
hash depends only on its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PIECE_BYTES = 1 << 21
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_WHITE = ~WHITE
LETTERS = np.zeros(256, bool)
LETTERS[ord("a") : ord("z") + 1] = True
LETTERS[ord("A") : ord("Z") + 1] = True
LETTERS[0x80:] = True
ALNUM = LETTERS.copy()
ALNUM[ord("0") : ord("9") + 1] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_CODES = np.random.default_rng(20240607).integers(1, 2**64 - 1, 256, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Rows with long texts reach Python a few megabytes at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(
    column: pa.Array, most: int = PIECE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts."""
    data, at = utf8(column)
    first, n = 0, len(at) - 1
    while first < n:
        end = int(np.searchsorted(at, at[first] + most, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z only."""
    return _LOWER[data]


def fold_latin(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the accented capitals U+00C0 to U+00DE."""
    low = _LOWER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = low[lead]
    low[lead] = np.where((second >= 0x80) & (second <= 0x9E) & (second != 0x97), second + 32, second)
    return low


def words(
    data: np.ndarray, at: np.ndarray, inside: np.ndarray = NOT_WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` bytes, and the first word of each row.

    No run crosses from one row into the next. The third array has one entry more
    than there are rows.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    held = inside[data]
    opens = held.copy()
    opens[1:] &= ~held[:-1]
    closes = held.copy()
    closes[:-1] &= ~held[1:]
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = held[edges]
    closes[edges - 1] = held[edges - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, at, "left")


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        filled = 1
        while filled < size:  # powers of the second half are those of the first, shifted
            step = np.uint64(pow(base, filled, 2**64))
            have[filled : 2 * filled] = have[:filled] * step
            filled *= 2
        _powers[kind] = have
    return have


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    return span_hashes(_BYTE_CODES[data], starts, ends)


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of 64-bit codes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(codes)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(codes * _power("up", _BASE, n)[:n], out=total[1:])
    spans = (total[ends] - total[starts]) * _power("down", _INVERSE, n + 1)[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def windows(codes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows inside rows, and each window's first word."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined = np.zeros(n, np.uint64)
    for k in range(size):
        joined *= np.uint64(0xD6E8FEB86659FD93)
        joined += codes[k : k + n]
    whole = np.ones(n, bool)
    edges = first[1:-1]
    for k in range(1, size):  # a window that begins k words before a row's end crosses it
        cut = edges - k
        whole[cut[(cut >= 0) & (cut < n)]] = False
    begins = np.flatnonzero(whole)
    return mix(joined[begins]), begins


def rows_of(positions: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The row that each word position lies in."""
    return np.searchsorted(first, positions, "right") - 1
