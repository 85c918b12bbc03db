"""Fill-in-the-middle documents over seekable compressed frames.

A text is stored as frames: runs of at most ``FRAME_UNITS`` code points, each an
independent zstandard frame, with the number of code points beside it. Cumulative counts
say which frame holds a position, so a range of the text is its whole frames as they
are, and only the frames that a cut goes through are decompressed, cut and compressed
again. The rearranged document is again a list of frames; its digest, and the text that
is rebuilt from it, stream over the frames in order, one at a time.

Two cuts are drawn from the document's key: a prefix, a middle and a suffix, any of
which may be empty. ``psm`` writes ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm``
writes ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, and ``plain`` is the text as it is:
for an empty text, for one that contains one of the three marks, and for a fixed share
of the others. As no rearranged text contains a mark of its own, and a mark can't arise
where a mark and a text meet (it begins with ``<``, ends with ``>`` and has neither
inside), the marks found in the output are those that were written, so the output and
its form give the text back exactly.

A null text counts as empty. A null key is drawn like the key ``''``. Rows are
independent of each other: repeated rows and keys give the same output, an empty table
an empty one. Nothing is shuffled, and a task holds one text and its frames at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm import text

FRAME_UNITS = 1 << 14
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
# Of 100 texts that could be rearranged so many are; of 100 of those so many as spm.
REARRANGED, SPM = 90, 20

Frame = tuple[int, bytes]
FRAMES = "array<struct<units: int, data: binary>>"
_FRAMES = pa.list_(pa.struct([("units", pa.int32()), ("data", pa.binary())]))
_squeeze = zstandard.ZstdCompressor(level=1)
_expand = zstandard.ZstdDecompressor()


def _frame(body: str) -> Frame:
    return len(body), _squeeze.compress(body.encode())


def _open(frame: Frame) -> str:
    return _expand.decompress(frame[1]).decode()


def pack(body: str, units: int = FRAME_UNITS) -> list[Frame]:
    """The frames of a text; none of an empty one."""
    return [_frame(body[k : k + units]) for k in range(0, len(body), units)]


def cut(frames: list[Frame], lo: int, hi: int) -> list[Frame]:
    """The frames of the code points from ``lo`` to before ``hi``.

    Frames that lie wholly inside are taken over as they are.
    """
    ends = list(accumulate(n for n, _ in frames))
    out = []
    for k in range(bisect_right(ends, lo), len(frames)):
        begin = ends[k] - frames[k][0]
        if begin >= hi:
            break
        if lo <= begin and ends[k] <= hi:
            out.append(frames[k])
        else:
            out.append(_frame(_open(frames[k])[max(lo - begin, 0) : hi - begin]))
    return out


def draw(key: str) -> list[int]:
    """Four numbers of 32 bits for a key."""
    digits = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    return [int(digits[k : k + 8], 16) for k in range(0, 32, 8)]


def rearranged(key: str, body: str, units: int = FRAME_UNITS) -> tuple[int, str, int | None, int | None, list[Frame]]:
    """(code points, form, those of the prefix, those of the middle, frames of the output)."""
    n, stored = len(body), pack(body, units)
    first, second, keep, order = draw(key)
    if not n or any(mark in body for mark in (PREFIX, SUFFIX, MIDDLE)) or keep % 100 >= REARRANGED:
        return n, "plain", None, None, stored
    a, b = sorted((first % (n + 1), second % (n + 1)))
    form = "spm" if order % 100 < SPM else "psm"
    ranges = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
    out = []
    for mark in ORDER[form]:
        out += [_frame(mark), *cut(stored, *ranges[mark])]
    return n, form, a, b - a, out


def streamed(frames: Iterable[Frame]) -> Iterator[str]:
    """The text of frames, in order, one frame at a time."""
    return map(_open, frames)


def rebuilt(frames: list[Frame], form: str) -> Iterator[str]:
    """The text that the output of a form was made from, piece by piece."""
    if form == "plain":
        yield from streamed(frames)
        return
    marks, found, at, tail = ORDER[form], [], 0, ""
    for piece in streamed(frames):
        seen = tail + piece
        while len(found) < len(marks):
            k = seen.find(marks[len(found)], max(0, found[-1] - at + len(tail)) if found else 0)
            if k < 0:
                break
            found.append(at - len(tail) + k)
        at += len(piece)
        tail = seen[-(len(PREFIX) - 1) :]
    ends = [*found[1:], at]
    parts = {mark: cut(frames, lo + len(mark), hi) for mark, lo, hi in zip(marks, found, ends)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from streamed(parts[mark])


def digest(pieces: Iterable[str]) -> str:
    """Lower-case hex sha256 of a text in UTF-8, given in pieces."""
    total = hashlib.sha256()
    for piece in pieces:
        total.update(piece.encode())
    return total.hexdigest()


def fill_in_middle(documents: DataFrame, key: str = "doc_id", body: str = "text", units: int = FRAME_UNITS) -> DataFrame:
    """``key``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``frames``, the
    rearranged text, of each row; the counts are code points, null for ``plain``."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn, texts = batch.column(1).to_pylist(), batch.column(2)
            for lo, hi, data, at in text.pieces(texts):
                raw = data.tobytes()
                bounds = at.tolist()
                bodies = [raw[x:y].decode() for x, y in zip(bounds, bounds[1:])]
                n, form, prefix, middle, frames = zip(*map(rearranged, drawn[lo:hi], bodies, [units] * len(bodies)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[lo:hi],
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array([[{"units": u, "data": d} for u, d in f] for f in frames], _FRAMES),
                    ],
                    ["key", "n", "form", "prefix_chars", "middle_chars", "frames"],
                )

    rows = documents.select(
        F.col(key).alias("key"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("drawn"), F.col(body).alias("body")
    )
    out = rows.mapInArrow(run, f"key {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, frames {FRAMES}")
    return out.withColumnRenamed("key", key)


def digests(filled: DataFrame, key: str = "doc_id") -> DataFrame:
    """``fill_in_middle``'s rows with ``output_sha256`` and ``restored_sha256`` in the
    place of ``frames``: of the output, and of the text rebuilt from it and its form."""
    kind = filled.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outputs, restored = [], []
            for form, frames in zip(batch.column(2).to_pylist(), batch.column(5).to_pylist()):
                own = [(f["units"], f["data"]) for f in frames]
                outputs.append(digest(streamed(own)))
                restored.append(digest(rebuilt(own, form)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(outputs, pa.string()), pa.array(restored, pa.string())],
                ["key", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
            )

    rows = filled.select(F.col(key).alias("key"), "n", "form", "prefix_chars", "middle_chars", "frames")
    schema = f"key {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
